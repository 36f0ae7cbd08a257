"""Messages and rows made from the ``events`` test table, by fixed rules.

``events`` holds one record per ``event_id``.  A hundred ids in a row make one
message, so a message is bounded by the key's uniqueness.  Faults are injected
by remainder of the id or the sequence, which keeps every count in reach of
plain SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.functions.text import rfc3339
from recordlake.operators.decode import BATCH, EVENT
from recordlake.schema import COLUMNS, PARTITION_COLUMNS, RAW_SCHEMA
from recordlake.sinks.lake import laid_out, lake_path, write_lake
from recordlake.sources.raw import raw_table

PER_MESSAGE = 100
SUBJECT = "rec.v1.ledger"
AUDIT_SUBJECT = "rec.v1.audit"
STREAM = "LEDGER"
AUDIT_STREAM = "AUDIT"

#: Parts older than this were written before ``execution_subject`` was a column.
BOUNDARY = "2024-01-16"


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def with_faults(events: DataFrame) -> DataFrame:
    """Adds the sequence, position, message kind and fault flags every rule below is built on."""
    placed = events.selectExpr(
        "*",
        f"event_id div {PER_MESSAGE} + 1 AS seq",
        f"CAST(event_id % {PER_MESSAGE} AS INT) AS idx",
        "event_id % 89 = 0 AS f_bad",
        "event_id % 97 = 0 AS f_noid",
        "event_id % 101 = 0 AS f_notime",
    )
    kind = """CASE
      WHEN seq % 25 = 0 THEN 'garbage'
      WHEN seq % 40 = 7 THEN 'empty'
      WHEN seq % 40 = 13 THEN 'wrong_envelope'
      ELSE 'batch'
    END"""
    return placed.selectExpr("*", f"{kind} AS kind")


# The lake columns an event carries, as SQL over ``events``; the others are absent.
CARRIED = {
    "event_id": "concat('ev-', event_id)",
    "time": "ts",
    "tenant": "concat('tenant-', user_id % 7)",
    "app": "if(user_id % 11 = 0, '', event_type)",
    "feature": "event_type",
    "run_id": "concat('run-', user_id)",
    "tags_json": """concat('{"k":"', get_json_object(props, '$.k'), '"}')""",
    "input_tokens": "CAST(get_json_object(props, '$.k') AS BIGINT)",
    "output_tokens": "event_id % 500",
    "cost_usd": "value",
    "latency_ms": "event_id % 1000",
    "outcome": "if(event_type = 'error', 'error', 'ok')",
    "principal_subject": "concat('user:', user_id)",
    "chain_depth": "CAST(user_id % 4 AS INT)",
    "error_detail": "if(event_type = 'error', concat('user ', user_id, ' not found'), '')",
    "execution_subject": "if(user_id % 3 = 0, concat('runner:', user_id % 5), '')",
}


def _event_text(extra: bool) -> str:
    """One event as JSON text, with its fault if it has one; ``extra`` adds a field no column takes to some."""
    c = CARRIED
    text = lambda name, value: f"""',"{name}":"', {value}, '"'"""
    number = lambda name, value: f"""',"{name}":', CAST({value} AS STRING)"""
    pieces = [
        f"""'{{"event_id":"', if(f_noid AND NOT f_bad, '', {c["event_id"]}), '"'""",
        f"""if(f_notime AND NOT f_bad AND NOT f_noid, '', concat({text("time", rfc3339(c["time"]))}))""",
        *(text(name, c[name]) for name in ("tenant", "app", "feature", "run_id")),
        f"""',"tags":', {c["tags_json"]}""",
        f"""',"usage":{{"input_tokens":', {c["input_tokens"]}, ',"output_tokens":', {c["output_tokens"]}, '}}'""",
        f"""',"cost_usd":', if(f_bad, '"zz"', CAST({c["cost_usd"]} AS STRING))""",
        number("latency_ms", c["latency_ms"]),
        *(text(name, c[name]) for name in ("outcome", "principal_subject")),
        number("chain_depth", c["chain_depth"]),
        text("error_detail", c["error_detail"]),
        f"""if(ts < TIMESTAMP_NTZ '{BOUNDARY}', '', concat({text("execution_subject", c["execution_subject"])}))""",
        """if(event_id % 10 = 0, ',"region":"eu"', '')""" if extra else "''",
        "'}'",
    ]
    return f"concat({', '.join(pieces)})"


def raw_messages(spark: SparkSession, sf_dir: str, envelope: str = BATCH, extra: bool = False) -> DataFrame:
    """The test events as messages in ``RAW_SCHEMA``.

    With the batch envelope a hundred events share a message; with the event
    envelope every event is its own message and no grouping is needed.
    """
    events = with_faults(events_table(spark, sf_dir)).selectExpr(
        "seq", "idx", "kind", "ts", "event_id AS id", f"{_event_text(extra)} AS text"
    )
    if envelope == EVENT:
        return events.select(
            F.lit(AUDIT_STREAM).alias("stream"),
            F.concat(F.lit(f"{AUDIT_SUBJECT}.tenant-"), (F.col("seq") % 7).cast("string"), F.lit(".svc")).alias("subject"),
            (F.col("id") + 1).alias("seq"),
            F.col("ts").alias("published_at"),
            F.encode("text", "UTF-8").alias("payload"),
        )
    messages = events.groupBy("seq", "kind").agg(
        F.max("ts").alias("published_at"),
        F.array_sort(F.collect_list(F.struct("idx", "text"))).alias("events"),
    )
    texts = F.col("events.text")
    payload = (
        F.when(F.col("kind") == "garbage", "not json")
        .when(F.col("kind") == "empty", "{}")
        .when(F.col("kind") == "wrong_envelope", texts[0])
        .otherwise(F.concat(F.lit('{"events":['), F.array_join(texts, ","), F.lit("]}")))
    )
    return messages.select(
        F.lit(STREAM).alias("stream"),
        F.concat(F.lit(f"{SUBJECT}.tenant-"), (F.col("seq") % 7).cast("string"), F.lit(".svc")).alias("subject"),
        "seq",
        "published_at",
        F.encode(payload, "UTF-8").alias("payload"),
    ).select(*RAW_SCHEMA.fieldNames())


#: Sequences of the messages that hold no events at all, beside those that hold the table's.
EXTRA_FROM = 1_000_000_000


def whole_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every test event in a good message of its hundred; faults come beside them and take no event's place.

    Each message ends with four faulty events more, and behind every tenth one comes a message that is no JSON.
    """
    placed = events_table(spark, sf_dir).selectExpr(
        "*",
        f"event_id div {PER_MESSAGE} + 1 AS seq",
        f"CAST(event_id % {PER_MESSAGE} AS INT) AS idx",
        *(f"false AS {flag}" for flag in ("f_bad", "f_noid", "f_notime")),
    )
    texts = placed.selectExpr("seq", "idx", "ts", f"{_event_text(False)} AS text")
    whole = texts.groupBy("seq").agg(F.max("ts").alias("published_at"), F.array_sort(F.collect_list(F.struct("idx", "text"))).alias("events"))
    faults = """array(
      concat('{"event_id":"","n":', seq, '}'),
      concat('{"event_id":"x-', seq, '"}'),
      concat('{"event_id":"y-', seq, '","time":"2024-01-01T00:00:00Z","cost_usd":"zz"}'),
      concat('{"event_id":"z-', seq, '","time":"2024-01-01T00:00:00Z","tenant":{"n":', seq, '}}'))"""
    payload = f"""concat('{{"events":[', array_join(concat(events.text, {faults}), ','), ']}}')"""
    named = [F.lit(STREAM).alias("stream"), F.concat(F.lit(f"{SUBJECT}.tenant-"), (F.col("seq") % 7).cast("string"), F.lit(".svc")).alias("subject")]
    good = whole.select(*named, "seq", "published_at", F.encode(F.expr(payload), "UTF-8").alias("payload"))
    beside = whole.filter("seq % 10 = 0").select(
        *named, (F.col("seq") + EXTRA_FROM).alias("seq"), "published_at", F.encode(F.lit("not json"), "UTF-8").alias("payload")
    )
    return good.unionByName(beside)


def kinds_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every test event as a message of its own, with values of every kind where texts are due."""
    field = """CASE event_id % 9
      WHEN 0 THEN concat('"tenant":"', user_id, '"')
      WHEN 1 THEN concat('"tenant":{"x":', user_id, '}')
      WHEN 2 THEN concat('"tenant" : [', user_id, ']')
      WHEN 3 THEN concat('"tenant":', user_id)
      WHEN 4 THEN concat('"tags":{"k":"1","n":', user_id, '}')
      WHEN 5 THEN concat('"policy_violations":["a",', user_id, ']')
      WHEN 6 THEN '"tenant":false'
      WHEN 7 THEN concat('"tenant":"{\\\\"x\\\\":', user_id, '}","tags":{"k":"', user_id, '"}')
      ELSE '"tenant":null'
    END"""
    text = f"""concat('{{"event_id":"ev-', event_id, '","time":"', {rfc3339("ts")}, '",', {field}, '}}')"""
    return events_table(spark, sf_dir).select(
        F.lit(AUDIT_STREAM).alias("stream"),
        F.lit(AUDIT_SUBJECT).alias("subject"),
        (F.col("event_id") + 1).alias("seq"),
        F.col("ts").alias("published_at"),
        F.encode(F.expr(text), "UTF-8").alias("payload"),
    )


def odd_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every test event in messages that are spaced and spelled oddly: two of five events are good, in any spacing."""
    event = lambda *fields: "concat('{ ', " + ", ' ,\n ', ".join(fields) + ", ' }')"
    named = """concat('"event_id" : "ev-', event_id, '"')"""
    timed = f"""concat('"time" :"', {rfc3339("ts")}, '"')"""
    number = """'"cost_usd" : 0.12345678901234567890123'"""
    text = f"""CASE event_id % 5
      WHEN 0 THEN {event(named, timed, number, """'"feature" : "a [,] {{ b "'""")}
      WHEN 1 THEN {event("""'"event_id":""'""", "concat('\"n\":', event_id)", number)}
      WHEN 2 THEN {event(named, """'"tags":{{"k":"1","k":"2"}}'""")}
      WHEN 3 THEN concat('"{{', event_id, ' ]}}"')
      ELSE {event(named, timed, """'"more":[{{"x":[1, {{}}]}},"]"]'""")}
    END""".replace("{{", "{").replace("}}", "}")
    placed = with_faults(events_table(spark, sf_dir)).selectExpr("seq", "idx", "ts", f"{text} AS text")
    whole = placed.groupBy("seq").agg(F.max("ts").alias("published_at"), F.array_sort(F.collect_list(F.struct("idx", "text"))).alias("events"))
    payload = F.concat(F.lit('{ "events" : [\n'), F.array_join(F.col("events.text"), " ,\r\n\t"), F.lit(" ] }"))
    return whole.select(
        F.lit(STREAM).alias("stream"), F.lit(SUBJECT).alias("subject"), "seq", "published_at", F.encode(payload, "UTF-8").alias("payload")
    )


def doubled_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every test event as a message of its own; three of four hold a key twice, at the top or below."""
    text = """CASE event_id % 4
      WHEN 0 THEN concat('{"event_id":"ev-', event_id, '","tenant":"', user_id, '","usage":{"input_tokens":', event_id, '}}')
      WHEN 1 THEN concat('{"event_id":"ev-', event_id, '" , "event_id":"ev-', event_id, '","surprise":[', event_id, '],"usage":{"input_tokens":1}}')
      WHEN 2 THEN concat('{ "event_id":"{,', event_id, '","usage":{"input_tokens" : 1, "input_tokens":"', event_id, '","more":0.5}}')
      ELSE concat('{"event_id":"ev-', event_id, '","event_id":', event_id, ',"usage":"none","meta":{"surprise":true}}')
    END"""
    return events_table(spark, sf_dir).select(
        F.lit(AUDIT_STREAM).alias("stream"),
        F.lit(AUDIT_SUBJECT).alias("subject"),
        (F.col("event_id") + 1).alias("seq"),
        F.col("ts").alias("published_at"),
        F.encode(F.expr(text), "UTF-8").alias("payload"),
    )


def redelivered(raw: DataFrame) -> DataFrame:
    """Every message once, and those with ``seq % 10 = 3`` a second time, unchanged."""
    return raw.unionAll(raw.filter(F.col("seq") % 10 == 3))


def land(spark: SparkSession, raw: DataFrame, path: str) -> DataFrame:
    """Messages written to a landing table in sequence order, so that a range of them is a few row groups."""
    raw.repartitionByRange("seq").sortWithinPartitions("seq").write.mode("overwrite").parquet(path)
    return raw_table(spark, path)


def write_vintages(spark: SparkSession, sf_dir: str, root: str) -> None:
    """The test rows as a lake of two vintages: parts from before the boundary lack ``execution_subject``."""
    rows = lake_rows(spark, sf_dir)
    recent = F.col("time") >= F.lit(BOUNDARY).cast("timestamp_ntz")
    older = laid_out(rows.filter(~recent)).drop("execution_subject")
    older.write.mode("append").partitionBy(*PARTITION_COLUMNS).parquet(lake_path(root, "ledger"))
    write_lake(rows.filter(recent), root, "ledger")


def write_redelivered(spark: SparkSession, sf_dir: str, root: str) -> None:
    """The test rows as a lake that took some messages twice: one append for each delivery."""
    rows = lake_rows(spark, sf_dir)
    number = F.expr(f"cast(substring(event_id, 4) as bigint) div {PER_MESSAGE} + 1")
    write_lake(rows, root, "ledger")
    write_lake(rows.filter(number % 10 == 3), root, "ledger")


def lake_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every test event as a lake row, without going through messages: absent columns at their zero values."""
    zero = {"string": "''", "bigint": "0", "int": "0", "double": "0", "boolean": "false"}
    lists = {"policy_violations", "compartments_effective"}
    cells = []
    for c in COLUMNS:
        kind = c.dtype.simpleString()
        value = CARRIED.get(c.name, "'[]'" if c.name in lists else zero.get(kind))
        cells.append(f"CAST({value} AS {kind}) AS {c.name}")
    return events_table(spark, sf_dir).selectExpr(*cells)
