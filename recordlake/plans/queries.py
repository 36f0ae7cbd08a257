"""The queries the engine is checked by: every operator, run over the whole ``events`` table.

Messages, lakes and drained lakes are made from the table once per session and
kept in the shared folder; each query then reads them the way a user would.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import recordlake as rl
from recordlake.schema import DEAD_SCHEMA
from recordlake.session import scratch_path
from recordlake.sources import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]

#: The moment tails by age and retention look back from, and how far.
NOW = dt.datetime(2024, 1, 30, 12, 0, 0)
AGE = "36h"
WEEK = dt.timedelta(days=7)
LAST = 20

#: Byte budget of the retention queries: about half of what the test messages take at sf0.01.
BUDGET = 1_500_000

#: How long the streamed query for duplicates remembers an id: longer than it runs.
WINDOW = "1 hour"
#: Limits the policy query holds the test messages against; the first two are outgrown.
HELD_POLICY = {"subjects": f"{fx.SUBJECT}.>", "max_age": "604800", "max_bytes": str(BUDGET), "max_msgs": "-1"}

_made: dict[tuple[str, str, str], str] = {}


def _derived(spark: SparkSession, sf_dir: str, name: str, make: Callable[[str], object]) -> str:
    """The path of a derived table, made on its first use in this session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _made:
        path = scratch_path(spark, name)
        make(path)
        _made[key] = path
    return _made[key]


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing table of ledger messages."""
    path = _derived(spark, sf_dir, "ledger-raw", lambda p: fx.land(spark, fx.raw_messages(spark, sf_dir), p))
    return rl.raw_table(spark, path)


def audit_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing table of audit messages, one event each."""
    path = _derived(spark, sf_dir, "audit-raw", lambda p: fx.land(spark, fx.raw_messages(spark, sf_dir, rl.EVENT), p))
    return rl.raw_table(spark, path)


def drifting_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing table of messages in which some events carry a field no column takes."""
    path = _derived(
        spark, sf_dir, "drift-raw", lambda p: fx.land(spark, fx.raw_messages(spark, sf_dir, extra=True), p)
    )
    return rl.raw_table(spark, path)


def twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger messages with some delivered a second time."""
    return fx.redelivered(messages(spark, sf_dir))


def lake(spark: SparkSession, sf_dir: str, **read) -> DataFrame:
    """The lake of two vintages."""
    root = _derived(spark, sf_dir, "lake", lambda p: fx.write_vintages(spark, sf_dir, p))
    return rl.read_lake(spark, root, "ledger", **read)


def lake_with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lake that took some messages twice."""
    root = _derived(spark, sf_dir, "lake-copies", lambda p: fx.write_redelivered(spark, sf_dir, p))
    return rl.read_lake(spark, root, "ledger")


def drained(spark: SparkSession, sf_dir: str) -> str:
    """The folder a drain of the ledger messages filled: ``lake``, ``dead`` and ``flushes``."""

    def make(root: str) -> None:
        landing = _derived(spark, sf_dir, "ledger-raw", lambda p: fx.land(spark, fx.raw_messages(spark, sf_dir), p))
        query = rl.drain(
            rl.raw_stream(spark, landing),
            rl.BATCH,
            lake=f"{root}/lake",
            dead=f"{root}/dead",
            checkpoint=f"{root}/checkpoint",
            flush_log=f"{root}/flushes",
            available_now=True,
        )
        query.awaitTermination()

    return _derived(spark, sf_dir, "drained", make)


#: Rows after which the row-bounded drain flushes.
FLUSH_ROWS = 2_000


def flushed_by_rows(spark: SparkSession, sf_dir: str) -> str:
    """The flush log of a drain that took all messages as one batch and flushed by rows."""

    def make(root: str) -> None:
        landing = _derived(spark, sf_dir, "ledger-raw", lambda p: fx.land(spark, fx.raw_messages(spark, sf_dir), p))
        rl.drain(
            rl.raw_stream(spark, landing, max_files=None),
            rl.BATCH,
            lake=f"{root}/lake",
            dead=f"{root}/dead",
            checkpoint=f"{root}/checkpoint",
            flush_log=f"{root}/flushes",
            available_now=True,
            max_rows=FLUSH_ROWS,
        ).awaitTermination()

    return f"{_derived(spark, sf_dir, 'flushed-by-rows', make)}/flushes"


def recorded(spark: SparkSession, sf_dir: str) -> str:
    """A folder with the messages landed in three deliveries (``raw``), each drained as it came by two drains into one lake with a ``manifest``."""

    def make(root: str) -> None:
        raw = messages(spark, sf_dir)
        last = raw.agg(F.max("seq")).first()[0]
        third = F.expr(f"CASE WHEN seq <= {last} div 3 THEN 0 WHEN seq <= 2 * {last} div 3 THEN 1 ELSE 2 END")
        for i in range(3):
            raw.filter(third == i).write.mode("append").parquet(f"{root}/raw")
            for origin in ("ledger", "again"):
                rl.drain(
                    rl.raw_stream(spark, f"{root}/raw", max_files=None),
                    rl.BATCH,
                    lake=f"{root}/lake",
                    dead=f"{root}/dead",
                    checkpoint=f"{root}/checkpoint-{origin}",
                    origin=origin,
                    manifest=f"{root}/manifest",
                    available_now=True,
                ).awaitTermination()

    return _derived(spark, sf_dir, "recorded", make)


def whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing table in which every event of the table is a good one of some message, and faults are extras."""
    path = _derived(spark, sf_dir, "whole-raw", lambda p: fx.land(spark, fx.whole_messages(spark, sf_dir), p))
    return rl.raw_table(spark, path)


class StoreDown(Exception):
    """What the writers of the redelivery queries fail with, once each."""


def redelivered_drain(spark: SparkSession, sf_dir: str) -> str:
    """The folder of a drain that failed at its dead letters, then after its rows, and then went through.

    Each attempt takes all messages as one batch.  ``notes`` tells what every attempt found and wrote, in order.
    """

    def make(root: str) -> None:
        landing = _derived(spark, sf_dir, "ledger-raw", lambda p: fx.land(spark, fx.raw_messages(spark, sf_dir), p))
        notes: list[tuple[int, int, str, int]] = []

        def attempt(number: int) -> None:
            def told(what: str, n: int) -> None:
                notes.append((number, len(notes), what, n))

            def dead(letters: DataFrame, batch_id: int) -> None:
                told("dead", letters.count())
                if number == 1:
                    raise StoreDown("dead letters")
                rl.write_dead(letters, f"{root}/dead", origin="ledger")

            def rows(found: DataFrame, batch_id: int) -> None:
                told("rows", found.count())
                rl.write_lake(found, f"{root}/lake", "ledger")
                if number == 2:
                    raise StoreDown("rows")

            query = rl.drain(
                rl.raw_stream(spark, landing, max_files=None),
                rl.BATCH,
                lake=rows,
                dead=dead,
                checkpoint=f"{root}/checkpoint",
                flush_log=f"{root}/flushes",
                available_now=True,
            )
            try:
                query.awaitTermination()
            except StreamingQueryException as failed:
                if StoreDown.__name__ not in str(failed):
                    raise
            told("flushes", rl.read_flushes(spark, f"{root}/flushes").count())

        for number in (1, 2, 3):
            attempt(number)
        spark.createDataFrame(notes, "attempt int, step int, what string, n long").write.parquet(f"{root}/notes")

    return _derived(spark, sf_dir, "redelivered", make)


def _readable(df: DataFrame) -> DataFrame:
    """Payload bytes as text, for comparison."""
    return df.withColumn("payload", F.col("payload").cast("string"))


def raw_scan(spark, sf_dir):
    return _readable(messages(spark, sf_dir))


def decode_batch_rows(spark, sf_dir):
    return rl.to_rows(rl.decode(messages(spark, sf_dir), rl.BATCH))


def decode_rejects(spark, sf_dir):
    return _readable(rl.with_rendered(rl.to_rejects(rl.decode(messages(spark, sf_dir), rl.BATCH))))


def decode_event_envelope(spark, sf_dir):
    return rl.to_rows(rl.decode(audit_messages(spark, sf_dir), rl.EVENT))


def decode_event_rejects(spark, sf_dir):
    return _readable(rl.with_rendered(rl.to_rejects(rl.decode(audit_messages(spark, sf_dir), rl.EVENT))))


def message_dispositions(spark, sf_dir):
    return rl.dispositions(messages(spark, sf_dir), rl.BATCH)


def flush_stats(spark, sf_dir):
    return rl.flush_stats(rl.decode(messages(spark, sf_dir), rl.BATCH, keep_empty=True))


def subject_filter(spark, sf_dir):
    wanted = rl.filter_subject(messages(spark, sf_dir), f"{fx.SUBJECT}.tenant-3.>")
    return rl.subject_parts(wanted, fx.SUBJECT).select("seq", "subject", "subject_tenant", "subject_app")


def dead_letters(spark, sf_dir):
    return _readable(rl.to_dead(rl.to_rejects(rl.decode(messages(spark, sf_dir), rl.BATCH)), "ledger"))


def dead_letters_once(spark, sf_dir):
    rejects = rl.to_rejects(rl.decode(twice(spark, sf_dir), rl.BATCH))
    return _readable(rl.distinct_dead(rl.to_dead(rejects, "ledger")))


def dead_letters_retried(spark, sf_dir):
    """The drained dead-letter table after the whole stream has been dead-lettered a second time."""

    def make(path: str) -> None:
        letters = rl.to_dead(rl.to_rejects(rl.decode(messages(spark, sf_dir), rl.BATCH)), "ledger")
        rl.write_dead(letters, path)
        rl.write_dead(letters, path)

    path = _derived(spark, sf_dir, "dead-retried", make)
    return _readable(rl.read_dead(spark, path).select(*DEAD_SCHEMA.fieldNames()))


def _dead_of(raw: DataFrame) -> DataFrame:
    return rl.to_dead(rl.to_rejects(rl.decode(raw, rl.BATCH)), "ledger")


def dead_letters_unknown_seq(spark, sf_dir):
    """Every event as a message that is no JSON and whose sequence is not known, dead-lettered twice."""

    def make(path: str) -> None:
        text = F.concat(F.lit("event "), F.col("event_id").cast("string"))
        unknown = F.when(F.col("event_id") % 2 == 0, F.lit(0)).cast("bigint")
        told = fx.events_table(spark, sf_dir).select(
            F.lit(fx.STREAM).alias("stream"),
            F.lit(fx.SUBJECT).alias("subject"),
            unknown.alias("seq"),
            F.col("ts").alias("published_at"),
            F.encode(text, "UTF-8").alias("payload"),
        )
        for _ in range(2):
            rl.write_dead(_dead_of(told), path, (None, None), "ledger")

    held = _readable(rl.read_dead(spark, _derived(spark, sf_dir, "dead-unknown", make)))
    return held.select("origin", "reason", "stream", "sequence", "payload")


def dead_letters_recreated(spark, sf_dir):
    """The dead letters of a stream and of its successor, whose sequences start again with other bytes."""

    def make(path: str) -> None:
        first = messages(spark, sf_dir).withColumn("payload", F.encode(F.concat(F.lit("old "), F.col("seq").cast("string")), "UTF-8"))
        again = first.withColumn("payload", F.encode(F.concat(F.lit("new "), F.col("seq").cast("string")), "UTF-8"))
        for raw in (first, again, first):
            rl.write_dead(_dead_of(raw), path, origin="ledger")

    held = _readable(rl.read_dead(spark, _derived(spark, sf_dir, "dead-recreated", make)))
    return held.select("msg_id", "origin", "reason", "stream", "sequence", "payload")


def lake_roundtrip(spark, sf_dir):
    return lake(spark, sf_dir)


def lake_totals(spark, sf_dir):
    return rl.lake_totals(lake(spark, sf_dir))


def lake_pruned_count(spark, sf_dir):
    return rl.partition_count(lake(spark, sf_dir), "2024-01-10", "click")


def lake_any_value(spark, sf_dir):
    one = lake(spark, sf_dir).filter((F.col("tenant") == "tenant-3") & (F.col("app") == "click"))
    return rl.any_tenant_app(one)


def lake_empty_app(spark, sf_dir):
    return lake(spark, sf_dir).filter(F.col("app") == "").select("event_id", "app", "tenant")


def lake_projection(spark, sf_dir):
    return rl.ids_in_order(lake(spark, sf_dir))


def lake_strict(spark, sf_dir):
    narrow = lake(spark, sf_dir, columns=["event_id", "tenant", "app", "date", "cost_usd"], strict=True)
    return narrow.groupBy("tenant").agg(F.count("*").alias("rows"), F.round(F.sum("cost_usd"), 2).alias("cost_usd"))


def lake_parts_lacking(spark, sf_dir):
    """The partitions whose parts lack a column, by their footers: those of the older vintage."""
    root = _derived(spark, sf_dir, "lake", lambda p: fx.write_vintages(spark, sf_dir, p))
    lacking = rl.parts_lacking(spark, root, "ledger").select("part", F.explode("columns").alias("column"))
    folder = lambda key: F.regexp_extract("part", f"/{key}=([^/]*)/", 1)
    app = F.when(folder("app") == "__HIVE_DEFAULT_PARTITION__", "").otherwise(folder("app"))
    return lacking.select(folder("date").cast("date").alias("date"), app.alias("app"), "column").distinct()


def lake_parts(spark, sf_dir):
    root = _derived(spark, sf_dir, "lake", lambda p: fx.write_vintages(spark, sf_dir, p))
    parts = rl.lake_parts(spark, root, "ledger")
    return parts.groupBy("date", "app").agg(
        F.sum("rows").alias("rows"), F.min("first_time").alias("first_time"), F.max("last_time").alias("last_time")
    )


def lake_dedupe(spark, sf_dir):
    return rl.dedupe(lake_with_copies(spark, sf_dir))


def lake_dedupe_usage(spark, sf_dir):
    return rl.usage_by_tenant_day(rl.dedupe(lake_with_copies(spark, sf_dir)))


def lake_views(spark, sf_dir):
    rl.register_views(spark, lake_with_copies(spark, sf_dir), "ledger")
    return spark.sql("SELECT app, count(*) AS rows, sum(input_tokens) AS input_tokens FROM ledger_deduped GROUP BY app")


def schema_evolution(spark, sf_dir):
    return lake(spark, sf_dir).select("event_id", "execution_subject")


def execution_provenance(spark, sf_dir):
    return rl.with_provenance(lake(spark, sf_dir)).select("event_id", "principal_subject", "execution_subject", "provenance")


def provenance_counts(spark, sf_dir):
    return rl.provenance_counts(lake(spark, sf_dir))


def tags_lookup(spark, sf_dir):
    opened = rl.list_items(rl.tag(lake(spark, sf_dir), "k"), "policy_violations")
    return opened.select("event_id", "k", F.size("policy_violations_items").cast("long").alias("violations"))


def _tail(spark, sf_dir, **options):
    return rl.tail_rows(messages(spark, sf_dir), rl.BATCH, stream=fx.STREAM, **options)


_SHOWN = ("seq", "idx", "event_id", "time", "tenant", "app", "outcome", "input_tokens", "cost_usd")


def tail_last_n(spark, sf_dir):
    return _tail(spark, sf_dir, since=LAST).select(*_SHOWN)


def tail_last_n_by_zones(spark, sf_dir):
    """The last messages of a stream by its zone map, which was recorded twice while messages landed."""

    def make(root: str) -> None:
        raw = messages(spark, sf_dir)
        for side in (F.col("seq") % 3 == 0, F.col("seq") % 3 != 0):
            raw.filter(side).write.mode("append").parquet(f"{root}/raw")
            rl.record_zones(spark, f"{root}/raw", f"{root}/zones")

    root = _derived(spark, sf_dir, "zoned", make)
    raw, zones = rl.raw_table(spark, f"{root}/raw"), rl.read_zones(spark, f"{root}/zones")
    return rl.tail_rows(raw, rl.BATCH, stream=fx.STREAM, since=LAST, zones=zones).select(*_SHOWN)


def tail_last_n_of_subject(spark, sf_dir):
    return _tail(spark, sf_dir, since=LAST, subject=f"{fx.SUBJECT}.tenant-3.>").select(*_SHOWN)


def tail_since_age(spark, sf_dir):
    return _tail(spark, sf_dir, since=AGE, now=NOW).select(*_SHOWN)


def tail_from_start(spark, sf_dir):
    return _tail(spark, sf_dir, from_start=True).select(*_SHOWN)


def tail_filtered(spark, sf_dir):
    return _tail(spark, sf_dir, from_start=True, filters=["outcome=error", "chain_depth=2"]).select(*_SHOWN)


def tail_no_detail(spark, sf_dir):
    shown = rl.tail(messages(spark, sf_dir), rl.BATCH, since=LAST, filters=["outcome=error"], no_detail=True)
    return shown.lines


def tail_json_lines(spark, sf_dir):
    return rl.tail(messages(spark, sf_dir), rl.BATCH, from_start=True).lines


def tail_pretty(spark, sf_dir):
    return rl.tail(messages(spark, sf_dir), rl.BATCH, since=LAST, pretty=True).lines


def tail_unreadable(spark, sf_dir):
    return rl.tail(messages(spark, sf_dir), rl.BATCH, from_start=True).unreadable


def tail_follow(spark, sf_dir):
    """The lines a followed tail has shown once it has caught up."""

    def make(root: str) -> None:
        landing = _derived(spark, sf_dir, "ledger-raw", lambda p: fx.land(spark, fx.raw_messages(spark, sf_dir), p))
        lines = rl.tail_stream(spark, landing, rl.BATCH, since=LAST, filters=["outcome=ok"])
        writer = lines.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint")
        writer.trigger(availableNow=True).start(f"{root}/lines").awaitTermination()

    return spark.read.schema("seq bigint, idx int, line string").parquet(_derived(spark, sf_dir, "followed", make) + "/lines")


def drain_available_now(spark, sf_dir):
    return rl.read_lake(spark, f"{drained(spark, sf_dir)}/lake", "ledger")


def drain_dead_letters(spark, sf_dir):
    return _readable(rl.read_dead(spark, f"{drained(spark, sf_dir)}/dead"))


def drain_flush_log(spark, sf_dir):
    log = rl.read_flushes(spark, f"{drained(spark, sf_dir)}/flushes")
    return log.agg(
        F.min("first_seq").alias("first_seq"),
        F.max("last_seq").alias("last_seq"),
        F.sum("messages").alias("messages"),
        F.sum("rows").alias("rows"),
        F.sum("rejects").alias("rejects"),
    )


def drain_row_bounded(spark, sf_dir):
    return rl.read_flushes(spark, flushed_by_rows(spark, sf_dir)).select("flush_id", "first_seq", "last_seq", "messages", "rows", "rejects")


def part_to_messages(spark, sf_dir):
    root = recorded(spark, sf_dir)
    held = rl.part_to_messages(rl.read_manifest(spark, f"{root}/manifest"), rl.raw_table(spark, f"{root}/raw"), rl.BATCH)
    return held.select("origin", "flush", "date", "app", "seq", "rows").distinct()


def decode_odd_messages(spark, sf_dir):
    """Every event of spaced and oddly spelled messages: the id of a row, the reason and the very text of a reject."""
    path = _derived(spark, sf_dir, "odd-raw", lambda p: fx.land(spark, fx.odd_messages(spark, sf_dir), p))
    decoded = rl.decode(rl.raw_table(spark, path), rl.BATCH)
    rows = rl.to_rows(decoded, "seq", "idx").select("seq", "idx", "event_id", F.lit("").alias("reason"), F.lit("").alias("text"))
    bad = rl.to_rejects(decoded).select("seq", "idx", F.lit("").alias("event_id"), "reason", F.col("payload").cast("string").alias("text"))
    return rows.unionAll(bad)


def tail_follow_unreadable(spark, sf_dir):
    """Both outputs of a follow that was stopped half-way and started again."""

    def make(root: str) -> None:
        raw = messages(spark, sf_dir)
        for half in (F.col("seq") % 2 == 0, F.col("seq") % 2 == 1):
            raw.filter(half).write.mode("append").parquet(f"{root}/raw")
            rl.follow(
                spark,
                f"{root}/raw",
                rl.BATCH,
                lines=f"{root}/lines",
                unreadable=f"{root}/unreadable",
                checkpoint=f"{root}/checkpoint",
                from_start=True,
                filters=["outcome=ok"],
                available_now=True,
            ).awaitTermination()

    root = _derived(spark, sf_dir, "followed-both", make)
    lines = spark.read.schema("seq bigint, idx int, line string").parquet(f"{root}/lines")
    notes = spark.read.schema("subject string, seq bigint, idx int, message string").parquet(f"{root}/unreadable")
    told = lines.select(F.lit("line").alias("kind"), "seq", "idx", F.col("line").alias("told"))
    return told.unionAll(notes.select(F.lit("unreadable"), "seq", "idx", "message"))


def duplicate_ids_stream(spark, sf_dir):
    """Messages by the ids of their publishers, over a restart: copies under other sequences, and some without id or sequence."""

    def make(root: str) -> None:
        raw = messages(spark, sf_dir).withColumn("message_id", F.concat(F.lit("m-"), F.col("seq").cast("string")))
        on = lambda r: raw.filter(F.col("seq") % 10 == r)
        bare = F.lit(None).cast("string")
        copies = on(3).withColumn("seq", F.col("seq") + 1_000_000)
        zero = on(4).withColumn("seq", F.lit(0).cast("long")).withColumn("message_id", bare)
        null = on(5).withColumn("seq", F.lit(None).cast("long")).withColumn("message_id", F.lit(""))
        unnamed = on(6).withColumn("message_id", bare)
        again = copies.unionByName(copies).unionByName(zero).unionByName(zero).unionByName(null).unionByName(unnamed).unionByName(unnamed)
        for part in (raw, again):
            part.write.mode("append").parquet(f"{root}/incoming")
            rl.publish_once(
                rl.raw_stream(spark, f"{root}/incoming", message_ids=True),
                f"{root}/landed",
                f"{root}/ids",
                f"{root}/checkpoint",
                window=dt.timedelta(hours=1),
                available_now=True,
            ).awaitTermination()

    landed = rl.raw_table(spark, f"{_derived(spark, sf_dir, 'published', make)}/landed", message_ids=True)
    return _readable(landed).select("stream", "subject", "seq", "published_at", "payload", "message_id")


def _sizes(raw: DataFrame) -> DataFrame:
    return raw.select("seq", "subject", F.length("payload").cast("long").alias("bytes"))


def retain_newest(spark, sf_dir):
    return _sizes(rl.retain_newest(messages(spark, sf_dir), max_bytes=BUDGET))


def retain_by_age(spark, sf_dir):
    return _sizes(rl.retain_newest(messages(spark, sf_dir), max_bytes=BUDGET, max_age=WEEK, now=NOW))


def admit_oldest(spark, sf_dir):
    accepted, refused = rl.admit(messages(spark, sf_dir), BUDGET)
    sides = [_sizes(side).withColumn("accepted", F.lit(name)) for side, name in ((accepted, True), (refused, False))]
    return sides[0].unionAll(sides[1])


#: Byte budgets of two streams in one table: each is outgrown at sf0.01 and above.
BUDGETS = {fx.STREAM: BUDGET, fx.AUDIT_STREAM: BUDGET // 2}


def both_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landing table of the ledger and the audit messages, landed with their sizes."""

    def make(path: str) -> None:
        for part in (messages(spark, sf_dir), audit_messages(spark, sf_dir)):
            rl.with_sizes(part).write.mode("append").parquet(path)

    return rl.raw_table(spark, _derived(spark, sf_dir, "both-streams", make), sizes=True)


def retain_streams(spark, sf_dir):
    kept = rl.retain_newest(both_streams(spark, sf_dir), max_bytes=BUDGETS)
    return kept.select("stream", "seq", F.col("payload_bytes").alias("bytes"))


def admit_streams(spark, sf_dir):
    accepted, refused = rl.admit(both_streams(spark, sf_dir), BUDGETS, held_bytes={fx.AUDIT_STREAM: BUDGET // 4})
    sides = [side.select("stream", "seq", F.lit(name).alias("accepted")) for side, name in ((accepted, True), (refused, False))]
    return sides[0].unionAll(sides[1])


def duplicate_window(spark, sf_dir):
    return _readable(rl.drop_duplicates(twice(spark, sf_dir)))


def duplicate_window_stream(spark, sf_dir):
    """The same on a stream: the newer half lands first, then the older one, then copies from both."""

    def make(root: str) -> None:
        raw = messages(spark, sf_dir)
        middle = raw.agg(F.expr("timestampadd(MICROSECOND, timestampdiff(MICROSECOND, min(published_at), max(published_at)) div 2, min(published_at))"))
        newer = F.col("published_at") >= F.lit(middle.first()[0])
        for part in (raw.filter(newer), raw.filter(~newer), raw.filter(F.col("seq") % 10 == 3)):
            part.write.mode("append").parquet(f"{root}/landing")
            once = rl.drop_duplicates(rl.raw_stream(spark, f"{root}/landing"), window=WINDOW)
            out = once.writeStream.format("parquet").option("path", f"{root}/once").option("checkpointLocation", f"{root}/checkpoint")
            out.trigger(availableNow=True).start().awaitTermination()

    return _readable(rl.raw_table(spark, f"{_derived(spark, sf_dir, 'once', make)}/once"))


def contract_drift(spark, sf_dir):
    observed = rl.observed_fields(drifting_messages(spark, sf_dir), rl.BATCH)
    return rl.contract_drift(observed, {"correlation_id": "set by callers that trace, and none of these does"})


def observed_doubled(spark, sf_dir):
    """The fields of events that hold keys twice."""
    path = _derived(spark, sf_dir, "doubled-raw", lambda p: fx.land(spark, fx.doubled_messages(spark, sf_dir), p))
    return rl.observed_fields(rl.raw_table(spark, path), rl.EVENT)


def policy_diff(spark, sf_dir):
    held = rl.held_policy(messages(spark, sf_dir), "ledger", HELD_POLICY)
    return rl.policy_diff(rl.policy_rows(spark, {"ledger": HELD_POLICY}), held)


def decode_text_kinds(spark, sf_dir):
    """Events with values of every kind where texts are due: rows by their texts, rejects by their bytes."""
    path = _derived(spark, sf_dir, "kinds-raw", lambda p: fx.land(spark, fx.kinds_messages(spark, sf_dir), p))
    decoded = rl.decode(rl.raw_table(spark, path), rl.EVENT)
    rows = rl.to_rows(decoded, "seq").select("seq", "tenant", "tags_json", F.lit("").alias("reason"), F.lit(0).cast("long").alias("bytes"))
    bad = rl.to_rejects(decoded)
    empty = F.lit("")
    return rows.unionAll(bad.select("seq", empty, empty, "reason", F.octet_length("payload").cast("long")))


def decode_whole_rejects(spark, sf_dir):
    """The faults beside the events of the whole landing table."""
    rejects = rl.to_rejects(rl.decode(whole(spark, sf_dir), rl.BATCH))
    return _readable(rejects).select("seq", "idx", "reason", "payload")


def usage_whole_by_tenant_day(spark, sf_dir):
    """Usage of every event of the table, from messages some of which arrived twice."""
    return rl.usage_by_tenant_day(rl.dedupe(rl.to_rows(rl.decode(fx.redelivered(whole(spark, sf_dir)), rl.BATCH))))


def drain_whole(spark, sf_dir):
    """What a drain of the whole landing table put into the lake: all events of the table, whole."""

    def make(root: str) -> None:
        whole(spark, sf_dir)
        landing = _derived(spark, sf_dir, "whole-raw", lambda p: fx.land(spark, fx.whole_messages(spark, sf_dir), p))
        drain = rl.drain(
            rl.raw_stream(spark, landing), rl.BATCH, f"{root}/lake", f"{root}/dead", f"{root}/checkpoint", available_now=True
        )
        drain.awaitTermination()

    return rl.read_lake(spark, f"{_derived(spark, sf_dir, 'whole-drained', make)}/lake", "ledger")


def drain_redelivery(spark, sf_dir):
    """How often every event is in the lake, and every letter kept, after two failed attempts: no gap, and letters once."""
    root = redelivered_drain(spark, sf_dir)
    rows = rl.read_lake(spark, f"{root}/lake", "ledger").groupBy(F.col("event_id").alias("id")).agg(F.count("*").alias("copies"))
    letters = rl.read_dead(spark, f"{root}/dead").groupBy(F.col("msg_id").alias("id")).agg(F.count("*").alias("copies"))
    return rows.select(F.lit("row").alias("kind"), "*").unionAll(letters.select(F.lit("letter"), "*"))


def drain_redelivery_deduped(spark, sf_dir):
    """The usage that readers see after the same attempts."""
    return rl.usage_by_tenant_day(rl.dedupe(rl.read_lake(spark, f"{redelivered_drain(spark, sf_dir)}/lake", "ledger")))


def drain_order(spark, sf_dir):
    """What each of the attempts did, in order: letters before rows, rows before the log."""
    notes = spark.read.schema("attempt int, step int, what string, n long").parquet(f"{redelivered_drain(spark, sf_dir)}/notes")
    return notes.select("attempt", "step", "what", "n")


def drain_rejects_only(spark, sf_dir):
    """The parts of a lake after one flush with rows and one that has nothing but rejects; the latter adds no file."""

    def make(root: str) -> None:
        raw = messages(spark, sf_dir)
        spoilt = raw.withColumn("payload", F.encode(F.concat(F.lit("no "), F.col("seq").cast("string")), "UTF-8"))
        for batch_id, batch in enumerate((raw, spoilt)):
            rl.flush(batch, batch_id, rl.BATCH, f"ledger-{batch_id}", f"{root}/lake", f"{root}/dead", "", f"{root}/flushes")
            files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{root}/lake")
            files.where("path LIKE '%.parquet'").select(F.lit(batch_id).alias("flush"), "path").write.mode("append").parquet(f"{root}/listed")

    root = _derived(spark, sf_dir, "rejects-only", make)
    listed = spark.read.schema("flush int, path string").parquet(f"{root}/listed")
    new = listed.groupBy("path").agg(F.min("flush").alias("flush_id")).groupBy("flush_id").agg(F.count("*").alias("parts"))
    log = rl.read_flushes(spark, f"{root}/flushes").join(new, "flush_id", "left")
    return log.select("flush_id", "rows", "rejects", (F.coalesce("parts", F.lit(0)) > 0).alias("wrote_parts"))


def lake_prefixes(spark, sf_dir):
    """Two streams under one root, each behind its prefix, written by path and read back by URI."""

    def make(root: str) -> None:
        for raw, envelope, prefix in ((messages, rl.BATCH, "ledger"), (audit_messages, rl.EVENT, "audit")):
            rl.write_lake(rl.to_rows(rl.decode(raw(spark, sf_dir), envelope)), root, prefix)

    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(_derived(spark, sf_dir, "prefixes", make))
    store = path.getFileSystem(conf)
    uri = path.makeQualified(store.getUri(), store.getWorkingDirectory()).toString()
    sides = [rl.read_lake(spark, uri, prefix).select(F.lit(prefix).alias("prefix"), "event_id", "app") for prefix in ("ledger", "audit")]
    return sides[0].unionAll(sides[1])


def lake_half_written(spark, sf_dir):
    """A lake whose apps are all digits and beside whose parts half-written ones stand."""

    def make(root: str) -> None:
        rows = fx.lake_rows(spark, sf_dir).withColumn("app", F.lpad(F.regexp_extract("run_id", "[0-9]+", 0), 5, "0").substr(4, 2))
        rl.write_lake(rows, root, "ledger")
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for part in rl.lake_parts(spark, root, "ledger").orderBy("part").limit(20).collect():
            path = jvm.org.apache.hadoop.fs.Path(f"{part['part']}.incomplete")
            out = path.getFileSystem(conf).create(path)
            out.write(bytearray(b"PAR1 and no more"))
            out.close()

    root = _derived(spark, sf_dir, "half-written", make)
    return rl.read_lake(spark, root, "ledger").select("event_id", "app", "date")


def tail_precedence(spark, sf_dir):
    """A tail given two ways to begin: the start goes before an age and a number."""
    sides = [
        _tail(spark, sf_dir, from_start=True, since=since, now=NOW).select(F.lit(str(since)).alias("since"), "seq", "idx")
        for since in (LAST, AGE)
    ]
    return sides[0].unionAll(sides[1])


def drain_after_follow(spark, sf_dir):
    """The lake of a drain that began after a follow had shown the same messages: looking consumes nothing."""

    def make(root: str) -> None:
        messages(spark, sf_dir).write.parquet(f"{root}/raw")
        places = {name: f"{root}/{name}" for name in ("lines", "unreadable", "checkpoint")}
        rl.follow(spark, f"{root}/raw", rl.BATCH, **places, from_start=True, available_now=True).awaitTermination()
        drain = rl.drain(
            rl.raw_stream(spark, f"{root}/raw"), rl.BATCH, f"{root}/lake", f"{root}/dead", f"{root}/drain", available_now=True
        )
        drain.awaitTermination()

    root = _derived(spark, sf_dir, "after-follow", make)
    drained_rows = rl.read_lake(spark, f"{root}/lake", "ledger").select(F.lit("row").alias("kind"), F.col("event_id").alias("id"))
    return drained_rows.unionAll(rl.read_dead(spark, f"{root}/dead").select(F.lit("letter"), "msg_id"))


def usage_by_tenant_day(spark, sf_dir):
    return rl.usage_by_tenant_day(rl.dedupe(rl.to_rows(rl.decode(twice(spark, sf_dir), rl.BATCH))))


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        raw_scan,
        decode_batch_rows,
        decode_rejects,
        decode_event_envelope,
        decode_event_rejects,
        message_dispositions,
        flush_stats,
        subject_filter,
        dead_letters,
        dead_letters_once,
        dead_letters_retried,
        dead_letters_unknown_seq,
        dead_letters_recreated,
        lake_roundtrip,
        lake_totals,
        lake_pruned_count,
        lake_any_value,
        lake_empty_app,
        lake_projection,
        lake_strict,
        lake_parts,
        lake_parts_lacking,
        lake_dedupe,
        lake_dedupe_usage,
        lake_views,
        schema_evolution,
        execution_provenance,
        provenance_counts,
        tags_lookup,
        tail_last_n,
        tail_last_n_by_zones,
        tail_last_n_of_subject,
        tail_since_age,
        tail_from_start,
        tail_filtered,
        tail_no_detail,
        tail_json_lines,
        tail_pretty,
        tail_unreadable,
        tail_follow,
        drain_available_now,
        drain_dead_letters,
        drain_flush_log,
        drain_row_bounded,
        part_to_messages,
        decode_odd_messages,
        tail_follow_unreadable,
        duplicate_ids_stream,
        retain_newest,
        retain_by_age,
        admit_oldest,
        retain_streams,
        admit_streams,
        duplicate_window,
        duplicate_window_stream,
        contract_drift,
        observed_doubled,
        policy_diff,
        decode_text_kinds,
        decode_whole_rejects,
        usage_whole_by_tenant_day,
        drain_whole,
        drain_redelivery,
        drain_redelivery_deduped,
        drain_order,
        drain_rejects_only,
        lake_prefixes,
        lake_half_written,
        tail_precedence,
        drain_after_follow,
        usage_by_tenant_day,
    )
}
