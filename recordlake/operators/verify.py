"""Checks that refuse instead of guess: contract drift, policy differences, create-or-verify."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlake.functions.elements import kind_of, with_members
from recordlake.operators.decode import event_texts
from recordlake.schema import COLUMNS, DEAD_SCHEMA, RAW_SCHEMA
from recordlake.sinks.deadletter import DEAD_SUBJECT
from recordlake.sources.raw import spread_out

# The kinds of JSON value, by the Spark type a lake column is read with.
_KINDS = {
    T.StringType(): "text",
    T.LongType(): "integer",
    T.IntegerType(): "integer",
    T.DoubleType(): "number",
    T.BooleanType(): "boolean",
}

GIB = 2**30
WEEK = 7 * 24 * 3600

# The policies of the three streams.  Sizes in bytes, times in seconds; -1 is no limit.
POLICIES: dict[str, dict[str, str]] = {
    "ledger": {
        "subjects": "rec.v1.ledger.>",
        "storage": "file",
        "retention": "limits",
        "discard": "old",
        "max_age": str(WEEK),
        "max_bytes": str(8 * GIB),
        "max_msgs": "-1",
        "replicas": "1",
        "deny_delete": "false",
        "deny_purge": "false",
        "duplicates": "120",
    },
    "audit": {
        "subjects": "rec.v1.audit.>",
        "storage": "file",
        "retention": "limits",
        "discard": "new",
        "max_age": "0",
        "max_bytes": str(8 * GIB),
        "max_msgs": "-1",
        "replicas": "1",
        "deny_delete": "true",
        "deny_purge": "true",
        "duplicates": "120",
    },
    "dead": {
        "subjects": f"{DEAD_SUBJECT}.>",
        "storage": "file",
        "retention": "limits",
        "discard": "new",
        "max_age": "0",
        "max_bytes": str(GIB),
        "max_msgs": "-1",
        "replicas": "1",
        "deny_delete": "true",
        "deny_purge": "true",
        "duplicates": "120",
    },
}

#: What an operator may tune; everything else in a policy is policy.
SIZING = ("max_age", "max_bytes", "replicas")
#: Set when a table is made but never compared: the window can be changed without changing what is kept.
UNCOMPARED = ("duplicates",)
LIMITS = ("max_bytes", "max_msgs")

PROPERTY = "recordlake."

#: Differences an error message spells out; the error holds them all.
TOLD = 50


class PolicyMismatch(Exception):
    """Tables exist with policies other than those asked for.  ``differences``, where given, has all of them as a DataFrame."""

    def __init__(self, message: str, differences: DataFrame | None = None):
        super().__init__(message)
        self.differences = differences


# The kind of a JSON value, told as the type of a variant, or already as a kind.
_KIND = """CASE
  WHEN told IN ('text', 'integer', 'number', 'boolean', 'list', 'object', 'null') THEN told
  WHEN told = 'STRING' THEN 'text'
  WHEN told = 'BIGINT' THEN 'integer'
  WHEN told = 'DOUBLE' OR startswith(told, 'DECIMAL') THEN 'number'
  WHEN told = 'BOOLEAN' THEN 'boolean'
  WHEN startswith(told, 'ARRAY') THEN 'list'
  WHEN startswith(told, 'OBJECT') THEN 'object'
  ELSE 'null'
END"""


#: Fields whose members are fields themselves, spread over columns.
CONTAINERS = tuple(dict.fromkeys(c.source.partition(".")[0] for c in COLUMNS if "." in c.source))


def _distinct(members: str, parent: str) -> str:
    """Members as (field, told, text), one of each field and kind; only a container keeps its text."""
    field = f"concat({parent}, '.', m.key)" if parent else "m.key"
    told = kind_of("m.value")
    kept = "CAST(NULL AS STRING)" if parent else f"CASE WHEN m.key IN ({_listed(CONTAINERS)}) AND startswith(m.value, '{{') THEN m.value END"
    return f"array_distinct(transform({members}, m -> named_struct('field', {field}, 'told', {told}, 'text', {kept})))"


def _listed(names: Iterable[str]) -> str:
    return ", ".join(f"'{n}'" for n in names)


def observed_fields(raw: DataFrame, envelope: str) -> DataFrame:
    """The fields events really carry: ``field``, ``kind`` of value, and in how many events.

    Read from every readable event.  Fields of ``usage`` are listed one by one, and ``usage`` itself with its kind.
    An event that holds a key twice does not parse; its fields are read off its text, each
    once for every kind its values have (those of a second ``usage`` count again).  Counts are folded per task before the
    shuffle, over a few dozen names.  The payloads are laid out in even pieces first: reading them costs
    far more than their bytes, so a few files would be a few long tasks.
    """
    texts = event_texts(spread_out(raw.select("payload")), envelope).selectExpr("CASE WHEN _fault IS NULL THEN _text END AS text")
    parsed = texts.selectExpr("text", "try_parse_json(text) AS event")
    spread = ["coalesce(map_entries(try_variant_get(event, '$', 'map<string,variant>')), array())"]
    for container in CONTAINERS:
        held = f"map_entries(try_variant_get(event, '$.{container}', 'map<string,variant>'))"
        nested = f"transform({held}, m -> named_struct('key', concat('{container}.', m.key), 'value', m.value))"
        spread.append(f"coalesce({nested}, array())")
    named = f"transform(concat({', '.join(spread)}), m -> named_struct('field', m.key, 'told', schema_of_variant(m.value)))"
    # The texts of events that did not parse, level by level: two are all there can be, as below them no column is fed,
    # and what is below a field that is no container belongs to that field.
    unparsed = "CASE WHEN event IS NULL THEN trim(BOTH ' \\t\\n\\r' FROM text) END AS text"
    outer = with_members(parsed.selectExpr(f"{named} AS named", unparsed), "text", "members")
    plain = "transform(named, f -> named_struct('field', f.field, 'told', f.told, 'text', CAST(NULL AS STRING)))"
    fields = outer.selectExpr(f"inline(concat({plain}, coalesce({_distinct('members', '')}, array()))) AS (field, told, text)")
    inner = with_members(fields, "text", "members")
    below = f"coalesce({_distinct('members', 'field')}, array())"
    every = inner.selectExpr(f"inline(concat(array(named_struct('field', field, 'told', told, 'text', text)), {below})) AS (field, told, text)")
    return every.selectExpr("field", f"{_KIND} AS kind").groupBy("field", "kind").agg(F.count("*").alias("events"))


def contract_fields(spark: SparkSession) -> DataFrame:
    """The fields the lake columns are read from, with the kind of value each expects; containers feed no column of their own."""
    listed = [(c.source, c.name, _wire_kind(c.wire)) for c in COLUMNS] + [(c, None, "object") for c in CONTAINERS]
    return spark.createDataFrame(listed, "field string, column string, want string")


def _wire_kind(wire: T.DataType) -> str:
    if isinstance(wire, T.MapType):
        return "object"
    if isinstance(wire, T.ArrayType):
        return "list"
    return _KINDS[wire]


def contract_drift(observed: DataFrame, ignored: Mapping[str, str] | None = None) -> DataFrame:
    """Where the fields on the wire and the lake columns part ways, in both directions.

    ``not a column``: events carry the field and no column takes it.
    ``not carried``: a column has no field behind it.
    ``other kind``: the field is there with another kind of value.

    A field left out on purpose goes into ``ignored`` with the reason, which is
    required: without one it could not be told from a field nobody noticed.
    ``usage`` itself is spread over columns: it is no column, and need not be carried, but it has to be an object.
    """
    ignored = dict(ignored or {})
    unexplained = sorted(f for f, why in ignored.items() if not why.strip())
    if unexplained:
        raise ValueError(f"ignored without a reason: {', '.join(unexplained)}")
    contract = contract_fields(observed.sparkSession)
    seen = observed.filter(~F.col("field").isin(*ignored) & (F.col("kind") != "null"))
    both = contract.join(seen, "field", "full_outer")
    fits = (F.col("want") == F.col("kind")) | ((F.col("want") == "number") & (F.col("kind") == "integer"))
    problem = (
        F.when(F.col("want").isNull(), "not a column")
        .when(F.col("kind").isNull(), F.when(F.col("column").isNotNull(), "not carried"))
        .when(~fits, "other kind")
    )
    return both.select(
        "field",
        "column",
        "want",
        F.col("kind").alias("seen"),
        F.coalesce("events", F.lit(0)).cast("long").alias("events"),
        problem.alias("problem"),
    ).filter(F.col("problem").isNotNull())


def policy_rows(spark: SparkSession, policies: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Policies as ``(table, field, value)``."""
    listed = [(t, f, str(v)) for t, fields in policies.items() for f, v in fields.items() if f not in UNCOMPARED]
    return spark.createDataFrame(listed, "table string, field string, value string")


def _limit(field: Column, value: Column) -> Column:
    """Zero, below zero and -1 are the same absence of a limit."""
    return F.when(field.isin(*LIMITS) & (value.try_cast("long") <= 0), "-1").otherwise(value)


def policy_diff(want: DataFrame, got: DataFrame) -> DataFrame:
    """Every field on which two sets of policies differ: ``table, field, want, running, told``."""
    key = ["table", "field"]
    wanted = want.select(*key, _limit(F.col("field"), F.col("value")).alias("want"))
    running = got.select(*key, _limit(F.col("field"), F.col("value")).alias("running"))
    both = wanted.join(running, key, "full_outer").filter(~F.col("want").eqNullSafe(F.col("running")))
    absent = lambda c: F.coalesce(c, F.lit("nothing"))
    told = F.concat(F.col("field"), F.lit(": want "), absent("want"), F.lit(", running "), absent("running"))
    return both.select(*key, "want", "running", told.alias("told"))


def held_policy(raw: DataFrame, name: str, policy: Mapping[str, str]) -> DataFrame:
    """The policy a table of messages is seen to live under, as ``(table, field, value)``.

    Subjects are the common subject base of its messages.  A limit it keeps is
    reported as that limit, one it has outgrown as what it holds.  Compared with
    ``policy_diff`` this names every limit that is not being kept.
    """
    subjects = policy["subjects"]
    prefix = subjects.removesuffix(">")
    outside = F.min(F.when(~F.col("subject").startswith(prefix), F.col("subject")))
    span = F.unix_micros(F.max("published_at").cast("timestamp")) - F.unix_micros(F.min("published_at").cast("timestamp"))
    held = raw.agg(
        outside.alias("outside"),
        F.coalesce(F.ceil(span / 1_000_000), F.lit(0)).cast("long").alias("max_age"),
        F.coalesce(F.sum(F.length("payload")), F.lit(0)).alias("max_bytes"),
        F.count("*").alias("max_msgs"),
    )
    kept = [F.struct(F.lit("subjects").alias("field"), F.coalesce("outside", F.lit(subjects)).alias("value"))]
    for field in ("max_age", "max_bytes", "max_msgs"):
        limit = int(policy[field])
        over = F.lit(limit > 0) & (F.col(field) > limit)
        value = F.when(over, F.col(field).cast("string")).otherwise(str(limit))
        kept.append(F.struct(F.lit(field).alias("field"), value.alias("value")))
    return held.select(F.lit(name).alias("table"), F.inline(F.array(*kept)))


def sized(name: str, **sizing: int) -> dict[str, str]:
    """The policy of one stream with the sizes an operator may set; zero keeps the default."""
    other = sorted(set(sizing) - set(SIZING))
    if other:
        raise ValueError(f"{', '.join(other)} is policy and not a setting; settings are {', '.join(SIZING)}")
    return {**POLICIES[name], **{k: str(v) for k, v in sizing.items() if v}}


def running_policies(spark: SparkSession, tables: Iterable[str]) -> dict[str, dict[str, str] | None]:
    """The policy each catalog table carries as properties; None for a table that does not exist."""
    found: dict[str, dict[str, str] | None] = {}
    for table in tables:
        try:
            properties = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
        except AnalysisException as missing:
            if missing.getCondition() != "TABLE_OR_VIEW_NOT_FOUND":
                raise
            found[table] = None
            continue
        found[table] = {r.key.removeprefix(PROPERTY): r.value for r in properties if r.key.startswith(PROPERTY)}
    return found


def _create(spark: SparkSession, table: str, schema: T.StructType, location: str, policy: Mapping[str, str]) -> None:
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    properties = ", ".join(f"'{PROPERTY}{k}' = '{v}'" for k, v in policy.items())
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet TBLPROPERTIES ({properties}) LOCATION '{location}'")


def provision(
    spark: SparkSession, policies: Mapping[str, Mapping[str, str]], location: str, dry_run: bool = False
) -> dict[str, str]:
    """Create the message tables that are missing and verify the others: ``created``, ``verified`` or ``missing``.

    A table that runs under another policy is never changed.  All tables are
    looked at before the differences of all of them are raised at once: which
    side is right is for a person to say.
    """
    running = running_policies(spark, policies)
    status: dict[str, str] = {}
    for table, policy in policies.items():
        if running[table] is not None:
            status[table] = "verified"
        elif dry_run:
            status[table] = "missing"
        else:
            schema = DEAD_SCHEMA if policy["subjects"].startswith(DEAD_SUBJECT) else RAW_SCHEMA
            _create(spark, table, schema, f"{location.rstrip('/')}/{table}", policy)
            status[table] = "created"
    standing = {t: p for t, p in running.items() if p is not None}
    if standing:
        want = policy_rows(spark, {t: policies[t] for t in standing})
        refuse(policy_diff(want, policy_rows(spark, standing)))
    return status


def refuse(differences: DataFrame) -> None:
    """Raise with every policy difference, or return when there is none.  At most one line per table and field."""
    lines = [f"{d.table}: {d.told}" for d in differences.orderBy("table", "field").collect()]
    if lines:
        raise PolicyMismatch("policies differ; nothing was changed:\n  " + "\n  ".join(lines))


def lake_differences(observed: DataFrame, want: DataFrame, got: DataFrame, ignored: Mapping[str, str] | None = None) -> DataFrame:
    """``side`` (contract or the table), ``field`` and ``told`` of everything that differs, contract and policies together.

    A column no event happens to carry is no difference here; a field that has no
    column, or another kind of value, is.  Publishers can make up any number of fields, and all are told.
    """
    drift = contract_drift(observed, ignored).filter(F.col("problem") != "not carried")
    told = F.concat("field", F.lit(": "), "problem", F.lit(" ("), "seen", F.lit(", "), "events", F.lit(" events)"))
    drifting = drift.select(F.lit("contract").alias("side"), "field", told.alias("told"))
    return drifting.unionByName(policy_diff(want, got).select(F.col("table").alias("side"), "field", "told"))


def verify_lake(observed: DataFrame, want: DataFrame, got: DataFrame, ignored: Mapping[str, str] | None = None) -> None:
    """Contract and policies together: raises once, with everything that differs.

    The error carries all of ``lake_differences``; its message spells out the first ``TOLD``, contract
    first, as the fields that publishers make up are too many for a driver to hold.
    """
    differences = lake_differences(observed, want, got, ignored)
    first = differences.orderBy(F.col("side") != "contract", "side", "field", "told").take(TOLD + 1)
    lines = [f"{d.side}: {d.told}" for d in first[:TOLD]]
    if len(first) > TOLD:
        lines.append(f"and {differences.count() - TOLD} more; see contract_drift, or the differences of this error")
    if lines:
        raise PolicyMismatch("the lake and its contract differ; nothing was changed:\n  " + "\n  ".join(lines), differences)
