"""The schemas of every table, and the one ordered list of lake columns.

``COLUMNS`` is the contract.  The event parser, the flattening select, the lake
DDL, the reader, the JSON-line renderer and the filters are all generated from
it, so a column cannot be called one thing in the lake and another in a
rendered line.  New columns are appended, never inserted: a part written before
a column existed then differs from a newer one by a trailing column only.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

STRING, LONG, INT = T.StringType(), T.LongType(), T.IntegerType()
DOUBLE, BOOL, NTZ = T.DoubleType(), T.BooleanType(), T.TimestampNTZType()
TEXT_MAP = T.MapType(STRING, STRING)
TEXT_LIST = T.ArrayType(STRING)


class LakeColumn(NamedTuple):
    """One lake column: its name, lake type, the event field it is read from and that field's type."""

    name: str
    dtype: T.DataType
    source: str
    wire: T.DataType


def _col(name: str, dtype: T.DataType = STRING, source: str | None = None, wire: T.DataType | None = None) -> LakeColumn:
    return LakeColumn(name, dtype, source or name, wire or dtype)


# Names, types and order of the lake schema.
COLUMNS: tuple[LakeColumn, ...] = (
    _col("event_id"),
    _col("time", NTZ, wire=STRING),
    _col("tenant"),
    _col("app"),
    _col("feature"),
    _col("run_id"),
    _col("correlation_id"),
    _col("causation_id"),
    _col("budget_id"),
    _col("tags_json", source="tags", wire=TEXT_MAP),
    _col("prompt_name"),
    _col("prompt_hash"),
    _col("alias"),
    _col("resolved_model"),
    _col("model_overridden", BOOL),
    _col("input_tokens", LONG, "usage.input_tokens"),
    _col("output_tokens", LONG, "usage.output_tokens"),
    _col("cached_tokens", LONG, "usage.cached_tokens"),
    _col("reasoning_tokens", LONG, "usage.reasoning_tokens"),
    _col("cost_usd", DOUBLE),
    _col("cost_source"),
    _col("latency_ms", LONG),
    _col("provider_request_id"),
    _col("fallback_used", BOOL),
    _col("outcome"),
    _col("error_kind"),
    _col("policy_mode"),
    _col("policy_violations", wire=TEXT_LIST),
    _col("tool"),
    _col("principal_subject"),
    _col("principal_actor"),
    _col("principal_kind"),
    _col("chain_depth", INT),
    _col("clearance_effective"),
    _col("compartments_effective", wire=TEXT_LIST),
    _col("redaction_plan"),
    _col("redaction_count", INT),
    _col("disclosed_count", INT),
    _col("error_detail"),
    _col("execution_subject"),
)

COLUMN_NAMES: tuple[str, ...] = tuple(c.name for c in COLUMNS)
_BY_NAME = {c.name: c for c in COLUMNS}

#: Hive partition columns; ``date`` is derived from ``time`` and belongs to the layout, not to the row.
PARTITION_COLUMNS = ("date", "app")


def column_named(name: str) -> LakeColumn | None:
    """The lake column called ``name``, or None when there is none."""
    return _BY_NAME.get(name)


def event_schema() -> T.StructType:
    """The event as it is on the wire, derived from ``COLUMNS`` (``usage`` is one nested struct)."""
    fields: list[T.StructField] = []
    nested: dict[str, list[T.StructField]] = {}
    for c in COLUMNS:
        head, _, leaf = c.source.partition(".")
        if not leaf:
            fields.append(T.StructField(head, c.wire))
            continue
        if head not in nested:
            nested[head] = []
            fields.append(T.StructField(head, T.StructType(nested[head])))
        nested[head].append(T.StructField(leaf, c.wire))
    return T.StructType(
        [T.StructField(f.name, T.StructType(nested[f.name])) if f.name in nested else f for f in fields]
    )


ROW_SCHEMA = T.StructType([T.StructField(c.name, c.dtype) for c in COLUMNS])
LAKE_SCHEMA = T.StructType([*ROW_SCHEMA.fields, T.StructField("date", T.DateType())])

RAW_SCHEMA = T.StructType(
    [
        T.StructField("stream", STRING),
        T.StructField("subject", STRING),
        T.StructField("seq", LONG),
        T.StructField("published_at", NTZ),
        T.StructField("payload", T.BinaryType()),
    ]
)

#: Messages with the id their publisher gave them; NULL or empty where there was none.
RAW_ID_SCHEMA = T.StructType([*RAW_SCHEMA.fields, T.StructField("message_id", STRING)])

#: The size of a message, stored beside it where it was landed ``with_sizes``.
SIZE_FIELD = T.StructField("payload_bytes", LONG)

REJECT_SCHEMA = T.StructType(
    [
        T.StructField("stream", STRING),
        T.StructField("subject", STRING),
        T.StructField("seq", LONG),
        T.StructField("idx", INT),
        T.StructField("reason", STRING),
        T.StructField("error", STRING),
        T.StructField("payload", T.BinaryType()),
    ]
)

DEAD_SCHEMA = T.StructType(
    [
        T.StructField("msg_id", STRING),
        T.StructField("origin", STRING),
        T.StructField("dead_subject", STRING),
        T.StructField("reason", STRING),
        T.StructField("error", STRING),
        T.StructField("stream", STRING),
        T.StructField("subject", STRING),
        T.StructField("sequence", STRING),
        T.StructField("event_index", STRING),
        T.StructField("payload", T.BinaryType()),
    ]
)

FLUSH_SCHEMA = T.StructType(
    [
        T.StructField("flush_id", LONG),
        T.StructField("first_seq", LONG),
        T.StructField("last_seq", LONG),
        T.StructField("messages", LONG),
        T.StructField("rows", LONG),
        T.StructField("rejects", LONG),
        T.StructField("origin", STRING),
        T.StructField("drain", STRING),
    ]
)

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("part", STRING),
        T.StructField("date", T.DateType()),
        T.StructField("app", STRING),
        T.StructField("bytes", LONG),
        T.StructField("stream", STRING),
        T.StructField("first_seq", LONG),
        T.StructField("last_seq", LONG),
        T.StructField("origin", STRING),
        T.StructField("drain", STRING),
        T.StructField("flush", LONG),
    ]
)

ZONE_SCHEMA = T.StructType(
    [
        T.StructField("file", STRING),
        T.StructField("stream", STRING),
        T.StructField("least", LONG),
        T.StructField("greatest", LONG),
        T.StructField("messages", LONG),
    ]
)
