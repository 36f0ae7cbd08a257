"""Messages to rows and rejects.

``decode`` is one narrow pass: no shuffle, no Python on the row path.  A message
is parsed twice on purpose.  The first parse only splits it, leaving every
event as raw JSON text; the second parses one event at a time.  A single typed
parse would flag the whole message for one bad event, and the blast radius of a
bad event has to be that event.

A rejected event keeps its bytes however its message is spaced or spelled: where putting
the parsed parts together again does not give the message, its elements are
cut out of the text itself.  An unreadable message keeps its bytes untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlake.functions.elements import blanked, bounds, cut, pieces, running
from recordlake.functions.text import json_list, json_map, literal, parse_instant
from recordlake.schema import COLUMNS, REJECT_SCHEMA, TEXT_LIST, TEXT_MAP, LakeColumn, event_schema

#: One message is ``{"events":[...]}``.
BATCH = "batch"
#: One message is one event.
EVENT = "event"

# Why an event can never become a row.
UNMARSHAL = "unmarshal"
NO_EVENT_ID = "missing_event_id"
NO_TIME = "missing_time"

# The error text beside each reason.
ERR_NO_EVENT_ID = "event_id is empty"
ERR_NO_TIME = "time is unset"
ERR_EVENT = "event does not match the record schema"
ERR_UTF8 = "message is not valid UTF-8"
ERR_MESSAGE = "message is not a JSON object"
ERR_EVENTS = "events is not a list"
ERR_ENVELOPE = "message is not a batch of events"
HINT_BINARY = " (the payload does not start like JSON; this stream carries JSON text)"

#: A time equal to this is an unset time, not a date.
ZERO_TIME = "0001-01-01 00:00:00"
#: The last moment a four-digit year can name; a later one would have no readable partition.
LAST_TIME = "9999-12-31 23:59:59.999999"

_STRICT = "map('columnNameOfCorruptRecord', '_corrupt', 'allowSingleQuotes', 'false', 'allowNonNumericNumbers', 'false')"

#: The SQL text of a message's payload.
_TEXT = "CAST(payload AS STRING)"

_ZERO = {
    T.StringType(): "''",
    T.LongType(): "0L",
    T.IntegerType(): "0",
    T.DoubleType(): "0D",
    T.BooleanType(): "false",
}


def _from_json(text: str, shape: str) -> str:
    return f"from_json({text}, '{shape}', {_STRICT})"


def _parsed(text: str) -> str:
    """One event's JSON text as a struct, with ``_corrupt`` set when it does not fit the schema."""
    schema = event_schema().add(T.StructField("_corrupt", T.StringType()))
    return _from_json(text, schema.simpleString())


# The fault of a message as a whole is looked for by parsing it as the value of a key that another key
# follows: a message with anything after its object then fails to parse, where a bare parse would stop at
# the end of the object and drop the rest unseen.
_ONE_VALUE = _from_json(f"""concat('{{"message":', {_TEXT}, ',"tail":1}}')""", "tail int") + ".tail <=> 1"
_KEYS = f"json_object_keys({_TEXT})"
_HINT = f"if(ltrim({_TEXT}) RLIKE r'^[\\[{{]', '', {literal(HINT_BINARY)})"
_NOT_TEXT = f"NOT coalesce(is_valid_utf8({_TEXT}), false)"
_NOT_OBJECT = f"{_KEYS} IS NULL OR NOT ({_ONE_VALUE})"

def _carried(raw: DataFrame) -> list[str]:
    return [c for c in raw.columns if c != "payload"]


def _split(raw: DataFrame) -> DataFrame:
    """Each message with ``_fault`` (why it is unreadable) and ``_events`` (its events as raw text).

    Putting the parts of a plain batch back together gives the message again,
    byte for byte, and that proves all there is to check: no other keys, nothing
    after the object, no element but objects.  Only a message that differs, if
    just in its spacing, is looked at more closely: its elements, whatever they
    are, are cut out of its text by ``functions.elements``.

    The message bytes go on as ``_whole`` only where a reject may need them:
    carried along, they would be copied once for every event of the message.
    """
    split = raw.selectExpr("*", f"{_from_json(_TEXT, 'events array<string>')}.events AS _parts")
    same = f"""concat('{{"events":[', array_join(_parts, ','), ']}}') = {_TEXT}"""
    judged = split.selectExpr("*", f"coalesce({same}, false) AS _plain")
    fault = f"""CASE
      WHEN _plain THEN NULL
      WHEN {_NOT_TEXT} THEN {literal(ERR_UTF8 + HINT_BINARY)}
      WHEN {_NOT_OBJECT} THEN concat({literal(ERR_MESSAGE)}, {_HINT})
      WHEN size({_KEYS}) > 1 OR array_position({_KEYS}, 'events') <> size({_KEYS}) THEN {literal(ERR_ENVELOPE)}
      WHEN _parts IS NULL AND get_json_object({_TEXT}, '$.events') IS NOT NULL THEN {literal(ERR_EVENTS)}
    END"""
    told = judged.selectExpr("*", f"{fault} AS _fault")
    odd = told.selectExpr("*", f"CASE WHEN NOT _plain AND _fault IS NULL THEN {_TEXT} END AS _odd")
    scanned = odd.selectExpr("*", f"{pieces(blanked('_odd'))} AS _pieces").selectExpr("*", f"{running('_pieces')} AS _sums")
    placed = scanned.selectExpr("*", f"{bounds('_sums', '_pieces', 2)} AS _places")
    return placed.selectExpr(
        *_carried(raw),
        "_fault",
        f"CASE WHEN _plain THEN _parts ELSE {cut('_odd', '_places')} END AS _events",
        "CASE WHEN _fault IS NOT NULL THEN payload END AS _whole",
    )


def _unfit(event: str, time: str) -> str:
    """True when the text did not parse into the event schema, a time that is no time included."""
    keys = f"map_keys({event}.tags)"
    checks = [
        f"{event} IS NULL",
        f"{event}._corrupt IS NOT NULL",
        f"size({event}.tags) > 1 AND size(array_distinct({keys})) <> size({keys})",
        f"exists(map_values({event}.tags), v -> v IS NULL)",
        f"{event}.time <> '' AND {time} IS NULL",
        f"{time} NOT BETWEEN TIMESTAMP_NTZ '{ZERO_TIME}' AND TIMESTAMP_NTZ '{LAST_TIME}'",
        f"NOT abs({event}.cost_usd) < double('Infinity')",
        *(f"exists({event}.{c.source}, v -> v IS NULL)" for c in COLUMNS if c.wire == TEXT_LIST),
    ]
    return " OR ".join(f"coalesce({check}, false)" for check in checks)


#: A value of another kind than text behind the name of a text field, or of a list where a text is due.
_TEXT_NAMES = "|".join(c.source for c in COLUMNS if isinstance(c.wire, T.StringType))
_OTHER_KIND = f'"({_TEXT_NAMES})"\\s*:\\s*[^"\\sn]'
_TYPED = [c.source for c in COLUMNS if c.wire in (T.StringType(), TEXT_MAP, TEXT_LIST) and "." not in c.source]


def _as_sent(event: str, text: str, name: str) -> str:
    """True when the only mention of a map or list in ``text`` is the one its parsed texts are written as."""
    mention = literal(f'"{name}"')
    once = f"length({text}) - length(replace({text}, {mention}, '')) = {len(name) + 2}"
    written = f"contains({text}, concat({mention}, ':', to_json({event}.{name})))"
    return f"(coalesce(size({event}.{name}), -1) <= 0 OR {once} AND {written})"


def _doubtful(event: str, text: str) -> str:
    """False only for events whose text fields are plainly texts; all others are looked at by ``_mistyped``.

    The parser reads ``7`` and ``{"x":1}`` as the texts ``'7'`` and ``'{"x":1}'``, so the kind of a
    value has to be found in the text itself.  A quote inside of a value is always escaped there, so
    a bare ``"name"`` before a colon is a key.
    """
    collections = [_as_sent(event, text, c.source) for c in COLUMNS if c.wire in (TEXT_MAP, TEXT_LIST)]
    return f"""contains({text}, '\\\\u') OR {text} RLIKE r'{_OTHER_KIND}' OR NOT ({" AND ".join(collections)})"""


def _mistyped(text: str) -> str:
    """True when a text field, a tag or an element of a list of texts holds a value of another kind; null is absent."""
    shape = "struct<" + ",".join(f"{name}:variant" for name in _TYPED) + ",_corrupt:string>"
    kinds = ["k._corrupt IS NOT NULL"]
    for c in COLUMNS:
        if c.source not in _TYPED:
            continue
        kind = f"schema_of_variant(k.{c.source})"
        if c.wire == TEXT_MAP:
            tags = f"map_values(try_cast(k.{c.source} AS map<string,variant>))"
            kinds.append(f"{kind} NOT IN ('OBJECT<>', 'VOID') AND coalesce(exists({tags}, v -> schema_of_variant(v) <> 'STRING'), true)")
        elif c.wire == TEXT_LIST:
            kinds.append(f"{kind} NOT IN ('ARRAY<STRING>', 'ARRAY<VOID>', 'VOID')")
        else:
            kinds.append(f"{kind} NOT IN ('STRING', 'VOID')")
    wrong = " OR ".join(f"coalesce({kind}, false)" for kind in kinds)
    return f"exists(array({_from_json(text, shape)}), k -> {wrong})"


def _reason(event: str, time: str, text: str) -> str:
    """The one reason an event is rejected for, in the order parse, id, time; NULL for a good event."""
    return f"""CASE
      WHEN {_unfit(event, time)} THEN '{UNMARSHAL}'
      WHEN CASE WHEN {_doubtful(event, text)} THEN {_mistyped(text)} ELSE false END THEN '{UNMARSHAL}'
      WHEN coalesce({event}.event_id, '') = '' THEN '{NO_EVENT_ID}'
      WHEN {time} IS NULL OR {time} = TIMESTAMP_NTZ '{ZERO_TIME}' THEN '{NO_TIME}'
    END"""


def _lake_value(column: LakeColumn) -> str:
    """One lake column of ``_event``: absent fields take the zero value of their type, never NULL."""
    if column.name == "time":
        return "_time"
    value = f"_event.{column.source}"
    if column.wire == TEXT_MAP:
        return json_map(value)
    if column.wire == TEXT_LIST:
        return json_list(value)
    return f"coalesce({value}, {_ZERO[column.dtype]})"


def _batches(raw: DataFrame, keep_empty: bool) -> DataFrame:
    parts = "CASE WHEN _fault IS NOT NULL THEN array(CAST(NULL AS STRING)) ELSE coalesce(_events, array()) END"
    explode = "posexplode_outer" if keep_empty else "posexplode"
    spread = _split(raw).selectExpr(*_carried(raw), "_fault", "_whole", f"{explode}({parts}) AS (_pos, _text)")
    return spread.selectExpr(*_carried(raw), "if(_fault IS NOT NULL, -1, _pos) AS idx", "_fault", "_whole", "_text")


def _singles(raw: DataFrame) -> DataFrame:
    fault = f"CASE WHEN {_NOT_TEXT} OR {_NOT_OBJECT} THEN concat({literal(ERR_MESSAGE)}, {_HINT}) END"
    return raw.selectExpr(*_carried(raw), "-1 AS idx", f"{fault} AS _fault", "payload AS _whole", f"{_TEXT} AS _text")


def event_texts(raw: DataFrame, envelope: str, keep_empty: bool = False) -> DataFrame:
    """One record per event: ``idx`` and ``_text``, or ``_fault`` with idx -1 for an unreadable message."""
    if envelope == BATCH:
        return _batches(raw, keep_empty)
    if envelope == EVENT:
        return _singles(raw)
    raise ValueError(f"envelope {envelope!r}: want {BATCH!r} or {EVENT!r}")


def decode(raw: DataFrame, envelope: str, keep_empty: bool = False, beside: tuple[str, ...] = ()) -> DataFrame:
    """Rows and rejects of every message, in one narrow pass over ``raw``.

    Each event gives one record with ``idx`` (its place in the message, -1 for
    a whole message) and either ``row``, a struct in lake order, or ``reason``,
    ``error`` and ``payload`` (the original bytes).  ``to_rows`` and
    ``to_rejects`` take the two halves apart.

    An empty batch yields nothing.  With ``keep_empty`` it yields one record
    whose ``idx``, ``row`` and ``reason`` are NULL, so that messages can be
    counted without a second pass over the source.  Columns of ``raw`` named in
    ``beside`` go along with every record of their message.
    """
    events = event_texts(raw, envelope, keep_empty)
    parsed = events.selectExpr("*", f"CASE WHEN _fault IS NULL THEN {_parsed('_text')} END AS _event")
    timed = parsed.selectExpr("*", f"{parse_instant('_event.time')} AS _time")
    reason = f"CASE WHEN idx IS NULL THEN NULL WHEN _fault IS NOT NULL THEN '{UNMARSHAL}' ELSE {_reason('_event', '_time', '_text')} END"
    cells = ", ".join(f"'{c.name}', {_lake_value(c)}" for c in COLUMNS)
    error = f"""CASE
      WHEN _fault IS NOT NULL THEN _fault
      WHEN reason = '{UNMARSHAL}' THEN {literal(ERR_EVENT)}
      WHEN reason = '{NO_EVENT_ID}' THEN {literal(ERR_NO_EVENT_ID)}
      WHEN reason = '{NO_TIME}' THEN {literal(ERR_NO_TIME)}
    END"""
    return timed.selectExpr("*", f"{reason} AS reason").selectExpr(
        *beside,
        "stream",
        "subject",
        "seq",
        "idx",
        f"CASE WHEN reason IS NULL AND idx IS NOT NULL THEN named_struct({cells}) END AS row",
        "reason",
        f"{error} AS error",
        "CASE WHEN reason IS NOT NULL THEN coalesce(_whole, encode(_text, 'UTF-8')) END AS payload",
    )


def to_rows(decoded: DataFrame, *beside: str) -> DataFrame:
    """The rows of a decoded table: the 40 lake columns in order, after the columns named in ``beside``.

    A filter on ``row`` would say the same, but the optimizer moves filters
    below the parse by copying the parse into them.  A generator stays put.
    """
    return decoded.selectExpr(*beside, "inline(CASE WHEN row IS NOT NULL THEN array(row) END)")


def to_rejects(decoded: DataFrame) -> DataFrame:
    """The rejects of a decoded table, in ``REJECT_SCHEMA``."""
    told = "named_struct('idx', idx, 'reason', reason, 'error', error, 'payload', payload)"
    found = decoded.selectExpr("stream", "subject", "seq", f"inline(CASE WHEN reason IS NOT NULL THEN array({told}) END)")
    return found.select(*REJECT_SCHEMA.fieldNames())


def render_reject() -> Column:
    """``event N: reason: error``, or ``reason: error`` for a whole message."""
    return F.expr("concat(if(idx < 0, '', concat('event ', idx, ': ')), reason, ': ', error)")


def with_rendered(rejects: DataFrame) -> DataFrame:
    """Adds ``rendered``, the one-line form of each reject."""
    return rejects.select("*", render_reject().alias("rendered"))


def dispositions(raw: DataFrame, envelope: str) -> DataFrame:
    """What became of each message: its rows, its rejects, and ``term`` or ``ack``.

    A message of nothing but rejects is terminated once they are recorded; any
    other, an empty batch included, is acknowledged.  Counted inside each
    message, so two copies of a message stay two and nothing is shuffled.
    """
    if envelope == BATCH:
        split, texts = _split(raw), "coalesce(_events, array())"
    else:
        split, texts = event_texts(raw, envelope), "array(_text)"
    parsed = f"transform({texts}, t -> named_struct('text', t, 'event', {_parsed('t')}))"
    read = f"transform({parsed}, p -> named_struct('text', p.text, 'event', p.event, 'time', {parse_instant('p.event.time')}))"
    reasons = f"transform({read}, r -> {_reason('r.event', 'r.time', 'r.text')})"
    counted = split.selectExpr("stream", "subject", "seq", "_fault", f"CASE WHEN _fault IS NULL THEN {reasons} END AS _reasons")
    tallied = counted.selectExpr(
        "stream",
        "subject",
        "seq",
        "CAST(if(_fault IS NOT NULL, 0, size(filter(_reasons, r -> r IS NULL))) AS BIGINT) AS rows",
        "CAST(if(_fault IS NOT NULL, 1, size(filter(_reasons, r -> r IS NOT NULL))) AS BIGINT) AS rejects",
    )
    return tallied.selectExpr("*", "if(rows = 0 AND rejects > 0, 'term', 'ack') AS disposition")


# The figures of a flush, as aggregates over a decoded table.
FLUSH_FIGURES = (
    "coalesce(min(seq) FILTER (WHERE seq > 0), 0) AS first_seq",
    "coalesce(max(seq) FILTER (WHERE seq > 0), 0) AS last_seq",
    "count_if(coalesce(idx, 0) <= 0) AS messages",
    "count(row) AS rows",
    "count(reason) AS rejects",
)


def flush_stats(decoded: DataFrame) -> DataFrame:
    """One record: the sequence range over all messages, and how many messages, rows and rejects there were.

    Takes ``decode(..., keep_empty=True)``, where each message has exactly one
    record whose ``idx`` is NULL, -1 or 0.  Sequence 0 means unknown and is left
    out of the range.
    """
    return decoded.selectExpr(*FLUSH_FIGURES)
