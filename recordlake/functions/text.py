"""Text forms of lake values as SQL expressions: JSON text, RFC 3339 times and plain decimal numbers.

Each function takes the SQL text of a value and gives the SQL text of the
result.  Written as SQL a whole select list reaches the JVM in one call, where
building it from column objects takes thousands.
"""

from __future__ import annotations

import datetime as dt

# Characters that are written as escapes inside JSON strings.
_ESCAPES = (
    ("&", r"\u0026"),
    ("<", r"\u003c"),
    (">", r"\u003e"),
    ("\u2028", r"\u2028"),
    ("\u2029", r"\u2029"),
)

# Date-time texts that name one instant.  A text without an offset is taken as UTC.
RFC3339_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,9})?(Z|[+-][0-9]{2}:[0-9]{2})?$"


def literal(text: str) -> str:
    """A text as an SQL string literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n")
    return f"'{escaped}'"


def escape_json(text: str) -> str:
    """JSON text with ``&``, ``<``, ``>`` and the two Unicode line separators written as escapes.

    Those characters can only stand inside strings of a JSON text, so replacing
    them anywhere keeps its value.
    """
    for plain, written in _ESCAPES:
        text = f"replace({text}, {literal(plain)}, {literal(written)})"
    return text


def json_map(tags: str) -> str:
    """A string map as a JSON object with its keys in order; absent or empty is ``{}``, never ``null``.

    Sorted keys make redelivered copies of an event byte-identical.
    """
    ordered = f"if(size({tags}) > 1, map_from_entries(array_sort(map_entries({tags}))), {tags})"
    return f"CASE WHEN size({tags}) > 0 THEN {escape_json(f'to_json({ordered})')} ELSE '{{}}' END"


def json_list(items: str) -> str:
    """A string list as a JSON array; absent or empty is ``[]``."""
    return f"CASE WHEN size({items}) > 0 THEN {escape_json(f'to_json({items})')} ELSE '[]' END"


def json_string(text: str) -> str:
    """A text as a quoted JSON string."""
    listed = f"to_json(array({text}))"
    return escape_json(f"substring({listed}, 2, length({listed}) - 2)")


def parse_instant(text: str) -> str:
    """An RFC 3339 text as a UTC TIMESTAMP_NTZ; NULL when it is not one.

    The pattern is checked first because a plain cast also takes ``12:30:00``
    and would put today's date on it.  The time as written is read without a zone and
    its offset, of 18 hours at most, taken off it, so no session time zone has a part in it.
    """
    offset = f"substring({text}, -6, 1) IN ('+', '-')"
    written = f"CASE WHEN endswith({text}, 'Z') THEN left({text}, length({text}) - 1) WHEN {offset} THEN left({text}, length({text}) - 6) ELSE {text} END"
    hours, minutes = f"CAST(substring({text}, -5, 2) AS INT)", f"CAST(right({text}, 2) AS INT)"
    ahead = f"if(substring({text}, -6, 1) = '-', -1, 1) * ({hours} * 60 + {minutes})"
    shift = f"CASE WHEN NOT {offset} THEN 0 WHEN {minutes} < 60 AND {hours} * 60 + {minutes} <= 1080 THEN {ahead} END"
    return f"CASE WHEN {text} RLIKE r'{RFC3339_PATTERN}' THEN timestampadd(MINUTE, -({shift}), try_cast({written} AS TIMESTAMP_NTZ)) END"


def instant_literal(moment: dt.datetime | None) -> str:
    """A moment as a TIMESTAMP_NTZ literal in UTC; without a zone it is UTC already, and None is now.

    Handed over as text: a Python datetime would be read in the driver's own zone.
    """
    if moment is None:
        moment = dt.datetime.now(dt.timezone.utc)
    if moment.tzinfo is not None:
        moment = moment.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return f"TIMESTAMP_NTZ '{moment.isoformat(sep=' ')}'"


def rfc3339(time: str) -> str:
    """A UTC TIMESTAMP_NTZ as RFC 3339 text: no trailing zeros in the fraction, ``Z`` at the end."""
    return f"concat(replace(CAST({time} AS STRING), ' ', 'T'), 'Z')"


def json_number(value: str) -> str:
    """A double the way JSON prints it: plain digits from 1e-6 up to 1e21, an exponent outside, no ``.0``."""
    short = f"CAST({value} AS STRING)"
    power = f"substring_index({short}, 'E', -1)"
    whole = lambda text: f"regexp_replace({text}, r'\\.0$', '')"
    trimmed = lambda text: f"regexp_replace({text}, r'\\.?0+$', '')"
    return f"""CASE
      WHEN isnan({value}) OR abs({value}) = double('Infinity') THEN CAST(NULL AS STRING)
      WHEN NOT contains({short}, 'E') THEN {whole(short)}
      WHEN abs({value}) >= 1e-6D AND abs({value}) < 1e-3D THEN {trimmed(f"CAST(try_cast({value} AS DECIMAL(38, 30)) AS STRING)")}
      WHEN abs({value}) >= 1e7D AND abs({value}) < 1e21D THEN {trimmed(f"CAST(try_cast({value} AS DECIMAL(38, 16)) AS STRING)")}
      ELSE concat({whole(f"substring_index({short}, 'E', 1)")}, 'e', if(startswith({power}, '-'), '', '+'), {power})
    END"""
