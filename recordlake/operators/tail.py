"""Filters and renderings of rows: exact-text predicates and JSON lines."""

from __future__ import annotations

import datetime as dt
import math
import re
from collections.abc import Iterable, Mapping
from functools import reduce
from itertools import groupby
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlake.functions.arguments import parse_filters
from recordlake.functions.text import escape_json, json_number, json_string, rfc3339
from recordlake.schema import COLUMNS, LakeColumn

_RANGE = {T.LongType(): 2**63, T.IntegerType(): 2**31}
_TIME = re.compile(r"([0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2})(?:\.([0-9]{0,5}[1-9]))?Z")


def _double_text(value: float) -> str:
    """A double's shortest text, with an exponent of two digits or more below 1e-4 and from 1e21 on."""
    if math.isnan(value):
        return "NaN"
    if math.isinf(value):
        return "+Inf" if value > 0 else "-Inf"
    shortest = repr(value)
    size = abs(value)
    if size and not 1e-4 <= size < 1e21:
        mantissa, _, power = shortest.partition("e")
        return f"{mantissa.removesuffix('.0')}e{power}"
    if "e" in shortest:
        shortest = format(value, ".0f")
    return shortest.removesuffix(".0")


def _literal(column: LakeColumn, text: str) -> Column | None:
    """The value of the column's type whose text form is exactly ``text``; None when there is none."""
    if column.dtype == T.StringType():
        return F.lit(text)
    if column.dtype == T.BooleanType():
        return F.lit(text == "true") if text in ("true", "false") else None
    if column.dtype in _RANGE:
        limit = _RANGE[column.dtype]
        if not re.fullmatch(r"0|-?[1-9][0-9]*", text) or not -limit <= int(text) < limit:
            return None
        return F.lit(int(text)).cast(column.dtype)
    if column.dtype == T.DoubleType():
        try:
            value = float(text)
        except ValueError:
            return None
        return F.lit(value) if _double_text(value) == text else None
    parts = _TIME.fullmatch(text)
    if parts is None:
        return None
    try:
        moment = dt.datetime.fromisoformat(parts[1]).replace(microsecond=int((parts[2] or "0").ljust(6, "0")))
    except ValueError:
        return None
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def where_equals(df: DataFrame, filters: Iterable[str] | Mapping[str, str]) -> DataFrame:
    """Rows on which every ``column=value`` holds, compared by the value's text form.

    A value is turned into its column's type here, so that what runs is a plain
    equality that reaches the scan.  A text no value is printed as (``1.50``,
    ``007``, ``True``) matches nothing, just as a text comparison would have it.
    """
    wanted = parse_filters(filters)
    if not wanted:
        return df
    by_name = {c.name: c for c in COLUMNS}
    tests = []
    for name, text in wanted.items():
        literal = _literal(by_name[name], text)
        tests.append(F.lit(False) if literal is None else F.col(name) == literal)
    return df.filter(reduce(and_, tests))


def _cell(column: LakeColumn) -> str:
    """One column as JSON text; NULL, a column its part predates, is ``null``."""
    if column.dtype == T.StringType():
        text = json_string(column.name)
    elif column.dtype == T.DoubleType():
        text = json_number(column.name)
    elif column.name == "time":
        text = json_string(rfc3339(column.name))
    else:
        text = f"CAST({column.name} AS STRING)"
    return f"coalesce(CASE WHEN {column.name} IS NOT NULL THEN {text} END, 'null')"


def _members(columns: list[LakeColumn]) -> str:
    """Neighbouring columns as the inside of one JSON object, through the JSON writer."""
    named = ", ".join(f"'{c.name}', {rfc3339(c.name) if c.name == 'time' else c.name}" for c in columns)
    written = f"to_json(named_struct({named}), map('ignoreNullFields', 'false'))"
    return escape_json(f"substring({written}, 2, length({written}) - 2)")


def _compact(columns: list[LakeColumn]) -> str:
    """All columns on one line: runs of columns through the JSON writer, doubles by their own rule between them."""
    pieces: list[str] = []
    for is_double, run in groupby(columns, key=lambda c: c.dtype == T.DoubleType()):
        if is_double:
            pieces += [f"""concat('"{c.name}":', {_cell(c)})""" for c in run]
        else:
            pieces.append(_members(list(run)))
    return f"concat('{{', concat_ws(',', {', '.join(pieces)}), '}}')"


def _indented(columns: list[LakeColumn]) -> str:
    members = ", ".join(f"""concat('  "{c.name}": ', {_cell(c)})""" for c in columns)
    return f"concat('{{\\n', concat_ws(',\\n', {members}), '\\n}}')"


def json_lines(rows: DataFrame, pretty: bool = False, no_detail: bool = False, beside: Iterable[str] = ()) -> DataFrame:
    """Each row as one JSON object in lake column order, zero values included, in the column ``line``.

    ``pretty`` indents it.  ``no_detail`` leaves ``error_detail`` out, key and
    all: it is the one column that may quote what it was meant to protect.
    """
    columns = [c for c in COLUMNS if not (no_detail and c.name == "error_detail")]
    line = _indented(columns) if pretty else _compact(columns)
    return rows.selectExpr(*beside, f"{line} AS line")
