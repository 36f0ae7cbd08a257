"""The elements of a JSON list inside a text, each as the very characters it was sent as.

A parse would write every element back from its parsed form and spell its numbers
and spaces anew.  Here the text is scanned instead, by array functions in the JVM:

1. Escaped characters and the insides of strings are blanked, length for length, so that
   every bracket and comma left is one of the structure.
2. The text is cut before each of them, which gives pieces of a known depth step and length.
3. Depths and places are the running sums of both, by doubling: each pass adds to
   every piece the sum of the one twice as far back, so n pieces take log n passes.
4. The commas at the depth of the list, and its two brackets, are where elements begin and end.

It takes texts that are known to be JSON.  Nothing bounds the depth or the number of elements.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Elements that are cut out of the same stretch of the text: a cut walks from the start of its text.
_STRETCH = 64


def blanked(text: str) -> str:
    """The text with strings and their quotes as underscores."""
    unescaped = rf"regexp_replace({text}, r'(?s)\\.', '__')"
    return f"array_join(transform(split({unescaped}, '\"', -1), (p, i) -> if(i % 2 = 1, repeat('_', length(p)), p)), '_')"


def pieces(blank: str) -> str:
    """The blanked text cut before every bracket and comma."""
    return rf"split({blank}, r'(?=[\[\]{{}},])', -1)"


def running(parts: str) -> str:
    """Each piece as (mark, depth after it, place of its end): its first character, and the two running sums."""
    step = """transform({0}, p -> named_struct('mark', left(p, 1),
      'depth', CASE WHEN left(p, 1) IN ('{{', '[') THEN 1 WHEN left(p, 1) IN ('}}', ']') THEN -1 ELSE 0 END, 'to', length(p)))""".format(parts)
    back = "get(a, i - shiftleft(1, s))"
    doubled = f"""(a, s) -> transform(a, (x, i) -> named_struct('mark', x.mark,
      'depth', x.depth + coalesce({back}.depth, 0), 'to', x.to + coalesce({back}.to, 0)))"""
    return f"aggregate(sequence(0, CAST(ceil(log2(size({parts}))) AS INT)), {step}, {doubled})"


def bounds(sums: str, parts: str, depth: int, brackets: str = "[]") -> str:
    """The places of the list's opening bracket, its commas and its closing bracket; the list is the one at ``depth``."""
    begin, end = brackets
    held = f"""(x.mark = '{begin}' AND x.depth = {depth}) OR (x.mark = ',' AND x.depth = {depth}) OR (x.mark = '{end}' AND x.depth = {depth - 1})"""
    placed = f"transform({sums}, (x, i) -> named_struct('mark', x.mark, 'depth', x.depth, 'at', x.to - length({parts}[i])))"
    return f"transform(filter({placed}, x -> {held}), x -> x.at)"


def cut(text: str, places: str) -> str:
    """The texts between neighbouring places, without the white space around them; a list of nothing has none."""
    first = f"{places}[{_STRETCH} * g]"
    last = f"{places}[least({_STRETCH} * (g + 1), size({places}) - 1)]"
    stretches = f"transform(sequence(0, (size({places}) - 2) div {_STRETCH}), g -> substring({text}, {first} + 1, {last} - {first}))"
    begin = f"{places}[k] - {places}[{_STRETCH} * (k div {_STRETCH})]"
    one = f"substring(s[k div {_STRETCH}], {begin} + 2, {places}[k + 1] - {places}[k] - 1)"
    trimmed = f"regexp_replace({one}, r'^[ \\t\\n\\r]+|[ \\t\\n\\r]+$', '')"
    # The stretches are bound to a name, so that they are cut once and not for every element.
    each = f"transform(array({stretches}), s -> transform(sequence(0, size({places}) - 2), k -> {trimmed}))[0]"
    return f"CASE WHEN size({places}) >= 2 THEN filter({each}, (e, i) -> e <> '' OR size({places}) > 2) END"


def with_members(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds ``name``, the members of the object that column ``text`` holds, as (key, value) texts; NULL where it holds none.

    Keys come as often as they were sent, where a parse would fold or refuse them.  A member is cut at its first
    colon outside strings.  Nothing here looks below the members.
    """
    blank, parts, sums, places, shapes, said = (f"_{name}_{step}" for step in ("blank", "pieces", "sums", "places", "shapes", "said"))
    staged = df.selectExpr("*", f"CASE WHEN startswith({text}, '{{') THEN {blanked(text)} END AS {blank}")
    for step, value in (
        (parts, pieces(blank)),
        (sums, running(parts)),
        (places, bounds(sums, parts, 1, "{}")),
        (shapes, cut(blank, places)),
        (said, cut(text, places)),
    ):
        staged = staged.selectExpr("*", f"{value} AS {step}")
    colon = f"locate(':', m.{shapes})"
    key = f"from_json(concat('[', left(m.{said}, {colon} - 1), ']'), 'array<string>')[0]"
    value = f"trim(LEADING ' \\t\\n\\r' FROM substring(m.{said}, {colon} + 1))"
    found = f"transform(arrays_zip({said}, {shapes}), m -> named_struct('key', {key}, 'value', {value})) AS {name}"
    return staged.selectExpr(*df.columns, found)


def kind_of(value: str) -> str:
    """The kind of a JSON value, from its text."""
    return f"""CASE left({value}, 1)
      WHEN '"' THEN 'text' WHEN '{{' THEN 'object' WHEN '[' THEN 'list' WHEN 't' THEN 'boolean' WHEN 'f' THEN 'boolean' WHEN 'n' THEN 'null'
      ELSE if({value} RLIKE '^-?[0-9]+$' AND try_cast({value} AS BIGINT) IS NOT NULL, 'integer', 'number')
    END"""
