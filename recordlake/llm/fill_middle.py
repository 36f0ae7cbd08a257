"""Fill-in-middle transformation: texts cut at two token ranks, found by an indexable skip list, and laid out anew.

A text is a list of tokens, each with a width in code points.  The skip list over
them has lanes: the base lane links every token to the next, and each express lane
links those that the lane below promotes, about one in four.  Every link carries
how many tokens and how many code points it spans.  A rank is reached by walking
the highest lane while its links do not overshoot, then the one below; the widths
added up on the way are the exact place of the cut, so that no text is sliced
before both of its cuts are known.  The tokens of very long texts are never
Python objects; a lane is a few arrays.

Which tokens a lane promotes depends on a hash of their place alone, so that every run
of a task builds the same lanes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from recordlake.llm.common import documents, packed
from recordlake.llm.textkernel import mix, slices

# Fixed values of the transformation.
SEED = 42
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of a hundred texts so many are transformed, and of a hundred of those so many get their suffix first.
TRANSFORMED = 50
SUFFIX_FIRST = 80

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class _Towers:
    """For every express lane the places it holds, and where each of them is in the lane below; grown as needed."""

    def __init__(self):
        self.size, self.lanes = 0, []

    def upto(self, n: int) -> list[tuple[np.ndarray, np.ndarray]]:
        if n > self.size:
            self.size = max(2 * self.size, n, 1 << 16)
            draw = mix(np.arange(1, self.size + 1, dtype=np.uint64))
            below, self.lanes = np.arange(self.size), []
            while len(below) > 4:
                up = draw[below] & np.uint64(3) == 0
                up[0] = True
                draw = draw >> np.uint64(2)
                down = np.flatnonzero(up)
                if len(down) == len(below):
                    break
                below = below[down]
                self.lanes.append((below, down))
        return self.lanes


_TOWERS = _Towers()


class SkipList:
    """Lanes of links over tokens; a link spans a number of tokens and a number of code points."""

    def __init__(self, widths: np.ndarray):
        n = len(widths)
        self.units, self.chars, self.down = [np.ones(n, dtype=np.int64)], [widths], [None]
        for places, down in _TOWERS.upto(n):
            held = int(np.searchsorted(places, n))
            if held < 2:
                break
            down = down[:held]
            self.units.append(np.add.reduceat(self.units[-1], down))
            self.chars.append(np.add.reduceat(self.chars[-1], down))
            self.down.append(down)

    def chars_before(self, rank: int) -> int:
        """The code points of the first ``rank`` tokens."""
        units = chars = at = 0
        for lane in range(len(self.units) - 1, -1, -1):
            spans, widths = self.units[lane], self.chars[lane]
            while at < len(spans) and units + spans[at] <= rank:
                units += int(spans[at])
                chars += int(widths[at])
                at += 1
            if units == rank or at == len(spans):
                break
            if lane:
                at = int(self.down[lane][at])
        return chars


def token_widths(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all tokens of some texts, and for each text the place of its first token (and the end).

    A token is a word with the white space before it; white space at the end of a text is one more.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, dtype=np.int64), np.zeros(len(offsets), dtype=np.int64)
    space = _SPACE[data]
    ends = np.zeros(n, dtype=bool)
    ends[:-1] = ~space[:-1] & space[1:]
    filled = offsets[1:] > offsets[:-1]
    ends[offsets[1:][filled] - 1] = True
    last = np.flatnonzero(ends) + 1
    chars = np.zeros(n + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=chars[1:])
    return np.diff(chars[last], prepend=0), np.searchsorted(last, offsets, side="right")


def _cut_rows(shape: StructType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first_draw, second_draw = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2"))
            sizes, cuts, ends = [], [], []
            for start, data, offsets in slices(batch.column("text")):
                widths, first = token_widths(data, offsets)
                for i in range(len(offsets) - 1):
                    n = int(first[i + 1] - first[i])
                    ranks = sorted((int(first_draw[start + i]) % (n + 1), int(second_draw[start + i]) % (n + 1)))
                    lanes = SkipList(widths[first[i] : first[i + 1]])
                    sizes.append(n)
                    cuts.append(lanes.chars_before(ranks[0]))
                    ends.append(lanes.chars_before(ranks[1]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc", "h3", "h4")), *(pa.array(c, pa.int64()) for c in (sizes, cuts, ends))],
                [f.name for f in shape],
            )

    return run


def restored(output: Column, form: Column) -> Column:
    """The text that was transformed, from the output and its form alone."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    part = lambda i: F.get(parts, F.lit(i))
    return (
        F.when(form == "psm", F.concat(part(1), part(3), part(2)))
        .when(form == "spm", F.concat(part(2), part(3), part(1)))
        .otherwise(output)
    )


def fill_middle(docs: DataFrame) -> DataFrame:
    """Every row as ``doc`` (all columns), with ``n`` (tokens), ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    Draws come from a hash of the id, so rows that repeat an id get equal draws; a null id
    draws as the empty text.  A null or empty text, one that holds a marker, and one that is
    not drawn stay plain, with null widths.  Texts of white space alone are one token.
    Extra columns of any name stay in the struct; an empty table gives an empty result.
    """
    hashed = F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    draw = lambda i: F.conv(F.substring(hashed, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}")
    rows = docs.select(packed(docs).alias("doc"), F.col("text"), *[draw(i) for i in range(4)])
    shape = StructType([rows.schema["doc"], *(StructField(c, LongType()) for c in ("h3", "h4", "n", "cut", "end"))])
    text = F.coalesce(F.col("doc.text"), F.lit(""))
    marked = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    plain = (F.col("n") == 0) | marked | (F.col("h3") % 100 >= TRANSFORMED)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < SUFFIX_FIRST, "spm").otherwise("psm")
    cut = rows.mapInArrow(_cut_rows(shape), shape).select("doc", "n", "cut", "end", form.alias("form"))
    middle_chars = F.col("end") - F.col("cut")
    sub = lambda start, size: F.substr(text, start.cast("int"), size.cast("int"))
    prefix, middle = sub(F.lit(1), F.col("cut")), sub(F.col("cut") + 1, middle_chars)
    suffix = F.substr(text, (F.col("end") + 1).cast("int"))
    output = (
        F.when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .when(F.col("form") == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
        .otherwise(text)
    )
    width = lambda c, name: F.when(F.col("form") != "plain", c).alias(name)
    return cut.select(
        "doc", "n", "form", width(F.col("cut"), "prefix_chars"), width(middle_chars, "middle_chars"), output.alias("output")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = fill_middle(documents(spark, sf_dir).select("doc_id", "text"))
    sha = lambda c, name: F.sha2(c.cast("binary"), 256).alias(name)
    return told.select(
        F.col("doc.doc_id").alias("doc_id"),
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        sha(F.col("output"), "output_sha256"),
        sha(restored(F.col("output"), F.col("form")), "restored_sha256"),
    )


ORACLE_SQL = rf"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
cut AS (
  SELECT doc_id, text, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens,
    CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
    CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM drawn),
ranks AS (
  SELECT *, CAST(len(tokens) AS BIGINT) AS n, least(h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)) AS a,
    greatest(h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)) AS b FROM cut),
parts AS (
  SELECT doc_id, text, n, array_to_string(tokens[1:a], '') AS p, array_to_string(tokens[a + 1:b], '') AS m,
    array_to_string(tokens[b + 1:], '') AS s,
    CASE WHEN n = 0 OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}') OR h3 % 100 >= {TRANSFORMED}
      THEN 'plain' WHEN h4 % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form FROM ranks)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
    WHEN 'spm' THEN '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m ELSE text END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""
