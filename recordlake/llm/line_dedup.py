"""Line dedup: repeated windows of three lines, found over all documents; later occurrences go.

Every document is cut at its newlines and every three lines in a row make a
window, so windows overlap.  A window is known by the 128-bit hash of its three
lines.  Where a window occurs more than once, its first occurrence stays (lowest
document id, a null one before all, then position) and each later one covers its three lines; the union
of what is covered is removed.  Whatever is removed survives word for word at an
earlier place, also where occurrences overlap: of ten equal lines one is left.

Plan: one map pass makes the windows, one aggregation with map-side partials
finds the repeated ones, and a join of occurrences with repeated windows, which
adaptive execution may split at a hot window, marks what goes.  Document texts
move once, to meet their covered positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.llm.common import documents, packed, refitted, written

#: Lines in a window.
WIDTH = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _key(doc_id: Column, text: Column) -> Column:
    """The identity of a document: its id with its text, so that rows that repeat are one document."""
    return F.unhex(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("\n"), text).cast("binary")))


def window_occurrences(docs: DataFrame) -> DataFrame:
    """Each window of each document: ``window``, ``place`` (id, key and position, in the order of precedence).

    A window of blank lines alone is no passage and is left out.
    """
    cut = docs.select(F.col("doc_id"), F.col("text")).where(F.contains("text", F.lit("\n")))
    cut = cut.select("doc_id", _key(F.col("doc_id"), F.col("text")).alias("key"), _lines(F.col("text")).alias("lines"))
    starts = F.when(F.size("lines") >= WIDTH, F.sequence(F.lit(0), F.size("lines") - WIDTH))
    joined = F.transform(starts, lambda i: F.array_join(F.slice("lines", i + 1, F.lit(WIDTH)), "\n"))
    hashes = F.transform(joined, lambda w: F.when(F.trim(F.translate(w, "\n\t\r", "   ")) != "", F.md5(w.cast("binary"))))
    spread = cut.select("doc_id", "key", F.posexplode(hashes).alias("pos", "window")).where("window IS NOT NULL")
    return spread.select(F.unhex("window").alias("window"), F.struct("doc_id", "key", "pos").alias("place"))


def covered_starts(docs: DataFrame) -> DataFrame:
    """``key`` of each document with ``starts``, the sorted positions of its windows that occurred before."""
    occurrences = written(window_occurrences(docs), "line-windows")
    repeated = occurrences.groupBy("window").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    repeated = written(repeated.where("n > 1").select("window", "first"), "line-repeats")
    later = occurrences.join(repeated, "window").where("place <> first")
    return later.groupBy(F.col("place.key").alias("key")).agg(F.sort_array(F.collect_set("place.pos")).alias("starts"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages taken out of ``text``, beside ``n_lines`` and ``n_removed``.

    All columns are kept, in a struct ``doc`` (so extra columns of any name are
    safe); ``n_chars`` follows the text.  A null text has no lines and stays
    null; the empty text is one empty line.  Texts of fewer than three lines have
    no window and stay as they are.  Rows that repeat an id and its text are one
    document and get the same result each.  An empty table gives an empty result.
    """
    rows = docs.select(packed(docs).alias("doc"), _key(F.col("doc_id"), F.col("text")).alias("key"))
    met = rows.join(covered_starts(docs), "key", "left")
    lines, starts = _lines(F.col("doc.text")), F.col("starts")
    run_first = F.filter(starts, lambda s, i: (i == 0) | (s - F.get(starts, i - 1) > WIDTH))
    run_last = F.filter(starts, lambda s, i: (i == F.size(starts) - 1) | (F.get(starts, i + 1) - s > WIDTH))
    gaps = F.arrays_zip(
        F.concat(F.array(F.lit(0)), F.transform(run_last, lambda s: s + WIDTH)).alias("a"),
        F.concat(run_first, F.array(F.size(lines))).alias("b"),
    )
    kept = F.flatten(F.transform(gaps, lambda g: F.slice(lines, g["a"] + 1, g["b"] - g["a"])))
    told = met.select("doc", lines.alias("lines"), F.when(starts.isNotNull(), kept).alias("kept"))
    text = F.coalesce(F.array_join("kept", "\n"), F.col("doc.text"))
    doc = F.struct(*refitted(docs, "doc", text))
    n_lines = F.coalesce(F.size("lines"), F.lit(0))
    n_lines = F.when(F.col("doc.text").isNull(), 0).otherwise(n_lines)
    return told.select(
        doc.alias("doc"),
        n_lines.cast("long").alias("n_lines"),
        F.when(F.col("kept").isNull(), 0).otherwise(n_lines - F.size("kept")).cast("long").alias("n_removed"),
    )


ORACLE_SQL = r"""
WITH cut AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
spread AS (SELECT doc_id, lines, unnest(range(1, len(lines) - 1)) AS p FROM cut WHERE len(lines) >= 3),
windows AS (SELECT doc_id, p, array_to_string(lines[p:p + 2], chr(10)) AS w FROM spread),
marked AS (
  SELECT doc_id, p, row_number() OVER (PARTITION BY w ORDER BY doc_id, p) AS nth FROM windows
  WHERE trim(translate(w, chr(10) || chr(9) || chr(13), '   ')) <> ''),
gone AS (SELECT DISTINCT doc_id, unnest([p, p + 1, p + 2]) AS p FROM marked WHERE nth > 1),
kept AS (
  SELECT l.doc_id, l.p, l.line FROM (SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS p FROM cut) l
  ANTI JOIN gone g ON l.doc_id = g.doc_id AND l.p = g.p),
again AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY p) AS text, count(*) AS n FROM kept GROUP BY doc_id)
SELECT c.doc_id, CAST(coalesce(len(c.lines), 0) AS BIGINT) AS n_lines,
  CAST(coalesce(len(c.lines), 0) - coalesce(a.n, 0) AS BIGINT) AS n_removed,
  CASE WHEN c.text IS NOT NULL THEN sha256(coalesce(a.text, '')) END AS kept_sha256
FROM cut c LEFT JOIN again a ON a.doc_id = c.doc_id
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup_lines(documents(spark, sf_dir))
    return done.select(
        F.col("doc.doc_id").alias("doc_id"), "n_lines", "n_removed", F.sha2(F.col("doc.text").cast("binary"), 256).alias("kept_sha256")
    )
