"""Mixing sources to target weights by Poisson replication.

A source's repetition rate is its target share of all characters over its present share, so
that the mix is as large as the corpus, or ``size`` times that.  Each document is drawn
Poisson(rate) times: a uniform number taken from the hash of seed and document is
looked up in the distribution's cumulative sums.  The draw depends on nothing but
the document, so a task that runs again draws the same.  A rate above ``STEP`` is
drawn as a sum of independent Poisson draws of at most that rate each, which is
exact and keeps every table of sums short; no rate is capped.

The copies are then dealt over all partitions by a hash of their own and sorted
by it within each: the global shuffle.  The hot source is no hot key there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.llm.common import documents, packed, written

#: Largest rate of one draw.
STEP = 16.0
#: Cumulative sums kept for a draw: beyond this place the tail of Poisson(16) is under 1e-20.
PLACES = 80
#: Exponent of a source's present share in its default target: 1 keeps shares, 0 evens them out.
TEMPERATURE = 0.5
SEED = "mix-1"


def _uniform(salt: Column, key: Column) -> Column:
    """A number in [0, 1) with 52 bits, from the hash of salt and key."""
    return F.conv(F.substring(F.md5(F.concat(salt, F.lit(":"), key).cast("binary")), 1, 13), 16, 10).cast("double") / float(2**52)


def repetition_rates(docs: DataFrame, weights: dict[str, float] | None = None, size: float = 1.0) -> DataFrame:
    """``source`` with ``rate``, the mean number of copies of each of its documents.

    ``weights`` names the share of each source; a source it leaves out gets none.
    Without it, a source's weight is its number of characters to the power
    ``TEMPERATURE``.  A source without any characters has rate 0.
    """
    chars = F.sum(F.coalesce(F.length("text"), F.lit(0))).cast("double")
    sizes = docs.groupBy("source").agg(chars.alias("chars"))
    if weights is None:
        weight = F.pow("chars", F.lit(TEMPERATURE))
    else:
        pairs = [F.lit(x) for name, w in weights.items() for x in (name, float(w))]
        weight = F.coalesce(F.create_map(*pairs)[F.col("source")], F.lit(0.0)) if pairs else F.lit(0.0)
    weighed = written(sizes.withColumn("weight", F.when(F.col("chars") > 0, weight).otherwise(0.0)), "mix-sizes")
    total = weighed.agg(F.sum("chars").alias("chars"), F.sum("weight").alias("weight")).first()
    if not total["weight"]:
        return weighed.select("source", F.lit(0.0).alias("rate"))
    rate = F.col("weight") / F.lit(total["weight"]) * F.lit(total["chars"]) * size / F.col("chars")
    return weighed.select("source", F.coalesce(rate, F.lit(0.0)).alias("rate"))


def _sums(rate: Column) -> Column:
    """The cumulative sums of Poisson(rate), from 0 events up."""
    terms = F.aggregate(
        F.sequence(F.lit(1), F.lit(PLACES)),
        F.array(F.exp(-rate)),
        lambda a, k: F.array_append(a, F.get(a, F.size(a) - 1) * rate / k),
    )
    return F.aggregate(
        terms,
        F.array().cast("array<double>"),
        lambda a, p: F.array_append(a, F.coalesce(F.get(a, F.size(a) - 1), F.lit(0.0)) + p),
    )


def mix(docs: DataFrame, weights: dict[str, float] | None = None, size: float = 1.0, seed: str = SEED) -> DataFrame:
    """The copies drawn: struct ``doc`` with all columns, ``copy`` (from 1), ``shuffle_key``; shuffled.

    Documents are told apart by id and text; rows that repeat both are drawn alike.
    A null source is a source of its own; it cannot be named in ``weights``.  A null
    or empty text weighs nothing but is drawn like its source.  A null id is an id.
    Nothing is drawn of an empty table.  Extra columns are carried in the struct.
    """
    rates = repetition_rates(docs, weights, size).where("rate > 0")
    draws = F.greatest(F.lit(1), F.ceil(F.col("rate") / STEP)).cast("int")
    table = rates.select("source", draws.alias("draws"), (F.col("rate") / draws).alias("step"))
    table = written(table.select(F.col("source").alias("mix_source"), "draws", _sums(F.col("step")).alias("sums")), "mix-rates")
    identity = F.concat_ws("\n", F.col("doc_id").cast("string"), F.md5(F.col("text").cast("binary")))
    rows = docs.select(packed(docs).alias("doc"), identity.alias("id"))
    met = rows.join(table, F.col("doc.source").eqNullSafe(F.col("mix_source")))
    one = lambda j: F.size(
        F.filter("sums", lambda s: s <= _uniform(F.concat(F.lit(f"{seed}:"), j.cast("string")), F.col("id")))
    )
    times = F.aggregate(F.sequence(F.lit(1), F.col("draws")), F.lit(0), lambda a, j: a + one(j))
    drawn = met.select("doc", "id", times.alias("times")).where("times > 0")
    copies = drawn.select("doc", "id", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy"))
    dealt = copies.withColumn("shuffle_key", F.md5(F.concat(F.lit(f"{seed}:deal:"), "copy", F.lit(":"), "id").cast("binary")))
    spread = dealt.drop("id").repartition(F.col("shuffle_key"))
    return spread.sortWithinPartitions("shuffle_key")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(documents(spark, sf_dir))
    return mixed.select(F.col("doc.doc_id").alias("doc_id"), F.col("doc.source").alias("source"), "copy", "shuffle_key", F.col("doc.text").alias("text"))


ORACLE_SQL = f"""
WITH sizes AS (
  SELECT source, CAST(sum(coalesce(length(text), 0)) AS DOUBLE) AS chars, pow(sum(coalesce(length(text), 0)), {TEMPERATURE}) AS w
  FROM documents GROUP BY source),
rates AS (
  SELECT source, w / (SELECT sum(w) FROM sizes) * (SELECT sum(chars) FROM sizes) / chars AS rate FROM sizes WHERE chars > 0),
steps AS (SELECT source, rate, CAST(greatest(1, ceil(rate / {STEP})) AS INTEGER) AS draws FROM rates WHERE rate > 0),
terms AS (
  SELECT source, draws, k, exp(-(rate / draws) + k * ln(rate / draws) - lgamma(k + 1)) AS p
  FROM steps, (SELECT unnest(range({PLACES + 1})) AS k)),
sums AS (SELECT source, draws, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS s FROM terms),
tables AS (SELECT source, draws, list(s ORDER BY k) AS sums FROM sums GROUP BY source, draws),
ids AS (
  SELECT d.doc_id, d.source, d.text, t.draws, t.sums, concat_ws(chr(10), CAST(d.doc_id AS VARCHAR), md5(d.text)) AS id
  FROM documents d JOIN tables t ON d.source IS NOT DISTINCT FROM t.source),
drawn AS (
  SELECT *, unnest(range(1, draws + 1)) AS j FROM ids),
numbers AS (
  SELECT *, CAST(CAST('0x' || substr(md5('{SEED}:' || j || ':' || id), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS u
  FROM drawn),
counts AS (
  SELECT doc_id, source, text, id, CAST(sum(len(list_filter(sums, lambda s: s <= u))) AS INTEGER) AS times FROM numbers
  GROUP BY doc_id, source, text, id),
copies AS (SELECT doc_id, source, text, id, unnest(range(1, times + 1)) AS n FROM counts)
SELECT doc_id, source, CAST(n AS INTEGER) AS copy, md5('{SEED}:deal:' || n || ':' || id) AS shuffle_key, text FROM copies
"""
