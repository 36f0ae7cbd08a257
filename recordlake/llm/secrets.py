"""Secret scans over a ledger of blobs: every version is addressed by content and scanned once per rule version.

A version's content is known by its SHA-256.  The ledger, a table in shared
storage, holds a row for each blob and rule version that has been scanned, with
the spans found (none, often).  A run reduces all versions to distinct blobs,
scans only the pairs that the ledger lacks, appends them, and joins findings back
to every path that ever held the blob.  Appending is Spark's atomic job commit;
a run that is lost half-way leaves pairs unscanned, never half a finding, and a
pair recorded twice by two runs at once counts once.

Patterns run in the JVM.  Spark gives the matches of a pattern and the texts
between them, not their places; the lengths of both, added up, are the places.
The work on a text is linear in its length, and in its matches but for a logarithm.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.llm.common import documents, packed, written
from recordlake.session import scratch_path


@dataclass(frozen=True)
class Rule:
    """One kind of secret.  ``least`` is the length that group ``value`` of a match must have."""

    kind: str
    version: int
    pattern: str
    value: int
    least: int

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The base kinds, in their order.  A run of hex digits, or of key characters after AKIA, is always
# matched to its end, so that asking for its least length in the pattern finds the same spans as asking afterwards.
# An assignment is different: one that is too short still uses up its text, so its length is judged afterwards.
RULES = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", 1, r"AKIA[A-Z0-9]{14,}", 0, 18),
    Rule("hex", 1, r"[0-9a-f]{16,}", 0, 16),
)

LEDGER_SCHEMA = "blob binary, kind string, version int, spans array<struct<start:long,end:long>>"


def rule_spans(text: Column, rule: Rule) -> Column:
    """The spans of a rule in a text, in code points: leftmost and not overlapping."""
    none = F.expr("CAST(array() AS array<struct<start:long,end:long>>)")
    lengths = lambda found: F.transform(found, lambda x: F.length(x).cast("long"))
    matches = lengths(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)))
    values = lengths(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.value)))
    between = lengths(F.split(text, rule.pattern, -1))
    # There is one text between more than there are matches: the one after the last.
    parts = F.filter(F.arrays_zip(matches.alias("n"), values.alias("value"), between.alias("to")), lambda z: z["n"].isNotNull())
    steps = F.transform(parts, lambda z: F.struct(z["n"], z["value"], (z["to"] + z["n"]).alias("to")))
    spans = F.transform(
        F.filter(_running(steps), lambda x: x["value"] >= rule.least),
        lambda x: F.struct((x["to"] - x["n"]).alias("start"), x["to"].alias("end")),
    )
    return F.when(F.rlike(text, F.lit(rule.pattern)), spans).otherwise(none)


def _running(steps: Column) -> Column:
    """``to`` of every step added up from the first, by doubling: n steps take log n passes, each linear."""

    def doubled(a: Column, s: Column) -> Column:
        back = lambda i: F.get(a, i - F.pow(F.lit(2.0), s).cast("int"))
        return F.transform(a, lambda x, i: F.struct(x["n"], x["value"], (x["to"] + F.coalesce(back(i)["to"], F.lit(0))).alias("to")))

    passes = lambda a: F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(a), F.lit(1)))).cast("int"))
    # Bound to a name by the array around it, so that the steps are worked out once.
    return F.transform(F.array(steps), lambda a: F.aggregate(passes(a), a, doubled))[0]


def open_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at ``path``, made empty if there is none."""
    spark.createDataFrame([], LEDGER_SCHEMA).write.mode("append").parquet(path)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def extend_ledger(versions: DataFrame, content: str, ledger_path: str, rules: tuple[Rule, ...] = RULES) -> None:
    """Scan the blobs of ``versions`` by the rules the ledger does not hold for them, and append what is found."""
    spark = versions.sparkSession
    text = F.coalesce(F.col(content), F.lit(""))
    hashed = versions.select(text.alias("text"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("blob"))
    seen = open_ledger(spark, ledger_path).groupBy("blob").agg(F.collect_set(F.concat("kind", F.lit("@"), "version")).alias("seen"))
    if not seen.isEmpty():
        # Hashes first: of the texts only those of blobs with something left to scan are moved.
        wanted = F.array(*[F.lit(r.name) for r in rules])
        left = hashed.select("blob").distinct().join(seen, "blob", "left").where(
            F.col("seen").isNull() | (F.size(F.array_except(wanted, F.col("seen"))) > 0)
        )
        left = written(left, "secret-left")
        hashed = hashed.join(left.select("blob"), "blob", "left_semi")
        seen = left
    fresh = hashed.groupBy("blob").agg(F.first("text").alias("text")).join(seen, "blob", "left")
    lacks = lambda rule: F.coalesce(~F.array_contains("seen", rule.name), F.lit(True))
    found = [
        F.when(
            lacks(r),
            F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), rule_spans(F.col("text"), r).alias("spans")),
        )
        for r in rules
    ]
    scanned = fresh.select("blob", F.inline(F.array_compact(F.array(*found))))
    scanned.write.mode("append").parquet(ledger_path)


def scan_secrets(versions: DataFrame, content: str, ledger_path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Findings of every version: its columns without the content as struct ``version``, ``blob``, and ``findings``.

    ``findings`` is a sorted array of (start, rank of the kind, end, kind).  A
    null content is the empty text.  Versions that repeat, ties and any number of
    paths with one content are each answered; extra columns of any name are
    carried in the struct.  No versions, no findings.
    """
    extend_ledger(versions, content, ledger_path, rules)
    rank = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.name, i)])
    ledger = open_ledger(versions.sparkSession, ledger_path)
    current = ledger.withColumn("rank", rank[F.concat("kind", F.lit("@"), "version")]).where("rank IS NOT NULL")
    told = F.transform(
        "spans", lambda s: F.struct(s["start"].alias("start"), F.col("rank"), s["end"].alias("end"), F.col("kind"))
    )
    found = current.where(F.size("spans") > 0).groupBy("blob").agg(F.sort_array(F.flatten(F.collect_set(told))).alias("findings"))
    kept = versions.drop(content)
    text = F.coalesce(F.col(content), F.lit(""))
    paths = versions.select(packed(kept).alias("version"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("blob"))
    none = F.expr("CAST(array() AS array<struct<start:long,rank:int,end:long,kind:string>>)")
    joined = paths.join(written(found, "secret-findings"), "blob", "left")
    return joined.select("version", "blob", F.coalesce("findings", none).alias("findings"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(documents(spark, sf_dir).select("doc_id", "text"), "text", scratch_path(spark, "secret-ledger"))
    count = lambda kind: F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")
    spans = F.array_join(
        F.transform("findings", lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ","
    )
    return found.select(
        F.col("version.doc_id").alias("doc_id"),
        *[count(r.kind) for r in RULES],
        F.sha2(spans.cast("binary"), 256).alias("base_sha256"),
        spans.alias("spans"),
    )


_KIND_SQL = r"""
SELECT doc_id, '{kind}' AS kind, {rank} AS rank, unnest(regexp_extract_all(text, r, {value})) AS v,
  unnest(regexp_extract_all(text, r, 0)) AS m, unnest(string_split_regex(text, r)[:-2]) AS gap,
  unnest(range(len(regexp_extract_all(text, r, 0)))) AS i
FROM (SELECT doc_id, coalesce(text, '') AS text, '{pattern}' AS r FROM documents)
"""

ORACLE_SQL = f"""
WITH hits AS ({" UNION ALL ".join(_KIND_SQL.format(kind=r.kind, rank=i, value=r.value, pattern=r.pattern.replace("'", "''")) for i, r in enumerate(RULES))}),
placed AS (
  SELECT *, CAST(sum(length(gap) + length(m)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS BIGINT) AS e FROM hits),
spans AS (
  SELECT doc_id, kind, rank, e - length(m) AS s, e FROM placed
  WHERE length(v) >= CASE kind WHEN 'assign' THEN 12 WHEN 'access' THEN 18 ELSE 16 END),
told AS (
  SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS a, count(*) FILTER (WHERE kind = 'access') AS b,
    count(*) FILTER (WHERE kind = 'hex') AS c, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex,
  sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN told t ON t.doc_id = d.doc_id
"""
