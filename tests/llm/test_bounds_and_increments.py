"""Ledgers that grow, texts of very many matches, short benchmark items, and samples that stay bounded."""

import re
import time

import numpy as np
from pyspark.sql import functions as F

from recordlake.llm import decontaminate, jaccard_join, secrets, textmodels
from recordlake.llm.textkernel import shingles

DOCS = "doc_id long, text string, lang string"


def ledger_rows(spark, path):
    return sorted((r["kind"], r["version"]) for r in secrets.open_ledger(spark, path).collect())


def test_a_second_run_scans_nothing_and_a_new_rule_scans_only_itself(spark, tmp_path):
    path = f"{tmp_path}/ledger"
    versions = spark.createDataFrame([(1, "key 0123456789abcdef", "a"), (2, "key 0123456789abcdef", "b"), (3, None, "c")], DOCS)
    found = {r["version"]["doc_id"]: [(f["kind"], f["start"], f["end"]) for f in r["findings"]] for r in secrets.scan_secrets(versions, "text", path).collect()}
    assert found == {1: [("hex", 4, 20)], 2: [("hex", 4, 20)], 3: []}
    once = ledger_rows(spark, path)
    assert once == sorted((r.kind, r.version) for r in secrets.RULES for _ in range(2))
    secrets.extend_ledger(versions, "text", path)
    assert ledger_rows(spark, path) == once
    newer = (*secrets.RULES[:2], secrets.Rule("hex", 2, r"[0-9a-f]{8,}", 0, 8))
    secrets.extend_ledger(versions, "text", path, newer)
    assert ledger_rows(spark, path) == sorted(once + [("hex", 2)] * 2)
    more = versions.unionByName(spark.createDataFrame([(4, "new deadbeefdeadbeef", "d")], DOCS))
    secrets.extend_ledger(more, "text", path, newer)
    assert len(ledger_rows(spark, path)) == len(once) + 2 + 3
    assert secrets.scan_secrets(versions.limit(0), "text", f"{tmp_path}/empty").count() == 0


def test_a_text_of_very_many_matches_is_scanned_in_little_time(spark, tmp_path):
    text = "".join(f"é {i:016x} token={'x' * (5 + i % 14)};" for i in range(64_000))
    begun = time.time()
    (row,) = secrets.scan_secrets(spark.createDataFrame([(1, text, "a")], DOCS), "text", f"{tmp_path}/ledger").collect()
    assert time.time() - begun < 60
    want = [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]{16,}", text)]
    want += [("assign", m.start(), m.end()) for m in re.finditer(r"token=(x+)", text) if len(m[1]) >= 12]
    assert sorted((f["kind"], f["start"], f["end"]) for f in row["findings"]) == sorted(want)


def test_short_items_are_found_as_they_are_between_words(spark):
    benchmark = spark.createDataFrame([(1, "What is the capital of Chad"), (2, "two"), (3, ""), (4, None), (5, "A?"), (None, "x")], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, "so: what  is the capital of chad?", ""), (2, "What is the capitol of Chad", ""), (3, "one-two", ""), (4, "network twofold", ""), (5, "TWO", ""),
         (6, "is it a?b", ""), (7, None, ""), (8, "What is the capital of Chadwick", "")], DOCS)
    got = {r["doc"]["doc_id"]: r["item_ids"] for r in decontaminate.contaminated(docs, benchmark).collect()}
    assert got == {1: [1], 2: [], 3: [2], 4: [], 5: [2], 6: [5], 7: [], 8: []}


def test_a_sample_is_bounded_whatever_repeats(spark):
    docs = spark.range(4000).select(
        F.when(F.col("id") < 3000, 1).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("t "), F.col("id").cast("string")).alias("text")
    )
    labels = spark.range(4000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("toxic"))
    sample = textmodels.labelled_sample(docs, labels, "toxic", 5000).collect()
    assert len(sample) == len({r["doc_id"] for r in sample}) <= 1001
    assert [r["text"] for r in sample if r["doc_id"] == 1] in ([], ["t 0"])


def test_sketches_turn_away_no_pair_that_links():
    rng = np.random.default_rng(4)
    turned = 0
    for n in (1, 3, 40, 700):
        for share in (0.3, 0.6, 0.8, 0.86, 0.9, 1.0):
            for extra in (0, n // 5, n // 3):
                a = rng.integers(0, 2**63, n, dtype=np.uint64)
                b = np.concatenate([a[: int(n * share)], rng.integers(0, 2**63, n - int(n * share) + extra, dtype=np.uint64)])
                both = len(np.intersect1d(a, b))
                may = jaccard_join._may_link(len(a), jaccard_join.sketch(a), len(b), jaccard_join.sketch(b))
                assert may or 100 * both < 75 * (len(a) + len(b) - both)
                turned += not may
    assert turned > 10
    data = np.frombuffer(b"one two three four five six", dtype=np.uint8)
    assert len(shingles(data, np.array([0, len(data)]), 5)[0]) == 2


def test_rows_that_a_join_cannot_need_are_left_out_before_its_shuffle(spark):
    rows = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("key"), F.when(F.col("id") != 3, F.col("id")).alias("id"))
    needed = rows.where("id IS NULL OR id % 50 = 0").select("key", "id")
    kept = jaccard_join._maybe(rows, ["key", "id"], needed.unionByName(needed))
    assert kept.columns == ["key", "id"]
    told = kept.collect()
    assert {r.key for r in needed.collect()} <= {r.key for r in told}
    assert 401 <= len(told) < 600
    assert jaccard_join._maybe(rows, ["key"], needed.where("id < 0")).count() == 0
