"""Vector codes, recurrent scores and fill-in-middle, against brute force on odd rows."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordlake.llm import fill_middle, gated_model, recurrent_scores, vector_codes

SCHEMA = "doc_id long, text string, n long, form string, row string"
TEXTS = [
    (0, None),
    (1, ""),
    (2, " \t\n "),
    (3, "one"),
    (4, "  two words  "),
    (5, "has a <P> in it, so it stays as it is"),
    (6, "x< S> <<P é" + "ü" * 30),
    (7, "many words, " * 9000),
    (7, "the same id again"),
    (8, "the same id again"),
    (None, "no id"),
    *[(i, f"Der {i} und die {i % 7} gehen\x0bheim {'ja ' * (i % 11)}") for i in range(10, 90)],
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(d, t, 5, "clash", "clash") for d, t in TEXTS], SCHEMA).repartition(3)


def lowered(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


# --- fill in the middle


def transformed(doc_id, text):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    spm = h[3] % 100 < 80
    return len(units), "spm" if spm else "psm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"


def test_fill_middle_equals_brute_force_and_comes_back(docs):
    rows = fill_middle.fill_middle(docs)
    rows = rows.withColumn("back", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    got = [(r["doc"]["doc_id"], r["doc"]["text"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in rows]
    assert sorted(got, key=str) == sorted(((d, t, *transformed(d, t)) for d, t in TEXTS), key=str)
    assert all(r["back"] == (r["doc"]["text"] or "") for r in rows)
    assert {r["form"] for r in rows} == {"plain", "psm", "spm"}


def test_skip_list_reaches_every_rank():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 5, 300, 70_000):
        widths = rng.integers(1, 9, n)
        lanes = fill_middle.SkipList(widths)
        sums = np.concatenate([[0], np.cumsum(widths)])
        for rank in {0, n, *rng.integers(0, n + 1, 40).tolist()}:
            assert lanes.chars_before(rank) == sums[rank]
        if n > 1000:
            assert len(lanes.units) > 5 and all(u.sum() == n and c.sum() == sums[-1] for u, c in zip(lanes.units, lanes.chars))


# --- vector codes


def test_orchard_finds_the_nearest_and_the_lower_of_ties():
    rng = np.random.default_rng(5)
    for high in (3, 2000):
        book, queries = rng.integers(-high, high, (100, 6)), rng.integers(-high, high, (500, 6))
        book[50] = book[10]
        far = ((queries[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
        best, least = vector_codes.Orchard(book).nearest(queries)
        assert (best == far.argmin(axis=1)).all() and (least == far.min(axis=1)).all()


def test_codes_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    odd = [
        (1, [0.5, -0.25, 0.125, 1.0], 1, "a"),
        (1, [0.5, -0.25, 0.125, 1.0], 1, "a"),
        (2, [0.5, -0.3, 0.1, 1.5], None, "a"),
        (3, None, 1, "a"),
        (4, [0.1, None, 0.1, 0.1], 1, "a"),
        (5, [0.1, nan, inf, 0.1], 1, "a"),
        (None, [0.4, -0.25, 0.1, 0.9], None, "a"),
        (6, [], 2, "a"),
        (7, [1.0, 2.0, 3.0, 4.0, 5.0], 2, "a"),
    ]
    df = spark.createDataFrame(odd, "vec_id long, embedding array<double>, label int, code string")
    coded, books = vector_codes.compress(df)
    rows = coded.collect()
    assert sorted(str(r["vec"]["vec_id"]) for r in rows) == ["1", "1", "2", "6", "7", "None"]
    assert sorted(books) == [0, 4, 5]
    for r in rows:
        whole = [math.floor(1024 * x) for x in r["vec"]["embedding"]]
        near = vector_codes.reconstructed(r["code"], books[r["dim"]])
        assert r["error"] == sum((a - b) ** 2 for a, b in zip(whole, near.tolist()))
    coded, books = vector_codes.compress(df.limit(0))
    assert coded.count() == 0 and books == {}


def test_a_component_out_of_range_is_told(spark):
    df = spark.createDataFrame([(1, [1e300])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="67108864 or more"):
        vector_codes.compress(df)


# --- recurrent scores


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(1)
    w = gated_model.fresh(np.array(sorted(rng.integers(1, 50, 70), reverse=True)).astype(float), 20.0)
    w = {k: v.astype(np.float64) for k, v in w.items()}
    tokens, offsets = rng.integers(0, 71, 60), np.array([0, 30, 50, 60])
    before, target, active, valid = gated_model._laid_out(tokens, offsets[:-1], np.diff(offsets), 0, 30, 0)
    state = lambda: np.zeros((3, gated_model.STATE))

    def loss():
        states, _ = gated_model._walk(w, w["embed"][before] @ w["into"] + w["into_bias"], state(), active, False)
        return -gated_model._log_probability(w, states[valid].astype(np.float64), target[valid]).mean()

    told = gated_model._gradients(w, before, target, state(), active, valid)
    for name, g in told.items():
        i = np.abs(g).argmax()
        at = w[name].ravel()
        kept = at[i]
        at[i] = kept + 1e-3
        high = loss()
        at[i] = kept - 1e-3
        low = loss()
        at[i] = kept
        assert g.ravel()[i] == pytest.approx((high - low) / 2e-3, rel=1e-3)


def test_training_in_one_piece_is_adam_over_every_window():
    rng = np.random.default_rng(5)
    w = gated_model.fresh(np.arange(40, 0, -1).astype(float), 5.0)
    tokens, offsets = rng.integers(0, 41, 400), np.array([0, 300, 330, 330, 400])
    trainer = gated_model.Trainer(w, seed=3)
    trainer.learn(tokens, offsets, 0)
    assert trainer.tokens == 400
    # All weights are stretches of one array, and gradients are put into another.
    assert all(np.shares_memory(v, trainer.flat) for v in trainer.w.values())
    assert all(np.shares_memory(v, trainer.slope) for v in trainer.g.values())
    told, plain = w, {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items()}
    order = np.argsort(-np.diff(offsets), kind="stable")
    starts, sizes, h = offsets[:-1][order], np.diff(offsets)[order], np.zeros((4, gated_model.STATE), dtype=np.float32)
    for step, at in enumerate(range(0, 300, gated_model.TRUNCATED), 1):
        width, steps = int((sizes > at).sum()), min(gated_model.TRUNCATED, 300 - at)
        before, target, active, valid = gated_model._laid_out(tokens, starts[:width], sizes[:width], at, steps, 0)
        g = gated_model._gradients(told, before, target, h[:width], active, valid)
        scale = min(1.0, gated_model.CLIP / (np.sqrt(sum(float((v * v).sum()) for v in g.values())) + 1e-9))
        plain = {k: (0.9 * m + 0.1 * scale * g[k], 0.99 * v + 0.01 * (scale * g[k]) ** 2) for k, (m, v) in plain.items()}
        rate = gated_model.RATE * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
        told = {k: (v - rate * plain[k][0] / (np.sqrt(plain[k][1]) + 1e-6)).astype(np.float32) for k, v in told.items()}
    for name, v in told.items():
        assert trainer.w[name] == pytest.approx(v, rel=1e-2, abs=2e-3), name


def test_state_is_carried_and_probabilities_sum_to_one():
    rng = np.random.default_rng(2)
    w = gated_model.fresh(np.arange(40, 0, -1).astype(float), 5.0)
    w["word"], w["kind"] = rng.standard_normal(w["word"].shape).astype(np.float32), rng.standard_normal(w["kind"].shape).astype(np.float32)
    text = rng.integers(0, 41, 3000)
    whole = gated_model.score(w, np.concatenate([text, [3]]), np.array([0, 3000, 3001]), 0)
    kept, gated_model.WINDOW = gated_model.WINDOW, 64
    try:
        assert gated_model.score(w, np.concatenate([[3], text]), np.array([0, 1, 3001]), 0)[::-1] == pytest.approx(whole, rel=1e-5)
    finally:
        gated_model.WINDOW = kept
    each = [gated_model.score(w, np.append(text[:50], x), np.array([0, 51]), 0)[0] for x in range(41)]
    assert np.exp(np.array(each) - gated_model.score(w, text[:50], np.array([0, 50]), 0)).sum() == pytest.approx(1, rel=1e-4)


def test_every_token_of_every_training_document_is_learned_from(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{(i * k) % 13}" for k in range(20 * (i % 9)))) for i in range(60)] + [(60, None), (61, "long " * 5000)], "doc_id long, text string")
    counts = {r["hash"]: r["n"] for r in recurrent_scores.token_counts(docs).collect()}
    held = np.array(sorted(counts, key=counts.get, reverse=True), dtype=np.int64)
    lookup = recurrent_scores.Lookup(held.view(np.uint64), np.array([counts[h] for h in held.tolist()], dtype=np.float64), 8)
    weights = gated_model.fresh(np.array([counts[h] for h in held[:8].tolist()], dtype=np.float64), 1.0)
    learned = 0
    for turn in range(recurrent_scores.ROUNDS):
        rows = recurrent_scores.rounds(docs).where(F.col("round") == turn).select("text", F.spark_partition_id().alias("part"))
        learned += sum(r["n"] for r in rows.mapInArrow(recurrent_scores._train_rows(weights, lookup, 0, turn), "part int, n double, sums binary").collect())
    assert learned == sum(counts.values())


@pytest.mark.parametrize("lookup", [1 << 16, 8])
def test_scores_of_odd_rows(docs, monkeypatch, lookup):
    monkeypatch.setattr(recurrent_scores, "LOOKUP", lookup)
    monkeypatch.setattr(recurrent_scores, "VOCABULARY", min(lookup, 64))
    counts = collections.Counter()
    held = {d: d is None or zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in TEXTS}
    for d, t in TEXTS:
        if not held[d]:
            counts.update([*lowered(t), None])
    total, kinds = sum(counts.values()), len(counts)
    want = []
    for d, t in TEXTS:
        told = [*lowered(t), None]
        base = sum(math.log10((counts[x] + 0.1) / (total + 0.1 * (kinds + 1))) for x in told)
        want.append((str(d), held[d], len(told), sum(counts[x] > 0 for x in told), total, round(base, 6)))
    rows = recurrent_scores.score_texts(docs).collect()
    got = [(str(r["row"]["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows]
    assert sorted(got) == sorted(want)
    assert all(r["score"] < 0 for r in rows)
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_nothing_to_learn_from(spark, docs):
    assert recurrent_scores.score_texts(docs.limit(0)).count() == 0
    (r,) = recurrent_scores.score_texts(spark.createDataFrame([(None, "a b", 1, "", "")], SCHEMA)).collect()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) == (3, 0, 0, 0.0) and math.isfinite(r["score"])
