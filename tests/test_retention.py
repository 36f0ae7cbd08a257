import datetime as dt
import random

import pytest

import recordlake as rl
from recordlake.operators import retention

NOW = dt.datetime(2026, 9, 29, 12)


def suffix(sizes, budget):
    """The newest sequences that fit, by adding up."""
    kept, total = set(), 0
    for seq in sorted(sizes, reverse=True):
        total += sizes[seq]
        if total > budget:
            break
        kept.add(seq)
    return kept


@pytest.mark.parametrize("seed", range(6))
def test_both_ends_equal_adding_up(messages, monkeypatch, seed):
    monkeypatch.setattr(retention, "FANOUT", 4)
    rng = random.Random(seed)
    seqs = rng.sample(range(1, 5000), 60)
    payloads = [(s, b"x" * rng.choice([0, 1, 3, 50])) for s in seqs]
    payloads += payloads[:10]
    sizes = {}
    for s, p in payloads:
        sizes[s] = sizes.get(s, 0) + len(p)
    total = sum(sizes.values())
    raw = messages(*payloads)
    for budget in (1, total // 3, total - 1, total, total + 1):
        newest = {r.seq for r in rl.retain_newest(raw, max_bytes=budget).collect()}
        assert newest == suffix(sizes, budget)
        accepted, refused = rl.admit(raw, budget)
        oldest = {-s for s in suffix({-s: n for s, n in sizes.items()}, budget)}
        assert {r.seq for r in accepted.collect()} == oldest
        assert {r.seq for r in refused.collect()} == set(sizes) - oldest
        assert accepted.count() + refused.count() == len(payloads)


def test_no_limit_keeps_all(messages):
    raw = messages(b"abc", b"de")
    assert rl.retain_newest(raw).count() == rl.retain_newest(raw, max_bytes=-1).count() == 2
    accepted, refused = rl.admit(raw, 0)
    assert (accepted.count(), refused.count()) == (2, 0)


def test_nothing_at_all(messages):
    raw = messages(b"abc").limit(0)
    assert rl.retain_newest(raw, max_bytes=1).count() == 0
    assert rl.admit(raw, 1)[0].count() == 0


def test_what_is_already_held_takes_up_room_and_stays(messages):
    accepted, refused = rl.admit(messages(b"abc", b"def", b"ghi"), 10, held_bytes=5)
    assert [r.seq for r in accepted.collect()] == [1]
    assert sorted(r.seq for r in refused.collect()) == [2, 3]


def test_age_goes_before_size(spark, messages):
    old, young = messages((1, b"aaa"), at=NOW - dt.timedelta(days=8)), messages((2, b"bbb"), (3, b"ccc"), at=NOW)
    raw = old.unionAll(young)
    kept = rl.retain_newest(raw, max_bytes=6, max_age=dt.timedelta(days=7), now=NOW)
    assert sorted(r.seq for r in kept.collect()) == [2, 3]
    assert rl.retain_newest(raw, max_age=dt.timedelta(days=9), now=NOW).count() == 3


def test_every_stream_has_a_budget_of_its_own(messages, monkeypatch):
    monkeypatch.setattr(retention, "FANOUT", 4)
    rng = random.Random(7)
    sizes = {"A": {s: rng.choice([0, 2, 9]) for s in range(1, 40)}, "B": {s: 100 for s in range(1000, 1030)}, None: {3: 5, 4: 5}}
    raw = None
    for stream, held in sizes.items():
        part = messages(*[(s, b"x" * n) for s, n in held.items()], stream=stream)
        raw = part if raw is None else raw.unionAll(part)
    for sized in (raw, rl.with_sizes(raw)):
        kept = {(r.stream, r.seq) for r in rl.retain_newest(sized, max_bytes=50).collect()}
        assert kept == {(stream, s) for stream, held in sizes.items() for s in suffix(held, 50)}
        kept = {(r.stream, r.seq) for r in rl.retain_newest(sized, max_bytes={"B": 250, "A": 0}).collect()}
        assert kept == {(stream, s) for stream, held in sizes.items() for s in (suffix(held, 250) if stream == "B" else held)}
        accepted, refused = rl.admit(sized, {"A": 30, "B": 300}, held_bytes={"B": 200, "A": 31})
        assert {(r.stream, r.seq) for r in accepted.collect()} == {("B", 1000), (None, 3), (None, 4)}
        assert accepted.columns == sized.columns and accepted.count() + refused.count() == raw.count()


def test_a_budget_reads_sizes_and_no_payloads(spark, messages, tmp_path):
    raw = messages((1, b"aaa"), (2, b"bb"), (3, b"c"))
    rl.with_sizes(raw).write.parquet(f"{tmp_path}/raw")
    landed = rl.raw_table(spark, f"{tmp_path}/raw", sizes=True)
    kept = rl.retain_newest(landed, max_bytes=3).select("stream", "seq")
    assert sorted(r.seq for r in kept.collect()) == [2, 3]
    assert "payload:binary" not in kept._jdf.queryExecution().toString()


def test_unknown_sequences_are_the_oldest(messages):
    raw = messages((None, b"aaa"), (0, b"bb"), (1, b"c"))
    assert [r.seq for r in rl.retain_newest(raw, max_bytes=4).collect()] == [1]
    assert rl.retain_newest(raw, max_bytes=6).count() == 3


def test_a_size_that_was_not_stored_is_an_error(messages):
    lacking = messages((1, b"aaa")).selectExpr("*", "CAST(NULL AS BIGINT) AS payload_bytes")
    with pytest.raises(Exception, match="was not landed with its size"):
        rl.retain_newest(lacking, max_bytes=1).collect()


def test_too_many_streams_are_refused(messages, monkeypatch):
    monkeypatch.setattr(retention, "STREAMS", 1)
    raw = messages(b"aa", stream="A").unionAll(messages(b"bb", stream="B"))
    with pytest.raises(Exception, match="more than 1 streams"):
        rl.retain_newest(raw, max_bytes=1).collect()
