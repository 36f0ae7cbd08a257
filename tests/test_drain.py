import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.errors import StreamingQueryException

import recordlake as rl
from conftest import batch, event, single
from recordlake.schema import DEAD_SCHEMA


@pytest.fixture
def landing(spark, messages, tmp_path):
    path = str(tmp_path / "landing")

    def land(*payloads, **where):
        messages(*payloads, **where).coalesce(1).write.mode("append").parquet(path)
        return path

    return land


@pytest.fixture
def out(tmp_path):
    return {k: str(tmp_path / k) for k in ("lake", "dead", "checkpoint", "flushes")}


def run(spark, path, out, envelope=rl.BATCH, **options):
    query = rl.drain(
        rl.raw_stream(spark, path, max_files=options.pop("max_files", 1)),
        envelope,
        options.pop("lake", out["lake"]),
        options.pop("dead", out["dead"]),
        out["checkpoint"],
        flush_log=out["flushes"],
        available_now=True,
        **options,
    )
    query.awaitTermination()


def ids(spark, out, prefix="ledger"):
    return sorted(r.event_id for r in rl.read_lake(spark, out["lake"], prefix).collect())


def test_end_to_end(spark, landing, out):
    path = landing((1, batch(event("a"), event(""), event("b"))), (2, b"\xff\xff not json"), (3, b"{}"))
    run(spark, path, out)
    assert ids(spark, out) == ["a", "b"]
    dead = sorted(rl.read_dead(spark, out["dead"]).collect(), key=lambda d: d.msg_id)
    assert [(d.msg_id, d.reason, d.origin, d.dead_subject) for d in dead] == [
        ("LEDGER-1-1", "missing_event_id", "ledger", "rec.v1.dead.ledger"),
        ("LEDGER-2--1", "unmarshal", "ledger", "rec.v1.dead.ledger"),
    ]
    assert bytes(dead[1].payload) == b"\xff\xff not json"
    assert (dead[1].stream, dead[1].subject, dead[1].sequence, dead[1].event_index) == ("LEDGER", "rec.v1.ledger.acme.svc", "2", "-1")
    log = rl.read_flushes(spark, out["flushes"]).collect()
    assert [tuple(r)[:7] for r in log] == [(0, 1, 3, 3, 2, 2, "ledger")]
    assert log[0].drain not in ("", "direct", None)


def test_what_lands_later_is_drained_by_the_next_run_and_nothing_twice(spark, landing, out):
    run(spark, landing((1, batch(event("a")))), out)
    run(spark, landing((2, batch(event("b")))), out)
    run(spark, landing((3, b"{}")), out)
    assert ids(spark, out) == ["a", "b"]
    assert [(r.first_seq, r.rows) for r in rl.read_flushes(spark, out["flushes"]).orderBy("flush_id").collect()] == [(1, 1), (2, 1), (3, 0)]


def test_a_failed_lake_write_is_redelivered_and_dead_letters_stay_single(spark, landing, out):
    landing((1, batch(event("a"), event(""))))
    path = landing((2, batch(event("b"), event("c"))))
    fails = [True]

    def flaky(rows, batch_id):
        if fails and batch_id == 1:
            fails.clear()
            raise OSError("the store is having a bad minute")
        rl.write_lake(rows, out["lake"], "ledger")

    with pytest.raises(StreamingQueryException):
        run(spark, path, out, lake=flaky)
    assert ids(spark, out) == ["a"] or ids(spark, out) == ["b", "c"]
    run(spark, path, out, lake=flaky)
    assert ids(spark, out) == ["a", "b", "c"]
    assert rl.read_dead(spark, out["dead"]).count() == 1
    assert rl.read_flushes(spark, out["flushes"]).count() == 2


def test_a_failure_after_the_rows_landed_duplicates_them_and_dedupe_takes_the_copies_away(spark, landing, out):
    path = landing((1, batch(event("a"), event("b"), event(""))))
    fails = [True]

    def lands_then_fails(rows, batch_id):
        rl.write_lake(rows, out["lake"], "ledger")
        if fails:
            fails.clear()
            raise OSError("written, but nobody was told")

    with pytest.raises(StreamingQueryException):
        run(spark, path, out, lake=lands_then_fails)
    run(spark, path, out, lake=lands_then_fails)
    assert ids(spark, out) == ["a", "a", "b", "b"]
    assert sorted(r.event_id for r in rl.dedupe(rl.read_lake(spark, out["lake"], "ledger")).collect()) == ["a", "b"]
    assert rl.read_dead(spark, out["dead"]).count() == 1


def test_a_failing_dead_letter_write_leaves_the_lake_untouched(spark, landing, out, tmp_path):
    path = landing((1, batch(event("a"), event(""))))

    def full(letters, batch_id):
        raise OSError("full")

    with pytest.raises(StreamingQueryException):
        run(spark, path, out, dead=full)
    assert not (tmp_path / "lake").exists() and not (tmp_path / "flushes").exists()
    run(spark, path, out)
    assert ids(spark, out) == ["a"]


def test_single_event_messages_go_under_their_own_prefix(spark, landing, out):
    path = landing(single(event("a")), single(event("")), stream="AUDIT", subject="rec.v1.audit.acme.svc")
    run(spark, path, out, envelope=rl.EVENT, origin="audit")
    assert ids(spark, out, "audit") == ["a"]
    assert rl.read_dead(spark, out["dead"]).first().msg_id == "AUDIT-2--1"


def test_both_targets_are_required_before_anything_runs(spark, landing, out):
    raw = rl.raw_stream(spark, landing(b"{}"))
    with pytest.raises(ValueError, match="dead-letter target is required"):
        rl.drain(raw, rl.BATCH, out["lake"], None, out["checkpoint"])
    with pytest.raises(ValueError, match="no destination"):
        rl.drain(raw, rl.BATCH, "", out["dead"], out["checkpoint"])
    with pytest.raises(ValueError, match="checkpoint"):
        rl.drain(raw, rl.BATCH, out["lake"], out["dead"], "")
    with pytest.raises(ValueError, match="stream is required"):
        rl.drain(rl.raw_table(spark, landing(b"{}")), rl.BATCH, out["lake"], out["dead"], out["checkpoint"])


def test_a_dead_letter_written_three_times_is_kept_once(spark, messages, tmp_path):
    letters = rl.to_dead(rl.to_rejects(rl.decode(messages((42, b"junk"), (42, b"junk")), rl.BATCH)), "ledger")
    path = str(tmp_path / "dead")
    for seq_range in ((42, 42), None, (40, 50)):
        rl.write_dead(letters, path, seq_range)
    kept = rl.read_dead(spark, path).collect()
    assert [d.msg_id for d in kept] == ["LEDGER-42--1"]
    assert rl.read_dead(spark, path).columns == DEAD_SCHEMA.fieldNames()


def test_origins_are_kept_apart_and_an_empty_one_is_unknown(spark, messages, tmp_path):
    rejects = rl.to_rejects(rl.decode(messages(b"junk"), rl.BATCH))
    path = str(tmp_path / "dead")
    for origin in ("ledger", "audit", ""):
        rl.write_dead(rl.to_dead(rejects, origin), path)
    assert {d.dead_subject for d in rl.read_dead(spark, path).collect()} == {f"rec.v1.dead.{o}" for o in ("ledger", "audit", "unknown")}
    assert rl.dead_subject_for("") == "rec.v1.dead.unknown"


def test_looking_for_ids_opens_only_the_blocks_of_the_batch(spark, messages, tmp_path):
    path = str(tmp_path / "dead")
    for seq in (5, 3_000_000, 9_000_001):
        rl.write_dead(rl.to_dead(rl.to_rejects(rl.decode(messages((seq, b"junk")), rl.BATCH)), "ledger"), path, (seq, seq))
    letters = rl.to_dead(rl.to_rejects(rl.decode(messages((9_000_001, b"junk"), (9_000_002, b"junk")), rl.BATCH)), "ledger")
    fresh = rl.dead_once(letters, path, (9_000_001, 9_000_002))
    assert [d.msg_id for d in fresh.collect()] == ["LEDGER-9000002--1"]
    scan = next(line for line in fresh._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan parquet" in line)
    assert "seq_block" in scan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "payload" not in scan.split("ReadSchema")[1]


def test_messages_published_twice_in_the_window_pass_a_stream_once(spark, landing, tmp_path):
    path = landing((1, b"{}"), (1, b"{}"), (2, b"{}"), at=dt.datetime(2026, 9, 29, 12))
    once = rl.drop_duplicates(rl.raw_stream(spark, path))
    once.writeStream.format("memory").queryName("once").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.seq for r in spark.sql("SELECT seq FROM once").collect()) == [1, 2]
    assert rl.drop_duplicates(rl.raw_table(spark, path)).count() == 2


def test_a_message_that_lands_late_is_no_duplicate(spark, landing, tmp_path):
    noon = dt.datetime(2026, 9, 29, 12)
    for parts, at in (([11], noon + dt.timedelta(hours=3)), ([3, 3], noon), ([3, 11], noon), ([4], noon)):
        path = landing(*[(seq, b"{}") for seq in parts], at=at)
        once = rl.drop_duplicates(rl.raw_stream(spark, path), window="1 hour").writeStream.format("parquet")
        once = once.option("path", str(tmp_path / "late")).option("checkpointLocation", str(tmp_path / "c"))
        once.trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.seq for r in rl.raw_table(spark, str(tmp_path / "late")).collect()) == [3, 4, 11]


def test_distinct_letters_of_unknown_or_restarted_sequences_are_all_kept(spark, messages, tmp_path):
    path = str(tmp_path / "dead")
    unknown = [(0, b"one"), (0, b"two"), (None, b"three"), (None, b"four")]
    for batch_ in (unknown, unknown, [(5, b"before")], [(5, b"after")], [(5, b"before")]):
        letters = rl.to_dead(rl.to_rejects(rl.decode(messages(*batch_), rl.BATCH)), "ledger")
        rl.write_dead(letters, path, (5, 5) if batch_[0][0] else (None, None), "ledger")
    kept = [bytes(d.payload) for d in rl.read_dead(spark, path).collect()]
    assert sorted(kept) == [b"after", b"before", b"four", b"one", b"three", b"two"]


def test_writers_of_two_origins_at_once_lose_nothing(spark, messages, tmp_path):
    path = str(tmp_path / "dead")

    def write(origin):
        for first in range(1, 41, 10):
            rejects = rl.to_rejects(rl.decode(messages(*[(first + i, b"junk") for i in range(10)]), rl.BATCH))
            rl.write_dead(rl.to_dead(rejects, origin), path, (first, first + 9), origin)

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(write, ("ledger", "audit")))
    held = rl.read_dead(spark, path).groupBy("origin").count().collect()
    assert {r.origin: r["count"] for r in held} == {"ledger": 40, "audit": 40}


def test_drains_that_share_a_flush_log_keep_their_own_lines(spark, landing, out, tmp_path):
    path = landing((1, batch(event("a"))))
    run(spark, path, out)
    run(spark, path, {**out, "checkpoint": str(tmp_path / "anew")})
    log = rl.read_flushes(spark, out["flushes"]).collect()
    assert [r.flush_id for r in log] == [0, 0] and len({r.drain for r in log}) == 2
