"""Flushes bounded by rows, the manifest of their parts, both outputs of a follow, and messages landed once by id."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import recordlake as rl
from conftest import batch, event, single
from recordlake.schema import RAW_ID_SCHEMA
from recordlake.streaming.published import read_ids

NOON = dt.datetime(2026, 9, 29, 12)


def flush(raw, root, batch_id=0, **options):
    rl.flush(raw, batch_id, rl.BATCH, "ledger", f"{root}/lake", f"{root}/dead", flush_log=f"{root}/log", **options)


def log(spark, root):
    return [tuple(r)[:6] for r in rl.read_flushes(spark, f"{root}/log").orderBy("flush_id").collect()]


def four(name):
    return batch(*[event(f"{name}{i}") for i in range(4)])


def test_the_bound_counts_rows_and_not_messages(spark, messages, tmp_path):
    flush(messages(four("a"), four("b"), four("c")), tmp_path, max_rows=5)
    assert log(spark, tmp_path) == [(0, 1, 2, 2, 8, 0), (1, 3, 3, 1, 4, 0)]
    assert rl.read_lake(spark, f"{tmp_path}/lake", "ledger").count() == 12


def test_a_flush_starts_its_count_anew_and_no_message_is_split_or_lost(spark, messages, tmp_path):
    raw = messages((4, four("d")), (1, four("a")), (2, b"junk"), (3, four("c")), (3, four("c")), (5, b"{}"), (0, four("z")), (None, four("y")), (9, b"junk"))
    flush(raw.repartition(3), tmp_path, batch_id=2, max_rows=7)
    told = log(spark, tmp_path)
    assert [(f - 2 * (1 << 20), messages, rows, rejects) for f, _, _, messages, rows, rejects in told] == [(0, 2, 8, 0), (1, 3, 8, 1), (2, 2, 8, 0), (3, 2, 0, 1)]
    assert [(first, last) for _, first, last, *_ in told] == [(0, 0), (1, 3), (3, 4), (5, 9)]
    assert rl.read_lake(spark, f"{tmp_path}/lake", "ledger").count() == 24
    assert rl.read_dead(spark, f"{tmp_path}/dead").count() == 2


@pytest.mark.parametrize("limit", [1, 4, 12, 13])
def test_bounds_at_the_edges(spark, messages, tmp_path, limit):
    flush(messages(four("a"), four("b"), four("c")), tmp_path, max_rows=limit)
    assert [r[4] for r in log(spark, tmp_path)] == ([4, 4, 4] if limit <= 4 else [12])


def test_all_flushes_of_a_batch_are_landed_by_a_few_jobs_in_parts_of_their_own(spark, messages, tmp_path):
    raw = messages(*[four(f"m{i}-") if i % 7 else b"junk" for i in range(40)])
    spark.sparkContext.setJobGroup("flushes", "flushes of one batch")
    try:
        flush(raw, tmp_path, max_rows=4)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("flushes"))
    finally:
        spark.sparkContext._jsc.sc().clearJobGroup()
    told = log(spark, tmp_path)
    assert [r[0] for r in told] == list(range(34)) and {r[4] for r in told} == {4} and sum(r[5] for r in told) == 6
    assert jobs < 100
    rows = rl.read_lake(spark, f"{tmp_path}/lake", "ledger").select(F.regexp_extract("event_id", "m([0-9]+)-", 1).alias("m"), F.input_file_name().alias("part"))
    assert [r["n"] for r in rows.groupBy("part").agg(F.countDistinct("m").alias("n")).collect()] == [1] * 34


@pytest.mark.parametrize("limit", [1, 3, 10, 57])
def test_flushes_of_many_ranges_are_those_of_a_walk_in_order(spark, messages, tmp_path, limit):
    sizes = [(i * 7919) % 6 for i in range(90)]
    raw = messages(*[batch(*[event(f"{i}-{k}") for k in range(n)]) for i, n in enumerate(sizes)])
    flush(raw.repartition(5), tmp_path, max_rows=limit)
    want, held = [[0, 0]], 0
    for n in sizes:
        if held >= limit:
            want.append([0, 0])
            held = 0
        want[-1] = [want[-1][0] + 1, want[-1][1] + n]
        held += n
    assert [list(r[3:5]) for r in log(spark, tmp_path)] == want


def test_a_batch_of_one_file_is_decoded_by_many_tasks(spark, messages, tmp_path):
    spread = []
    rl.flush(
        messages(*[four(f"m{i}-") for i in range(40)]).coalesce(1), 0, rl.BATCH, "ledger",
        lake=lambda rows, _: spread.append(rows.select(F.spark_partition_id().alias("p")).distinct().count()), dead=f"{tmp_path}/dead",
    )
    assert spread[0] > 1


def test_messages_are_read_in_small_batches(spark, messages, tmp_path):
    messages(*[b"{}"] * 2_000).coalesce(1).write.parquet(f"{tmp_path}/raw")
    raw = rl.raw_table(spark, f"{tmp_path}/raw")
    assert len(raw.collect()) == 2_000
    scanned = raw._jdf.queryExecution().executedPlan()
    while "ColumnarToRow" not in scanned.nodeName():
        scanned = scanned.children().head()
    assert scanned.metrics().get("numInputBatches").get().value() >= 8


@pytest.mark.parametrize("limit", [None, 600])
def test_decoded_records_are_held_on_disk_and_in_small_batches(spark, messages, tmp_path, limit):
    size, seen = "spark.sql.inMemoryColumnarStorage.batchSize", []
    before = spark.conf.get(size)

    def lake(rows, _):
        held = rows._jdf.queryExecution().withCachedData().collectLeaves().head().cacheBuilder()
        seen.append((rows.count(), held.storageLevel().useMemory(), held.cachedColumnBuffers().count()))

    raw = messages(*[batch(*[event(f"{m}-{i}") for i in range(600)]) for m in range(2)])
    rl.flush(raw, 0, rl.BATCH, "ledger", lake, f"{tmp_path}/dead", max_rows=limit)
    assert [rows for rows, *_ in seen] == ([600, 600] if limit else [1_200])
    assert not any(in_memory for _, in_memory, _ in seen) and all(batches >= 6 for *_, batches in seen)
    assert spark.conf.get(size) == before


def test_parts_are_traced_to_their_messages_over_drains_and_repetitions(spark, messages, tmp_path):
    raw = messages((1, batch(event("a", app="x/y +%"), event("b", app=""))), (2, batch(event("c", "2026-10-01T00:00:00Z"), event("d"))), (70_000, batch(event("e"))))
    some = lambda *seqs: raw.filter(F.col("seq").isin(*seqs))
    manifest = f"{tmp_path}/manifest"
    flush(some(1), tmp_path, 0, manifest=manifest)
    # A flush that lost its manifest and its acknowledgement comes again: all four of its parts are its own.
    rl.write_lake(rl.to_rows(rl.decode(some(2, 70_000), rl.BATCH)), f"{tmp_path}/lake", "ledger")
    flush(some(2, 70_000), tmp_path, 1, manifest=manifest)
    flush(some(2, 70_000), tmp_path, 1, manifest=manifest)
    flush(some(1), tmp_path, 0, manifest=manifest, drain_id="other")
    held = rl.read_manifest(spark, manifest)
    files = {r[0] for r in rl.read_lake(spark, f"{tmp_path}/lake", "ledger").select(F.regexp_extract("_metadata.file_path", "date=.*", 0)).distinct().collect()}
    assert len({r.part for r in held.collect()}) == held.count() <= len(files)
    traced = rl.part_to_messages(held, raw, rl.BATCH)
    got = {(r.drain, r.flush, str(r.date), r.app, r.seq, r.rows) for r in traced.collect()}
    day = "2026-09-29"
    assert got == {
        ("direct", 0, day, "x/y +%", 1, 1), ("direct", 0, day, "", 1, 1), ("other", 0, day, "x/y +%", 1, 1), ("other", 0, day, "", 1, 1),
        ("direct", 1, "2026-10-01", "svc", 2, 1), ("direct", 1, day, "svc", 2, 1), ("direct", 1, day, "svc", 70_000, 1),
    }


def test_no_parts_no_messages(spark, messages, tmp_path):
    assert rl.read_manifest(spark, f"{tmp_path}/none").count() == 0
    assert rl.part_to_messages(rl.read_manifest(spark, f"{tmp_path}/none"), messages(four("a")), rl.BATCH).count() == 0


def test_a_follow_shows_rejects_and_goes_on_from_where_it_began(spark, messages, tmp_path):
    path = f"{tmp_path}/raw"
    messages((1, batch(event("a"))), (2, batch(event("b"), event(""))), (3, b"junk")).write.parquet(path)
    failing = []

    def run(lines=f"{tmp_path}/lines"):
        return rl.follow(spark, path, rl.BATCH, lines, f"{tmp_path}/unreadable", f"{tmp_path}/own", since=2, available_now=True)

    run().awaitTermination()
    # Four more land while it is away: the beginning stays at sequence 2, and a failed batch comes again whole.
    messages((4, batch(event("d"))), (5, b"more"), (6, batch(event("f"))), (7, b"{}")).write.mode("append").parquet(path)

    def broken(frame, batch_id):
        failing.append(batch_id)
        raise RuntimeError("no room")

    with pytest.raises(Exception, match="no room"):
        run(broken).awaitTermination()
    run().awaitTermination()
    assert failing and [r.seq for r in spark.read.parquet(f"{tmp_path}/lines").orderBy("seq").collect()] == [2, 4, 6]
    notes = [r.message for r in spark.read.parquet(f"{tmp_path}/unreadable").orderBy("seq").collect()]
    assert [n.split(":")[0] for n in notes] == [f"rec.v1.ledger.acme.svc seq {s}" for s in (2, 3, 5)]


def published(spark, *rows):
    told = [("LEDGER", "s", seq, NOON, bytearray(single({"n": n})), name) for n, (seq, name) in enumerate(rows)]
    return spark.createDataFrame(told, RAW_ID_SCHEMA)


def test_ids_fold_within_the_window_and_repetitions_decide_alike(spark, tmp_path):
    ids = f"{tmp_path}/ids"

    def land(batch_id, now, *rows):
        got = rl.fold_published(published(spark, *rows), batch_id, ids, dt.timedelta(minutes=2), now)
        return sorted((r.seq or 0, r.message_id or "") for r in got.collect())

    first = [(1, "m"), (9, "m"), (2, None), (2, ""), (0, None), (0, None), (None, None), (3, "seq 2")]
    want = [(0, ""), (0, ""), (0, ""), (1, "m"), (2, ""), (3, "seq 2")]
    assert land(0, NOON, *first) == want
    assert land(0, NOON + dt.timedelta(hours=5), *first) == want
    assert land(1, NOON + dt.timedelta(seconds=90), (20, "m"), (2, None), (21, "n")) == [(21, "n")]
    # A clock set back makes nothing late and forgets nothing.
    assert land(2, NOON - dt.timedelta(hours=1), (22, "n"), (23, "o")) == [(23, "o")]
    assert land(3, NOON + dt.timedelta(minutes=10), (24, "m")) == [(24, "m")]
    assert read_ids(spark, ids).count() == 6


def test_an_id_of_most_messages_is_folded_before_the_shuffle(spark):
    once = rl.first_of_each(published(spark, *[(i + 1, "hot") for i in range(200)], (0, None)))
    assert sorted((r.seq, r.message_id) for r in once.collect()) == [(0, None), (1, "hot")]
    assert "partial_min" in once._jdf.queryExecution().executedPlan().toString()
