import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

import recordlake as rl
from conftest import batch, event, plan_of, single
from recordlake.functions.arguments import Start
from recordlake.operators.tail import _double_text
from recordlake.schema import COLUMN_NAMES, RAW_SCHEMA
from recordlake.sources.raw import filter_subject, subject_parts


def lines(shown):
    return [r.line for r in shown.lines.orderBy("seq", "idx").collect()]


def objects(shown):
    return [json.loads(line) for line in lines(shown)]


@pytest.fixture
def five(messages):
    """Five messages of two events each."""
    return messages(*[batch(event(f"e{i}-0", outcome="ok"), event(f"e{i}-1", outcome="denied", tool="pay")) for i in range(1, 6)])


def test_one_line_per_event_with_the_lake_columns_in_order(messages):
    shown = rl.tail(messages(batch(event("ev-1"), event("ev-2")), batch(event("ev-3", outcome="denied"))), rl.BATCH)
    got = lines(shown)
    assert len(got) == 3
    assert [k for k, _ in json.loads(got[0], object_pairs_hook=list)] == list(COLUMN_NAMES)
    assert json.loads(got[2])["outcome"] == "denied" and json.loads(got[0])["time"] == "2026-09-29T12:00:00Z"


def test_the_exact_line(messages):
    given = event("e", "2026-09-29T12:00:00.120Z", cost_usd=1e7, tags={"b": "<", "a": 'q"'}, chain_depth=2, fallback_used=True)
    line = lines(rl.tail(messages(batch(given)), rl.BATCH))[0]
    assert line.startswith('{"event_id":"e","time":"2026-09-29T12:00:00.12Z","tenant":"acme","app":"svc","feature":""')
    assert '"cost_usd":10000000,' in line and '"chain_depth":2,' in line and '"fallback_used":true,' in line
    assert '"tags_json":"{\\"a\\":\\"q\\\\\\"\\",\\"b\\":\\"\\\\u003c\\"}"' in line
    assert '"policy_violations":"[]"' in line and line.endswith('"execution_subject":""}')


def test_pretty_indents_by_two_and_says_the_same(messages):
    raw = messages(batch(event("e", cost_usd=0.25, error_detail='a "quoted" <b>')))
    pretty, plain = lines(rl.tail(raw, rl.BATCH, pretty=True))[0], lines(rl.tail(raw, rl.BATCH))[0]
    assert pretty.startswith('{\n  "event_id": "e",\n  "time": "2026') and pretty.endswith("\n}")
    assert json.loads(pretty, object_pairs_hook=list) == json.loads(plain, object_pairs_hook=list)


def test_a_column_not_recorded_is_null_in_a_line(spark, messages):
    rows = rl.to_rows(rl.decode(messages(batch(event())), rl.BATCH)).withColumn("execution_subject", F.lit(None).cast("string"))
    for pretty in (False, True):
        assert json.loads(rl.json_lines(rows, pretty).first().line)["execution_subject"] is None


def test_no_detail_drops_the_key_and_nothing_else(messages):
    raw = messages(batch(event("e", error_detail="ada@corp.example not found")))
    line = lines(rl.tail(raw, rl.BATCH, no_detail=True))[0]
    assert "ada@" not in line
    assert list(json.loads(line)) == [n for n in COLUMN_NAMES if n != "error_detail"]


def test_single_event_messages(messages):
    assert [o["event_id"] for o in objects(rl.tail(messages(single(event("a")), single(event("b"))), rl.EVENT))] == ["a", "b"]


def test_the_last_messages_are_counted_in_messages(five):
    assert [o["event_id"] for o in objects(rl.tail(five, rl.BATCH, since="2"))] == ["e4-0", "e4-1", "e5-0", "e5-1"]
    assert len(lines(rl.tail(five, rl.BATCH, since="500"))) == 10
    assert len(lines(rl.tail(five, rl.BATCH))) == 10


def test_the_last_n_is_sequence_arithmetic_over_the_whole_stream(spark):
    at = dt.datetime(2026, 9, 29)
    rows = [("S", f"base.t{s % 2}.svc", s, at, bytearray(batch(event(f"e{s}")))) for s in (1, 2, 3, 50, 97, 100)]
    rows.append(("OTHER", "base.t0.svc", 900, at, bytearray(batch(event("other")))))
    raw = spark.createDataFrame(rows, RAW_SCHEMA)
    assert [o["event_id"] for o in objects(rl.tail(raw, rl.BATCH, stream="S", since=4))] == ["e97", "e100"]
    assert [o["event_id"] for o in objects(rl.tail(raw, rl.BATCH, stream="S", since=4, subject="base.t1.>"))] == ["e97"]
    assert lines(rl.tail(raw.limit(0), rl.BATCH, since=4)) == []


def test_by_age_from_start_and_which_wins(spark):
    now = dt.datetime(2026, 9, 29, 12)
    rows = [("S", "b.t.a", i, now - dt.timedelta(minutes=m), bytearray(batch(event(f"e{i}")))) for i, m in enumerate((90, 61, 60, 5), 1)]
    raw = spark.createDataFrame(rows, RAW_SCHEMA)
    ids = lambda **o: [x["event_id"] for x in objects(rl.tail(raw, rl.BATCH, now=now, **o))]
    assert ids(since="1h") == ["e3", "e4"]
    assert ids(since="2") == ["e3", "e4"]
    assert ids(since="1", from_start=True) == ["e1", "e2", "e3", "e4"]
    with pytest.raises(ValueError):
        ids(since="5x", from_start=True)


def test_a_moment_with_a_zone_is_the_same_moment(spark):
    at = dt.datetime(2026, 9, 29, 12)
    raw = spark.createDataFrame([("S", "b.t.a", 1, at, bytearray(batch(event("e"))))], RAW_SCHEMA)
    tokyo = dt.timezone(dt.timedelta(hours=9))
    hits = lambda now: rl.tail_rows(raw, rl.BATCH, since="1h", now=now).count()
    assert hits(dt.datetime(2026, 9, 29, 22, tzinfo=tokyo)) == 1
    assert hits(dt.datetime(2026, 9, 29, 22, 0, 1, tzinfo=tokyo)) == 0


def test_filters_are_all_required(five):
    assert len(lines(rl.tail(five, rl.BATCH, filters=["outcome=denied", "tool=pay"]))) == 5
    assert lines(rl.tail(five, rl.BATCH, filters=["outcome=denied", "tool=other"])) == []
    assert len(lines(rl.tail(five, rl.BATCH, filters={"event_id": "e1-0"}))) == 1


def test_unreadable_messages_are_told_and_the_rest_is_shown(messages):
    shown = rl.tail(messages(batch(event("a")), b"\xff\xff junk", batch(event("b"), event(""))), rl.BATCH)
    assert len(lines(shown)) == 2
    told = [r.message for r in shown.unreadable.orderBy("seq").collect()]
    assert told[0].startswith("rec.v1.ledger.acme.svc seq 2: unreadable: unmarshal: ")
    assert told[1] == "rec.v1.ledger.acme.svc seq 3: unreadable: event 1: missing_event_id: event_id is empty"


def test_the_sequence_bound_reaches_the_scan(spark, five, tmp_path):
    path = str(tmp_path / "raw")
    five.write.parquet(path)
    plan = plan_of(rl.tail(rl.raw_table(spark, path), rl.BATCH, since=2, subject="rec.v1.ledger.>").lines)
    pushed = next(line for line in plan.splitlines() if "FileScan" in line and "payload" in line)
    assert "GreaterThanOrEqual(seq,ScalarSubquery" in pushed and "StringStartsWith(subject,rec.v1.ledger.)" in pushed
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_following_shows_what_lands_later_and_consumes_nothing(spark, messages, tmp_path):
    path = str(tmp_path / "raw")
    messages((1, batch(event("a"))), (2, batch(event("b"))), (3, batch(event("c")))).write.parquet(path)
    follow = rl.tail_stream(spark, path, rl.BATCH, since=2)
    writer = lambda: (
        follow.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "own")).trigger(availableNow=True)
        .start(str(tmp_path / "lines")).awaitTermination()
    )
    shown = lambda: sorted(json.loads(r.line)["event_id"] for r in spark.read.parquet(str(tmp_path / "lines")).collect())
    writer()
    assert shown() == ["b", "c"]
    messages((4, batch(event("d")))).write.mode("append").parquet(path)
    writer()
    assert shown() == ["b", "c", "d"]
    rl.drain(rl.raw_stream(spark, path), rl.BATCH, str(tmp_path / "lake"), str(tmp_path / "dead"), str(tmp_path / "drain"), available_now=True).awaitTermination()
    assert rl.read_lake(spark, str(tmp_path / "lake"), "ledger").count() == 4


@pytest.mark.parametrize(
    "said, start",
    [("", Start()), (None, Start()), ("20", Start(last=20)), (" 7 ", Start(last=7)), ("+5", Start(last=5)),
     ("10m", Start(age=dt.timedelta(minutes=10))), ("1h30m", Start(age=dt.timedelta(minutes=90))),
     ("1.5h", Start(age=dt.timedelta(minutes=90))), ("250ms", Start(age=dt.timedelta(milliseconds=250))), (".5s", Start(age=dt.timedelta(seconds=0.5)))],
)
def test_since(said, start):
    assert rl.parse_since(said) == start


@pytest.mark.parametrize("said", ["0", "-5", "-1m", "0s", "twenty", "5x", "1d", "m", "1h 30m", "9999999h"])
def test_since_refuses(said):
    with pytest.raises(ValueError):
        rl.parse_since(said)


def test_filters_are_cut_at_the_first_equals_and_the_last_one_wins():
    assert rl.parse_filters(["run_id=r-1", "tool=a=b", "run_id=r-2", "app="]) == {"run_id": "r-2", "tool": "a=b", "app": ""}
    for bad in ("outcome", "=x"):
        with pytest.raises(ValueError):
            rl.parse_filters([bad])
    with pytest.raises(ValueError, match='no column "outcom"; columns are event_id, time'):
        rl.parse_filters(["outcom=denied"])


@pytest.mark.parametrize(
    "test, hits",
    [("cost_usd=1.5", 1), ("cost_usd=1.50", 0), ("cost_usd=x", 0), ("latency_ms=12", 1), ("latency_ms=012", 0), ("latency_ms=12.0", 0),
     ("latency_ms=99999999999999999999", 0), ("fallback_used=true", 1), ("fallback_used=True", 0), ("fallback_used=1", 0),
     ("time=2026-09-29T12:00:00.12Z", 1), ("time=2026-09-29T12:00:00.120Z", 0), ("time=2026-09-29 12:00:00.12", 0), ("time=2026-99-29T12:00:00Z", 0),
     ("tenant=it's", 1), ("chain_depth=-1", 1), ("chain_depth=-0", 0), ("error_detail=", 1), ("tags_json={}", 1)],
)
def test_values_are_compared_by_their_text(messages, test, hits):
    raw = messages(batch(event("e", "2026-09-29T12:00:00.120Z", cost_usd=1.5, latency_ms=12, fallback_used=True, tenant="it's", chain_depth=-1)))
    assert rl.tail_rows(raw, rl.BATCH, filters=[test]).count() == hits


def test_doubles_as_filter_text():
    given = {0.0: "0", 1.0: "1", 1.5: "1.5", 1e20: "100000000000000000000", 1e21: "1e+21", 0.0001: "0.0001", 0.00001: "1e-05", 1.25e-7: "1.25e-07", 123456789.0: "123456789"}
    assert {v: _double_text(v) for v in given} == given


def test_subjects(spark):
    subjects = ["a.b.t.app", "a.b", "a.bc.t", "a.b.", "a.b.t", "x"]
    df = spark.createDataFrame([(s,) for s in subjects], "subject string")
    hits = lambda p: [r.subject for r in filter_subject(df, p).collect()]
    assert hits("a.b.>") == ["a.b.t.app", "a.b.t"]
    assert hits("a.b") == ["a.b"] and hits(">") == subjects
    for bad in ("a.*.c", "a.>.c", "a>"):
        with pytest.raises(ValueError):
            filter_subject(df, bad)
    assert [(r.subject_tenant, r.subject_app) for r in subject_parts(df, "a.b").collect()][:2] == [("t", "app"), (None, None)]


def test_a_zone_map_gives_the_newest_sequence_without_a_look_at_messages(spark, messages, tmp_path):
    landing, zones = f"{tmp_path}/raw", f"{tmp_path}/zones"
    for stream, seqs in (("A", (5, 1)), ("B", (900, 0)), ("A", (3, 8))):
        messages(*[(s, batch(event(f"e-{s}"))) for s in seqs], stream=stream).coalesce(1).write.mode("append").parquet(landing)
        rl.record_zones(spark, landing, zones)
    rl.record_zones(spark, landing, zones)
    held = rl.read_zones(spark, zones)
    assert {(r.stream, r.least, r.greatest, r.messages) for r in held.collect()} == {("A", 1, 5, 2), ("B", 900, 900, 2), ("A", 3, 8, 2)}
    raw = rl.raw_table(spark, landing)
    shown = rl.tail_rows(raw, rl.BATCH, stream="A", since=4, zones=held)
    assert sorted(r.seq for r in shown.collect()) == [5, 8]
    plan = plan_of(rl.last_messages(raw, 4, held))
    assert plan.count(f"{tmp_path}/raw") == 1 and plan.count(f"{tmp_path}/zones") >= 1
