import pytest

import recordlake as rl
from conftest import batch, event, plan_of, single
from recordlake.operators.verify import PolicyMismatch
from recordlake.sources.raw import SPREAD
from test_decode import FULL


def drift(df):
    return {(r.field, r.problem, r.seen, r.events) for r in df.collect()}


def test_a_full_event_drifts_nowhere(messages):
    observed = rl.observed_fields(messages(batch(FULL, FULL)), rl.BATCH)
    assert rl.contract_drift(observed).collect() == []


def test_drift_shows_in_both_directions_and_in_kind(messages):
    observed = rl.observed_fields(messages(batch({**FULL, "region": "eu"}, {**FULL, "tool": None, "cost_usd": "x"}), b"junk"), rl.BATCH)
    assert drift(rl.contract_drift(observed)) == {("region", "not a column", "text", 1), ("cost_usd", "other kind", "text", 1)}
    short = {k: v for k, v in FULL.items() if k not in ("tool", "usage")}
    lacking = drift(rl.contract_drift(rl.observed_fields(messages(batch({**short, "usage": {"input_tokens": 1, "new_tokens": 2}})), rl.BATCH)))
    assert ("tool", "not carried", None, 0) in lacking and ("usage.new_tokens", "not a column", "integer", 1) in lacking
    assert ("usage.cached_tokens", "not carried", None, 0) in lacking and len(lacking) == 5


def test_leaving_a_field_out_takes_a_reason(messages):
    observed = rl.observed_fields(messages(batch({**FULL, "region": "eu"})), rl.BATCH)
    assert rl.contract_drift(observed, {"region": "billing keeps it"}).collect() == []
    with pytest.raises(ValueError, match="without a reason: region"):
        rl.contract_drift(observed, {"region": " "})


def test_policies_differ_field_by_field_and_no_limit_is_one_thing(spark):
    want = {"a": {**rl.POLICIES["audit"], "max_msgs": "0"}}
    got = {"a": {**rl.POLICIES["audit"], "discard": "old", "max_msgs": "-1", "duplicates": "5"}}
    told = [r.told for r in rl.policy_diff(rl.policy_rows(spark, want), rl.policy_rows(spark, got)).collect()]
    assert told == ["discard: want new, running old"]
    gone = {"a": {k: v for k, v in got["a"].items() if k not in ("discard", "subjects")}}
    both = rl.policy_diff(rl.policy_rows(spark, want), rl.policy_rows(spark, gone))
    assert {(r.field, r.running) for r in both.collect()} == {("discard", None), ("subjects", None)}


def test_the_three_policies():
    assert rl.POLICIES["ledger"]["discard"] == "old" and rl.POLICIES["ledger"]["max_age"] == "604800"
    for name in ("audit", "dead"):
        assert rl.POLICIES[name]["discard"] == "new" and rl.POLICIES[name]["max_age"] == "0"
        assert rl.POLICIES[name]["deny_delete"] == rl.POLICIES[name]["deny_purge"] == "true"
    assert rl.sized("dead", max_bytes=5)["max_bytes"] == "5" and rl.sized("dead", max_bytes=0) == rl.POLICIES["dead"]
    with pytest.raises(ValueError, match="discard is policy"):
        rl.sized("dead", discard=1)


def test_what_a_table_holds_against_its_policy(spark, messages):
    raw = messages(b"12345", b"678")
    policy = {"subjects": "rec.v1.ledger.>", "max_age": "60", "max_bytes": "7", "max_msgs": "-1"}
    diff = rl.policy_diff(rl.policy_rows(spark, {"t": policy}), rl.held_policy(raw, "t", policy))
    assert [r.told for r in diff.collect()] == ["max_bytes: want 7, running 8"]
    other = {**policy, "max_bytes": "8", "subjects": "rec.v1.audit.>"}
    diff = rl.policy_diff(rl.policy_rows(spark, {"t": other}), rl.held_policy(raw, "t", other))
    assert [(r.field, r.running) for r in diff.collect()] == [("subjects", "rec.v1.ledger.acme.svc")]


def test_provision_creates_verifies_and_never_patches(spark, tmp_path):
    policies = {"p_ledger": rl.POLICIES["ledger"], "p_audit": rl.POLICIES["audit"], "p_dead": rl.POLICIES["dead"]}
    assert rl.provision(spark, policies, str(tmp_path), dry_run=True) == dict.fromkeys(policies, "missing")
    try:
        assert rl.provision(spark, policies, str(tmp_path)) == dict.fromkeys(policies, "created")
        assert rl.provision(spark, policies, str(tmp_path)) == dict.fromkeys(policies, "verified")
        spark.sql("ALTER TABLE p_audit SET TBLPROPERTIES ('recordlake.discard' = 'old')")
        spark.sql("ALTER TABLE p_dead SET TBLPROPERTIES ('recordlake.max_bytes' = '1')")
        with pytest.raises(PolicyMismatch) as raised:
            rl.provision(spark, policies, str(tmp_path))
        assert "p_audit: discard: want new, running old" in str(raised.value)
        assert "p_dead: max_bytes: want 1073741824, running 1" in str(raised.value)
        assert spark.sql("SHOW TBLPROPERTIES p_audit ('recordlake.discard')").first().value == "old"
    finally:
        for table in policies:
            spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_the_whole_check_raises_once_with_everything(spark, messages):
    observed = rl.observed_fields(messages(batch({**FULL, "region": "eu"})), rl.BATCH)
    want = rl.policy_rows(spark, {"a": rl.POLICIES["audit"]})
    rl.verify_lake(observed, want, want, {"region": "billing keeps it"})
    running = rl.policy_rows(spark, {"a": {**rl.POLICIES["audit"], "discard": "old"}})
    with pytest.raises(PolicyMismatch) as raised:
        rl.verify_lake(observed, want, running)
    assert "region: not a column" in str(raised.value) and "discard: want new" in str(raised.value)


def test_an_error_names_the_first_fields_and_counts_the_rest(spark, messages):
    observed = rl.observed_fields(messages(batch({**FULL, **{f"x{i:03}": 1 for i in range(60)}})), rl.BATCH)
    want = rl.policy_rows(spark, {"a": rl.POLICIES["audit"]})
    with pytest.raises(PolicyMismatch, match="10 more; see contract_drift"):
        rl.verify_lake(observed, want, want)


def test_no_event_is_needed(messages):
    observed = rl.observed_fields(messages(b"{}", b"junk"), rl.BATCH)
    assert rl.contract_drift(observed).filter("problem <> 'not carried'").count() == 0
    assert rl.contract_drift(observed).count() == 40


def test_every_difference_is_told_however_many_there_are(spark, messages):
    raw = messages(batch(event("a", **{f"made_up_{i:02}": "x" for i in range(60)})))
    want = rl.policy_rows(spark, {"ledger": {"max_age": "604800"}})
    got = rl.policy_rows(spark, {"ledger": {"max_age": "5"}})
    with pytest.raises(rl.PolicyMismatch, match="and 11 more") as told:
        rl.verify_lake(rl.observed_fields(raw, rl.BATCH), want, got)
    rows = told.value.differences.collect()
    assert {r.field for r in rows if r.side == "contract"} == {f"made_up_{i:02}" for i in range(60)}
    assert [(r.side, r.field) for r in rows if r.side != "contract"] == [("ledger", "max_age")]


def test_an_event_with_a_doubled_key_is_looked_at(spark, messages):
    doubled = b'{"event_id":"a","tags":{"k":"1","k":"2"},"surprise":[1],"usage":{"input_tokens":1,"input_tokens":"x","more":{"y":1}},"a\\"b:{":1}'
    observed = rl.observed_fields(messages(b'{"events":[ ' + doubled + b' ,{"usage":5},{}]}'), rl.BATCH)
    found = rl.contract_drift(observed).filter("problem <> 'not carried'")
    assert drift(found) == {
        ("surprise", "not a column", "list", 1),
        ("usage.input_tokens", "other kind", "text", 1),
        ("usage.more", "not a column", "object", 1),
        ('a"b:{', "not a column", "integer", 1),
        ("usage", "other kind", "integer", 1),
    }


def test_a_key_that_is_doubled_counts_once_for_each_kind(messages):
    observed = rl.observed_fields(messages(b'{"event_id":"a","event_id":"b","event_id":null,"n":1,"n":1.5,"n":2}'), rl.EVENT)
    assert {(r.field, r.kind, r.events) for r in observed.collect()} == {
        ("event_id", "text", 1), ("event_id", "null", 1), ("n", "integer", 1), ("n", "number", 1)
    }


def test_messages_of_one_file_are_observed_by_many_tasks(spark, messages):
    raw = messages(*[single(event(f"e{i}")) for i in range(40)]).coalesce(1)
    pieces = spark.sparkContext.defaultParallelism
    assert f"RoundRobinPartitioning({SPREAD * pieces})" in plan_of(rl.observed_fields(raw, rl.EVENT))
    assert {(r.field, r.events) for r in rl.observed_fields(raw, rl.EVENT).collect()} == {(f, 40) for f in ("event_id", "time", "tenant", "app")}
