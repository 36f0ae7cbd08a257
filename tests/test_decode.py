import datetime as dt
import json

import pytest

import recordlake as rl
from conftest import batch, event, plan_of, single
from recordlake.schema import COLUMNS, REJECT_SCHEMA, ROW_SCHEMA


def rows(raw, envelope=rl.BATCH):
    return rl.to_rows(rl.decode(raw, envelope), "seq", "idx").orderBy("seq", "idx").collect()


def rejects(raw, envelope=rl.BATCH):
    return rl.with_rendered(rl.to_rejects(rl.decode(raw, envelope))).orderBy("seq", "idx").collect()


FULL = event(
    feature="f", run_id="r", correlation_id="co", causation_id="ca", budget_id="b", tags={"z": "1", "a": "2"},
    prompt_name="pn", prompt_hash="ph", alias="al", resolved_model="rm", model_overridden=True,
    usage={"input_tokens": 1, "output_tokens": 2, "cached_tokens": 3, "reasoning_tokens": 4}, cost_usd=0.25,
    cost_source="cs", latency_ms=99, provider_request_id="pr", fallback_used=True, outcome="ok", error_kind="ek",
    policy_mode="pm", policy_violations=["v1", "v2"], tool="t", principal_subject="ps", principal_actor="pa",
    principal_kind="pk", chain_depth=3, clearance_effective="ce", compartments_effective=["c1"], redaction_plan="rp",
    redaction_count=5, disclosed_count=6, error_detail="ed", execution_subject="es",
)


def test_a_full_event_fills_every_column(messages):
    got = rows(messages(batch(FULL)))[0].asDict()
    assert got["time"] == dt.datetime(2026, 9, 29, 12)
    assert got["tags_json"] == '{"a":"2","z":"1"}'
    assert got["policy_violations"] == '["v1","v2"]' and got["compartments_effective"] == '["c1"]'
    for c in COLUMNS:
        if c.name in ("time", "tags_json", "policy_violations", "compartments_effective"):
            continue
        sent = FULL
        for part in c.source.split("."):
            sent = sent[part]
        assert got[c.name] == sent, c.name


def test_rows_have_the_lake_columns_in_order(messages):
    decoded = rl.to_rows(rl.decode(messages(batch(event())), rl.BATCH))
    assert [(f.name, f.dataType) for f in decoded.schema] == [(f.name, f.dataType) for f in ROW_SCHEMA]
    assert rl.to_rejects(rl.decode(messages(b"x"), rl.BATCH)).columns == REJECT_SCHEMA.fieldNames()


def test_absent_fields_are_zero_values_and_not_null(messages):
    got = rows(messages(batch({"event_id": "e", "time": "2024-01-01T00:00:00Z"})))[0].asDict()
    assert None not in got.values()
    assert got["tags_json"] == "{}" and got["policy_violations"] == "[]" and got["cost_usd"] == 0.0
    assert got["execution_subject"] == "" and got["fallback_used"] is False


def test_one_bad_event_loses_one_event(messages):
    good = [event(f"e{i}") for i in range(500)]
    good[250] = event("")
    raw = messages(batch(*good))
    assert len(rows(raw)) == 499
    bad = rejects(raw)
    assert [(b.idx, b.reason, b.rendered) for b in bad] == [
        (250, "missing_event_id", "event 250: missing_event_id: event_id is empty")
    ]
    assert json.loads(bytes(bad[0].payload)) == good[250]


def test_position_survives_and_neighbours_of_every_fault_land(messages):
    raw = messages(batch(event("a"), {**event("b"), "cost_usd": "zz"}, event("c"), event("d", time=None), event("e", time="soon"), event("f")))
    assert [(r.idx, r.event_id) for r in rows(raw)] == [(0, "a"), (2, "c"), (5, "f")]
    assert [(b.idx, b.reason) for b in rejects(raw)] == [(1, "unmarshal"), (3, "missing_time"), (4, "unmarshal")]


def test_an_unset_time_is_refused_and_the_epoch_is_not(messages):
    raw = messages(batch(event("a", "0001-01-01T00:00:00Z"), event("b", ""), event("c", "1970-01-01T00:00:00Z")))
    assert [r.event_id for r in rows(raw)] == ["c"]
    assert {b.reason for b in rejects(raw)} == {"missing_time"}


def test_times_stay_within_four_digit_years(messages):
    times = ["9999-12-31T23:59:59.999999Z", "9999-12-31T23:59:59-05:00", "0001-01-01T00:00:00+05:00", "0000-06-01T00:00:00Z", "0001-01-02T00:00:00Z"]
    raw = messages(batch(*[event(f"e{i}", t) for i, t in enumerate(times)]))
    assert [r.event_id for r in rows(raw)] == ["e0", "e4"]
    assert {b.reason for b in rejects(raw)} == {"unmarshal"}


def test_parse_comes_before_id_and_id_before_time(messages):
    raw = messages(batch({"event_id": "", "time": "", "cost_usd": "x"}, {"event_id": "", "time": ""}, {"event_id": " "}))
    assert [b.reason for b in rejects(raw)] == ["unmarshal", "missing_event_id", "missing_time"]


@pytest.mark.parametrize(
    "payload",
    [b"\xff\xff not json", b"", b"null", b"5", b"[]", b'{"events":[', b'{"events":[]} trailing', b'{"events":[]}{"events":[]}',
     b"{'events':[]}", b'{"events":{}}', b'{"events":5}', b'{"events":[{"event_id":"\xff"}]}', b'{"events":[],"events":[]}',
     b'{"Events":[]}', b'{"events":[{"a":NaN}]}'],
)
def test_an_unreadable_message_is_one_reject_with_its_bytes(messages, payload):
    raw = messages(payload)
    assert rows(raw) == []
    bad = rejects(raw)
    assert [(b.idx, b.reason, bytes(b.payload)) for b in bad] == [(-1, "unmarshal", payload)]
    assert bad[0].rendered.startswith("unmarshal: ")


def test_bytes_that_do_not_start_like_json_are_named_as_such(messages):
    assert "does not start like JSON" in rejects(messages(b"\x0a\x04data"))[0].error
    assert "does not start like JSON" not in rejects(messages(b'{"events":['))[0].error


def test_the_wrong_envelope_fails_and_neither_vanishes_nor_invents(messages):
    assert rows(messages(single(event()))) == []
    assert [b.idx for b in rejects(messages(single(event())))] == [-1]
    assert rows(messages(batch(event())), rl.EVENT) == []
    assert [b.reason for b in rejects(messages(batch(event())), rl.EVENT)] == ["missing_event_id"]


@pytest.mark.parametrize("payload", [b"{}", b'{"events":[]}', b' {"events": [] }\n', b'{"events":null}'])
def test_an_empty_batch_is_neither_row_nor_reject(messages, payload):
    raw = messages(payload)
    assert rows(raw) == [] and rejects(raw) == []
    told = rl.dispositions(raw, rl.BATCH).first()
    assert (told.rows, told.rejects, told.disposition) == (0, 0, "ack")


def test_spacing_changes_nothing_but_the_bytes_of_a_reject(messages):
    events = [event("a"), event("", cost_usd=1.5), event("b")]
    spaced = messages(json.dumps({"events": events}, indent=2).encode())
    assert [r.event_id for r in rows(spaced)] == ["a", "b"]
    assert json.loads(bytes(rejects(spaced)[0].payload)) == events[1]


def test_list_elements_that_are_no_objects_are_rejects_at_their_place(messages):
    raw = messages(b'{"events":[null,5,"x",[1],"{\\"event_id\\":\\"q\\",\\"time\\":\\"2024-01-01T00:00:00Z\\"}",' + single(event("a")) + b"]}")
    assert [r.event_id for r in rows(raw)] == ["a"]
    bad = rejects(raw)
    assert [(b.idx, b.reason) for b in bad] == [(i, "unmarshal") for i in range(5)]
    assert json.loads(bytes(bad[2].payload)) == "x" and bytes(bad[0].payload) == b"null"


def test_a_text_that_looks_like_an_object_is_no_event_even_beside_doubled_keys(messages):
    raw = messages(b'{"events":["{\\"event_id\\":\\"q\\"}",{"event_id":"a","tags":{"k":"1","k":"2"}}]}')
    assert rows(raw) == []
    assert [(b.idx, b.reason) for b in rejects(raw)] == [(0, "unmarshal"), (1, "unmarshal")]


@pytest.mark.parametrize("quoted", [b'"{\\"event_id\\":\\"q\\"}"', b'" {}"', b'"\\u007b\\u0022event_id\\u0022:\\u0022q\\u0022}"', b'"\\n{}"'])
def test_no_quoted_text_passes_for_an_event(messages, quoted):
    raw = messages(b'{"events":[' + quoted + b"," + single(event("a")) + b"]}")
    assert [r.event_id for r in rows(raw)] == ["a"]
    bad = rejects(raw)
    assert [(b.idx, b.reason) for b in bad] == [(0, "unmarshal")]
    assert json.loads(bytes(bad[0].payload)) == json.loads(quoted)


@pytest.mark.parametrize(
    "fault",
    [{"chain_depth": 2**31}, {"latency_ms": 1.5}, {"latency_ms": "12"}, {"fallback_used": "true"}, {"usage": 5}, {"cost_usd": "NaN"},
     {"usage": {"input_tokens": "x"}}, {"tags": ["a"]}, {"tags": {"a": None}}, {"policy_violations": "v"}, {"policy_violations": [None]}],
)
def test_values_of_another_type_are_refused(messages, fault):
    raw = messages(batch(event("bad", **fault), event("good")))
    assert [r.event_id for r in rows(raw)] == ["good"]
    assert [(b.idx, b.reason) for b in rejects(raw)] == [(0, "unmarshal")]


def test_doubled_tag_names_and_overflowing_numbers_are_refused_with_the_bytes(messages):
    doubled = b'{"event_id":"d","time":"2024-01-01T00:00:00Z","tags":{"k":"1","k":"2"}}'
    huge = b'{"event_id":"h","time":"2024-01-01T00:00:00Z","cost_usd":1e400}'
    raw = messages(b'{"events":[' + doubled + b"]}", b'{"events":[' + huge + b"]}")
    bad = rejects(raw)
    assert bytes(bad[0].payload) == doubled
    assert huge in bytes(bad[1].payload)


def test_unknown_fields_are_kept_in_a_reject(messages):
    bad = rejects(messages(batch({"event_id": "", "time": "2024-01-01T00:00:00Z", "new_field": {"deep": [1, 2]}})))[0]
    assert json.loads(bytes(bad.payload))["new_field"] == {"deep": [1, 2]}


def test_single_events_and_their_faults(messages):
    given = [single(event("a")), single(event("")), b"garbage", b"[1]", b"{}", b'{"event_id":"z"} {"event_id":"y"}']
    raw = messages(*given)
    assert [(r.seq, r.idx) for r in rows(raw, rl.EVENT)] == [(1, -1)]
    bad = rejects(raw, rl.EVENT)
    assert [(b.seq, b.idx, b.reason) for b in bad] == [
        (2, -1, "missing_event_id"), (3, -1, "unmarshal"), (4, -1, "unmarshal"), (5, -1, "missing_event_id"), (6, -1, "unmarshal")
    ]
    assert [bytes(b.payload) for b in bad] == given[1:]


def test_an_unknown_envelope_is_refused(messages):
    with pytest.raises(ValueError, match="envelope"):
        rl.decode(messages(b"{}"), "both")


def test_dispositions_count_each_copy_of_a_message(messages):
    mixed, broken = batch(event("a"), event("")), batch(event(""))
    raw = messages((1, mixed), (1, mixed), (2, broken), (3, b"junk"), (4, b"{}"))
    got = sorted((d.seq, d.rows, d.rejects, d.disposition) for d in rl.dispositions(raw, rl.BATCH).collect())
    assert got == [(1, 1, 1, "ack"), (1, 1, 1, "ack"), (2, 0, 1, "term"), (3, 0, 1, "term"), (4, 0, 0, "ack")]
    audit = rl.dispositions(messages(single(event("a")), single(event("")), b"junk"), rl.EVENT)
    assert sorted((d.seq, d.rows, d.rejects, d.disposition) for d in audit.collect()) == [(1, 1, 0, "ack"), (2, 0, 1, "term"), (3, 0, 1, "term")]


def test_the_range_of_a_flush_counts_every_message_and_leaves_out_sequence_zero(messages):
    raw = messages((0, batch(event("z"))), (10, b"junk"), (11, batch(event("a"), event("b"))), (12, b"{}"))
    stats = rl.flush_stats(rl.decode(raw, rl.BATCH, keep_empty=True)).first()
    assert stats.asDict() == {"first_seq": 10, "last_seq": 12, "messages": 4, "rows": 3, "rejects": 1}


def test_decoding_shuffles_nothing_and_runs_no_python(messages):
    for df in (rl.to_rows(rl.decode(messages(b"{}"), rl.BATCH)), rl.dispositions(messages(b"{}"), rl.BATCH)):
        plan = plan_of(df)
        assert "Exchange" not in plan and "Python" not in plan
    assert plan_of(rl.to_rows(rl.decode(messages(b"{}"), rl.BATCH))).count("execution_subject:string") <= 1


LONG_NUMBER = b'{ "event_id" : "", "time":"2024-01-01T00:00:00Z", "cost_usd" : 0.12345678901234567890123, "x": "a \\" ] } , {" }'


@pytest.mark.parametrize("between", [b",", b" ,\n ", b"\t,\r\n"])
def test_elements_are_cut_out_of_the_text_as_they_were_sent(messages, between):
    odd = [LONG_NUMBER, b'"{\\"event_id\\":1}"', b"null", b"[[1], [2, {}]]", b"-1.50e+1", b'{"event_id":"a\\\\","tags":{"k":"1","k":"2"}}', b'"\xc3\xa9,[\xf0\x9f\x98\x80"', b"{ }"]
    good = single(event("a", error_detail="\U0001f600 [,] {\\}"))
    raw = messages(b' {"events" : [ ' + between.join([*odd, good]) + b" ] } ")
    bad = sorted(rejects(raw), key=lambda b: b.idx)
    assert [bytes(b.payload) for b in bad] == odd and [b.idx for b in bad] == list(range(len(odd)))
    assert [(r.idx, r.event_id) for r in rows(raw)] == [(len(odd), "a")]


def test_a_spaced_message_of_many_deep_events_loses_none(messages):
    deep = b'{"event_id":"d","time":"2024-01-01T00:00:00Z","more":' + b"[" * 300 + b"{},[ ]" + b"]" * 300 + b"}"
    many = [single(event(f"e{i}", x=[i, {"y": [i]}])) for i in range(3000)]
    raw = messages(b'{"events": [' + b", ".join([*many, deep]) + b"]}")
    assert rl.to_rows(rl.decode(raw, rl.BATCH)).count() == 3001 and rejects(raw) == []


OTHER_KINDS = [
    '"tenant":{"x":1}',
    '"tenant":[1,2]',
    '"app" : true',
    '"feature":7',
    '"ten\\u0061nt":7',
    '"tenant":{"a":1,"a":2}',
    '"tags":{"k":1}',
    '"tags":{"k":"1","j":{"k":"1"}}',
    '"tags":"k"',
    '"policy_violations":["a",1]',
    '"policy_violations":[["a"]]',
    '"more":{"tags":{"k":"1"}},"tags":{"k":1}',
]


@pytest.mark.parametrize("field", OTHER_KINDS)
def test_another_kind_of_value_is_no_text(messages, field):
    bad = f'{{"event_id":"b","time":"2026-09-29T12:00:00Z",{field}}}'
    raw = messages(b'{"events":[' + single(event("a")) + b"," + bad.encode() + b"]}")
    assert [r.event_id for r in rl.to_rows(rl.decode(raw, rl.BATCH)).collect()] == ["a"]
    (reject,) = rl.to_rejects(rl.decode(raw, rl.BATCH)).collect()
    assert (reject.idx, reject.reason, bytes(reject.payload)) == (1, "unmarshal", bad.encode())
    assert [(d.rows, d.rejects) for d in rl.dispositions(raw, rl.BATCH).collect()] == [(1, 1)]


def test_texts_that_look_like_other_kinds_are_texts(messages):
    looks = ['{"x":1}', "[1,2]", "true", "7", '"tenant":7', "null", "\\u0061"]
    kept = [event(str(i), tenant=t, feature=None, tags={"k": t, "tags": t}, policy_violations=[t]) for i, t in enumerate(looks)]
    rows = rl.to_rows(rl.decode(messages(batch(*kept)), rl.BATCH)).collect()
    assert [(r.tenant, json.loads(r.tags_json)["k"], json.loads(r.policy_violations), r.feature) for r in rows] == [(t, t, [t], "") for t in looks]
