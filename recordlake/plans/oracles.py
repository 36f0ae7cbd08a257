"""The same results in plain SQL over the ``events`` table, written from the rules and not from the operators."""

from __future__ import annotations

from recordlake.plans.queries import AGE, BUDGET, BUDGETS, FLUSH_ROWS, LAST, NOW
from recordlake.schema import COLUMNS

# Each event with its message number, place and faults, and each message's kind.
PRELUDE = """
WITH f AS (
  SELECT event_id // 100 + 1 AS seq, CAST(event_id % 100 AS INTEGER) AS idx,
         event_id % 89 = 0 AS f_bad, event_id % 97 = 0 AS f_noid, event_id % 101 = 0 AS f_notime,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         'rec.v1.ledger.tenant-' || ((event_id // 100 + 1) % 7) || '.svc' AS subject, *
  FROM events),
m AS (
  SELECT *, CASE WHEN seq % 25 = 0 THEN 'garbage' WHEN seq % 40 = 7 THEN 'empty'
                 WHEN seq % 40 = 13 THEN 'wrong_envelope' ELSE 'batch' END AS kind,
         CASE WHEN f_bad THEN 'unmarshal' WHEN f_noid THEN 'missing_event_id'
              WHEN f_notime THEN 'missing_time' END AS fault
  FROM f),
t AS (
  SELECT *, '{"event_id":"' || CASE WHEN fault = 'missing_event_id' THEN '' ELSE 'ev-' || event_id END || '"'
      || CASE WHEN fault = 'missing_time' THEN ''
              ELSE ',"time":"' || replace(CAST(ts AS VARCHAR), ' ', 'T') || 'Z"' END
      || ',"tenant":"tenant-' || (user_id % 7) || '"'
      || ',"app":"' || CASE WHEN user_id % 11 = 0 THEN '' ELSE event_type END || '"'
      || ',"feature":"' || event_type || '"'
      || ',"run_id":"run-' || user_id || '"'
      || ',"tags":{"k":"' || k || '"}'
      || ',"usage":{"input_tokens":' || k || ',"output_tokens":' || (event_id % 500) || '}'
      || ',"cost_usd":' || CASE WHEN f_bad THEN '"zz"' ELSE CAST(value AS VARCHAR) END
      || ',"latency_ms":' || (event_id % 1000)
      || ',"outcome":"' || CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END || '"'
      || ',"principal_subject":"user:' || user_id || '"'
      || ',"chain_depth":' || (user_id % 4)
      || ',"error_detail":"' || CASE WHEN event_type = 'error' THEN 'user ' || user_id || ' not found' ELSE '' END || '"'
      || CASE WHEN ts < TIMESTAMP '2024-01-16' THEN ''
              ELSE ',"execution_subject":"' || CASE WHEN user_id % 3 = 0 THEN 'runner:' || (user_id % 5) ELSE '' END || '"' END
      || '}' AS text
  FROM m),
raw AS (
  SELECT 'LEDGER' AS stream, min(subject) AS subject, seq, max(ts) AS published_at,
         CASE min(kind) WHEN 'garbage' THEN 'not json' WHEN 'empty' THEN '{}'
              WHEN 'wrong_envelope' THEN arg_min(text, idx)
              ELSE '{"events":[' || string_agg(text, ',' ORDER BY idx) || ']}' END AS payload,
         min(kind) AS kind
  FROM t GROUP BY seq),
whole AS (
  SELECT stream, subject, seq, CAST(-1 AS INTEGER) AS idx, 'unmarshal' AS reason,
         CASE kind WHEN 'garbage'
              THEN 'message is not a JSON object (the payload does not start like JSON; this stream carries JSON text)'
              ELSE 'message is not a batch of events' END AS error,
         payload
  FROM raw WHERE kind IN ('garbage', 'wrong_envelope')),
faulty AS (
  SELECT subject, seq, idx, event_id, ts, fault AS reason,
         CASE fault WHEN 'unmarshal' THEN 'event does not match the record schema'
                    WHEN 'missing_event_id' THEN 'event_id is empty' ELSE 'time is unset' END AS error,
         text AS payload, kind
  FROM t WHERE fault IS NOT NULL),
rejects AS (
  SELECT stream, subject, seq, idx, reason, error, payload FROM whole
  UNION ALL
  SELECT 'LEDGER', subject, seq, idx, reason, error, payload FROM faulty WHERE kind = 'batch'),
good AS (SELECT * FROM t WHERE kind = 'batch' AND fault IS NULL)
"""

# The columns the test events carry; every other column is at its zero value.
CARRIED = {
    "event_id": "'ev-' || event_id",
    "time": "ts",
    "tenant": "'tenant-' || (user_id % 7)",
    "app": "CASE WHEN user_id % 11 = 0 THEN '' ELSE event_type END",
    "feature": "event_type",
    "run_id": "'run-' || user_id",
    "tags_json": "'{\"k\":\"' || k || '\"}'",
    "input_tokens": "k",
    "output_tokens": "event_id % 500",
    "cost_usd": "value",
    "latency_ms": "event_id % 1000",
    "outcome": "CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END",
    "principal_subject": "'user:' || user_id",
    "chain_depth": "CAST(user_id % 4 AS INTEGER)",
    "error_detail": "CASE WHEN event_type = 'error' THEN 'user ' || user_id || ' not found' ELSE '' END",
}
ZERO = {
    "string": "''",
    "bigint": "CAST(0 AS BIGINT)",
    "int": "CAST(0 AS INTEGER)",
    "double": "CAST(0 AS DOUBLE)",
    "boolean": "false",
}
LISTS = ("policy_violations", "compartments_effective")
RUNNER = "CASE WHEN user_id % 3 = 0 THEN 'runner:' || (user_id % 5) ELSE '' END"

#: As sent: absent before the boundary, which decodes to the zero value.
SENT = f"CASE WHEN ts < TIMESTAMP '2024-01-16' THEN '' ELSE {RUNNER} END"
#: As stored by parts of two vintages: not recorded before the boundary.
STORED = f"CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN {RUNNER} END"


def _value(name: str, kind: str, execution: str) -> str:
    if name == "execution_subject":
        return execution
    return CARRIED.get(name, "'[]'" if name in LISTS else ZERO.get(kind))


def _row(execution: str) -> str:
    return ",\n  ".join(f"{_value(c.name, c.dtype.simpleString(), execution)} AS {c.name}" for c in COLUMNS)


def _line(execution: str, no_detail: bool = False, pretty: bool = False) -> str:
    """A row as JSON text, spelled out column by column."""
    number = "CASE WHEN value = floor(value) THEN CAST(CAST(value AS BIGINT) AS VARCHAR) ELSE CAST(value AS VARCHAR) END"
    start, gap, between, end = ("  ", " ", ",\n", "\n}") if pretty else ("", "", ",", "}")
    cells = []
    for c in COLUMNS:
        if no_detail and c.name == "error_detail":
            continue
        kind, value = c.dtype.simpleString(), _value(c.name, c.dtype.simpleString(), execution)
        if c.name == "time":
            text = "'\"' || replace(CAST(ts AS VARCHAR), ' ', 'T') || 'Z\"'"
        elif c.name == "cost_usd":
            text = number
        elif kind == "string":
            text = f"'\"' || replace({value}, '\"', '\\\"') || '\"'"
        else:
            text = f"CAST({value} AS VARCHAR)"
        cells.append(f"'{start}\"{c.name}\":{gap}' || {text}")
    first = "'{\n'" if pretty else "'{'"
    return first + " || " + f" || '{between}' || ".join(cells) + f" || '{end}'"


_SHOWN = """seq, idx, 'ev-' || event_id AS event_id, ts AS time, 'tenant-' || (user_id % 7) AS tenant,
  CASE WHEN user_id % 11 = 0 THEN '' ELSE event_type END AS app,
  CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS outcome, k AS input_tokens, value AS cost_usd"""
_LAST = f"seq >= (SELECT max(seq) - {LAST - 1} FROM raw)"
_LAKE = "CASE WHEN user_id % 11 = 0 THEN '' ELSE event_type END"
_RENDERED = "CASE WHEN idx < 0 THEN '' ELSE 'event ' || idx || ': ' END || reason || ': ' || error"
_DEAD = """stream || '-' || seq || '-' || idx AS msg_id, 'ledger' AS origin, 'rec.v1.dead.ledger' AS dead_subject,
  reason, error, stream, subject, CAST(seq AS VARCHAR) AS sequence, CAST(idx AS VARCHAR) AS event_index, payload"""
_USAGE = """'tenant-' || (user_id % 7) AS tenant, CAST(ts AS DATE) AS date, count(*) AS calls,
  CAST(sum(k) AS BIGINT) AS input_tokens, CAST(sum(event_id % 500) AS BIGINT) AS output_tokens,
  round(sum(value), 2) AS cost_usd"""
_SIZES = "SELECT seq, subject, CAST(strlen(payload) AS BIGINT) AS bytes"
_AUDIT_SUBJECT = "'rec.v1.audit.tenant-' || (seq % 7) || '.svc'"

assert AGE == "36h"

_TAKEN = ", ".join(f"'{c.source}'" for c in COLUMNS)

_BODIES: dict[str, str] = {
    "raw_scan": "SELECT stream, subject, seq, published_at, payload FROM raw",
    "decode_batch_rows": f"SELECT {_row(SENT)} FROM good",
    "decode_rejects": f"SELECT *, {_RENDERED} AS rendered FROM rejects",
    "decode_event_envelope": f"SELECT {_row(SENT)} FROM t WHERE fault IS NULL",
    "decode_event_rejects": f"""SELECT 'AUDIT' AS stream, {_AUDIT_SUBJECT} AS subject, event_id + 1 AS seq,
  CAST(-1 AS INTEGER) AS idx, reason, error, payload, reason || ': ' || error AS rendered FROM faulty""",
    "message_dispositions": """SELECT 'LEDGER' AS stream, min(subject) AS subject, seq,
  CAST(sum(CASE WHEN kind = 'batch' AND fault IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS rows,
  CAST(CASE WHEN min(kind) IN ('garbage', 'wrong_envelope') THEN 1
       ELSE sum(CASE WHEN kind = 'batch' AND fault IS NOT NULL THEN 1 ELSE 0 END) END AS BIGINT) AS rejects,
  CASE WHEN min(kind) IN ('garbage', 'wrong_envelope') THEN 'term'
       WHEN min(kind) = 'batch' AND bool_and(fault IS NOT NULL) THEN 'term' ELSE 'ack' END AS disposition
  FROM t GROUP BY seq""",
    "flush_stats": """SELECT (SELECT min(seq) FROM raw) AS first_seq, (SELECT max(seq) FROM raw) AS last_seq,
  (SELECT count(*) FROM raw) AS messages, (SELECT count(*) FROM good) AS rows, (SELECT count(*) FROM rejects) AS rejects""",
    "subject_filter": """SELECT seq, subject, 'tenant-3' AS subject_tenant, 'svc' AS subject_app
  FROM raw WHERE subject LIKE 'rec.v1.ledger.tenant-3.%'""",
    "dead_letters": f"SELECT {_DEAD} FROM rejects",
    "dead_letters_once": f"SELECT {_DEAD} FROM rejects",
    "dead_letters_retried": f"SELECT {_DEAD} FROM rejects",
    "dead_letters_unknown_seq": """SELECT 'ledger' AS origin, 'unmarshal' AS reason, 'LEDGER' AS stream,
  CASE WHEN event_id % 2 = 0 THEN '0' END AS sequence, 'event ' || event_id AS payload FROM t""",
    "dead_letters_recreated": """SELECT stream || '-' || seq || '--1' AS msg_id, 'ledger' AS origin, 'unmarshal' AS reason, stream,
  CAST(seq AS VARCHAR) AS sequence, life || seq AS payload FROM raw CROSS JOIN (VALUES ('old '), ('new ')) AS lives(life)""",
    "lake_roundtrip": f"SELECT {_row(STORED)}, CAST(ts AS DATE) AS date FROM t",
    "lake_totals": "SELECT count(*) AS rows, CAST(sum(k) AS BIGINT) AS input_tokens FROM t",
    "lake_pruned_count": f"""SELECT count(*) AS rows FROM t
  WHERE CAST(ts AS DATE) = DATE '2024-01-10' AND {_LAKE} = 'click'""",
    "lake_any_value": f"""SELECT min('tenant-' || (user_id % 7)) AS tenant, min({_LAKE}) AS app FROM t
  WHERE user_id % 7 = 3 AND {_LAKE} = 'click'""",
    "lake_empty_app": """SELECT 'ev-' || event_id AS event_id, '' AS app, 'tenant-' || (user_id % 7) AS tenant
  FROM t WHERE user_id % 11 = 0""",
    "lake_projection": f"""SELECT 'ev-' || event_id AS event_id, {_LAKE} AS app, CAST(CAST(ts AS DATE) AS VARCHAR) AS date,
  k AS input_tokens FROM t ORDER BY event_id""",
    "lake_strict": """SELECT 'tenant-' || (user_id % 7) AS tenant, count(*) AS rows, round(sum(value), 2) AS cost_usd
  FROM t GROUP BY 1""",
    "lake_parts": f"""SELECT CAST(ts AS DATE) AS date, {_LAKE} AS app, count(*) AS rows, min(ts) AS first_time,
  max(ts) AS last_time FROM t GROUP BY 1, 2""",
    "lake_dedupe": f""", copies AS (SELECT * FROM t UNION ALL SELECT * FROM t WHERE seq % 10 = 3),
one AS (SELECT * FROM copies QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ts) = 1)
SELECT {_row(RUNNER)}, CAST(ts AS DATE) AS date FROM one""",
    "lake_dedupe_usage": f"""SELECT {_USAGE} FROM t GROUP BY 1, 2""",
    "lake_views": f"SELECT {_LAKE} AS app, count(*) AS rows, CAST(sum(k) AS BIGINT) AS input_tokens FROM t GROUP BY 1",
    "schema_evolution": f"SELECT 'ev-' || event_id AS event_id, {STORED} AS execution_subject FROM t",
    "execution_provenance": f"""SELECT 'ev-' || event_id AS event_id, 'user:' || user_id AS principal_subject,
  {STORED} AS execution_subject,
  CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'not recorded' WHEN user_id % 3 = 0 THEN 'runner' ELSE 'direct' END AS provenance
  FROM t""",
    "provenance_counts": """SELECT CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'not recorded'
  WHEN user_id % 3 = 0 THEN 'runner' ELSE 'direct' END AS provenance, count(*) AS rows FROM t GROUP BY 1""",
    "tags_lookup": "SELECT 'ev-' || event_id AS event_id, CAST(k AS VARCHAR) AS k, CAST(0 AS BIGINT) AS violations FROM t",
    "tail_last_n": f"SELECT {_SHOWN} FROM good WHERE {_LAST}",
    "tail_last_n_of_subject": f"SELECT {_SHOWN} FROM good WHERE {_LAST} AND subject LIKE 'rec.v1.ledger.tenant-3.%'",
    "tail_since_age": f"""SELECT {_SHOWN} FROM good
  WHERE seq IN (SELECT seq FROM raw WHERE published_at >= TIMESTAMP '{NOW}' - INTERVAL 36 HOUR)""",
    "tail_from_start": f"SELECT {_SHOWN} FROM good",
    "tail_filtered": f"SELECT {_SHOWN} FROM good WHERE event_type = 'error' AND user_id % 4 = 2",
    "tail_no_detail": f"SELECT seq, idx, {_line(SENT, no_detail=True)} AS line FROM good WHERE {_LAST} AND event_type = 'error'",
    "tail_json_lines": f"SELECT seq, idx, {_line(SENT)} AS line FROM good",
    "tail_pretty": f"SELECT seq, idx, {_line(SENT, pretty=True)} AS line FROM good WHERE {_LAST}",
    "tail_unreadable": f"""SELECT subject, seq, idx,
  subject || ' seq ' || seq || ': unreadable: ' || {_RENDERED} AS message FROM rejects""",
    "tail_follow": f"SELECT seq, idx, {_line(SENT)} AS line FROM good WHERE {_LAST} AND event_type <> 'error'",
    "drain_available_now": f"SELECT {_row(SENT)}, CAST(ts AS DATE) AS date FROM good",
    "drain_dead_letters": f"SELECT {_DEAD} FROM rejects",
    "drain_flush_log": """SELECT (SELECT min(seq) FROM raw) AS first_seq, (SELECT max(seq) FROM raw) AS last_seq,
  (SELECT count(*) FROM raw) AS messages, (SELECT count(*) FROM good) AS rows, (SELECT count(*) FROM rejects) AS rejects""",
    "retain_newest": f""", summed AS (
  SELECT *, sum(strlen(payload)) OVER (ORDER BY seq DESC) AS running FROM raw)
{_SIZES} FROM summed WHERE running <= {BUDGET}""",
    "retain_by_age": f""", summed AS (
  SELECT *, sum(strlen(payload)) OVER (ORDER BY seq DESC) AS running FROM raw
  WHERE published_at >= TIMESTAMP '{NOW}' - INTERVAL 7 DAY)
{_SIZES} FROM summed WHERE running <= {BUDGET}""",
    "admit_oldest": f""", summed AS (SELECT *, sum(strlen(payload)) OVER (ORDER BY seq) AS running FROM raw)
{_SIZES}, running <= {BUDGET} AS accepted FROM summed""",
    "duplicate_window": "SELECT stream, subject, seq, published_at, payload FROM raw",
    "duplicate_window_stream": "SELECT stream, subject, seq, published_at, payload FROM raw",
    "contract_drift": f""", carried AS (
  SELECT t.*, unnest(CASE WHEN fault = 'missing_time' THEN [] ELSE ['time'] END
    || CASE WHEN ts < TIMESTAMP '2024-01-16' THEN [] ELSE ['execution_subject'] END
    || CASE WHEN event_id % 10 = 0 THEN ['region'] ELSE [] END
    || ['event_id', 'tenant', 'app', 'feature', 'run_id', 'tags', 'usage.input_tokens', 'usage.output_tokens',
        'cost_usd', 'latency_ms', 'outcome', 'principal_subject', 'chain_depth', 'error_detail']) AS field
  FROM t WHERE kind = 'batch'),
contract AS (SELECT unnest([{_TAKEN}]) AS field, unnest([{", ".join(f"'{c.name}'" for c in COLUMNS)}]) AS col,
  unnest([{", ".join("'%s'" % {"string": "text", "bigint": "integer", "int": "integer", "double": "number", "boolean": "boolean", "map<string,string>": "object", "array<string>": "list"}[c.wire.simpleString()] for c in COLUMNS)}]) AS want)
SELECT field, CAST(NULL AS VARCHAR) AS "column", CAST(NULL AS VARCHAR) AS want, 'text' AS seen, count(*) AS events,
  'not a column' AS problem FROM carried WHERE field = 'region' GROUP BY field
UNION ALL
SELECT field, 'cost_usd', 'number', 'text', count(*), 'other kind' FROM carried WHERE field = 'cost_usd' AND f_bad GROUP BY field
UNION ALL
SELECT field, col, want, NULL, 0, 'not carried' FROM contract WHERE field NOT IN (SELECT field FROM carried)""",
    "policy_diff": f""", held AS (
  SELECT CAST(ceil((epoch_us(max(published_at)) - epoch_us(min(published_at))) / 1000000) AS BIGINT) AS age,
         CAST(sum(strlen(payload)) AS BIGINT) AS bytes FROM raw)
SELECT * FROM (
  SELECT 'ledger' AS "table", 'max_age' AS field, '604800' AS want, CAST(age AS VARCHAR) AS running,
         'max_age: want 604800, running ' || age AS told FROM held WHERE age > 604800
  UNION ALL
  SELECT 'ledger', 'max_bytes', '{BUDGET}', CAST(bytes AS VARCHAR), 'max_bytes: want {BUDGET}, running ' || bytes
  FROM held WHERE bytes > {BUDGET})""",
    "usage_by_tenant_day": f"SELECT {_USAGE} FROM good GROUP BY 1, 2",
}

_BODIES["drain_row_bounded"] = f""", counted AS (
  SELECT raw.seq, row_number() OVER (ORDER BY raw.seq) AS place,
    (SELECT count(*) FROM good g WHERE g.seq = raw.seq) AS rows, (SELECT count(*) FROM rejects r WHERE r.seq = raw.seq) AS rejects FROM raw),
walked AS (
  SELECT seq, place, rows, rejects, rows AS held, CAST(0 AS BIGINT) AS flush_id FROM counted WHERE place = 1
  UNION ALL
  SELECT c.seq, c.place, c.rows, c.rejects, CASE WHEN w.held >= {FLUSH_ROWS} THEN c.rows ELSE w.held + c.rows END,
    CASE WHEN w.held >= {FLUSH_ROWS} THEN w.flush_id + 1 ELSE w.flush_id END
  FROM walked w JOIN counted c ON c.place = w.place + 1)
SELECT flush_id, min(seq) AS first_seq, max(seq) AS last_seq, count(*) AS messages, CAST(sum(rows) AS BIGINT) AS rows,
  CAST(sum(rejects) AS BIGINT) AS rejects FROM walked GROUP BY flush_id"""
_BODIES["part_to_messages"] = """, top AS (SELECT max(seq) AS last FROM raw),
counted AS (
  SELECT seq, CAST(ts AS DATE) AS date, CASE WHEN user_id % 11 = 0 THEN '' ELSE event_type END AS app, count(*) AS rows FROM good GROUP BY ALL)
SELECT unnest(['ledger', 'again']) AS origin,
  CAST(CASE WHEN seq <= last // 3 THEN 0 WHEN seq <= 2 * last // 3 THEN 1 ELSE 2 END AS BIGINT) AS flush, date, app, seq, rows FROM counted, top"""
_ODD = """'{ "event_id":"" ,' || chr(10) || ' "n":' || event_id || ' ,' || chr(10) || ' "cost_usd" : 0.12345678901234567890123 }'"""
_BODIES["decode_odd_messages"] = f"""SELECT seq, idx, CASE WHEN event_id % 5 IN (0, 4) THEN 'ev-' || event_id ELSE '' END AS event_id,
  CASE event_id % 5 WHEN 1 THEN 'missing_event_id' WHEN 2 THEN 'unmarshal' WHEN 3 THEN 'unmarshal' ELSE '' END AS reason,
  CASE event_id % 5 WHEN 1 THEN {_ODD} WHEN 2 THEN '{{ "event_id" : "ev-' || event_id || '" ,' || chr(10) || ' "tags":{{"k":"1","k":"2"}} }}'
    WHEN 3 THEN '"{{' || event_id || ' ]}}"' ELSE '' END AS text
FROM f"""
_BODIES["tail_follow_unreadable"] = f"""SELECT 'line' AS kind, seq, idx, {_line(SENT)} AS told FROM good WHERE event_type <> 'error'
UNION ALL
SELECT 'unreadable', seq, idx, subject || ' seq ' || seq || ': unreadable: ' || {_RENDERED} FROM rejects"""
_BODIES["duplicate_ids_stream"] = """, sent AS (SELECT stream, subject, seq, published_at, payload, 'm-' || seq AS message_id FROM raw)
SELECT stream, subject, seq, published_at, payload, message_id FROM sent
UNION ALL SELECT stream, subject, 0, published_at, payload, NULL FROM sent, range(2) WHERE seq % 10 = 4
UNION ALL SELECT stream, subject, NULL, published_at, payload, '' FROM sent WHERE seq % 10 = 5
UNION ALL SELECT stream, subject, seq, published_at, payload, NULL FROM sent WHERE seq % 10 = 6"""

_BODIES["lake_parts_lacking"] = f"""SELECT DISTINCT CAST(ts AS DATE) AS date, {_LAKE} AS app, 'execution_subject' AS "column"
FROM t WHERE ts < TIMESTAMP '2024-01-16'"""
_BODIES["tail_last_n_by_zones"] = _BODIES["tail_last_n"]
_BODIES["observed_doubled"] = """, held AS (
  SELECT unnest(CASE event_id % 4
    WHEN 0 THEN ['event_id text', 'tenant text', 'usage object', 'usage.input_tokens integer']
    WHEN 1 THEN ['event_id text', 'surprise list', 'usage object', 'usage.input_tokens integer']
    WHEN 2 THEN ['event_id text', 'usage object', 'usage.input_tokens integer', 'usage.input_tokens text', 'usage.more number']
    ELSE ['event_id text', 'event_id integer', 'usage text', 'meta object'] END) AS told FROM f)
SELECT split_part(told, ' ', 1) AS field, split_part(told, ' ', 2) AS kind, count(*) AS events FROM held GROUP BY told"""
_BOTH = """, both_streams AS (
  SELECT stream, seq, CAST(strlen(payload) AS BIGINT) AS bytes FROM raw
  UNION ALL SELECT 'AUDIT', event_id + 1, CAST(strlen(text) AS BIGINT) FROM t)"""
_LIMIT = f"CASE stream WHEN 'LEDGER' THEN {BUDGETS['LEDGER']} ELSE {BUDGETS['AUDIT']} END"
_BODIES["retain_streams"] = f"""{_BOTH}
SELECT stream, seq, bytes FROM both_streams
QUALIFY sum(bytes) OVER (PARTITION BY stream ORDER BY seq DESC) <= {_LIMIT}"""
_BODIES["admit_streams"] = f"""{_BOTH}
SELECT stream, seq, sum(bytes) OVER (PARTITION BY stream ORDER BY seq)
  <= CASE stream WHEN 'LEDGER' THEN {BUDGETS['LEDGER']} ELSE {BUDGETS['AUDIT'] - BUDGET // 4} END AS accepted FROM both_streams"""

_BODIES["decode_text_kinds"] = """, sent AS (
  SELECT *, CASE event_id % 9 WHEN 0 THEN '"tenant":"' || user_id || '"' WHEN 1 THEN '"tenant":{"x":' || user_id || '}'
    WHEN 2 THEN '"tenant" : [' || user_id || ']' WHEN 3 THEN '"tenant":' || user_id WHEN 4 THEN '"tags":{"k":"1","n":' || user_id || '}'
    WHEN 5 THEN '"policy_violations":["a",' || user_id || ']' WHEN 6 THEN '"tenant":false' END AS field FROM f)
SELECT event_id + 1 AS seq,
  CASE event_id % 9 WHEN 0 THEN CAST(user_id AS VARCHAR) WHEN 7 THEN '{"x":' || user_id || '}' ELSE '' END AS tenant,
  CASE event_id % 9 WHEN 7 THEN '{"k":"' || user_id || '"}' WHEN 0 THEN '{}' WHEN 8 THEN '{}' ELSE '' END AS tags_json,
  CASE WHEN event_id % 9 IN (0, 7, 8) THEN '' ELSE 'unmarshal' END AS reason,
  CASE WHEN event_id % 9 IN (0, 7, 8) THEN 0
    ELSE strlen('{"event_id":"ev-' || event_id || '","time":"' || replace(CAST(ts AS VARCHAR), ' ', 'T') || 'Z",' || field || '}') END AS bytes
FROM sent"""
_BODIES["decode_whole_rejects"] = """, numbered AS (SELECT seq, CAST(count(*) AS INTEGER) AS n FROM f GROUP BY seq)
SELECT seq, n AS idx, 'missing_event_id' AS reason, '{"event_id":"","n":' || seq || '}' AS payload FROM numbered
UNION ALL SELECT seq, n + 1, 'missing_time', '{"event_id":"x-' || seq || '"}' FROM numbered
UNION ALL SELECT seq, n + 2, 'unmarshal', '{"event_id":"y-' || seq || '","time":"2024-01-01T00:00:00Z","cost_usd":"zz"}' FROM numbered
UNION ALL SELECT seq, n + 3, 'unmarshal', '{"event_id":"z-' || seq || '","time":"2024-01-01T00:00:00Z","tenant":{"n":' || seq || '}}' FROM numbered
UNION ALL SELECT seq + 1000000000, -1, 'unmarshal', 'not json' FROM numbered WHERE seq % 10 = 0"""
_BODIES["usage_whole_by_tenant_day"] = f"SELECT {_USAGE} FROM t GROUP BY 1, 2"
_BODIES["drain_whole"] = f"SELECT {_row(SENT)}, CAST(ts AS DATE) AS date FROM t"
_BODIES["drain_redelivery"] = """SELECT 'row' AS kind, 'ev-' || event_id AS id, CAST(2 AS BIGINT) AS copies FROM good
UNION ALL SELECT 'letter', stream || '-' || seq || '-' || idx, 1 FROM rejects"""
_BODIES["drain_redelivery_deduped"] = _BODIES["usage_by_tenant_day"]
_BODIES["drain_order"] = """, counts AS (SELECT (SELECT count(*) FROM rejects) AS dead, (SELECT count(*) FROM good) AS rows),
attempts AS (SELECT * FROM (VALUES (1, 0, 'dead'), (1, 1, 'flushes'), (2, 2, 'dead'), (2, 3, 'rows'), (2, 4, 'flushes'),
  (3, 5, 'dead'), (3, 6, 'rows'), (3, 7, 'flushes')) AS a(attempt, step, what))
SELECT CAST(attempt AS INTEGER) AS attempt, CAST(step AS INTEGER) AS step, what,
  CASE what WHEN 'dead' THEN dead WHEN 'rows' THEN rows ELSE CASE WHEN attempt = 3 THEN 1 ELSE 0 END END AS n FROM attempts, counts"""
_BODIES["drain_rejects_only"] = """SELECT CAST(0 AS BIGINT) AS flush_id, (SELECT count(*) FROM good) AS rows,
  (SELECT count(*) FROM rejects) AS rejects, true AS wrote_parts
UNION ALL SELECT 1, 0, (SELECT count(*) FROM raw), false"""
_BODIES["lake_prefixes"] = f"""SELECT 'ledger' AS prefix, 'ev-' || event_id AS event_id, {_LAKE} AS app FROM good
UNION ALL SELECT 'audit', 'ev-' || event_id, {_LAKE} FROM t WHERE fault IS NULL"""
_BODIES["lake_half_written"] = """SELECT 'ev-' || event_id AS event_id, substr(lpad(CAST(user_id AS VARCHAR), 5, '0'), 4, 2) AS app,
  CAST(ts AS DATE) AS date FROM f"""
_BODIES["tail_precedence"] = f"SELECT unnest(['{LAST}', '{AGE}']) AS since, seq, idx FROM good"
_BODIES["drain_after_follow"] = """SELECT 'row' AS kind, 'ev-' || event_id AS id FROM good
UNION ALL SELECT 'letter', stream || '-' || seq || '-' || idx FROM rejects"""

ORACLES: dict[str, str] = {name: PRELUDE + body for name, body in _BODIES.items()}
ORACLES["drain_row_bounded"] = ORACLES["drain_row_bounded"].replace("WITH f AS", "WITH RECURSIVE f AS", 1)
