import datetime as dt
import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from recordlake.schema import RAW_SCHEMA  # noqa: E402
from recordlake.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4, memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield session
    session.stop()


def event(event_id="ev-1", time="2026-09-29T12:00:00Z", **fields):
    """An event as it is sent."""
    return {"event_id": event_id, "time": time, "tenant": "acme", "app": "svc", **fields}


def batch(*events) -> bytes:
    return json.dumps({"events": list(events)}, separators=(",", ":")).encode()


def single(one) -> bytes:
    return json.dumps(one, separators=(",", ":")).encode()


@pytest.fixture
def messages(spark):
    """Payloads as a table of messages, numbered from 1 unless given as (seq, payload)."""

    def make(*payloads, stream="LEDGER", subject="rec.v1.ledger.acme.svc", at=dt.datetime(2026, 9, 29, 12)):
        rows = []
        for place, payload in enumerate(payloads, start=1):
            seq, payload = payload if isinstance(payload, tuple) else (place, payload)
            rows.append((stream, subject, seq, at, None if payload is None else bytearray(payload)))
        return spark.createDataFrame(rows, RAW_SCHEMA)

    return make


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
