"""Times the headline operators at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]`` and prints one JSON line.

Each figure is the median of ``$BENCH_RUNS`` warm runs, in seconds.  ``rows_per_sec``
and ``lake`` are beside the times: what a flush does per second, and the files it leaves.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable

from pyspark.sql import functions as F

import recordlake as rl
from recordlake.plans import queries as q
from recordlake.session import local_session, scratch_path
from recordlake.sources import fixtures as fx

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(run: Callable[[], object]) -> float:
    begun = time.perf_counter()
    run()
    return time.perf_counter() - begun


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=int(CPUS), memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    root = scratch_path(spark, "bench")

    raw = q.messages(spark, SF_DIR)
    audit = q.audit_messages(spark, SF_DIR)
    rows = fx.lake_rows(spark, SF_DIR)
    lake = q.lake(spark, SF_DIR)
    copies = q.lake_with_copies(spark, SF_DIR)
    n_rows = rows.count()
    landing = q._derived(spark, SF_DIR, "ledger-raw", lambda p: None)
    turn = iter(range(10_000))

    def fresh(name: str) -> str:
        return f"{root}/{name}-{next(turn)}"

    def write() -> None:
        rl.write_lake(rows, fresh("written"), "ledger")

    def drain() -> None:
        out = fresh("drained")
        rl.drain(
            rl.raw_stream(spark, landing),
            rl.BATCH,
            lake=f"{out}/lake",
            dead=f"{out}/dead",
            checkpoint=f"{out}/checkpoint",
            flush_log=f"{out}/flushes",
            available_now=True,
        ).awaitTermination()

    measures: dict[str, Callable[[], object]] = {
        "decode": lambda: noop(rl.decode(raw, rl.BATCH)),
        "decode_rows": lambda: noop(rl.to_rows(rl.decode(raw, rl.BATCH))),
        "decode_event_envelope": lambda: noop(rl.to_rows(rl.decode(audit, rl.EVENT))),
        "dispositions": lambda: noop(rl.dispositions(raw, rl.BATCH)),
        "usage_by_tenant_day": lambda: q.usage_by_tenant_day(spark, SF_DIR).collect(),
        "lake_write": write,
        "lake_scan": lambda: noop(lake),
        "lake_dedupe": lambda: noop(rl.dedupe(copies)),
        "lake_dedupe_usage": lambda: rl.usage_by_tenant_day(rl.dedupe(copies)).collect(),
        "lake_pruned_count": lambda: rl.partition_count(lake, "2024-01-10", "click").collect(),
        "provenance_counts": lambda: rl.provenance_counts(lake).collect(),
        "dead_letters_once": lambda: noop(rl.distinct_dead(rl.to_dead(rl.to_rejects(rl.decode(raw, rl.BATCH)), "ledger"))),
        "drain_available_now": drain,
        "tail_last_100": lambda: rl.tail(raw, rl.BATCH, stream=fx.STREAM).lines.collect(),
        "tail_from_start": lambda: noop(rl.tail(raw, rl.BATCH, from_start=True).lines),
        "retain_newest": lambda: noop(rl.retain_newest(raw, max_bytes=q.BUDGET)),
        "contract_drift": lambda: rl.contract_drift(rl.observed_fields(raw, rl.BATCH)).collect(),
    }
    seconds: dict[str, float] = {}
    for name, run in measures.items():
        run()
        seconds[name] = round(statistics.median(timed(run) for _ in range(RUNS)), 4)

    written = fresh("measured")
    rl.write_lake(rows, written, "ledger")
    parts = rl.lake_parts(spark, written, "ledger").agg(F.count("*"), F.avg("bytes")).first()
    per_second = {k: round(n_rows / seconds[k]) for k in ("decode_rows", "lake_write", "lake_dedupe", "drain_available_now")}
    print(
        json.dumps(
            {
                "metric": "recordlake headline operators, sum of warm medians",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "rows": n_rows,
                "rows_per_sec": per_second,
                "lake": {"files": parts[0], "mean_bytes": round(parts[1])},
            }
        )
    )


if __name__ == "__main__":
    main()
