"""Compares a Spark result with its SQL, the way the driver does: columns by name, rows in any order."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _key(row):
    return tuple((v is None, str(v)) for v in row)


def differences(con, df, sql: str) -> str | None:
    """What differs, or None."""
    told = con.execute(sql)
    names = [d[0] for d in told.description]
    types = {d[0]: str(d[1]) for d in told.description}
    want = told.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} want {sorted(names)}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
             "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
    for name, kind in df.dtypes:
        if kinds.get(kind) != types[name]:
            return f"type of {name}: {kind} want {types[name]}"
    order = sorted(names)
    got = sorted((tuple(r[c] for c in order) for r in df.collect()), key=_key)
    place = [names.index(c) for c in order]
    want = sorted((tuple(r[i] for i in place) for r in want), key=_key)
    if len(got) != len(want):
        return f"{len(got)} rows want {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            bad = [(c, a, b) for c, a, b in zip(order, g, w) if a != b]
            return f"values {bad[:4]}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry
    from recordlake.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    sqls, bad = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        begun = time.time()
        try:
            problem = differences(con, query(spark, sf), sqls[name])
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - begun:.1f}s {problem or ''}", flush=True)
    print(f"{bad} failed")
