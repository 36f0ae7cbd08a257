import datetime as dt
import shutil
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import recordlake as rl
from conftest import plan_of
from recordlake.schema import COLUMNS, LAKE_SCHEMA, ROW_SCHEMA

DAY = dt.datetime(2026, 9, 29, 12, 0, 0, 123456)


def sentinel(place, **given):
    """A row whose every cell is a value of its own, so that a shift by one column shows."""
    cells = {}
    for i, c in enumerate(COLUMNS):
        kind = c.dtype
        cells[c.name] = (
            DAY if c.name == "time" else f"{c.name}-{place}" if kind == T.StringType() else (i % 2 == 0)
            if kind == T.BooleanType() else i + 0.5 if kind == T.DoubleType() else 1000 * place + i
        )
    return tuple({**cells, **given}[c.name] for c in COLUMNS)


@pytest.fixture
def write(spark, tmp_path):
    def land(*rows, prefix="ledger"):
        rl.write_lake(spark.createDataFrame(list(rows), ROW_SCHEMA), str(tmp_path), prefix)
        return str(tmp_path)

    return land


def tree():
    return [
        sentinel(1, event_id="a", app="svc-a", input_tokens=10),
        sentinel(2, event_id="b", app="svc-b", input_tokens=20),
        sentinel(3, event_id="c", app="svc-a", input_tokens=30, time=DAY + dt.timedelta(days=1)),
    ]


def test_every_column_comes_back_as_it_went_in(spark, write):
    root = write(sentinel(1))
    got = rl.read_lake(spark, root, "ledger")
    assert got.columns == LAKE_SCHEMA.fieldNames()
    assert [f.dataType for f in got.schema] == [f.dataType for f in LAKE_SCHEMA]
    assert tuple(got.first()) == (*sentinel(1), DAY.date())


def test_the_layout_is_date_and_app_in_the_path_and_zstd_inside(write):
    root = Path(write(*tree()))
    dirs = {str(p.parent.relative_to(root)) for p in root.rglob("*.parquet")}
    assert dirs == {"ledger/date=2026-09-29/app=svc-a", "ledger/date=2026-09-29/app=svc-b", "ledger/date=2026-09-30/app=svc-a"}
    part = pq.ParquetFile(next(root.rglob("*.parquet")))
    assert part.metadata.row_group(0).column(0).compression == "ZSTD"
    assert part.schema_arrow.names == [n for n in LAKE_SCHEMA.fieldNames() if n not in ("date", "app")]


def test_totals_and_one_partition(spark, write):
    lake = rl.read_lake(spark, write(*tree()), "ledger")
    assert tuple(rl.lake_totals(lake).first()) == (3, 60)
    pruned = rl.partition_count(lake, "2026-09-29", "svc-a")
    assert pruned.first()[0] == 1
    scan = next(line for line in plan_of(pruned).splitlines() if "FileScan" in line)
    assert "2026-09-29" in scan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "svc-a" in scan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert tuple(rl.any_tenant_app(lake.filter("event_id = 'b'")).first()) == ("tenant-2", "svc-b")
    assert [(r.event_id, r.date) for r in rl.ids_in_order(lake).collect()] == [("a", "2026-09-29"), ("b", "2026-09-29"), ("c", "2026-09-30")]


def test_a_query_reads_the_columns_it_names(spark, write):
    lake = rl.read_lake(spark, write(*tree()), "ledger")
    assert "ReadSchema: struct<cost_usd:double>" in plan_of(lake.agg(F.sum("cost_usd")))


def test_an_empty_app_and_an_all_digit_app_are_strings(spark, write):
    root = write(sentinel(1, event_id="e", app=""), sentinel(2, event_id="n", app="123"), sentinel(3, event_id="s", app="a/b=c d"))
    lake = rl.read_lake(spark, root, "ledger")
    assert {(r.event_id, r.app) for r in lake.collect()} == {("e", ""), ("n", "123"), ("s", "a/b=c d")}
    empty = lake.filter(F.col("app") == "")
    assert empty.count() == 1
    assert "PartitionFilters: []" not in plan_of(empty)


def test_the_first_and_the_last_day_can_be_read_back(spark, write):
    days = [dt.datetime(1, 1, 2), dt.datetime(1582, 10, 10, 1), dt.datetime(9999, 12, 31, 23, 59, 59, 999999)]
    lake = rl.read_lake(spark, write(*[sentinel(i, time=day) for i, day in enumerate(days)]), "ledger")
    assert sorted((r.time, r.date) for r in lake.collect()) == [(day, day.date()) for day in days]


def test_no_rows_no_file(spark, tmp_path):
    rl.write_lake(spark.createDataFrame([], ROW_SCHEMA), str(tmp_path), "ledger")
    assert list(tmp_path.rglob("*.parquet")) == []


def test_two_prefixes_are_two_lakes(spark, write):
    root = write(sentinel(1), prefix="ledger")
    write(sentinel(2), sentinel(3), prefix="audit")
    assert rl.read_lake(spark, root, "ledger").count() == 1
    assert rl.read_lake(spark, root, "audit").count() == 2
    assert rl.lake_path("/lake/", "audit") == "/lake/audit"


def test_a_torn_part_changes_nothing(spark, write):
    root = write(*tree())
    whole = next(Path(root).rglob("*.parquet"))
    torn = whole.with_name("part-torn.parquet.incomplete")
    torn.write_bytes(whole.read_bytes()[:200])
    assert rl.read_lake(spark, root, "ledger").count() == 3


def test_a_tree_copied_elsewhere_reads_the_same(spark, write, tmp_path_factory):
    root = write(*tree())
    other = tmp_path_factory.mktemp("copy") / "lake"
    shutil.copytree(root, other)
    assert rl.lake_totals(rl.read_lake(spark, str(other), "ledger")).first()[1] == 60


def older_part(spark, root, place):
    """A part from before execution_subject was a column."""
    df = rl.sinks.lake.with_date(spark.createDataFrame([sentinel(place, event_id=f"old-{place}")], ROW_SCHEMA))
    df.drop("execution_subject").write.mode("append").partitionBy("date", "app").parquet(f"{root}/ledger")


def test_not_recorded_direct_and_runner_stay_apart(spark, write):
    root = write(sentinel(1, event_id="d", execution_subject=""), sentinel(2, event_id="r", execution_subject="runner:1"))
    older_part(spark, root, 3)
    lake = rl.read_lake(spark, root, "ledger")
    assert {(r.provenance, r.rows) for r in rl.provenance_counts(lake).collect()} == {("not recorded", 1), ("direct", 1), ("runner", 1)}
    assert lake.filter("execution_subject IS NULL").first().event_id == "old-3"


def test_a_strict_read_refuses_only_what_it_needs(spark, write):
    root = write(sentinel(1))
    older_part(spark, root, 2)
    with pytest.raises(rl.SchemaMismatch, match="execution_subject could not be found in file"):
        rl.read_lake(spark, root, "ledger", columns=["event_id", "execution_subject"], strict=True)
    assert rl.read_lake(spark, root, "ledger", columns=["event_id", "date", "app"], strict=True).count() == 2
    with pytest.raises(ValueError, match="no column nope"):
        rl.read_lake(spark, root, "ledger", columns=["nope"])


def test_a_strict_read_goes_by_footers_and_not_by_values(spark, write, tmp_path):
    root = write(sentinel(1))
    holding = spark.createDataFrame([sentinel(2, app="a:b %41=c", execution_subject=None)], ROW_SCHEMA)
    rl.sinks.lake.with_date(holding).write.mode("append").partitionBy("date", "app").parquet(f"{root}/ledger")
    names = ["event_id", "app", "execution_subject"]
    assert rl.read_lake(spark, root, "ledger", columns=names, strict=True).filter("execution_subject IS NULL").count() == 1
    assert rl.parts_lacking(spark, root, "ledger").count() == 0
    older_part(spark, root, 3)
    empty = rl.sinks.lake.with_date(holding).drop("execution_subject", "tool", "date", "app").limit(0)
    empty.coalesce(1).write.parquet(f"{root}/ledger/date=2024-01-01/app=x")
    lacking = {tuple(r.columns) for r in rl.parts_lacking(spark, root, "ledger").collect()}
    assert lacking == {("execution_subject",), ("tool", "execution_subject")}
    assert rl.parts_lacking(spark, root, "ledger", ["event_id", "app"]).count() == 0
    with pytest.raises(rl.SchemaMismatch, match="tool could not be found in file"):
        rl.read_lake(spark, root, "ledger", columns=["tool"], strict=True)


def test_copies_are_folded_before_the_shuffle(spark, write):
    root = write(*tree(), *tree())
    write(sentinel(9, event_id="a", time=DAY - dt.timedelta(hours=1)))
    lake = rl.read_lake(spark, root, "ledger")
    one = rl.dedupe(lake)
    plan = plan_of(one)
    assert plan.index("WindowGroupLimit") < plan.index("Exchange hashpartitioning(event_id") < plan.rindex("WindowGroupLimit")
    assert plan.count("Exchange") == 1
    assert sorted(r.event_id for r in one.collect()) == ["a", "b", "c"]
    assert one.filter("event_id = 'a'").first().time == DAY - dt.timedelta(hours=1)


def test_a_hot_partition_is_split_over_tasks(spark, tmp_path):
    hot = spark.range(0, 120_000, 1, 8).selectExpr("concat('ev-', id) AS event_id", "if(id % 3 = 0, concat('app-', id % 7), 'hot') AS app", "id")
    cells = []
    for c in COLUMNS:
        if c.name in ("event_id", "app"):
            cells.append(c.name)
        elif c.name == "time":
            cells.append(f"TIMESTAMP_NTZ '{DAY}' AS time")
        elif c.name == "run_id":
            cells.append("sha2(CAST(id AS STRING), 512) AS run_id")
        else:
            cells.append(f"CAST(NULL AS {c.dtype.simpleString()}) AS {c.name}")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "200")
    try:
        rl.write_lake(hot.selectExpr(*cells), str(tmp_path), "ledger")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    parts = rl.lake_parts(spark, str(tmp_path), "ledger").collect()
    assert sum(p.rows for p in parts) == 120_000
    of_hot = [p.rows for p in parts if p.app == "hot"]
    assert len(of_hot) > 1 and max(of_hot) < 60_000
    assert len([p for p in parts if p.app == "app-1"]) == 1


def test_tags_and_lists_open(spark, write):
    root = write(sentinel(1, tags_json='{"k":"1","odd.key\'s":"2"}', policy_violations='["x","y"]'))
    lake = rl.read_lake(spark, root, "ledger")
    got = rl.list_items(rl.tag(rl.tag(rl.tag(lake, "k"), "odd.key's", "odd"), "none"), "policy_violations").first()
    assert (got.k, got.odd, got.none, got.policy_violations_items) == ("1", "2", None, ["x", "y"])


def test_the_lake_as_views(spark, write):
    rl.register_views(spark, rl.read_lake(spark, write(*tree(), *tree()), "ledger"), "seen")
    assert spark.sql("SELECT count(*) FROM seen").first()[0] == 6
    assert spark.sql("SELECT count(*) FROM seen_deduped").first()[0] == 3
    assert spark.sql("SELECT count(*) FROM seen_provenance WHERE provenance = 'runner'").first()[0] == 6
