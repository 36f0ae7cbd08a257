from pyspark.sql import types as T

from recordlake.schema import COLUMN_NAMES, COLUMNS, LAKE_SCHEMA, ROW_SCHEMA, column_named, event_schema


def test_forty_columns_each_named_once_and_the_newest_last():
    assert len(COLUMN_NAMES) == len(set(COLUMN_NAMES)) == 40
    assert COLUMN_NAMES[:4] == ("event_id", "time", "tenant", "app")
    assert COLUMN_NAMES[-2:] == ("error_detail", "execution_subject")


def test_date_belongs_to_the_layout_and_not_to_the_row():
    assert "date" not in ROW_SCHEMA.fieldNames()
    assert LAKE_SCHEMA.fieldNames() == [*COLUMN_NAMES, "date"]


def test_every_column_is_read_from_one_event_field():
    wire = event_schema()
    sources = [c.source for c in COLUMNS]
    assert len(set(sources)) == 40
    for source in sources:
        head, _, leaf = source.partition(".")
        assert head in wire.fieldNames()
        if leaf:
            assert leaf in wire[head].dataType.fieldNames()
    renamed = {c.name: c.source for c in COLUMNS if c.name != c.source}
    assert renamed == {"tags_json": "tags", **{f"{k}_tokens": f"usage.{k}_tokens" for k in ("input", "output", "cached", "reasoning")}}


def test_a_column_is_found_by_name_and_an_unknown_one_is_not():
    assert column_named("chain_depth").dtype == T.IntegerType()
    assert column_named("date") is None
