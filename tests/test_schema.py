"""Schema checks that raise, keys, and look-ups of one row."""

import pytest
from pyspark.sql import functions as F

from quayside.operators import quality
from quayside.reports.naming import only_row
from quayside.reports.revenue import addendum
from quayside.sources import schema

COLUMNS = "table string, column string, type string"
KEYS = "table string, name string, key_pos int"


def test_types_that_differ_raise_and_text_types_do_not(spark):
    have = spark.createDataFrame([("t", "a", "varchar(9)"), ("t", "b", "int"), ("t", "x", "int"), ("t", "p", "int")], COLUMNS)
    want = spark.createDataFrame([("t", "a", "string"), ("t", "b", "int"), ("t", "m", "int")], COLUMNS)
    assert sorted((r.column, r.issue) for r in schema.assert_compatible(have, want, ("p",)).collect()) == [("m", "missing"), ("x", "extra")]
    with pytest.raises(ValueError, match="t.b is int, not bigint"):
        schema.assert_compatible(have, want.withColumn("type", F.expr("if(column = 'b', 'bigint', type)")))


def test_keys_are_checked(spark):
    rows = spark.createDataFrame([("t", "B", 2), ("t", "A", 1), ("t", "c", 0), ("u", "A", 1), ("u", "B", 1), ("v", "A", 0)], KEYS)
    assert schema.discovered_keys(rows, "t", ["a", "b", "c"]) == ["a", "b"]
    for table, columns, told in (("t", ["a"], "absent_key b"), ("u", ["a", "b"], "repeated_position 1: a,b"), ("v", ["a"], "no_keys"), ("w", ["a"], "no descriptor")):
        with pytest.raises(ValueError, match=told):
            schema.discovered_keys(rows, table, columns)


def test_windows_of_reports(spark):
    rows = spark.createDataFrame([(20231231, 20231201), (20240102, 20231201), (20240105, 20231201)], "settlement_day_key int, operating_day_key int")
    columns = "due_day_key int, adden_max_operating_day_key int, adden_min_settlement_day_key int, adden_max_settlement_day_key int, deposit_due_day_key int"
    schedule = spark.createDataFrame([(1, 20231231, 20231230, 20240103, 0), (2, 20231231, 20240105, 20231231, 0), (3, 20231231, None, 20240105, 0)], columns)
    assert sorted((r.report_due_day_key, r.settlement_day_key) for r in addendum(rows, schedule).collect()) == [(1, 20231231), (1, 20240102)]


def test_a_look_up_of_one_row(spark):
    one = spark.createDataFrame([("a", 1)], "n string, k int")
    assert only_row(one).collect() == [("a", 1)] and only_row(one.limit(0)).collect() == []
    with pytest.raises(Exception, match="a look-up of one row found several"):
        only_row(one.union(one)).collect()


def test_progress_tells_nothing_across_snapshots(spark):
    columns = "table_id int, run_at timestamp_ntz, row_count long, watermark_at timestamp_ntz, run_s long, lag_s long, snapshot string"
    rows = [(1, 10, 100, 0, 5, 50, "a"), (1, 20, 150, 5, 10, 40, "a"), (1, 30, 20, 1, 10, 40, "b")]
    df = spark.createDataFrame(rows, "table_id int, r int, row_count long, w int, run_s long, lag_s long, snapshot string")
    df = df.select("table_id", F.timestamp_seconds("r").cast("timestamp_ntz").alias("run_at"), "row_count", F.timestamp_seconds("w").cast("timestamp_ntz").alias("watermark_at"), "run_s", "lag_s", "snapshot")
    assert df.schema.simpleString() == spark.createDataFrame([], columns).schema.simpleString()
    first, second = quality.progress(df).orderBy("run_at").collect()
    assert (first.rows_added, first.rows_per_second, first.catchup_ratio) == (50, 5.0, 0.5)
    assert second.run_duration_s == 10 and all(second[c] is None for c in ("rows_added", "took", "advance", "rows_per_second", "catchup_ratio", "catchup_processing_s", "catchup_wall_s"))


def test_catching_up_by_rows(spark):
    rows = [(1, 1, 100, 10, 500), (1, 2, 300, 10, 400), (1, 3, 300, 10, 400), (1, 4, 300, 10, 0)]
    df = spark.createDataFrame(rows, "table_id int, run_at int, row_count long, run_s long, rows_lag long")
    assert [r.catchup_processing_s for r in quality.rows_catchup(df).orderBy("run_at").collect()] == [None, 20, None, 0]
