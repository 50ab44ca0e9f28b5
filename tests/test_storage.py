"""Exports that fail and repeat, partitions reclustered in place, footers and first lines."""

import gzip
import math
import random

import pytest
from pyspark.sql import functions as F

from quayside.operators import layout, versions
from quayside.sources import export, feeds, footers
from quayside.sources.files import exists, list_uris

CASTS = {"n": "int"}


def orders(spark, keys):
    return spark.createDataFrame([(k, str(k) if k % 3 else "x", "secret") for k in keys], "k long, n string, p string")


def exported(spark, to):
    return sorted((r.k, r.n, r.run, r.batch) for r in export.read_export(spark, to).collect())


def test_export_in_batches_from_the_watermark(spark, tmp_path):
    to = str(tmp_path)
    first = export.export_run(orders(spark, range(7)), to, "k", CASTS, ("p",), batch_rows=3)
    assert (first.run, first.watermark, first.n_rows, first.n_batches) == (0, 6, 7, 3)
    assert export.export_run(orders(spark, range(7)), to, "k", CASTS, ("p",)) is None
    export.export_run(orders(spark, range(10)), to, "k", CASTS, ("p",), batch_rows=2)
    want = [(k, k if k % 3 else None, 0, k // 3) for k in range(7)] + [(k, k if k % 3 else None, 1, (k - 7) // 2) for k in (7, 8, 9)]
    assert exported(spark, to) == sorted(want) and "p" not in export.read_export(spark, to).columns
    export.export_run(orders(spark, (1, 50)), to, "k", CASTS, ("p",), full=True)
    assert exported(spark, to) == [(1, 1, 2, 0), (50, 50, 2, 0)] and not exists(spark, f"{to}/runs/run=0")
    assert export.last_commit(spark, to).watermark == 50


def test_an_export_that_fails_before_its_commit_changes_nothing(spark, tmp_path):
    to = str(tmp_path)
    export.export_run(orders(spark, range(5)), to, "k", CASTS)
    before = exported(spark, to)
    orders(spark, range(5, 9)).withColumn("batch", F.lit(0)).write.parquet(f"{to}/runs/run=1")  # rows written, no commit
    assert exported(spark, to) == before
    assert export.export_run(orders(spark, range(9)), to, "k", CASTS).n_rows == 4
    assert [r[0] for r in exported(spark, to)] == list(range(9))


def test_partitions_that_overlap_are_rewritten_and_others_keep_their_files(spark, tmp_path):
    path = str(tmp_path / "t")
    for k in range(6):
        rows = [("mixed", 6 * j + k) for j in range(50)] + [("sorted", 50 * k + j) for j in range(50)]
        spark.createDataFrame(rows, "part string, id long").coalesce(1).write.mode("append").partitionBy("part").parquet(path)
    before = set(list_uris(spark, path))
    rows = {r.part: (r.n_files, r.overlap, r.recluster, r.n_files_after, r.overlap_after) for r in layout.recluster_units(spark, path, "id", ("part",)).collect()}
    assert rows == {"mixed": (6, 5, True, 1, 0), "sorted": (6, 0, False, 6, 0)}
    after = set(list_uris(spark, path))
    assert {f for f in before if "part=sorted" in f} <= after and not {f for f in before if "part=mixed" in f} & after
    assert spark.read.parquet(path).groupBy("part").agg(F.sum("id").alias("s"), F.count("id").alias("n")).select("s", "n").distinct().collect() == [(sum(range(300)), 300)]


def test_extremes_from_footers_read_only_files_that_do_not_tell(spark, tmp_path):
    path, kind = str(tmp_path / "t"), "k string, v int"
    spark.createDataFrame([("b", 1), ("d", None)], kind).coalesce(1).write.mode("append").parquet(path)
    spark.createDataFrame([("c", 5), (None, 7)], kind).coalesce(1).write.mode("append").parquet(path)
    spark.createDataFrame([("e" * 90, 3)], kind).coalesce(1).write.mode("append").parquet(path)
    told = footers.footer_statistics(spark, list_uris(spark, path), "k", spark.read.parquet(path).schema["k"].dataType)
    assert sorted((r.low or "", r.high or "", r.known, r.n_rows, r.nulls) for r in told.collect()) == [("", "", False, 1, 0), ("b", "d", True, 2, 0), ("c", "c", True, 2, 1)]
    assert layout.stats_min_max(spark, path, "k").first() == ("b", "e" * 90) and layout.stats_min_max(spark, path, "v").first() == (1, 7)
    nothing = str(tmp_path / "nulls")
    spark.createDataFrame([(None, None)], kind).write.parquet(nothing)
    assert layout.stats_min_max(spark, nothing, "k").first() == (None, None)


def test_extremes_of_several_columns_open_each_file_once(spark, tmp_path):
    path, kind = str(tmp_path / "t"), "k string, v int, x double, p int"
    for rows in ([("b" * 70, 1, 1.5, 1), (None, 9, float("nan"), 2)], [(None, None, None, 1)], [("c" * 70 + "é", -4, -2.0, 2)]):
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").partitionBy("p").parquet(path)
    told = footers.column_extremes(spark, list_uris(spark, path), {c: spark.read.parquet(path).schema[c].dataType for c in ("k", "v")}).collect()
    assert not any(r.unknown for r in told) and max(r.high_0 or "" for r in told) == "c" * 70 + "é"
    k, v, x, p = (df.first() for df in layout.columns_min_max(spark, path, ["k", "v", "x", "p"]))
    assert k == ("b" * 70, "c" * 70 + "é") and v == (-4, 9) and p == ("1", "2") and x.low == -2.0 and math.isnan(x.high)


def test_rows_of_a_partition_are_not_gathered_to_meet_its_size(spark):
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        dealt = feeds.dealt_to_files(spark.range(4000).selectExpr("id", "id % 2 as part"), ("part",), 100)
        plan = dealt._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(setting, before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert dealt.count() == 4000


def test_first_lines_need_the_first_bytes_only(spark, tmp_path):
    rng = random.Random(1)
    body = "\n".join(f"{rng.random()},{rng.random()}" for _ in range(20_000))
    (tmp_path / "a.csv").write_text("A,B\r\n" + body)
    with gzip.open(tmp_path / "b.csv.gz", "wt") as file:
        file.write("a,c\n" + body)
    (tmp_path / "e.csv").write_text("")
    files = [f"file://{tmp_path}/{n}" for n in ("a.csv", "b.csv.gz", "e.csv")]
    assert [r.head for r in footers.first_lines(spark, files, most=4096).orderBy("file").collect()] == ["A,B", "a,c", None]
    (tmp_path / "long.csv").write_text("x" * 5000 + "\n1")
    with pytest.raises(Exception, match="no line ends in the first 4096 bytes"):
        footers.first_lines(spark, [f"file://{tmp_path}/long.csv"], most=4096).collect()


def test_change_files_of_several_versions(spark, tmp_path):
    (tmp_path / "a.csv").write_text("K,CHANGE_TS\n1,2024-01-02 00:00:00\n")
    with gzip.open(tmp_path / "b.csv.gz", "wt") as file:
        file.write("k,change_ts,v\n2,2024-02-02 00:00:00,9\n")
    rows = feeds.cdc_csv_load(spark, [f"file://{tmp_path}/a.csv", f"file://{tmp_path}/b.csv.gz"], {"k": "int", "change_ts": "timestamp_ntz", "v": "int"})
    assert sorted((r.k, r.v, r.part_month) for r in rows.collect()) == [(1, None, 1), (2, 9, 2)]


def test_columns_go_from_the_files_that_have_them(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a", 2)], "k int, secret string, v int").coalesce(1).write.mode("append").parquet(f"{path}/p=1")
    spark.createDataFrame([(2, 5)], "k int, v int").coalesce(1).write.mode("append").parquet(f"{path}/p=2")
    kept = next(f for f in list_uris(spark, path) if "p=2" in f)
    when = (tmp_path / "t" / "p=2" / kept.rsplit("/", 1)[1]).stat().st_mtime_ns
    done = {("p=1" in r.file): (r.rewritten, r.n_rows) for r in layout.drop_columns_in_place(spark, path, ["secret", "none"]).collect()}
    assert done == {True: (True, 1), False: (False, 1)}
    assert (tmp_path / "t" / "p=2" / kept.rsplit("/", 1)[1]).stat().st_mtime_ns == when
    rows = spark.read.option("mergeSchema", True).parquet(path)
    assert sorted(rows.columns) == ["k", "p", "v"] and sorted((r.k, r.v, r.p) for r in rows.collect()) == [(1, 2, 1), (2, 5, 2)]
    assert not any(r.rewritten for r in layout.drop_columns_in_place(spark, path, ["secret"]).collect())
    with pytest.raises(ValueError, match="path partition"):
        layout.drop_columns_in_place(spark, path, ["p"])


def test_versions_are_swapped_by_a_pointer(spark, tmp_path):
    root = str(tmp_path)
    assert [versions.publish(spark.range(n), root) for n in (3, 4, 5)] == [0, 1, 2]
    assert versions.read_live(spark, root).count() == 5 and not exists(spark, f"{root}/versions/version=0")
    with pytest.raises(ValueError, match="is empty"):
        versions.publish(spark.range(0), root)
    assert versions.read_live(spark, root).count() == 5
    assert versions.roll_back(spark, root) == 1 and versions.read_live(spark, root).count() == 4
    with pytest.raises(ValueError, match="no version to go back to"):
        versions.roll_back(spark, root)


def test_a_partition_is_written_by_one_task_without_a_sort(spark, tmp_path):
    setting, before = "spark.sql.maxConcurrentOutputFileWriters", spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    rows = spark.range(1000).withColumn("part", F.col("id") % 7).coalesce(1)
    with feeds.unsorted_writes(spark):
        assert spark.conf.get(setting) == "16"
        rows.write.partitionBy("part").parquet(f"{tmp_path}/t")
    assert spark.conf.get(setting) == before
    assert len(list_uris(spark, f"{tmp_path}/t")) == 7 and spark.read.parquet(f"{tmp_path}/t").count() == 1000


def test_size_of_a_dataset_is_told_by_its_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5000).selectExpr("id", "id % 2 as part").repartition("part").write.partitionBy("part").parquet(path)
    n_bytes = sum(f.stat().st_size for f in (tmp_path / "t").rglob("*.parquet"))
    size = layout.size_profile(spark, path).first()
    assert (size.n_rows, size.n_files, size.n_bytes, size.rows_per_mb) == (5000, 2, n_bytes, max(1000, 5000 * 1048576 // n_bytes))
