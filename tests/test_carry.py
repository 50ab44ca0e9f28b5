"""Running totals by carry equal a plain pass; batches by size equal the greedy loop."""

import random

import pytest
from pyspark.sql import functions as F

from quayside.functions.scratch import scratch_scope
from quayside.operators import cdc, quality
from quayside.operators.carry import running
from quayside.sources.files import exists


def plain_running(rows, before):
    """{id: (sum, max, last)} by group, in order of (t, id)."""
    out, held = {}, {}
    for g, t, i, v in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])):
        now = held.get(g, (None, None, None))
        after = now if v is None else ((now[0] or 0) + v, v if now[1] is None else max(now[1], v), v)
        out[i] = now if before else after
        held[g] = after
    return out


@pytest.mark.parametrize("before", [False, True])
def test_running(spark, before):
    rng = random.Random(5)
    rows = [(rng.choice([None, 1, 1, 1, 2, 3]), rng.randrange(9), i, rng.choice([None, 0, 3, 7, -2])) for i in range(700)]
    df = spark.createDataFrame(rows, "g int, t int, i int, v int").repartition(5)
    folds = {"s": ("sum", F.col("v")), "m": ("max", F.col("v")), "l": ("last", F.col("v"))}
    got = {r.i: (r.s, r.m, r.l) for r in running(df, ["t", "i"], folds, by=("g",), before=before).collect()}
    assert got == plain_running(rows, before)


def test_running_of_no_rows_and_of_no_groups(spark):
    df = spark.createDataFrame([(k, 1) for k in (4, 2, 9)], "k int, n int")
    fold = {"s": ("sum", F.col("n"))}
    assert {r.k: r.s for r in running(df, ["k"], fold).collect()} == {2: 1, 4: 2, 9: 3}
    assert running(df.limit(0), ["k"], fold).collect() == []


def greedy(jobs, above, target):
    out, size, batch = {}, 0, 0
    for job, n in sorted(j for j in jobs if j[0] > above):
        size += n
        out[job] = batch
        if size > target:
            size, batch = 0, batch + 1
    return out


@pytest.mark.parametrize("target", [1, 55, 10_000])
def test_batches_equal_the_greedy_loop(spark, target):
    rng = random.Random(target)
    jobs = [(j, rng.randrange(1, 40)) for j in rng.sample(range(3_000), 400)]
    df = spark.createDataFrame(jobs, "job_id long, data_count long")
    got = {r.job_id: r.batch_no for r in quality.range_batches(df, 100, target).collect()}
    assert got == greedy(jobs, 100, target)


def test_batches_where_every_job_exceeds_the_target(spark):
    df = spark.range(20_000).select(F.col("id").alias("job_id"), F.lit(100).alias("data_count"))
    got = quality.range_batches(df, -1, 60)
    assert got.filter("batch_no <> job_id").isEmpty() and got.count() == 20_000


def test_numbers_are_in_order_of_the_key(spark):
    df = spark.range(5_000).select((F.col("id") * 7 % 5_003).alias("k"))
    rows = cdc.surrogate_index(df, "k", start=10).orderBy("k").collect()
    assert [r.row_index for r in rows] == list(range(10, 5_010))


def test_a_table_of_many_files(spark):
    files = spark.range(4_000).select(F.lit(1).alias("table_id"), F.col("id").alias("file"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts"), (F.col("id") % 10 == 0).alias("is_first"))
    snapshots = files.filter("is_first").select("table_id", "ts")
    got = {r.file: r.snapshot for r in cdc.asof_snapshot(files, snapshots).select("file", F.unix_seconds(F.col("snapshot").cast("timestamp")).alias("snapshot")).collect()}
    assert got == {f: (f - 1) // 10 * 10 for f in range(1, 4_000)}


def test_a_scope_deletes_what_was_made_in_it(spark):
    df = spark.range(9).select("id")
    with scratch_scope(spark) as made:
        out = running(df, ["id"], {"s": ("sum", F.col("id"))})
        assert out.count() == 9 and made and all(exists(spark, p) for p in made)
    assert not any(exists(spark, p) for p in made)
