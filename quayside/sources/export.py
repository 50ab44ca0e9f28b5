"""Incremental export in batches, under commits that say what is there.

A run writes its rows in batches of an order, each a folder, and then one commit: which runs
are live, and the watermark to go on from. A full refresh makes its own run the only live
one, others add to it. Nothing counts before its commit, so a run that fails leaves the export
as it was, and its repeat writes the same run again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from quayside.operators.carry import running
from quayside.sources.feeds import incremental_export
from quayside.sources.files import child_dirs, delete, exists
from quayside.streaming.runs import committed

BATCH_ROWS = 500_000


def last_commit(spark: SparkSession, to: str) -> Row | None:
    """The newest commit of an export: run, base (the first live run), watermark, n_rows, n_batches."""
    done = committed(spark, f"{to}/commits")
    return spark.read.parquet(f"{to}/commits/run={done[0]}").first() if done else None


def read_export(spark: SparkSession, to: str) -> DataFrame:
    """All rows of the live runs, with their run and batch."""
    last = last_commit(spark, to)
    if last is None:
        raise ValueError(f"{to} holds no committed export")
    live = [n for n in range(last.base, last.run + 1) if exists(spark, f"{to}/runs/run={n}")]
    return spark.read.option("basePath", f"{to}/runs").parquet(*(f"{to}/runs/run={n}" for n in live))


def export_run(df: DataFrame, to: str, index: str, casts: dict[str, str], private: tuple[str, ...] = (), full: bool = False, batch_rows: int = BATCH_ROWS) -> Row | None:
    """Export the rows of ``df`` above the committed watermark of ``index`` (all of them on a
    ``full`` refresh, or the first time), cast without failing and without private columns, in
    batches of ``batch_rows`` in order of the index; returns the commit, or None if there was
    nothing new. The watermark is seen while the rows are written."""
    spark, last = df.sparkSession, last_commit(df.sparkSession, to)
    full = full or last is None
    run = 0 if last is None else last.run + 1
    rows = incremental_export(df, index, None if full else last.watermark, casts, tuple(c for c in private if c != index))
    numbered = running(rows, [index], {"__n": ("sum", F.lit(1))})
    seen = Observation()
    numbered = numbered.observe(seen, F.count(F.lit(1)).alias("n_rows"), F.max(index).alias("watermark"))
    batch = F.floor((F.col("__n") - 1) / batch_rows).cast("int")
    numbered.withColumn("batch", batch).drop("__n").write.mode("overwrite").partitionBy("batch").option("compression", "zstd").parquet(f"{to}/runs/run={run}")
    n_rows = seen.get["n_rows"] or 0
    if not n_rows:
        delete(spark, f"{to}/runs/run={run}")
        return None
    base, watermark = run if full else last.base, seen.get["watermark"]
    if watermark is None:  # only nulls: the next run starts over
        watermark = None if last is None else last.watermark
    kind = rows.schema[index].dataType.simpleString()
    commit = spark.createDataFrame([(run, base, watermark, n_rows, -(-n_rows // batch_rows))], f"run long, base long, watermark {kind}, n_rows long, n_batches long")
    commit.coalesce(1).write.mode("overwrite").parquet(f"{to}/commits/run={run}")
    if full:
        for name in child_dirs(spark, f"{to}/runs"):
            if int(name.split("=")[1]) < base:
                delete(spark, f"{to}/runs/{name}")
    return commit.first()
