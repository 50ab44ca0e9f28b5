"""The change log as a stream of files, folded and merged batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.scratch import saved, scratch_scope
from quayside.operators.cdc import OPER, SEQ
from quayside.operators.quality import assert_cdc
from quayside.streaming.runs import commit, committed
from quayside.streaming.state_table import KEEP, batches, merge, read_current, start_table

__all__ = ["KEEP", "apply_batch", "apply_stream", "read_current", "start_table", "stream_runs"]

STREAM_RUN = "run long, batch long, landed long, redelivered long"


def apply_batch(spark: SparkSession, rows: DataFrame, root: str, keys: list[str], batch: int, key_nulls: bool = True) -> dict | None:
    """Check one batch and merge it (see ``merge``); a batch that breaks the invariants of a
    change log raises and changes nothing. Keys may be null unless ``key_nulls`` is off."""
    rows = rows.filter(F.col(OPER).isNull() | ~F.col(OPER).isin("B", "L"))  # images before a change, loads
    assert_cdc(rows, [] if key_nulls else keys)
    return merge(spark, rows, root, keys, batch)


def without_redelivered(stream: DataFrame, horizon: str) -> DataFrame:
    """Records of a stream of files that did not land before, by sequence and operation: what
    landed within ``horizon`` is remembered in the checkpoint. Time is that of landing, so a
    record is never late, however old its sequence is."""
    landed = stream.select("*", F.col("_metadata.file_modification_time").alias("__landed"))
    return landed.withWatermark("__landed", horizon).dropDuplicatesWithinWatermark([SEQ, OPER]).drop("__landed")


def apply_stream(spark: SparkSession, source: str, schema, root: str, keys: list[str], files_per_batch: int = 4, horizon: str = "30 days") -> int:
    """Apply all files landed in ``source`` since the last run, then stop; returns the
    newest committed batch. Batches come in the order in which files landed; one that is
    committed already is skipped, and a file that lands again under another name changes
    nothing, so a repeat changes nothing; records of a low sequence that land late still
    apply to keys that hold nothing newer."""
    setting, empty = "spark.sql.streaming.noDataMicroBatches.enabled", spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)

    def apply(rows: DataFrame, batch: int) -> None:
        with scratch_scope(spark):  # read once: what follows looks at the rows more than once
            apply_batch(spark, saved(rows, "landed"), root, keys, batch)

    writer = without_redelivered(stream, horizon).writeStream.foreachBatch(apply)
    spark.conf.set(setting, "false")  # old keys go with the next data
    try:
        query = writer.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    finally:
        spark.conf.set(setting, empty)
    query.awaitTermination()
    newest, progress = batches(spark, root)[0], query.recentProgress
    landed = sum(p["numInputRows"] for p in progress)
    again = sum(int(state["customMetrics"].get("numDroppedDuplicateRows", 0)) for p in progress for state in p["stateOperators"])
    done = committed(spark, f"{root}/stream")
    run = done[0] + 1 if done else 0
    commit(spark, f"{root}/stream", run, (run, newest, landed, again), STREAM_RUN)
    return newest


def stream_runs(spark: SparkSession, root: str) -> DataFrame:
    """A row a run: run, newest batch, records landed, and those left out since they had
    landed before."""
    done = committed(spark, f"{root}/stream")
    return spark.read.schema(STREAM_RUN).parquet(*(f"{root}/stream/run={n}" for n in done)) if done else spark.createDataFrame([], STREAM_RUN)
