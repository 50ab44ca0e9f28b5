"""Small committed records of a job's runs: positions and status rows.

Each run adds a folder of one row, whole or not there at all; the newest whole one counts, and
no run changes an earlier one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession

from quayside.sources.files import child_dirs, delete, exists

POSITION = "table_id string, snapshot string, watermark string, run long"
START = "0"  # below every change sequence, which are padded numbers
KEEP = 50  # positions that stay


def committed(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the whole records below ``path``, newest first."""
    if not exists(spark, path):
        return []
    names = [n for n in child_dirs(spark, path) if exists(spark, f"{path}/{n}/_SUCCESS")]
    return sorted((int(n.split("=")[1]) for n in names), reverse=True)


def commit(spark: SparkSession, path: str, run: int, row: tuple, schema: str) -> None:
    spark.createDataFrame([row], schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/run={run}")


def commit_position(spark: SparkSession, root: str, table: str, snapshot: str, watermark: str) -> int:
    """Record where a table is, after its data are committed: also of a batch that changed
    nothing, or it would be read for ever. Kept apart from the rows, since the newest of them
    may be deleted."""
    path = f"{root}/positions"
    done = committed(spark, path)
    run = done[0] + 1 if done else 0
    commit(spark, path, run, (table, snapshot, watermark, run), POSITION)
    for old in done[KEEP:]:
        delete(spark, f"{path}/run={old}")
    return run


def positions(spark: SparkSession, root: str) -> DataFrame:
    """The table's committed positions, as far as kept: table_id, snapshot, watermark, run."""
    done = committed(spark, f"{root}/positions")
    return spark.read.schema(POSITION).parquet(*(f"{root}/positions/run={n}" for n in done)) if done else spark.createDataFrame([], POSITION)


def read_position(spark: SparkSession, root: str) -> Row:
    """The newest committed position; of a table that has none, ("", START), so that it is
    built anew."""
    done = committed(spark, f"{root}/positions")
    if not done:
        return Row(snapshot="", watermark=START)
    row = spark.read.schema(POSITION).parquet(f"{root}/positions/run={done[0]}").first()
    return Row(snapshot=row.snapshot, watermark=row.watermark)
