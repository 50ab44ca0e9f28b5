"""Datasets replaced by version: each lies in a folder of its own, and a small committed record
says which one is live. Readers have one version or the next, never none; nothing is renamed,
which on an object store would be a copy."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quayside.sources.files import child_dirs, delete, exists
from quayside.streaming.runs import commit, committed

POINTER = "version long, n_rows long"
KEEP = 2  # the live version and the one before it


def live_version(spark: SparkSession, root: str) -> int | None:
    done = committed(spark, f"{root}/pointers")
    return spark.read.schema(POINTER).parquet(f"{root}/pointers/run={done[0]}").first().version if done else None


def read_live(spark: SparkSession, root: str) -> DataFrame:
    version = live_version(spark, root)
    if version is None:
        raise ValueError(f"{root} has no live version")
    return spark.read.parquet(f"{root}/versions/version={version}")


def publish(rows: DataFrame, root: str, parts: tuple[str, ...] = ()) -> int:
    """Write ``rows`` as the next version and make it live; returns its number. Rows are
    counted while they are written: an empty version is refused and the live one stays. The
    one before it is kept as a backup, older ones go."""
    spark, seen = rows.sparkSession, Observation()
    folders = [int(n.split("=")[1]) for n in child_dirs(spark, f"{root}/versions")] if exists(spark, f"{root}/versions") else []
    version = max(folders, default=-1) + 1
    path = f"{root}/versions/version={version}"
    writer = rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("compression", "zstd")
    writer.partitionBy(*parts).parquet(path) if parts else writer.parquet(path)
    n = seen.get["n"] or 0
    if not n:
        delete(spark, path)
        raise ValueError(f"the new version of {root} is empty")
    before = live_version(spark, root)
    _point(spark, root, version, n)
    for old in folders:
        if old not in (before, version):
            delete(spark, f"{root}/versions/version={old}")
    return version


def roll_back(spark: SparkSession, root: str) -> int:
    """Make the version before the live one live again, if it is still there."""
    live = live_version(spark, root)
    older = [int(n.split("=")[1]) for n in child_dirs(spark, f"{root}/versions")] if live is not None else []
    older = [v for v in older if v < live]
    if not older:
        raise ValueError(f"{root} has no version to go back to")
    _point(spark, root, max(older), spark.read.parquet(f"{root}/versions/version={max(older)}").count())
    return max(older)


def _point(spark: SparkSession, root: str, version: int, n_rows: int) -> None:
    done = committed(spark, f"{root}/pointers")
    commit(spark, f"{root}/pointers", done[0] + 1 if done else 0, (version, n_rows), POINTER)
    for old in done[KEEP:]:
        delete(spark, f"{root}/pointers/run={old}")
