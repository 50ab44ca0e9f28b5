"""What the corpus operators share: session settings, shared scratch tables, input shaping."""

from __future__ import annotations

import glob
import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.scratch import saved, scratch_dir, scratch_scope
from quayside.sources.files import delete

__all__ = ["documents", "drop_scratch", "hot_join", "id_text", "materialize", "prepare", "scratch_dir", "scratch_scope", "ship"]

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
PACKAGE = "quayside"


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application: a worker on another
    machine has no checkout of ours. Every operator does so before it uses them."""
    context = spark.sparkContext
    if getattr(ship, "done", None) == context.applicationId:
        return
    path = f"{tempfile.mkdtemp(prefix='spark-')}/{PACKAGE}.zip"
    with zipfile.ZipFile(path, "w") as file:
        for name in sorted(glob.glob(f"{ROOT}/{PACKAGE}/**/*.py", recursive=True)):
            file.write(name, os.path.relpath(name, ROOT))
    context.addPyFile(path)
    ship.done = context.applicationId


def prepare(spark: SparkSession) -> None:
    """Settings of a session for texts that vary from nothing to megabytes: small Arrow
    batches, and shuffle files dropped when their query ends; they stay set. Operators are
    right without them; queries and pipelines set them."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8388608")
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    ship(spark)


def materialize(df: DataFrame, name: str, scope: list[str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage ends here. The table
    belongs to ``scope`` or the innermost ``scratch_scope`` and goes with it; without one it
    stays, since a frame that an operator returns may still read it."""
    ship(df.sparkSession)
    return saved(df, name, scope)


def drop_scratch(*tables: DataFrame) -> None:
    """Delete scratch tables (results of ``materialize``) that nothing will read again."""
    for table in tables:
        delete(table.sparkSession, table._scratch_path)


#: A key of more than one in HOT_SHARE rows is joined by broadcast: there are fewer such keys.
HOT_SHARE = 4096


def hot_join(left: DataFrame, right: DataFrame, keys: list[str], rows: str, total: int | None = None) -> DataFrame:
    """Inner join to ``right``, which holds each key once and, as ``rows``, how many rows
    of ``left`` (or of a table that ``left`` is part of) have it; that column is dropped.

    Keys of more than a ``HOT_SHARE``-th of all these rows are fewer than ``HOT_SHARE``
    at any size, so they are broadcast and their rows stay where they are; only the
    others are dealt by key. Null keys match nothing. ``right`` is read three times (twice
    if ``total``, the sum of ``rows``, is known) and ``left`` twice: pass tables, not long
    plans.
    """
    total = right.agg(F.sum(rows)).first()[0] or 0 if total is None else total
    hot = F.broadcast(right.filter(F.col(rows) * HOT_SHARE > total).drop(rows))
    cold = right.filter(F.col(rows) * HOT_SHARE <= total).drop(rows)
    rest = left.join(hot, keys, "left_anti").join(cold.hint("merge"), keys)
    return left.join(hot, keys).unionByName(rest)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only what the operators read: a long id and the text, null as empty."""
    ship(df.sparkSession)
    return df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
