"""The shared folder for tables that a job writes and reads again.

Who deletes them: a table made within a ``scratch_scope`` is deleted when that scope ends, so
a caller that has written its result leaves nothing. Without a scope it stays until the
folder is cleared, since a returned frame may still read it.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from quayside.sources.files import delete

#: The tables of the innermost scope; threads and other contexts have scopes of their own.
_SCOPE: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)


def scratch_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset, a local session gets a folder of its own; on
    a cluster that is an error, since no local folder is shared."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = getattr(scratch_dir, "own", None) or tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        scratch_dir.own = root
    return root.rstrip("/")


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Delete, at the end, the scratch tables made within; yields their paths."""
    made: list[str] = []
    token = _SCOPE.set(made)
    try:
        yield made
    finally:
        _SCOPE.reset(token)
        for path in made:
            delete(spark, path)


def saved(df: DataFrame, name: str, scope: list[str] | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back: its plan ends there. It
    belongs to ``scope``, or else to the innermost one."""
    path = f"{scratch_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    owner = _SCOPE.get() if scope is None else scope
    if owner is not None:
        owner.append(path)
    df.write.option("compression", "zstd").parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._scratch_path = path
    return table
