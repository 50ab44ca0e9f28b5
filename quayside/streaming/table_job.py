"""One run of a table's job: build or catch up, commit the position, write a status row.

A new snapshot is loaded whole; else the next change records after the committed position are
checked and merged. The data are committed first, then the position, then the status: after a
crash in between, the next run merges the same records again, which changes nothing, since a
row passes over what it holds already and a delete of nothing is nothing.
"""

from __future__ import annotations

import time
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from quayside.functions.scratch import saved, scratch_scope
from quayside.operators.cdc import OPER, SEQ, batch_ceiling, silver_rebuild
from quayside.operators.quality import assert_cdc, assert_load, assert_stable, seq_to_timestamp
from quayside.streaming import runs, state_table

#: Seconds to the next run: records are waiting; caught up; nothing came.
SOON, USUAL, LONG = 30, 4 * 3600, 12 * 3600
STATUS = (
    "table_id string, run long, run_at timestamp_ntz, snapshot string, rebuilt boolean, row_count long, n_files long, n_bytes long, watermark string, watermark_at timestamp_ntz, upstream_max string, "
    "lag_s long, clock_lag_s long, budget_full boolean, records long, inserted long, dropped long, updated long, moved long, rewritten_files long, run_s double, next_run_s long"
)


def next_run(records: int, budget: int) -> int:
    """Seconds to the next run: at once if the budget was used up, long if nothing came."""
    return SOON if records >= budget else USUAL if records else LONG


def changes_of(history: DataFrame, snapshot: str, date: str | None) -> DataFrame:
    """The snapshot's change records, with year and month if the table is dated; null where
    a record has no date, so that the row keeps those it has."""
    rows = history.filter((F.col("snapshot") == snapshot) & F.col(OPER).isin("I", "U", "D")).drop("snapshot")
    return rows.withColumns({"part_year": F.year(date), "part_month": F.month(date)}) if date else rows


def catch_up(spark: SparkSession, changes: DataFrame, root: str, table: str, keys: list[str], snapshot: str, watermark: str, budget: int, date: str | None, fixed: bool) -> tuple[str, int, dict]:
    """Merge the next ``budget`` records after the watermark, ties at their end included, and
    commit the position; returns it, the number of records and what the merge saw."""
    ahead = batch_ceiling(changes, watermark, budget).first()
    if not ahead["n"]:
        return watermark, 0, {}
    assert_cdc(changes.filter(F.col(SEQ).isNull()), [], required=tuple(keys))  # a null sequence sorts first and stops the run
    with scratch_scope(spark):
        rows = saved(changes.filter((F.col(SEQ) > watermark) & (F.col(SEQ) <= ahead["ceiling"])), "changes")
        assert_cdc(rows, keys)
        if fixed and date:
            assert_stable(rows.filter(F.col(date).isNotNull()), keys, date)
        done = state_table.batches(spark, root)
        seen = state_table.merge(spark, rows, root, keys, done[0] + 1) or {}
    runs.commit_position(spark, root, table, snapshot, ahead["ceiling"])
    return ahead["ceiling"], ahead["n"], seen


def run_once(spark: SparkSession, history: DataFrame, root: str, table: str, keys: list[str], budget: int = 1_000_000, date: str | None = None, fixed: bool = False, now: datetime | None = None) -> Row:
    """One run over ``history`` (columns of the table, snapshot, change_seq, change_oper,
    change_ts); returns its status row, which is appended to ``root``/status. ``date`` names
    the column by whose year and month the table is kept; with ``fixed``, keys whose date
    changes within a batch raise, otherwise their rows move."""
    began = time.monotonic()
    now = now or datetime.now(timezone.utc).replace(tzinfo=None)
    snapshot = history.agg(F.max("snapshot")).first()[0]
    if snapshot is None:
        raise ValueError(f"{table} has no snapshot")
    at = runs.read_position(spark, root)
    rebuilt, watermark, seen = snapshot != at.snapshot, at.watermark, {}
    if rebuilt:
        of_snapshot = history.filter(F.col("snapshot") == snapshot)
        assert_load(of_snapshot, date)
        done = state_table.batches(spark, root)
        rows = silver_rebuild(of_snapshot, snapshot, date).drop("load_snapshot")
        state_table.start_table(rows, root, keys[0], batch=done[0] + 1 if done else state_table.FULL_LOAD)
        watermark = runs.START
        runs.commit_position(spark, root, table, snapshot, watermark)
    changes = changes_of(history, snapshot, date)
    watermark, records, seen = catch_up(spark, changes, root, table, keys, snapshot, watermark, budget, date, fixed)
    return _status(spark, root, table, now, began, snapshot, rebuilt, watermark, changes, records, budget, seen)


def _status(spark, root: str, table: str, now: datetime, began: float, snapshot: str, rebuilt: bool, watermark: str, changes: DataFrame, records: int, budget: int, seen: dict) -> Row:
    path = f"{root}/status"
    done = runs.committed(spark, path)
    run = done[0] + 1 if done else 0
    size = state_table.measure(spark, root).first()
    upstream = changes.agg(F.max(SEQ)).first()[0]
    times = spark.createDataFrame([(watermark, upstream)], "w string, u string").select(seq_to_timestamp(F.col("w")).cast("timestamp_ntz").alias("w"), seq_to_timestamp(F.col("u")).cast("timestamp_ntz").alias("u")).first()
    lag = lambda newer, older: None if newer is None or older is None else int((newer - older).total_seconds())
    moves = [seen.get(c, 0) for c in ("inserted", "dropped", "updated", "moved", "rewritten_files")]
    row = (
        table, run, now, snapshot, rebuilt, size.n_rows, size.n_files, size.n_bytes, watermark, times.w, upstream,
        lag(times.u, times.w), lag(now, times.w), records >= budget, records, *moves, time.monotonic() - began, next_run(records, budget),
    )
    runs.commit(spark, path, run, row, STATUS)
    return spark.read.schema(STATUS).parquet(f"{path}/run={run}").first()


def status_history(spark: SparkSession, *roots: str) -> DataFrame:
    """The status rows that the runs of some tables wrote."""
    paths = [f"{root}/status/run={n}" for root in roots for n in runs.committed(spark, f"{root}/status")]
    return spark.read.schema(STATUS).parquet(*paths) if paths else spark.createDataFrame([], STATUS)
