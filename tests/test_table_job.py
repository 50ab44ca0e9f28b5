"""The job of one table: positions, crashes between commits, checks, status rows."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quayside.operators import cdc, quality
from quayside.streaming import runs, state_table, table_job

SCHEMA = "snapshot string, k int, amount long, day date, change_seq string, change_oper string, change_ts timestamp_ntz"
DAY, LATER = datetime(2024, 1, 5).date(), datetime(2024, 2, 5).date()
NOW = datetime(2024, 3, 1)


def seq(n):
    return f"20240201{n:06d}" + "0" * 6


def history(spark, changes, snapshot="s1", loads=(1, 2, 3)):
    rows = [(snapshot, k, 0, DAY, None, "L", NOW) for k in loads]
    return spark.createDataFrame(rows + [(snapshot, k, a, d, s, o, NOW) for k, a, d, s, o in changes], SCHEMA)


CHANGES = [(1, 5, None, seq(1), "U"), (2, None, None, seq(2), "D"), (4, 7, DAY, seq(3), "I"), (9, 1, None, seq(4), "U"), (3, 8, LATER, seq(5), "U")]
WANT = {1: (5, 1), 3: (8, 2), 4: (7, 1)}


def run(spark, rows, root, **options):
    return table_job.run_once(spark, rows, root, "t", ["k"], date="day", now=NOW, **options)


def held(spark, root):
    return {r.k: (r.amount, r.part_month) for r in state_table.read_current(spark, root).collect()}


def test_runs_catch_up_by_the_budget(spark, tmp_path):
    root, rows = str(tmp_path), history(spark, CHANGES)
    seen = [run(spark, rows, root, budget=3) for _ in range(3)]
    assert [(s.records, s.next_run_s, s.rebuilt, s.watermark) for s in seen] == [(3, 30, True, seq(3)), (2, 14400, False, seq(5)), (0, 43200, False, seq(5))]
    assert held(spark, root) == WANT and seen[1].moved == 1 and seen[1].row_count == 3 and (seen[0].inserted, seen[0].dropped, seen[0].updated) == (1, 1, 1)
    assert seen[0].lag_s == 2 and seen[2].lag_s == 0
    history_rows = table_job.status_history(spark, root)
    assert history_rows.count() == 3 and [r.row_count for r in history_rows.orderBy("run").collect()] == [3, 3, 3]


def test_a_batch_that_changes_nothing_moves_the_position(spark, tmp_path):
    root = str(tmp_path)
    run(spark, history(spark, [(9, 1, None, seq(1), "U")]), root)
    assert runs.read_position(spark, root) == ("s1", seq(1)) and held(spark, root) == {1: (0, 1), 2: (0, 1), 3: (0, 1)}


def test_a_crash_between_data_and_position(spark, tmp_path, monkeypatch):
    root, rows = str(tmp_path), history(spark, CHANGES)
    run(spark, history(spark, []), root)
    with monkeypatch.context() as broken:
        broken.setattr(runs, "commit_position", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run(spark, rows, root)
    assert held(spark, root) == WANT and runs.read_position(spark, root).watermark == runs.START
    assert run(spark, rows, root).watermark == seq(5) and held(spark, root) == WANT


def test_a_newer_snapshot_is_loaded_whole(spark, tmp_path):
    root, rows = str(tmp_path), history(spark, CHANGES)
    run(spark, rows, root)
    status = run(spark, rows.union(history(spark, [], "s2", loads=(7, 8))), root)
    assert status.rebuilt and status.snapshot == "s2" and set(held(spark, root)) == {7, 8} and runs.read_position(spark, root) == ("s2", runs.START)


def test_broken_loads_and_batches_raise_and_leave_the_position(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(ValueError, match="can't be loaded"):
        run(spark, history(spark, CHANGES, loads=()), root)
    undated = history(spark, []).withColumn("day", F.lit(None).cast("date"))
    with pytest.raises(ValueError, match="3 of them without a date"):
        run(spark, undated, root)
    run(spark, history(spark, []), root)
    with pytest.raises(ValueError, match="null_seq 1"):
        run(spark, history(spark, [(1, 1, None, None, "U")]), root)
    with pytest.raises(ValueError, match="null_key 1"):
        run(spark, history(spark, [(None, 1, None, seq(1), "U")]), root)
    moving = [(1, 1, DAY, seq(1), "U"), (1, 1, LATER, seq(2), "U")]
    with pytest.raises(ValueError, match="more than one day"):
        run(spark, history(spark, moving), root, fixed=True)
    assert runs.read_position(spark, root).watermark == runs.START


def test_health_is_judged_by_two_measured_versions(spark, tmp_path):
    root = str(tmp_path)
    run(spark, history(spark, []), root)
    gone = [(k, None, None, seq(k), "D") for k in (1, 3)]
    run(spark, history(spark, gone), root)
    newest, before = state_table.batches(spark, root)[:2]
    named = lambda batch: state_table.measure(spark, root, batch).withColumn("table_id", F.lit("t"))
    issues = quality.table_health(named(before), named(newest)).first().issues
    assert {"max_id_fell", "min_id_rose", "rows_fell"} <= set(issues.split(","))


@pytest.mark.parametrize("size", [1, 7, 40, 99, 100, 5000])
def test_end_of_a_large_batch_is_found_without_holding_it(spark, monkeypatch, size):
    rows = [(None if k < 3 else f"{(k * 37) % 50:05d}", "IUDB"[k % 4]) for k in range(133)]
    log = spark.createDataFrame(rows, "change_seq string, change_oper string").repartition(5)
    want = cdc.batch_ceiling(log, "00004", size).first()
    monkeypatch.setattr(cdc, "SORTED_BATCH", 0)
    found = cdc.batch_ceiling(log, "00004", size)
    assert found.first() == want and "TakeOrdered" not in found._jdf.queryExecution().executedPlan().toString()
