"""The stream of change files: files that hold none of a batch's keys stay as they are."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quayside.plans import stream_queries
from quayside.sources.files import list_files
from quayside.streaming import cdc_stream, state_table

SCHEMA = "txn_id int, change_seq string, change_oper string, amount long, part_year int, part_month int"
TABLE = "txn_id int, amount long, change_seq string, part_year int, part_month int"


def started(spark, root, months=(1, 2, 3)):
    cdc_stream.start_table(spark.createDataFrame([(10 * m + k, 0, None, 2024, m) for m in months for k in range(3)], TABLE), root)


def land(spark, root, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/landed")
    return cdc_stream.apply_stream(spark, f"{root}/landed", spark.createDataFrame([], SCHEMA).schema, root, ["txn_id"], files_per_batch=1)


def places(spark, root):
    """The files of each month."""
    found = {}
    for (f,) in state_table.manifest(spark, root).select("file").collect():
        part = tuple(int(x) for x in re.search(r"__part_year=(\d+)/__part_month=(\d+)/", f).groups())
        found.setdefault(part, set()).add(f)
    return dict(sorted(found.items()))


def held(spark, root):
    return {r.txn_id: r.amount for r in cdc_stream.read_current(spark, root).collect()}


def test_only_touched_parts_are_rewritten(spark, tmp_path):
    root = str(tmp_path)
    started(spark, root)
    before, files = places(spark, root), set(list_files(spark, f"{root}/data"))
    land(spark, root, [(20, "0001", "U", 7, 2024, 2), (21, "0002", "D", None, 2024, 2), (99, "0003", "I", 5, 2024, 4)])
    after = places(spark, root)
    assert [p for p in before if after[p] == before[p]] == [(2024, 1), (2024, 3)] and (2024, 4) in after
    assert {f for f in files if "month=2" not in f} <= set(list_files(spark, f"{root}/data"))
    assert held(spark, root) == {10: 0, 11: 0, 12: 0, 20: 7, 22: 0, 30: 0, 31: 0, 32: 0, 99: 5}


def test_a_row_of_unknown_part_touches_the_files_of_its_key(spark, tmp_path):
    root = str(tmp_path)
    started(spark, root)
    before = places(spark, root)
    land(spark, root, [(30, "0001", "U", 8, None, None)])
    after = places(spark, root)
    assert held(spark, root)[30] == 8 and [p for p in before if after[p] == before[p]] == [(2024, 1), (2024, 2)]


@pytest.mark.parametrize("oper", ["I", "U"])
def test_a_key_that_changes_its_month_is_moved(spark, tmp_path, oper):
    root = str(tmp_path)
    started(spark, root)
    land(spark, root, [(10, "0001", oper, 8, 2024, 3)])
    rows = cdc_stream.read_current(spark, root).filter("txn_id = 10").collect()
    assert [(r.amount, r.part_month) for r in rows] == [(8, 3)]
    assert {r.txn_id for r in cdc_stream.read_current(spark, root, months=[(2024, 3)]).collect()} == {10, 30, 31, 32}


def test_a_batch_of_one_key_rewrites_the_files_of_its_range(spark, tmp_path):
    root, spread = str(tmp_path), "txn_id int, amount long, change_seq string"
    rows = spark.createDataFrame([(k, 0, None) for k in range(1_000)], spread).repartition(1)
    state_table.start_table(rows, root, rows_per_file=10)
    before = {r.file for r in state_table.manifest(spark, root).collect()}
    assert len(before) == 100
    log = spark.createDataFrame([(555, "0001", "U", 9)], "txn_id int, change_seq string, change_oper string, amount long")
    seen = cdc_stream.apply_batch(spark, log, root, ["txn_id"], 0)
    after = {r.file for r in state_table.manifest(spark, root).collect()}
    assert seen["rewritten_files"] == 1 and len(before - after) == 1 and seen["initial"] == 10 and seen["updated"] == 1
    assert state_table.read_current(spark, root).filter("amount = 9").count() == 1 and state_table.measure(spark, root).first().n_rows == 1_000


def test_a_file_that_lands_again_changes_nothing_and_is_counted(spark, tmp_path):
    root = str(tmp_path)
    started(spark, root, months=(1,))
    log = [(50, "0001", "I", 5, 2024, 1), (10, "0002", "U", 6, 2024, 1), (50, "0003", "D", None, 2024, 1)]
    land(spark, root, log)
    before = held(spark, root)
    land(spark, root, log[:2])  # without the delete: the key would come back
    assert held(spark, root) == before == {10: 6, 11: 0, 12: 0}
    assert [(r.landed, r.redelivered) for r in cdc_stream.stream_runs(spark, root).orderBy("run").collect()] == [(3, 0), (2, 2)]


def test_broken_records_raise_and_change_nothing(spark, tmp_path):
    root = str(tmp_path)
    started(spark, root, months=(1,))
    for row in ((10, None, "U", 1, 2024, 1), (10, "0001", "X", 1, 2024, 1)):
        with pytest.raises(ValueError, match="broken change records"):
            cdc_stream.apply_batch(spark, spark.createDataFrame([row], SCHEMA), root, ["txn_id"], 0)
    assert state_table.batches(spark, root) == [state_table.FULL_LOAD]


def test_keys_that_move_equal_one_event_at_a_time(spark, tmp_path):
    """Random logs over keys, a null one too, whose months change, in batches of any cut."""
    rng, want, log = random.Random(8), {}, []
    keys = [None, *range(1, 12)]
    start = [(k, 0, None, 2024, rng.randrange(1, 4)) for k in keys[::2]]
    want = {r[0]: (r[1], r[4]) for r in start}
    for n in range(90):
        key, oper = rng.choice(keys), rng.choice("IUUD")
        amount, month = (None if oper == "D" else rng.choice([None, n])), (None if oper != "I" and rng.random() < 0.5 else rng.randrange(1, 5))
        log.append((key, f"{n:04d}", oper, amount, None if month is None else 2024, month))
        if oper == "D":
            want.pop(key, None)
        elif oper == "I":
            want[key] = (amount, month)
        elif key in want:
            want[key] = (want[key][0] if amount is None else amount, want[key][1] if month is None else month)
    root = str(tmp_path)
    state_table.start_table(spark.createDataFrame(start, TABLE), root)
    for n, (lo, hi) in enumerate(((0, 7), (7, 40), (40, 41), (41, 90))):
        cdc_stream.apply_batch(spark, spark.createDataFrame(log[lo:hi], SCHEMA), root, ["txn_id"], n)
    rows = cdc_stream.read_current(spark, root).collect()
    assert len(rows) == len(want) and {r.txn_id: (r.amount, r.part_month) for r in rows} == want


def test_late_records_apply_unless_the_key_holds_newer_ones(spark, tmp_path):
    root = str(tmp_path)
    started(spark, root)
    land(spark, root, [(10, "0009", "U", 9, 2024, 1)])
    land(spark, root, [(10, "0005", "U", 5, 2024, 1), (11, "0004", "U", 4, 2024, 1)])
    assert held(spark, root)[10] == 9 and held(spark, root)[11] == 4


def test_repeats_change_nothing_and_old_folders_go(spark, tmp_path):
    root = str(tmp_path)
    started(spark, root, months=(1,))
    for n in range(4):
        land(spark, root, [(10, f"000{n}", "U", n, 2024, 1)])
    again = spark.createDataFrame([(10, "0000", "U", -1, 2024, 1)], SCHEMA)
    cdc_stream.apply_batch(spark, again, root, ["txn_id"], 3)
    assert held(spark, root)[10] == 3
    assert len({f.split("/data/")[1].split("/")[0] for f in list_files(spark, f"{root}/data")}) == cdc_stream.KEEP
    assert cdc_stream.read_current(spark, root).filter(F.col("part_month").isNull()).isEmpty()


def test_a_landed_file_is_written_by_all_tasks_that_have_its_records(spark, tmp_path):
    log = spark.range(100).repartition(4).selectExpr("lpad(cast(id as string), 20, '0') as change_seq")
    stream_queries.land(log, str(tmp_path / "landed"), 20, 79)
    assert len(list_files(spark, str(tmp_path / "landed"))) == 4 and spark.read.parquet(str(tmp_path / "landed")).count() == 60
