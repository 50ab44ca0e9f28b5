"""Batches of any cut must equal one event at a time."""

import random

from pyspark.sql import functions as F

from quayside.operators.cdc import cdc_apply, cdc_apply_last_op, cdc_fold, null_safe_update, surrogate_index

SCHEMA = "case_id int, txn_id int, amount long, status string, change_seq string, change_oper string"
KEYS = ["case_id", "txn_id"]


def one_by_one(rows, log):
    """What a table holds after the log, read one record at a time: {key: (amount, status, seq)}."""
    held = dict(rows)
    for key, amount, status, seq, oper in log:
        if oper == "D":
            held.pop(key, None)
        elif oper == "I":
            held[key] = (amount, status, seq)
        elif key in held:
            old = held[key]
            held[key] = (amount if amount is not None else old[0], status if status is not None else old[1], seq)
    return held


def made_log(rng):
    """A table and a log over few keys, most of them on one; logs begin with deletes of
    what is there, and updates come in runs."""
    hot, others = rng.choice([None, 40]), list(range(rng.randrange(1, 5)))
    rows = {k: (rng.randrange(3), "kept", None) for k in [hot, *others] if k is not None and k % 2 == 0}
    log = [(k, None, None, "D") for k in sorted(rows)[: rng.randrange(3)]]
    while len(log) < rng.randrange(5, 45):
        key = hot if rng.random() < 0.6 else rng.choice(others)
        kind = "D" if rng.random() < 0.15 else "I" if rng.random() < 0.3 else "U"
        for _ in range(rng.randrange(1, 5) if kind == "U" else 1):
            value = (rng.randrange(9), None) if rng.random() < 0.5 else (None, f"s{rng.randrange(9)}")
            log.append((key, None, None, kind) if kind == "D" else (key, *value, kind))
    return rows, [(k, amount, status, f"{100 + 7 * n:08d}", kind) for n, (k, amount, status, kind) in enumerate(log)]


def test_any_cut_equals_one_batch_equals_the_interpreter(spark):
    rng = random.Random(20)
    start, logs, want = [], [], {}
    for case in range(120):
        rows, log = made_log(rng)
        start += [(case, k, *v) for k, v in rows.items()]
        logs.append(log)
        want |= {(case, k): v for k, v in one_by_one(rows, log).items()}
    table = spark.createDataFrame(start, "case_id int, txn_id int, amount long, status string, change_seq string")

    def applied(parts):
        """All cases' logs in as many batches as ``parts`` cuts them; the second batch comes twice."""
        out = table
        for n in (0, 1, 1, *range(2, parts)) if parts > 1 else (0,):
            rows = [(case, *e) for case, log in enumerate(logs) for e in log[n * len(log) // parts : (n + 1) * len(log) // parts]]
            out = cdc_apply(out, cdc_fold(spark.createDataFrame(rows, SCHEMA), KEYS), KEYS)
        return {(r.case_id, r.txn_id): (r.amount, r.status, r.change_seq) for r in out.collect()}

    assert applied(1) == want
    assert applied(4) == want


def test_documented_operation_mixes(spark):
    for opers, want in (("IU", "I"), ("U", "U"), ("I", "I"), ("ID", "D"), ("DU", "D")):
        rows = [(0, 1, 1, "s", f"{n:04d}", o) for n, o in enumerate(opers)]
        assert cdc_fold(spark.createDataFrame(rows, SCHEMA), KEYS).first().change_oper == want


def test_older_rule_revives_a_row_after_delete_and_update(spark):
    target = spark.createDataFrame([(1, 9, "old", "0")], "txn_id int, amount long, status string, change_seq string")
    events = spark.createDataFrame([(1, None, None, "1", "D"), (1, 7, None, "2", "U")], "txn_id int, amount long, status string, change_seq string, change_oper string")
    assert [tuple(r) for r in cdc_apply_last_op(target, events, ["txn_id"]).collect()] == [(1, 7, "old", "2")]
    assert cdc_apply(target, cdc_fold(events, ["txn_id"]), ["txn_id"]).count() == 0


def test_null_keys_match_and_right_values_win(spark):
    left = spark.createDataFrame([(None, 1, "a"), (2, 2, "b")], "k int, v int, w string")
    right = spark.createDataFrame([(None, 9)], "k int, v int")
    assert sorted(map(tuple, null_safe_update(left, right, ["k"]).collect()), key=str) == [(2, 2, "b"), (None, 9, "a")]


def test_surrogates_have_no_gaps(spark):
    rows = surrogate_index(spark.range(1000), "id", start=7).select("row_index").collect()
    assert sorted(r[0] for r in rows) == list(range(7, 1007))


def test_a_hot_key_is_folded_like_any_other(spark):
    log = spark.range(5000).selectExpr("if(id % 3 = 0, 1, int(id)) as case_id", "0 as txn_id", "id as amount", "if(id = 3, 's', null) as status", "lpad(string(id), 8, '0') as change_seq", "if(id = 6, 'D', 'U') as change_oper")
    hot = cdc_fold(log, KEYS).filter("case_id = 1").first()
    assert (hot.change_oper, hot.amount, hot.status, hot.change_seq) == ("D", 4998, None, "00004998")
