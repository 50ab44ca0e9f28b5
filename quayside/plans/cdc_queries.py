"""Queries on change logs, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.operators import cdc
from quayside.plans.adapters import load, with_adapters

KEYS = ["txn_id"]
MIDDLE = "00000000000000000300"

FOLD = """+ marked AS (SELECT *, max(CASE WHEN change_oper IN ('I','D') THEN change_seq END) OVER (PARTITION BY txn_id) AS reset FROM cdc_log),
folded AS (SELECT txn_id, coalesce(max(CASE WHEN change_seq = reset THEN change_oper END), 'U') AS change_oper, max(change_seq) AS change_seq,
  arg_max(amount, change_seq) FILTER (WHERE amount IS NOT NULL AND (reset IS NULL OR change_seq >= reset)) AS amount,
  arg_max(status, change_seq) FILTER (WHERE status IS NOT NULL AND (reset IS NULL OR change_seq >= reset)) AS status,
  arg_max(part_year, change_seq) FILTER (WHERE reset IS NULL OR change_seq >= reset) AS part_year,
  arg_max(part_month, change_seq) FILTER (WHERE reset IS NULL OR change_seq >= reset) AS part_month
FROM marked GROUP BY txn_id)
"""
APPLY = FOLD + """, applied AS (SELECT coalesce(t.txn_id, s.txn_id) AS txn_id,
  CASE WHEN s.change_oper = 'I' THEN s.amount ELSE coalesce(s.amount, t.amount) END AS amount,
  CASE WHEN s.change_oper = 'I' THEN s.status ELSE coalesce(s.status, t.status) END AS status,
  coalesce(s.change_seq, t.change_seq) AS change_seq, coalesce(s.part_year, t.part_year) AS part_year, coalesce(s.part_month, t.part_month) AS part_month
FROM silver_initial t FULL JOIN folded s ON t.txn_id = s.txn_id
WHERE s.txn_id IS NULL OR s.change_oper = 'I' OR (s.change_oper = 'U' AND t.txn_id IS NOT NULL))
"""


def _folded(spark, d):
    return cdc.cdc_fold(load(spark, d, "cdc_log"), KEYS)


def cdc_fold(spark, d):
    return _folded(spark, d)


def cdc_apply(spark, d):
    return cdc.cdc_apply(load(spark, d, "silver_initial"), _folded(spark, d), KEYS)


def cdc_apply_last_op(spark, d):
    target = load(spark, d, "silver_initial")
    return cdc.cdc_apply_last_op(target, load(spark, d, "cdc_log"), KEYS)


def silver_rebuild(spark, d):
    history = load(spark, d, "cdc_log").withColumns({"snapshot": F.when(F.col("part_month") <= 3, "s1").otherwise("s2"), "change_oper": F.when(F.col("change_oper") == "I", "L").otherwise(F.col("change_oper"))})
    return cdc.silver_rebuild(history.withColumn("d", F.col("change_ts")).drop("part_year", "part_month"), "s2", "d").drop("d")


def cdc_batch_ceiling(spark, d):
    return cdc.batch_ceiling(load(spark, d, "cdc_log"), MIDDLE, 500)


def cdc_read_batch(spark, d):
    return cdc.read_batch(load(spark, d, "cdc_log"), MIDDLE, 500).select("txn_id", "change_seq", "change_oper", "amount", "status")


def _snapshots(spark, d):
    return load(spark, d, "landed_files").filter("is_first").select("table_id", "ts").distinct()


def cdc_asof_snapshot(spark, d):
    return cdc.asof_snapshot(load(spark, d, "landed_files"), _snapshots(spark, d))


def snapshot_load_groups(spark, d):
    return cdc.load_groups(load(spark, d, "landed_files")).select("table_id", "file", "load_no")


def stale_file_selection(spark, d):
    files = load(spark, d, "landed_files")
    oldest = files.filter("is_first and table_id % 2 = 0").groupBy("table_id").agg(F.min("ts").alias("oldest"))
    return cdc.stale_files(files, oldest).select("table_id", "file")


def surrogate_index(spark, d):
    return cdc.surrogate_index(load(spark, d, "orders").select("o_orderkey"), "o_orderkey", start=100)


def _patch(spark, d):
    return load(spark, d, "orders").groupBy("o_custkey").agg(F.when(F.col("o_custkey") % 3 > 0, F.max("o_totalprice")).alias("c_acctbal")).select(F.expr("case when o_custkey % 10 > 0 then o_custkey end").alias("c_custkey"), "c_acctbal").filter("c_custkey is not null")


def null_safe_update(spark, d):
    return cdc.null_safe_update(load(spark, d, "customer"), _patch(spark, d), ["c_custkey"]).select("c_custkey", "c_name", "c_acctbal")


def _nullable_events(spark, d):
    return load(spark, d, "events").select("event_id", F.expr("case when user_id % 9 > 0 then user_id end").alias("k"))


def _nullable_keys(spark, d):
    return load(spark, d, "orders").filter("o_custkey % 4 = 0").select(F.expr("case when o_custkey % 8 > 0 then o_custkey end").alias("k"))


def null_safe_semi(spark, d):
    return cdc.keyed_lookup(_nullable_events(spark, d), _nullable_keys(spark, d), ["k"])


def null_safe_anti(spark, d):
    return cdc.keyed_lookup(_nullable_events(spark, d), _nullable_keys(spark, d), ["k"], "left_anti")


def keyed_lookup_join(spark, d):
    keys = load(spark, d, "orders").filter("o_totalprice > 300000").select(F.col("o_orderkey").alias("l_orderkey"))
    return cdc.keyed_lookup(load(spark, d, "lineitem"), keys, ["l_orderkey"]).select("l_orderkey", "l_linenumber", "l_extendedprice")


def key_range_prefilter(spark, d):
    keys = load(spark, d, "orders").filter("o_orderstatus = 'F' and o_orderdate between '1996-01-01' and '1997-06-30'").select(F.col("o_orderkey").alias("l_orderkey"))
    return cdc.key_range_lookup(load(spark, d, "lineitem"), keys, "l_orderkey").select("l_orderkey", "l_linenumber")


def topk_after_watermark(spark, d):
    return cdc.topk_after(load(spark, d, "events").select("event_id", "user_id", "event_type"), "event_id", 250, 400, condition="event_type <> 'view'")


def cdc_accumulate(spark, d):
    size = F.length("change_seq") + F.coalesce(F.length("status"), F.lit(0))
    return cdc.accumulate(load(spark, d, "cdc_log"), MIDDLE, 640_000, 10_000, size).select("txn_id", "change_seq", "change_oper")


def source_max_seq(spark, d):
    log = load(spark, d, "cdc_log")
    newest = log.agg(F.max(F.struct("part_year", "part_month"))).first()[0]
    part = log.filter((F.col("part_year") == newest[0]) & (F.col("part_month") == newest[1]))
    return part.agg(F.max("change_seq").alias("max_seq"))


def touched_partitions(spark, d):
    rows = load(spark, d, "orders").select(F.expr("case when o_orderkey % 50 > 0 then o_orderdate end").alias("edw_inserted_dtm"))
    return cdc.touched_partitions(rows)


QUERIES = {
    f.__name__: f
    for f in (
        cdc_fold, cdc_apply, cdc_apply_last_op, silver_rebuild, cdc_batch_ceiling, cdc_read_batch, cdc_asof_snapshot, snapshot_load_groups, stale_file_selection, surrogate_index, null_safe_update,
        null_safe_semi, null_safe_anti, keyed_lookup_join, key_range_prefilter, topk_after_watermark, cdc_accumulate, source_max_seq, touched_partitions,
    )
}

NULLABLE = "k.k IS NOT DISTINCT FROM e.k"
SEMI = """WITH e AS (SELECT event_id, CASE WHEN user_id % 9 > 0 THEN user_id END AS k FROM events), m AS (SELECT DISTINCT CASE WHEN o_custkey % 8 > 0 THEN o_custkey END AS k FROM orders
  WHERE o_custkey % 4 = 0)
SELECT event_id, k FROM e WHERE {} EXISTS (SELECT 1 FROM m WHERE m.k IS NOT DISTINCT FROM e.k)"""

#: Of these, ``write_reconcile`` is a query of the job's.
SQL = {
    "cdc_fold": with_adapters(FOLD + "SELECT * FROM folded", "cdc_log"),
    "cdc_apply": with_adapters(APPLY + "SELECT * FROM applied", "cdc_log", "silver_initial"),
    "cdc_apply_last_op": with_adapters(
        """+ s AS (SELECT txn_id, arg_max(change_oper, change_seq) AS oper, max(change_seq) AS seq,
  arg_max({'a': amount, 's': status, 'y': part_year, 'm': part_month}, change_seq) AS lst,
  arg_max({'a': amount, 's': status, 'y': part_year, 'm': part_month}, change_seq) FILTER (WHERE change_oper = 'I') AS ins,
  arg_max(amount, change_seq) FILTER (WHERE change_oper = 'U' AND amount IS NOT NULL) AS ua, arg_max(status, change_seq) FILTER (WHERE change_oper = 'U' AND status IS NOT NULL) AS us,
  arg_max(part_year, change_seq) FILTER (WHERE change_oper = 'U') AS uy, arg_max(part_month, change_seq) FILTER (WHERE change_oper = 'U') AS um FROM cdc_log GROUP BY txn_id)
SELECT coalesce(t.txn_id, s.txn_id) AS txn_id,
  CASE WHEN s.txn_id IS NULL THEN t.amount WHEN oper = 'I' THEN lst.a ELSE coalesce(ua, CASE WHEN t.txn_id IS NOT NULL THEN t.amount ELSE ins.a END) END AS amount,
  CASE WHEN s.txn_id IS NULL THEN t.status WHEN oper = 'I' THEN lst.s ELSE coalesce(us, CASE WHEN t.txn_id IS NOT NULL THEN t.status ELSE ins.s END) END AS status,
  CASE WHEN s.txn_id IS NULL THEN t.part_year WHEN oper = 'I' THEN lst.y ELSE coalesce(uy, CASE WHEN t.txn_id IS NOT NULL THEN t.part_year ELSE ins.y END) END AS part_year,
  CASE WHEN s.txn_id IS NULL THEN t.part_month WHEN oper = 'I' THEN lst.m ELSE coalesce(um, CASE WHEN t.txn_id IS NOT NULL THEN t.part_month ELSE ins.m END) END AS part_month,
  coalesce(seq, t.change_seq) AS change_seq
FROM silver_initial t FULL JOIN s ON t.txn_id = s.txn_id WHERE s.txn_id IS NULL OR oper = 'I' OR (oper = 'U' AND (t.txn_id IS NOT NULL OR ins IS NOT NULL))""",
        "cdc_log", "silver_initial",
    ),
    "silver_rebuild": with_adapters("SELECT txn_id, change_seq, amount, status, 's2' AS load_snapshot, year(change_ts)::INT AS part_year, month(change_ts)::INT AS part_month FROM cdc_log WHERE part_month > 3 AND change_oper = 'I'", "cdc_log"),
    "cdc_batch_ceiling": with_adapters(f"SELECT count(*) AS n, max(change_seq) AS ceiling FROM (SELECT change_seq FROM cdc_log WHERE change_seq > '{MIDDLE}' ORDER BY 1 LIMIT 500)", "cdc_log"),
    "cdc_read_batch": with_adapters(f"SELECT txn_id, change_seq, change_oper, amount, status FROM cdc_log WHERE change_seq > '{MIDDLE}' AND change_seq <= (SELECT max(change_seq) FROM (SELECT change_seq FROM cdc_log WHERE change_seq > '{MIDDLE}' ORDER BY 1 LIMIT 500))", "cdc_log"),
    "cdc_asof_snapshot": with_adapters("SELECT f.table_id, f.file, f.ts, max(s.ts) AS snapshot FROM landed_files f JOIN landed_files s ON s.is_first AND s.table_id = f.table_id AND s.ts < f.ts GROUP BY ALL", "landed_files"),
    "snapshot_load_groups": with_adapters("SELECT table_id, file, sum(is_first::INT) OVER (PARTITION BY table_id ORDER BY ts, file)::BIGINT AS load_no FROM landed_files", "landed_files"),
    "stale_file_selection": with_adapters(
        """+ g AS (SELECT *, sum(is_first::INT) OVER (PARTITION BY table_id ORDER BY ts, file) AS n FROM landed_files),
newest AS (SELECT table_id, arg_max(s, n) AS cut FROM (SELECT table_id, n, min(ts) AS s FROM g GROUP BY ALL) GROUP BY 1),
oldest AS (SELECT table_id, min(ts) AS cut FROM landed_files WHERE is_first AND table_id % 2 = 0 GROUP BY 1)
SELECT g.table_id, file FROM g JOIN newest USING (table_id) LEFT JOIN oldest USING (table_id) WHERE ts < coalesce(oldest.cut, newest.cut)""",
        "landed_files",
    ),
    "surrogate_index": "SELECT o_orderkey, 99 + row_number() OVER (ORDER BY o_orderkey) AS row_index FROM orders",
    "null_safe_update": """SELECT c_custkey, c_name, coalesce(p, c_acctbal) AS c_acctbal FROM customer LEFT JOIN (SELECT o_custkey, CASE WHEN o_custkey % 3 > 0 THEN max(o_totalprice) END AS p FROM orders
  WHERE o_custkey % 10 > 0 GROUP BY 1) ON o_custkey = c_custkey""",
    "null_safe_semi": SEMI.format(""),
    "null_safe_anti": SEMI.format("NOT"),
    "keyed_lookup_join": "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_totalprice > 300000)",
    "key_range_prefilter": "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderdate BETWEEN '1996-01-01' AND '1997-06-30')",
    "topk_after_watermark": "SELECT event_id, user_id, event_type FROM events WHERE event_id > 250 AND event_type <> 'view' ORDER BY event_id LIMIT 400",
    "cdc_accumulate": with_adapters(
        f"""SELECT txn_id, change_seq, change_oper FROM (
  SELECT *, coalesce(sum(length(change_seq) + coalesce(length(status), 0)) OVER (ORDER BY change_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM (SELECT * FROM cdc_log WHERE change_seq > '{MIDDLE}' ORDER BY change_seq LIMIT 640000)) WHERE before < 10000""",
        "cdc_log",
    ),
    "source_max_seq": with_adapters("SELECT max(change_seq) AS max_seq FROM cdc_log WHERE (part_year, part_month) = (SELECT max((part_year, part_month)) FROM cdc_log)", "cdc_log"),
    "touched_partitions": """WITH p AS (SELECT year(x) AS y, month(x) AS m, count(*) AS n FROM (SELECT CASE WHEN o_orderkey % 50 > 0 THEN o_orderdate END AS x FROM orders) GROUP BY 1, 2),
l AS (SELECT list(printf('%04d-%02d:%d', y, m, n) ORDER BY y, m, n) FILTER (WHERE y IS NOT NULL) AS ls, count(y) AS n_parts, coalesce(sum(n) FILTER (WHERE y IS NULL), 0)::BIGINT AS null_dates FROM p)
SELECT n_parts, null_dates, null_dates = 0 AS pruned, array_to_string(ls[1:24], ',') || CASE WHEN len(ls) > 24 THEN ' +' || (len(ls) - 24) || ' more' ELSE '' END AS labels FROM l""",
    "write_reconcile": with_adapters(APPLY + """SELECT count(t.txn_id) AS initial, count(*) FILTER (WHERE t.txn_id IS NULL AND s.change_oper = 'I') AS inserted, count(*) FILTER (WHERE t.txn_id IS NOT NULL AND s.change_oper = 'D') AS dropped,
  (SELECT count(*) FROM applied) AS actual, count(t.txn_id) + count(*) FILTER (WHERE t.txn_id IS NULL AND s.change_oper = 'I') - count(*) FILTER (WHERE t.txn_id IS NOT NULL AND
  s.change_oper = 'D') = (SELECT count(*) FROM applied) AS ok FROM silver_initial t FULL JOIN folded s ON t.txn_id = s.txn_id""", "cdc_log", "silver_initial"),
}
