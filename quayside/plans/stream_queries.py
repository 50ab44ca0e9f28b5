"""Queries of the stream and of a table's job, with their SQL: the same as one large batch."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quayside.functions.scratch import saved, scratch_dir
from quayside.operators import cdc, quality
from quayside.plans.adapters import load, with_adapters
from quayside.plans.cdc_queries import FOLD as CDC_FOLD_SQL
from quayside.plans.cdc_queries import KEYS
from quayside.plans.cdc_queries import SQL as CDC_SQL
from quayside.sources.files import list_uris
from quayside.streaming import runs, state_table, table_job
from quayside.streaming.cdc_stream import apply_stream, read_current, start_table

FILES, FILES_PER_BATCH = 6, 2


def land(log, landed: str, low: int, high: int) -> None:
    """Records of some sequences land as one file of the feed, which all tasks that have any write
    a part of."""
    log.filter(F.col("change_seq").cast("long").between(low, high)).write.mode("append").parquet(landed)


def cdc_stream_apply(spark, d):
    root = f"{scratch_dir(spark)}/stream-{uuid.uuid4().hex}"
    landed, log, done = f"{root}/landed", load(spark, d, "cdc_log"), 0
    low, high = log.agg(F.min(F.col("change_seq").cast("long")), F.max(F.col("change_seq").cast("long"))).first()
    step = (high - low) // FILES + 1
    start_table(load(spark, d, "silver_initial"), root)
    for k in range(FILES):  # in the order of their sequence, as a feed lands them
        land(log, landed, low + k * step, low + (k + 1) * step - 1)
        if (k + 1) % FILES_PER_BATCH == 0 or k + 1 == FILES:  # parts of a file are of one batch
            n = len(list_uris(spark, landed))
            apply_stream(spark, landed, log.schema, root, KEYS, files_per_batch=max(1, n - done))
            done = n
    return read_current(spark, root)


# ---- the job of one table: the log's records in three batches after a full load

BATCHES = 3
_JOBS: dict[tuple[str, str], str] = {}


def _job(spark, d):
    """Root of a table whose job has run, once a session, until it had caught up."""
    at = (spark.sparkContext.applicationId, d)
    if at not in _JOBS:
        root = f"{scratch_dir(spark)}/job-{uuid.uuid4().hex}"
        loads = load(spark, d, "silver_initial").select(F.lit("s1").alias("snapshot"), "txn_id", "amount", "status", "change_seq", F.lit("L").alias("change_oper"), F.lit(None).cast("timestamp_ntz").alias("change_ts"))
        log = load(spark, d, "cdc_log")
        # shaped once, as a table of files: each look of each run reads only the columns and sequences it needs
        history = saved(loads.unionByName(log.withColumn("snapshot", F.lit("s1")).drop("part_year", "part_month")), "history")
        budget = -(-log.count() // BATCHES)
        while table_job.run_once(spark, history, root, "txn", KEYS, budget=budget).budget_full:
            pass
        _JOBS[at] = root
    return _JOBS[at]


def position_state(spark, d):
    rows = runs.positions(spark, _job(spark, d))
    return rows.groupBy("table_id").agg(F.max_by("snapshot", "run").alias("snapshot"), F.max_by("watermark", "run").alias("watermark"), F.max("run").alias("run"))


def job_status(spark, d):
    rows = table_job.status_history(spark, _job(spark, d))
    return rows.select("table_id", "run", "snapshot", "rebuilt", "records", "watermark", "upstream_max", "row_count", "inserted", "dropped", "updated", "budget_full", "next_run_s")


def job_progress(spark, d):
    """What the status rows of the runs say of their progress; the first has none before it."""
    rows = table_job.status_history(spark, _job(spark, d))
    return quality.progress(rows).select("table_id", "rows_added", (F.col("took") >= 0).alias("in_order"))


def table_health(spark, d):
    """The newest two versions of the table, as their files were measured when written."""
    root = _job(spark, d)
    newest, before = state_table.batches(spark, root)[:2]
    named = lambda batch: state_table.measure(spark, root, batch).withColumn("table_id", F.lit("txn"))
    both = named(before).select("table_id", F.col("n_rows").alias("rows_before"), F.col("max_id").alias("max_before")).join(named(newest).select("table_id", "n_rows", "max_id"), "table_id")
    issues = quality.table_health(named(before), named(newest)).select("table_id", F.split("issues", ",").alias("told"))
    told = F.array_join(F.filter(F.coalesce("told", F.array()), lambda x: ~x.isin("bytes_fell", "files_fell")), ",")
    return both.join(issues, "table_id", "left").select("table_id", "rows_before", "n_rows", "max_before", "max_id", told.alias("issues"))


def write_reconcile(spark, d):
    """Rows read, inserted and dropped, seen while the table was written, against those in its files."""
    return cdc.write_applied(load(spark, d, "silver_initial"), cdc.cdc_fold(load(spark, d, "cdc_log"), KEYS), KEYS, f"{scratch_dir(spark)}/applied-{uuid.uuid4().hex}")


def _after(batch: int) -> str:
    """SQL of the table after the first batches, by one fold of their records."""
    text = CDC_FOLD_SQL.replace("FROM cdc_log", f"FROM (SELECT * FROM dealt WHERE batch <= {batch})").replace("marked", f"marked{batch}").replace("folded", f"folded{batch}")
    return text.lstrip("+") + f""", after{batch} AS (SELECT coalesce(t.txn_id, s.txn_id) AS txn_id, t.txn_id IS NOT NULL AS old, s.change_oper FROM silver_initial t FULL JOIN folded{batch} s ON t.txn_id = s.txn_id
  WHERE s.txn_id IS NULL OR s.change_oper = 'I' OR (s.change_oper = 'U' AND t.txn_id IS NOT NULL))"""


DEALT = f"+ dealt AS (SELECT *, (row_number() OVER (ORDER BY change_seq) - 1) // ((count(*) OVER () + {BATCHES - 1}) // {BATCHES}) + 1 AS batch FROM cdc_log),\n"
#: Rows after each batch, the keys of each, and how many of them were held before it.
STATES = DEALT + ",".join(_after(b) for b in range(1, BATCHES + 1)) + ",\n" + f"""held AS (SELECT 0 AS batch, txn_id FROM silver_initial UNION ALL {" UNION ALL ".join(f"SELECT {b}, txn_id FROM after{b}" for b in range(1, BATCHES + 1))}),
sizes AS (SELECT batch, count(*) AS n, min(txn_id) AS lo, max(txn_id) AS hi FROM held GROUP BY 1),
gained AS (SELECT a.batch, count(*) FILTER (WHERE b.txn_id IS NULL) AS inserted FROM held a LEFT JOIN held b ON b.batch = a.batch - 1 AND b.txn_id = a.txn_id WHERE a.batch > 0 GROUP BY 1),
lost AS (SELECT b.batch + 1 AS batch, count(*) FILTER (WHERE a.txn_id IS NULL) AS dropped FROM held b LEFT JOIN held a ON a.batch = b.batch + 1 AND b.txn_id = a.txn_id WHERE
  b.batch < {BATCHES} GROUP BY 1),
kept AS (SELECT a.batch, count(*) AS updated FROM held a JOIN held b ON b.batch = a.batch - 1 AND b.txn_id = a.txn_id WHERE EXISTS (SELECT 1 FROM dealt c WHERE c.batch = a.batch
  AND c.txn_id = a.txn_id) GROUP BY 1),
runs AS (SELECT batch, count(*) AS records, max(change_seq) AS watermark FROM dealt GROUP BY 1),
size AS (SELECT (count(*) + {BATCHES - 1}) // {BATCHES} AS budget, max(change_seq) AS newest FROM cdc_log)
"""

QUERIES = {f.__name__: f for f in (cdc_stream_apply, position_state, job_status, job_progress, table_health, write_reconcile)}
SQL = {
    "cdc_stream_apply": CDC_SQL["cdc_apply"],
    "position_state": with_adapters("SELECT 'txn' AS table_id, 's1' AS snapshot, max(change_seq) AS watermark, (count(*) + budget - 1) // budget AS run FROM cdc_log, (SELECT (count(*) + 2) // 3 AS budget FROM cdc_log) GROUP BY budget", "cdc_log"),
    "job_status": with_adapters(
        STATES + """SELECT 'txn' AS table_id, batch - 1 AS run, 's1' AS snapshot, batch = 1 AS rebuilt, records, watermark, newest AS upstream_max, n AS row_count, coalesce(inserted, 0) AS inserted,
  coalesce(dropped, 0) AS dropped, coalesce(updated, 0) AS updated,
  records >= budget AS budget_full, CASE WHEN records >= budget THEN 30 ELSE 14400 END::BIGINT AS next_run_s FROM runs JOIN sizes USING (batch) LEFT JOIN gained USING (batch) LEFT
  JOIN lost USING (batch) LEFT JOIN kept USING (batch), size
UNION ALL SELECT 'txn', batch, 's1', false, 0, watermark, newest, n, 0, 0, 0, false, 43200 FROM runs JOIN sizes USING (batch), size WHERE batch = 3 AND records >= budget""",
        "cdc_log", "silver_initial",
    ),
    "job_progress": with_adapters(
        STATES + """SELECT 'txn' AS table_id, a.n - b.n AS rows_added, true AS in_order FROM sizes a JOIN sizes b ON b.batch = a.batch - 1 AND b.batch > 0
UNION ALL SELECT 'txn', 0, true FROM runs, size WHERE batch = 3 AND records >= budget""",
        "cdc_log", "silver_initial",
    ),
    "table_health": with_adapters(
        STATES + """SELECT 'txn' AS table_id, b.n AS rows_before, a.n AS n_rows, b.hi AS max_before, a.hi AS max_id,
  concat_ws(',', CASE WHEN a.hi < b.hi THEN 'max_id_fell' END, CASE WHEN a.lo > b.lo THEN 'min_id_rose' END, CASE WHEN a.n < b.n THEN 'rows_fell' END) AS issues FROM sizes a, sizes
  b WHERE a.batch = 3 AND b.batch = 2""",
        "cdc_log", "silver_initial",
    ),
    "write_reconcile": CDC_SQL["write_reconcile"],
}
