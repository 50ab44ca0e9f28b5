"""The test tables in the shapes of change logs and fare data. Each text runs unchanged
on Spark and in the SQL oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

ADAPTERS = {
    "cdc_log": """
SELECT user_id AS txn_id, lpad(CAST(event_id AS VARCHAR(20)), 20, '0') AS change_seq,
  CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS change_oper,
  CASE WHEN event_type IN ('signup','purchase','click') AND event_id % 7 <> 0 THEN CAST(round(value * 100) AS BIGINT) END AS amount,
  CASE WHEN event_type IN ('signup','view') THEN props END AS status,
  CAST(2024 AS INT) AS part_year, CAST(1 + user_id % 6 AS INT) AS part_month, ts AS change_ts
FROM events""",
    "silver_initial": """
SELECT DISTINCT user_id AS txn_id, user_id * 10 AS amount, 'load' AS status, CAST(NULL AS VARCHAR(20)) AS change_seq,
  CAST(2024 AS INT) AS part_year, CAST(1 + user_id % 6 AS INT) AS part_month
FROM events WHERE user_id % 2 = 0""",
    "landed_files": """
SELECT user_id AS table_id, event_id AS file, ts, event_id % 5 = 0 AS is_first FROM events""",
    "api_counts": """
SELECT job_id, CAST(n + CASE WHEN job_id % 5 = 0 THEN 1 ELSE 0 END AS BIGINT) AS data_count FROM (SELECT user_id AS job_id, count(*) AS n FROM events GROUP BY user_id) x WHERE job_id % 7 <> 0
UNION ALL SELECT DISTINCT user_id + 1000000 AS job_id, CAST(3 AS BIGINT) AS data_count FROM events WHERE user_id % 11 = 0""",
    "status_history": """
SELECT user_id AS table_id, CASE WHEN user_id % 3 = 0 THEN 'api' ELSE 'cdc' END AS feed, CAST(ts AS DATE) AS run_day, max(ts) AS run_at,
  count(*) AS row_count, lpad(CAST(max(event_id) AS VARCHAR(20)), 20, '0') AS watermark, max(ts) AS watermark_at,
  CAST(floor(sum(value)) AS BIGINT) % 20000 AS lag_s, CASE WHEN user_id % 3 = 0 THEN max(event_id) % 4 > 0 END AS caught_up, count(*) * 41 + 7 AS run_s,
  CASE WHEN user_id % 3 = 1 THEN max(event_id) % 9 = 0 END AS budget_nearly_full, CASE WHEN user_id % 3 = 2 THEN max(event_id) % 8 = 0 END AS budget_full,
  CASE WHEN user_id % 5 = 0 THEN max(event_id) % 3 END AS jobs_lag, CASE WHEN user_id % 3 = 1 THEN max(event_id) % 2 END AS pending
FROM events GROUP BY user_id, CAST(ts AS DATE)""",
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, or an adapter over them."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    register(spark, sf_dir, ADAPTERS[name])
    return spark.sql(ADAPTERS[name])


def register(spark: SparkSession, sf_dir: str, text: str) -> None:
    """The test tables that ``text`` names, as temporary views."""
    for table in (t for t in TABLES if t in text):
        spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(table)


def with_adapters(sql: str, *names: str) -> str:
    """SQL for the oracle: the adapters as common table expressions before it."""
    return "WITH " + ",\n".join(f"{n} AS ({ADAPTERS[n]})" for n in names) + ("," if sql.lstrip().startswith("+") else "") + "\n" + sql.lstrip().lstrip("+")
