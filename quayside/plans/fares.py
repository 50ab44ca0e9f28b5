"""The test tables as fare-data facts and dimensions: common table expressions that both
Spark and the SQL oracle read."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession

from quayside.functions.scratch import scratch_dir
from quayside.plans.adapters import register
from quayside.plans.vendor_tables import VENDOR
from quayside.sources.files import exists, total_bytes

FARES = {
    "fare_base": """
SELECT l_orderkey * 8 + l_linenumber AS txn_id, l_orderkey AS order_id, o_custkey AS account_id, l_partkey AS part_id, l_suppkey AS supp_id, l_linenumber AS line_no, l_returnflag AS flag,
  year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS settlement_day_key, year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS operating_day_key,
  CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, CAST(round(l_tax * 10000) AS BIGINT) AS tax_bp, CAST(round(l_discount * 10000) AS BIGINT) AS disc_bp, l_shipdate AS
  ship_dtm, o_orderdate AS order_dtm
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "payment_summary": """
SELECT settlement_day_key, operating_day_key, line_no AS payment_type_key, account_id % 5 AS sales_channel_key, CASE flag WHEN 'A' THEN 'SalesTxn' WHEN 'N' THEN 'UseTxn' ELSE
  'RefundTxn' END AS txn_source,
  supp_id AS reason_key, cents AS payment_value, cents AS transit_value, CASE WHEN disc_bp > 300 THEN disc_bp END AS benefit_value, CASE WHEN tax_bp > 200 THEN tax_bp END AS bankcard_payment_value,
  CASE WHEN line_no = 2 THEN disc_bp END AS one_account_value, CASE WHEN disc_bp > 500 THEN disc_bp END AS pass_cost, CASE WHEN line_no = 1 THEN 200 END AS enablement_fee, CASE
  WHEN line_no = 3 THEN 300 END AS replacement_fee
FROM fare_base""",
    "txn_channel_map": """
SELECT t.txn_source, t.txn_group, p.payment_type_key, c.sales_channel_key, CONCAT('channel ', CAST(c.sales_channel_key AS VARCHAR(2))) AS sales_channel_display, CONCAT('type ',
  CAST(p.payment_type_key AS VARCHAR(2))) AS txn_channel_display
FROM (SELECT DISTINCT CASE l_returnflag WHEN 'A' THEN 'SalesTxn' WHEN 'N' THEN 'UseTxn' ELSE 'RefundTxn' END AS txn_source, CASE l_returnflag WHEN 'A' THEN 'Product Sales' WHEN 'N'
  THEN 'Open Payment Trips' ELSE 'Direct Refunds Applied' END AS txn_group FROM lineitem) t
CROSS JOIN (SELECT DISTINCT l_linenumber AS payment_type_key FROM lineitem) p CROSS JOIN (SELECT DISTINCT c_custkey % 5 AS sales_channel_key FROM customer) c
UNION ALL SELECT x.txn_source, 'Product Sales', p.payment_type_key, c.sales_channel_key, CONCAT('order channel ', CAST(c.sales_channel_key AS VARCHAR(2))), CONCAT(x.txn_source,
  ' ', CAST(p.payment_type_key AS VARCHAR(2)))
FROM (SELECT 'SalesOrder' AS txn_source UNION ALL SELECT 'RefundOrder') x CROSS JOIN (SELECT DISTINCT l_linenumber AS payment_type_key FROM lineitem) p
CROSS JOIN (SELECT DISTINCT c_custkey % 5 AS sales_channel_key FROM customer WHERE c_custkey % 5 < 4) c WHERE x.txn_source = 'SalesOrder' OR p.payment_type_key < 3
UNION ALL SELECT DISTINCT 'UseTxn', 'Open Payment Trips', l_linenumber, 14, 'channel 14', CONCAT('adjusted ', CAST(l_linenumber AS VARCHAR(2))) FROM lineitem WHERE l_linenumber IN (2, 4)
UNION ALL SELECT DISTINCT 'UseTxn', 'Open Payment Trips', l_linenumber, 8, 'channel 8', 'tapped' FROM lineitem WHERE l_linenumber = 2""",
    "users_lists": "SELECT DISTINCT p_partkey % 7 AS fare_prod_users_list_key, CONCAT('list ', CAST(p_partkey % 7 AS VARCHAR(2))) AS fare_prod_users_list_name FROM part WHERE p_partkey % 7 > 1",
    "travel_modes": "SELECT DISTINCT n_nationkey % 4 AS travel_mode_id, CONCAT('mode ', CAST(n_nationkey % 4 AS VARCHAR(2))) AS travel_mode_name FROM nation WHERE n_nationkey % 4 < 3",
    "purses": "SELECT n_nationkey AS purse_sku, CONCAT('purse ', n_name) AS purse_name FROM nation",
    "rider_classes": "SELECT n_nationkey AS rider_class_id, n_name AS rider_class_name FROM nation WHERE n_nationkey < 20",
    "sale_types": "SELECT n_nationkey AS sale_type_key, CONCAT('sale ', n_name) AS sale_type_name FROM nation",
    "chargeback_kinds": "SELECT r_regionkey AS crdb_chgbk_activity_type_id, r_name AS chgbk_activity_type_name FROM region WHERE r_regionkey > 0",
    "calendar": """
SELECT DISTINCT year(d) * 10000 + month(d) * 100 + day(d) AS date_key, CAST(d AS DATE) AS dtm FROM (SELECT o_orderdate AS d FROM orders UNION ALL SELECT l_shipdate FROM lineitem) x""",
    "schedule": """
SELECT m * 100 + 28 AS due_day_key, m * 100 + 15 AS comp_operating_day_key, m * 100 + 131 AS comp_max_settlement_day_key, m * 100 + 15 AS adden_max_operating_day_key, m * 100 + 10
  AS adden_min_settlement_day_key, m * 100 + 12 AS adden_max_settlement_day_key, m * 100 + 29 AS deposit_due_day_key
FROM (SELECT DISTINCT year(o_orderdate) * 100 + month(o_orderdate) AS m FROM orders) x""",
    "recovery_txn": """
SELECT txn_id AS source_table_uk, operating_day_key, settlement_day_key, settlement_day_key AS posting_day_key, account_id % 25 AS rider_class_id, part_id AS fare_prod_key, line_no
  AS service_type_id, CONCAT('rule ', flag) AS fare_rule_description,
  CASE WHEN supp_id % 2 = 0 THEN 'tap' ELSE 'trip' END AS recovery_txn_type, CASE WHEN line_no < 6 THEN cents % 500 END AS minimum_fare_charge, account_id % 25 AS stop_point_key,
  supp_id % 25 AS route_key, ship_dtm AS transaction_dtm,
  supp_id AS device_id, txn_id * 3 AS tap_id, order_id AS trip_id, CASE WHEN txn_id % 4 = 0 THEN txn_id % 90 END AS incident_id, txn_id % 2 AS supervening_event
FROM fare_base WHERE flag <> 'A'""",
    "stop_points": "SELECT n_nationkey AS stop_point_key, CONCAT('stop ', n_name) AS stop_point_name FROM nation WHERE n_nationkey % 2 = 0",
    "routes": "SELECT n_nationkey AS route_key, CONCAT('route ', n_name) AS route_name FROM nation",
    "use_txn": """
SELECT txn_id AS dw_transaction_id, account_id AS transit_account_id, order_id AS patron_trip_id, line_no AS trip_price_count, part_id AS card_key, part_id AS fare_prod_key,
  supp_id AS operator_key, operating_day_key, settlement_day_key, settlement_day_key AS posting_day_key, ship_dtm AS transaction_dtm,
  line_no - 1 AS transfer_sequence_nbr, CASE WHEN tax_bp > 400 THEN -tax_bp ELSE disc_bp END AS fare_due, CASE WHEN line_no = 1 THEN 24 ELSE 1 END AS ride_type_key, cents % 3 AS
  value_changed, CASE WHEN disc_bp > 800 THEN disc_bp ELSE 0 END AS uncollectible_amount,
  CASE WHEN flag = 'N' THEN tax_bp ELSE 0 END AS bankcard_payment_value, part_id % 3 AS media_type_key, 30 + supp_id % 30 AS txn_status_key, CASE WHEN disc_bp > 300 THEN disc_bp
  END AS pass_cost, CASE WHEN tax_bp > 300 THEN tax_bp END AS benefit_value, CONCAT('R', CAST(txn_id AS VARCHAR(20))) AS retrieval_ref_nbr,
  CASE WHEN account_id % 2 = 0 THEN 'FARE' ELSE 'PIVOTAL' END AS source, supp_id AS device_id, txn_id * 7 AS transaction_id, CASE WHEN txn_id % 4 > 0 THEN txn_id % 1000 END AS
  pass_id, operating_day_key AS transit_day_key, order_dtm AS source_inserted_dtm,
  CASE WHEN txn_id % 20 = 0 THEN order_dtm END AS voided_dtm, CONCAT('S', CAST(part_id AS VARCHAR(12))) AS serial_nbr, txn_id % 3 AS pass_use_count, CASE WHEN txn_id % 5 = 0 THEN
  disc_bp END AS booking_prepaid_value, CASE WHEN txn_id % 6 = 0 THEN tax_bp END AS merchant_service_fee,
  flag AS transaction_status_name, supp_id % 50 AS bus_id, txn_id % 4 AS paygo_ride_count, txn_id % 5 AS ride_count, txn_id % 2 AS transfer_flag, CONCAT('T', CAST(part_id AS
  VARCHAR(12))) AS token_id, part_id * 3 AS pg_card_id, CONCAT('purse ', flag) AS purse_name, supp_id % 12 AS facility_id,
  txn_id * 3 AS tap_id, cents % 900 AS calculated_fare, CASE WHEN txn_id % 7 = 0 THEN disc_bp END AS one_account_value, CASE WHEN txn_id % 7 = 1 THEN disc_bp END AS
  restricted_purse_value, CASE WHEN txn_id % 7 = 2 THEN disc_bp END AS refundable_purse_value, CASE WHEN txn_id % 7 = 3 THEN disc_bp END AS discount_applied,
  CASE WHEN txn_id % 7 = 4 THEN disc_bp END AS post_pay_amount
FROM fare_base WHERE flag <> 'R'""",
    "patron_trip": """
SELECT o_orderkey AS patron_trip_id, o_orderpriority AS fare_rule_description, CASE WHEN o_custkey % 2 = 0 THEN 'FARE' ELSE 'PIVOTAL' END AS source FROM orders
UNION ALL SELECT o_orderkey, 'rule of another source', 'OTHER' FROM orders WHERE o_orderkey % 5 = 0""",
    "trip_payment": """
SELECT order_id AS patron_trip_id, line_no AS trip_price_count, CASE WHEN txn_id % 2 = 0 THEN txn_id END AS purse_load_id, CASE WHEN txn_id % 3 = 0 THEN txn_id END AS
  bankcard_payment_id, cents AS bankcard_value, disc_bp AS stored_value, tax_bp AS uncollectible_amount,
  txn_id % 2 AS is_reversal, CASE WHEN line_no = 1 THEN 1 ELSE 0 END AS je_is_fare_adjustment, CASE WHEN line_no = 1 THEN 131 ELSE 100 END AS journal_entry_type_id, ship_dtm AS transaction_dtm,
  CASE WHEN txn_id % 17 = 0 THEN 'OTHER' WHEN account_id % 2 = 0 THEN 'FARE' ELSE 'PIVOTAL' END AS source FROM fare_base""",
    "sale_txn": """
SELECT txn_id AS dw_transaction_id, CASE WHEN txn_id % 2 = 0 THEN txn_id END AS purse_load_id, CASE WHEN txn_id % 3 = 0 THEN txn_id END AS bankcard_payment_id, CASE WHEN txn_id % 4
  < 2 THEN 26 ELSE 20 END AS sale_type_key, settlement_day_key, operating_day_key, account_id AS transit_account_id,
  txn_id AS dw_patron_order_line_item_id, CASE WHEN line_no = 2 THEN 990508 ELSE 1 END AS reason_key, disc_bp AS pass_id, cents AS value_changed, tax_bp AS benefit_value, disc_bp
  AS refundable_purse_value,
  1 + txn_id % 5 AS bankcard_payment_type_key, CONCAT('Q', CAST(txn_id AS VARCHAR(20))) AS retrieval_ref_nbr FROM fare_base""",
    "order_lines": "SELECT order_id AS dw_patron_order_id, txn_id AS dw_patron_order_line_item_id, account_id AS subsystem_account_ref, supp_id AS xfer_to_subsystem_account_ref FROM fare_base",
    "channels": "SELECT DISTINCT c_custkey % 5 AS sales_channel_key, CONCAT('channel ', CAST(c_custkey % 5 AS VARCHAR(2))) AS sales_channel_name FROM customer",
    "outages": """
SELECT event_id AS availability_event_id, user_id AS device_id, event_type, CASE WHEN event_id % 4 > 0 THEN ts END AS outage_begin_dtm, ts AS open_dtm, CASE WHEN event_id % 6 > 0
  THEN ts + INTERVAL '5' HOUR END AS outage_end_dtm, CASE WHEN event_id % 11 > 0 THEN ts + INTERVAL '9' HOUR END AS close_dtm, event_id % 3 AS excluded,
  CONCAT('operator ', CAST(user_id % 5 AS VARCHAR(2))) AS operator_name, CASE WHEN user_id % 7 > 0 THEN CONCAT('facility ', CAST(user_id % 7 AS VARCHAR(2))) END AS facility_name,
  CASE WHEN user_id % 3 > 0 THEN user_id % 40 END AS bus_id,
  event_id % 5 AS failure_level, CONCAT('fault ', event_type) AS fault_description, CASE WHEN event_id % 8 > 0 THEN event_id % 8 END AS root_cause_id, substr('ABCD', CAST(1 +
  event_id % 4 AS INT), 1) AS location_category,
  CASE WHEN event_id % 9 > 0 THEN ts + INTERVAL '30' HOUR END AS deadline_dtm FROM events""",
}

FARES |= VENDOR
#: Adjustment sales with their payments and reads, and a channel map without one of their types.
PAYG = {
    "sale_adjustments": """
SELECT txn_id AS dw_transaction_id, ship_dtm AS transaction_dtm, CASE WHEN txn_id % 5 < 2 THEN 22 ELSE 20 END AS sale_type_key, CASE line_no WHEN 1 THEN 990951 WHEN 2 THEN 990961
  WHEN 3 THEN 990952 WHEN 4 THEN 990962 ELSE 990508 END AS reason_key,
  part_id % 3 AS media_type_key, CASE WHEN txn_id % 3 > 0 THEN txn_id END AS tap_id, account_id AS transit_account_id, supp_id AS device_id, CASE WHEN account_id % 10 > 0 THEN
  operating_day_key END AS operating_day_key, settlement_day_key, settlement_day_key AS posting_day_key FROM fare_base""",
    "sale_payments": """
SELECT txn_id AS dw_transaction_id, ship_dtm AS transaction_dtm, CASE WHEN disc_bp > 500 THEN -cents ELSE cents END AS payment_value, CONCAT('P', CAST(txn_id AS VARCHAR(20))) AS
  retrieval_ref_nbr FROM fare_base WHERE txn_id % 13 > 0
UNION ALL SELECT txn_id, CASE WHEN flag = 'N' THEN ship_dtm ELSE order_dtm END, disc_bp, 'second' FROM fare_base WHERE txn_id % 4 = 1""",
    "reads": """
SELECT txn_id AS tap_id, supp_id AS operator_key, part_id AS card_key FROM fare_base WHERE txn_id % 7 > 0
UNION ALL SELECT txn_id, supp_id, CAST(NULL AS BIGINT) FROM fare_base WHERE txn_id % 11 = 0""",
    "payg_channel_map": "SELECT * FROM txn_channel_map WHERE NOT (sales_channel_key = 14 AND payment_type_key = 4)",
}


def with_fares(sql: str, more: dict[str, str] | None = None) -> str:
    """``sql`` after all the expressions of FARES and ``more``; unused ones cost nothing."""
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in (FARES | (more or {})).items()) + "\n" + sql


_MADE: dict[tuple[str, str, str], str] = {}
#: Facts that a report reads once, so that writing their base first would only move all of it.
READ_ONCE = ("payment_summary",)
#: A fact that most reports join with itself by one key, under that key's name in its largest table and its own.
DEALT = {"fare_base": ("lineitem", "l_orderkey", "order_id")}
#: Facts that are views of one table, which is dealt to the buckets of a base by its key as it is read, before it
#: gets the many columns of the fact: its table, the key there, and the base.
DEALT_AS_READ = {"patron_order": ("orders", "o_orderkey", "fare_base")}
#: A bucket is a task's share of a join, so it is kept small beside a task's memory.
BUCKET_BYTES, MOST_BUCKETS = 4 << 20, 100_000


def _row_by_row(text: str) -> bool:
    """Does ``text`` only map and filter rows? Then it is read as a view of its source."""
    return not any(word in text for word in ("JOIN ", "DISTINCT ", "GROUP BY "))


def fare(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fact or dimension. What joins or groups is written once a session to the shared folder,
    in the columns of its text; what maps rows of that, or of the test tables, is a view of them, so
    that a report reads and computes only the columns and rows it needs, and copies none. What DEALT
    names is written in buckets of its key, so that its views meet by that key without being moved; the
    table of a fact in DEALT_AS_READ goes to these buckets in its own few columns. The base of a fact in READ_ONCE is joined as it is read, unless it has been written for others."""
    text, at = (FARES | PAYG)[name], (spark.sparkContext.applicationId, sf_dir, name)
    if name in DEALT_AS_READ:
        table, key, base = DEALT_AS_READ[name]
        return _dealt(spark, sf_dir, text, table, key, _buckets(spark, sf_dir, base))
    if _row_by_row(text):
        return _defined(spark, sf_dir, name, text)
    if not _written(spark, sf_dir, name):
        path = f"{scratch_dir(spark)}/{name}_{uuid.uuid4().hex}"
        if name in DEALT:
            _write_dealt(spark, sf_dir, name, path)
        else:
            _defined(spark, sf_dir, name, text).write.option("compression", "zstd").parquet(path)
        _MADE[at] = path
    return spark.read.table(_table(_MADE[at])) if name in DEALT else spark.read.parquet(_MADE[at])


def _table(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def _buckets(spark: SparkSession, sf_dir: str, name: str) -> int:
    """A number by the size of the largest table of a fact."""
    size = total_bytes(spark, f"{sf_dir}/{DEALT[name][0]}.parquet")
    return min(max(spark.sparkContext.defaultParallelism, math.ceil(size / BUCKET_BYTES)), MOST_BUCKETS)


def _dealt(spark: SparkSession, sf_dir: str, text: str, table: str, key: str, n: int) -> DataFrame:
    """What ``text`` makes of the test tables, one of which is dealt by a key as it is read."""
    register(spark, sf_dir, text)
    spark.table(table).repartition(n, key).createOrReplaceTempView(table)
    rows = spark.sql(text)
    register(spark, sf_dir, text)  # others read the table as it is
    return rows


def _write_dealt(spark: SparkSession, sf_dir: str, name: str, path: str) -> None:
    """Write the fact in buckets of its key. Its largest table is dealt by the key as it is read, so
    that its join leaves the rows in the tasks that write them."""
    source, source_key, key = DEALT[name]
    n = _buckets(spark, sf_dir, name)
    rows = _dealt(spark, sf_dir, FARES[name], source, source_key, n)
    rows.write.bucketBy(n, key).sortBy(key).format("parquet").option("compression", "zstd").option("path", path).saveAsTable(_table(path))


def _written(spark: SparkSession, sf_dir: str, name: str) -> bool:
    at = (spark.sparkContext.applicationId, sf_dir, name)
    return at in _MADE and exists(spark, _MADE[at])


def _defined(spark: SparkSession, sf_dir: str, name: str, text: str) -> DataFrame:
    for inner in ("txn_channel_map", "fare_base"):
        if inner in text and inner != name:
            as_read = name in READ_ONCE and not _written(spark, sf_dir, inner)
            (_defined(spark, sf_dir, inner, FARES[inner]) if as_read else fare(spark, sf_dir, inner)).createOrReplaceTempView(inner)
    register(spark, sf_dir, text)
    return spark.sql(text)
