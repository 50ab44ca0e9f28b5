"""More of the test tables as fare data: orders, unsettled items, clearing house, ledger
and service levels, as expressions that both Spark and the SQL oracle read. Keys and ids
of one dimension differ, some rows match nothing, and nulls stand where a feed has them."""

from __future__ import annotations

SOURCE = "CASE WHEN {0} % 2 = 0 THEN 'FARE' ELSE 'PIVOTAL' END"
DATE_KEY = "year({0}) * 10000 + month({0}) * 100 + day({0})"
#: Columns of cents: every such column is null for one line in eight.
MONEY = "CASE WHEN (txn_id + {1}) % 8 > 0 THEN (cents + {1} * 37) % 9000 END AS {0}"


def _money(*names: str) -> str:
    return ",\n  ".join(MONEY.format(name, k) for k, name in enumerate(names))


UNSETTLED_MONEY = (
    "transit_value", "pass_cost", "benefit_value", "bankcard_payment_value", "deposit_value", "administrative_fee", "replacement_fee", "shipping_fee", "refund_fee",
    "one_account_value", "discount_amount", "restricted_purse_value", "refundable_purse_value", "prepaid_bankcard_value", "overpay", "underpay", "uncollectible_amount",
    "post_pay_amount", "orig_sale_amt_paid_by_bv", "orig_sale_amt_paid_by_non_bv", "transaction_amount", "value_cash", "chargeback_amount", "chargeback_fee_amount",
)
PAYMENT_MONEY = (
    "product_value", "pass_cost", "transit_value", "benefit_value", "refundable_purse_value", "deposit_value", "replacement_fee", "administrative_fee", "shipping_fee",
    "card_fee", "enablement_fee", "one_account_value", "rounding_amount", "discount_amount", "refund_fee", "restricted_purse_value", "prepaid_bankcard_value",
)
SALE_MONEY = (
    "value_changed", "benefit_value", "refundable_purse_value", "pass_cost", "enablement_fee", "replacement_fee", "shipping_fee", "card_fee", "deposit_value",
    "administrative_fee", "net_value",
)
CLEARING_MONEY = (
    "administrative_fee", "bonus_added", "deposit", "replacement_fee", "sv_transaction", "benefit_value", "bankcard_payment_value", "net_value", "money_paid",
    "net_money_paid", "overpay", "underpay", "pass_cost", "shipping_fee", "payment_amount", "refund_fee", "pass_load_amt_paid_by_bv", "pass_load_amt_not_paid_by_bv",
    "one_account_value", "uncollectible_amount", "card_fee", "booking_prepaid_value", "discount_applied", "restricted_purse_value", "refundable_purse_value",
    "rounding_amount", "prepaid_bankcard_value", "post_pay_amount", "enablement_fee",
)

VENDOR = {
    "operators": """
SELECT s_suppkey AS operator_key, s_suppkey * 10 AS operator_id, CASE WHEN s_suppkey % 4 = 0 THEN 'Subway' ELSE s_name END AS operator_name,
  s_nationkey % 4 AS travel_mode_id FROM supplier""",
    "products": """
SELECT p_partkey AS fare_prod_key, p_name AS fare_prod_name, CASE WHEN p_partkey % 5 > 0 THEN p_brand END AS rider_class_name, p_size % 3 AS monetary_inst_type_id,
  CONCAT('kind ', CAST(p_size % 3 AS VARCHAR(2))) AS monetary_inst_type_name, p_partkey % 7 AS fare_prod_users_list_key
FROM part WHERE p_partkey % 9 > 0""",
    "payment_types": """
SELECT DISTINCT l_linenumber AS payment_type_key, l_linenumber + 1 AS payment_type_id, CONCAT('pay ', CAST(l_linenumber AS VARCHAR(2))) AS payment_type_name
FROM lineitem WHERE l_linenumber < 7""",
    "cards": """
SELECT p_partkey AS card_key, CONCAT('4', CAST(p_partkey % 1000 AS VARCHAR(4))) AS bin, CASE WHEN p_partkey % 3 > 0 THEN CONCAT('S', CAST(p_partkey AS VARCHAR(12))) END AS serial_nbr,
  CASE WHEN p_partkey % 4 > 0 THEN p_partkey END AS transit_account_key, CONCAT('T', CAST(p_partkey AS VARCHAR(12))) AS token_id, p_partkey * 3 AS pg_card_id,
  CASE p_partkey % 3 WHEN 0 THEN 'Card' WHEN 1 THEN 'Bank card' ELSE 'Phone' END AS media_type_name
FROM part""",
    "transit_accounts": """
SELECT c_custkey AS transit_account_key, c_custkey + 5000000 AS transit_account_id, CONCAT('rider ', CAST(c_nationkey AS VARCHAR(4))) AS rider_class_name,
  c_mktsegment AS account_status_name, c_custkey % 2 AS is_registered FROM customer""",
    "reasons": """
SELECT s_suppkey AS reason_key, CONCAT('reason ', s_name) AS reason_name, CAST(s_suppkey % 20 AS VARCHAR(4)) AS reason_code, CONCAT('type ', CAST(s_suppkey % 3 AS VARCHAR(2))) AS reason_type
FROM supplier WHERE s_suppkey % 5 > 0""",
    "devices": """SELECT s_suppkey AS device_key, CONCAT('place ', CAST(s_nationkey AS VARCHAR(4))) AS facility_name, CONCAT('D', CAST(s_suppkey AS VARCHAR(8))) AS device_id FROM supplier WHERE
  s_suppkey % 6 > 0""",
    "customers": "SELECT c_custkey AS customer_key, CONCAT('F', CAST(c_custkey AS VARCHAR(12))) AS fin_customer_id FROM customer WHERE c_custkey % 3 > 0",
    "business_entities": """
SELECT n_nationkey AS business_entity_key, n_nationkey + 100 AS business_entity_id, n_name AS business_entity_name, CONCAT('1 ', n_name) AS address_1, CAST(NULL AS VARCHAR(10)) AS address_2,
  CONCAT('city ', n_name) AS city, 'ST' AS state, n_name AS country, CAST(n_nationkey + 1000 AS VARCHAR(8)) AS postal_code FROM nation""",
    "employees": "SELECT s_suppkey AS employee_key, CAST(s_suppkey + 70000 AS VARCHAR(12)) AS employee_serial_nbr FROM supplier WHERE s_suppkey % 4 > 0",
    "csr_users": "SELECT s_suppkey AS user_id FROM supplier WHERE s_suppkey % 2 = 0",
    "csr_employees": """
SELECT s_suppkey AS rn_employee_user_id, s_suppkey + 1 AS employee_id, 'Ann' AS first_name, s_name AS last_name, CONCAT('descriptor ', s_name) AS rn_descriptor
FROM supplier WHERE s_suppkey % 3 > 0""",
    "order_types": """
SELECT s.source, y.order_type_name, y.order_type_enum, CASE WHEN y.order_type_name = 'Transfer' THEN 0 ELSE 1 END AS include_on_reports_flag,
  CASE WHEN y.order_type_name = 'Transfer' AND s.source = 'FARE' THEN 1 ELSE 0 END AS send_to_cch_flag
FROM (SELECT 'FARE' AS source UNION ALL SELECT 'PIVOTAL') s CROSS JOIN (
  SELECT 'Refund' AS order_type_name, 'Refund' AS order_type_enum UNION ALL SELECT 'Partial refund', 'Refund' UNION ALL SELECT 'Sale', 'Sale'
  UNION ALL SELECT 'Correction', 'TravelCorrection' UNION ALL SELECT 'Transfer', 'Transfer') y""",
    "order_type_dimension": "SELECT 1 AS patron_order_type_key, 'Transfer' AS order_type_enum UNION ALL SELECT 2, 'Sale'",
    "patron_order": f"""
SELECT o_orderkey AS dw_patron_order_id, o_orderkey AS order_nbr, {DATE_KEY.format('o_orderdate')} AS order_day_key, o_orderdate AS order_dtm, o_custkey AS patron_account_id,
  o_custkey % 5 AS sales_channel_key, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'P' THEN 3 ELSE 2 END AS patron_order_type_key, {SOURCE.format('o_custkey')} AS source,
  CASE o_orderkey % 5 WHEN 0 THEN 'Refund' WHEN 1 THEN 'Partial refund' WHEN 2 THEN 'Sale' WHEN 3 THEN 'Correction' ELSE 'Transfer' END AS order_type,
  CONCAT('desk ', CAST(o_custkey % 9 AS VARCHAR(2))) AS order_origin, CASE WHEN o_orderkey % 7 > 0 THEN o_custkey % 90 + 1 END AS device_key, CONCAT('O', CAST(o_orderkey AS
  VARCHAR(20))) AS retrieval_ref_nbr,
  CASE WHEN o_orderkey % 6 > 0 THEN o_orderkey % 9 END AS line_item_count, o_orderkey % 7000 AS order_total_product_value, o_orderkey % 700 AS order_total_deposit_value,
  o_orderkey % 11 AS order_total_replacement_fee, o_orderkey % 12 AS order_total_administrative_fee, o_orderkey % 13 AS order_total_shipping_fee,
  CASE WHEN o_orderkey % 14 > 0 THEN o_orderkey % 14 END AS order_total_card_fee, o_orderkey % 15 AS order_total_enablement_fee, o_orderkey % 9000 AS order_total_value,
  o_orderstatus AS order_status, o_custkey % 80 + 1 AS operator_key, o_custkey % 70 + 1 AS reason_key, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey % 60 + 1 END AS refund_reason_key,
  o_custkey % 50 + 1 AS created_by_user_id, o_orderdate AS order_completed_dtm, o_custkey % 40 + 1 AS employee_key,
  CASE o_orderkey % 3 WHEN 0 THEN CAST(o_custkey % 25 AS VARCHAR(8)) WHEN 1 THEN CONCAT('L', CAST(o_custkey % 25 AS VARCHAR(8))) END AS location_id,
  CASE o_orderkey % 4 WHEN 0 THEN 'Approved' WHEN 1 THEN 'Rejected' END AS review_approved_rejected, o_custkey % 30 + 1 AS review_assigned_to_user_id, o_orderdate AS review_approved_dtm,
  CASE WHEN o_orderkey % 8 < 2 THEN 0 WHEN o_orderkey % 8 < 4 THEN 1 END AS refund_is_opt_out, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS notes,
  CASE WHEN o_orderkey % 3 > 0 THEN 'sent' END AS collection_status, o_orderdate AS collection_date, o_orderkey % 3 AS submittal_count, CASE WHEN o_orderkey % 5 > 1 THEN o_custkey
  % 20 END AS approval_user_id,
  CASE WHEN o_orderkey % 6 > 1 THEN CONCAT('user ', CAST(o_custkey % 50 AS VARCHAR(4))) END AS inserted_user_id, CASE WHEN o_orderkey % 4 > 0 THEN 'Kim' END AS inserted_first_name,
  CONCAT('Lee ', CAST(o_custkey % 9 AS VARCHAR(2))) AS inserted_last_name
FROM orders""",
    "order_line_item": f"""
SELECT txn_id AS dw_patron_order_line_item_id, order_id AS dw_patron_order_id, line_no AS line_item_sequence, txn_id * 2 AS line_item_nbr, CASE WHEN txn_id % 10 > 0 THEN part_id END AS fare_prod_key,
  supp_id AS reason_key, operating_day_key, CAST(account_id AS VARCHAR(20)) AS subsystem_account_ref, CASE WHEN txn_id % 4 > 0 THEN CAST(supp_id AS VARCHAR(20)) END AS xfer_to_subsystem_account_ref,
  CASE txn_id % 3 WHEN 0 THEN 'ABP' WHEN 1 THEN 'CBO' END AS subsystem_enum, CASE WHEN txn_id % 5 > 0 THEN part_id END AS card_key, CASE WHEN txn_id % 6 = 0 THEN account_id END AS oa_account_id,
  supp_id * 10 AS travel_operator_id, supp_id AS responsible_operator_key, CASE WHEN line_no = 6 THEN 'Not Applicable' WHEN line_no < 4 THEN 'Passes' END AS product_group,
  CASE WHEN line_no = 5 THEN 'a name' END AS line_item_name, disc_bp AS item_total_discount_amount, cents AS line_item_amount, ship_dtm AS source_inserted_dtm, flag AS line_item_status,
  CASE WHEN txn_id % 9 = 0 THEN 'Refund Cash Overpayment' WHEN line_no = 1 THEN 'Cash Overpayment' WHEN line_no = 2 THEN 'Pass Removal' WHEN line_no = 3 THEN 'Refund Issue Media'
  WHEN line_no = 4 THEN 'Product Refund'
    WHEN line_no = 5 THEN 'Transit Account Trip Fare Adjustment' WHEN line_no = 6 THEN 'Transit Account Trip Void' ELSE 'Product Sale' END AS line_item_type,
  CASE WHEN txn_id % 11 = 0 THEN 'Enroll' END AS autoload_enroll_action, CASE WHEN txn_id % 7 = 0 THEN CONCAT('B', CAST(txn_id AS VARCHAR(20))) END AS ticket_or_book_id, txn_id % 1000 AS pass_id,
  CASE WHEN txn_id % 3 = 0 THEN 'Pretax Purse' WHEN txn_id % 3 = 1 THEN 'Purse' END AS purse_type, account_id % 25 AS account_rider_class_id, account_id % 30 AS purse_sku,
  'restricted' AS subsystem_purse_restriction, CASE WHEN txn_id % 8 = 0 THEN txn_id END AS pg_card_id, CASE WHEN txn_id % 5 = 0 THEN 'line note' END AS notes,
  CONCAT('from ', CAST(account_id % 25 AS VARCHAR(4))) AS origin_stop_point_desc, CONCAT('to ', CAST(supp_id % 25 AS VARCHAR(4))) AS destination_stop_point_desc
FROM fare_base WHERE txn_id % 37 > 0""",
    "order_payment": f"""
SELECT txn_id * 4 AS dw_patron_order_payment_id, txn_id * 2 AS dw_transaction_id, txn_id AS dw_patron_order_line_item_id, order_id AS dw_patron_order_id, settlement_day_key,
  CASE WHEN line_no < 3 THEN 1 ELSE line_no END AS payment_type_key, cents AS payment_amount, CASE WHEN txn_id % 6 > 0 THEN CONCAT('R', CAST(txn_id AS VARCHAR(20))) END AS retrieval_ref_nbr,
  CASE txn_id % 4 WHEN 0 THEN -9 WHEN 1 THEN 5 ELSE 7 END AS transaction_category, CAST(account_id AS VARCHAR(20)) AS subsystem_account_ref, CASE txn_id % 3 WHEN 0 THEN 'ABP' ELSE
  'CBO' END AS subsystem_enum,
  {_money(*PAYMENT_MONEY)}
FROM fare_base
UNION ALL SELECT txn_id * 4 + 1, txn_id * 2 + 1, txn_id, order_id, settlement_day_key, 1, -disc_bp, 'cash returned', 5, CAST(account_id AS VARCHAR(20)), 'ABP', {', '.join(['0'] * len(PAYMENT_MONEY))}
FROM fare_base WHERE line_no = 1 AND disc_bp > 300""",
    "product_sale": f"""
SELECT txn_id AS dw_transaction_id, ship_dtm AS transaction_dtm, CASE WHEN txn_id % 3 > 0 THEN txn_id END AS dw_patron_order_line_item_id, account_id % 5 AS sales_channel_key, supp_id AS device_key,
  CASE line_no WHEN 1 THEN 21 WHEN 2 THEN 23 WHEN 3 THEN 30 WHEN 4 THEN 31 ELSE 20 END AS sale_type_key, CASE WHEN txn_id % 10 > 0 THEN part_id END AS fare_prod_key, supp_id AS reason_key,
  account_id AS customer_key, account_id AS transit_account_id, operating_day_key, settlement_day_key, settlement_day_key AS posting_day_key, CASE WHEN txn_id % 5 > 0 THEN disc_bp
  END AS discount_amount,
  CASE WHEN txn_id % 6 > 0 THEN tax_bp END AS product_commission_amount, disc_bp AS fee_commission_amount FROM fare_base""",
    "product_sale_payment": f"""
SELECT txn_id AS dw_transaction_id, ship_dtm AS transaction_dtm, 1 + txn_id % 4 AS payment_type_key, cents AS payment_value, CONCAT('P', CAST(txn_id AS VARCHAR(20))) AS retrieval_ref_nbr,
  {_money(*SALE_MONEY)}
FROM fare_base WHERE txn_id % 13 > 0""",
    "unsettled": f"""
SELECT txn_id AS transaction_id, order_id AS order_nbr, line_no AS line_item_nbr, CASE WHEN flag = 'N' THEN 'OPEN' ELSE 'HELD' END AS settlement_state, settlement_day_key AS posting_day_key,
  CASE WHEN line_no > 1 THEN ship_dtm END AS ready_for_settlement_dtm, order_dtm AS transaction_dtm, order_dtm AS event_dtm, order_dtm AS msg_dtm, CAST(ship_dtm AS DATE) AS capture_date,
  CAST(ship_dtm AS DATE) AS bank_settlement_date, part_id AS fare_prod_key, supp_id * 10 AS operator_id, supp_id AS operator_key, line_no AS payment_type_key, account_id AS transit_account_id,
  CASE WHEN disc_bp > 0 THEN disc_bp END AS pass_id, txn_id % 4 AS pass_use_count, CASE WHEN txn_id % 7 > 0 THEN supp_id END AS device_id, account_id % 30 AS purse_sku,
  CASE WHEN line_no = 1 THEN 24 ELSE line_no END AS sale_type_key, supp_id AS reason_key, account_id % 6 AS crdb_chgbk_activity_type_id, CONCAT('R', CAST(txn_id AS VARCHAR(20))) AS retrieval_ref_nbr,
  CONCAT('M', CAST(supp_id AS VARCHAR(8))) AS merchant_number, CONCAT('kind ', CAST(line_no AS VARCHAR(2))) AS credit_card_type, CONCAT('E', CAST(supp_id AS VARCHAR(8))) AS equipment_name,
  CONCAT('text ', flag) AS txn_desc, flag AS order_origin, flag AS order_status, CONCAT('S', CAST(part_id AS VARCHAR(12))) AS serial_nbr, CONCAT('C', CAST(txn_id AS VARCHAR(20)))
  AS chargeback_ref_nbr,
  txn_id * 5 AS dw_cbx_tracking_id, CASE WHEN txn_id % 3 = 0 THEN account_id END AS payment_transit_account_id,
  {_money(*UNSETTLED_MONEY)}
FROM fare_base""",
    "clearing": f"""
SELECT txn_id AS dw_transaction_id, txn_id * 7 AS transaction_id, line_no AS transaction_category, CASE WHEN txn_id % 10 > 0 THEN part_id END AS fare_prod_key, line_no AS payment_type_key,
  supp_id % 25 AS route_key, supp_id % 30 + 100 AS business_entity_id, supp_id % 30 AS settlement_business_entity_id, line_no * 4 AS sale_type_key, txn_id % 4 AS processing_type_id,
  txn_id % 6 AS credit_card_type_id, txn_id % 5 AS transaction_origin_id, supp_id AS categorization_rule_id, CASE txn_id % 5 WHEN 0 THEN 'U' WHEN 1 THEN 'S' WHEN 2 THEN 'O' WHEN 3
  THEN 'X' ELSE 'M' END AS transaction_type_id,
  part_id % 4 AS media_type_id, account_id % 25 AS rider_class_id, account_id % 30 AS purse_sku, supp_id * 10 AS operator_id, CAST(order_dtm AS DATE) AS summary_period,
  account_id % 25 AS boarding_stop_key, (account_id + 3) % 25 AS alighting_stop_key, CASE WHEN line_no > 2 THEN disc_bp END AS pass_id, txn_id % 3 AS pass_use_count, supp_id AS device_id,
  line_no AS load_type_id, ship_dtm AS transaction_dtm, CONCAT('u', flag) AS user_ref_1, CAST(NULL AS VARCHAR(4)) AS user_ref_2, flag AS user_ref_3, CONCAT('M', CAST(supp_id AS
  VARCHAR(8))) AS merchant_number,
  CAST(ship_dtm AS DATE) AS capture_date, CAST(ship_dtm AS DATE) AS bank_settlement_date, line_no AS activity_type_id, txn_id * 3 AS transaction_ref_nbr, CONCAT('R', CAST(txn_id AS
  VARCHAR(20))) AS retrieval_ref_nbr,
  account_id AS transit_account_id, account_id + 1 AS payment_transit_account_id, CAST(order_dtm AS DATE) AS operating_date, order_id AS order_nbr, line_no AS line_item_nbr, flag AS use_type,
  {_money(*CLEARING_MONEY)}
FROM fare_base""",
    "categories": "SELECT DISTINCT l_linenumber AS transaction_category, CONCAT('category ', CAST(l_linenumber AS VARCHAR(2))) AS category_name FROM lineitem WHERE l_linenumber < 7",
    "reprocess_actions": "SELECT r_regionkey AS reprocess_action_id, r_name AS short_desc FROM region WHERE r_regionkey < 3",
    "credit_card_types": "SELECT r_regionkey AS cpa_credit_card_type_id, CONCAT('credit ', r_name) AS credit_card_type_name FROM region",
    "transaction_origins": "SELECT r_regionkey AS transaction_origin_key, CONCAT('origin ', r_name) AS transaction_origin_name FROM region WHERE r_regionkey > 0",
    "categorization_rules": "SELECT s_suppkey AS rule_id, CONCAT('rule ', s_name) AS rule_name FROM supplier WHERE s_suppkey % 3 > 0",
    "transaction_types": "SELECT 'U' AS transaction_type_id, 'use' AS description UNION ALL SELECT 'S', 'sale' UNION ALL SELECT 'M', 'misc'",
    "media_types": """
SELECT DISTINCT p_partkey % 3 AS media_type_key, p_partkey % 3 + 1 AS media_type_id, CONCAT('media ', CAST(p_partkey % 3 AS VARCHAR(2))) AS media_type_name,
  CASE WHEN p_partkey % 3 = 1 THEN 1 ELSE 0 END AS payg_flag FROM part""",
    "ride_types": "SELECT r_regionkey AS ride_type_key, CONCAT('ride ', r_name) AS ride_type_name FROM region",
    "txn_statuses": "SELECT n_nationkey + 30 AS txn_status_key, n_name AS txn_status_name, n_nationkey % 2 AS successful_use_flag FROM nation WHERE n_nationkey % 6 > 0",
    "service_types": "SELECT r_regionkey AS service_type_id, CONCAT('service ', r_name) AS service_type_name FROM region",
    "taps": """
SELECT event_id AS tap_id, ts AS transaction_dtm, user_id AS device_id, CONCAT('P', CAST(user_id % 9 AS VARCHAR(2))) AS device_prefix, CONCAT('T', CAST(user_id AS VARCHAR(12))) AS token_id,
  user_id AS transit_account_id, user_id % 20 * 10 AS operator_id, event_id * 2 AS transaction_id, event_id % 6 AS tap_status_id, event_type AS tap_status_desc, event_id % 2 AS unmatched_flag,
  CASE WHEN event_id % 3 > 0 THEN event_id END AS trip_id, user_id % 4 AS sector_id, ts + INTERVAL '1' HOUR AS voidable_until_dtm, event_id * 5 AS dw_transaction_id, ts AS source_inserted_dtm
FROM events""",
    "journal": """
SELECT o_orderkey AS voucher, o_orderdate AS accounting_date, CASE WHEN o_orderkey % 3 = 0 THEN 'OTHER' ELSE 'MAIN' END AS ledger_name, o_custkey AS ledger_account,
  CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 5000 END AS txn_currency_debit_amount, CASE WHEN o_orderkey % 2 = 1 THEN o_orderkey % 5000 END AS txn_currency_credit_amount,
  CONCAT('account ', CAST(o_custkey % 9 AS VARCHAR(2))) AS external_account_name, CONCAT(o_orderstatus, '|', o_orderpriority, '||', CAST(o_custkey AS VARCHAR(20))) AS description FROM orders""",
    "rule_sets": "SELECT r_regionkey AS cch_rules_set_id, r_name AS cch_rules_set_name FROM region WHERE r_regionkey < 4",
    "gl_rules": """
SELECT s_suppkey AS rule_id, s_name AS rule_name, CASE WHEN s_suppkey % 2 = 0 THEN 1 WHEN s_suppkey % 3 = 0 THEN 0 END AS negative_amount_flag, s_nationkey AS rule_from_account_id,
  (s_nationkey + 7) % 25 AS rule_to_account_id, CONCAT('E', CAST(s_nationkey % 2 AS VARCHAR(2))) AS legal_entity_code FROM supplier""",
    "gl_rule_map": """
SELECT s.s_suppkey AS rule_id, s.s_suppkey % 5 AS cch_rules_set_id, c.transaction_category
FROM supplier s CROSS JOIN (SELECT DISTINCT l_linenumber AS transaction_category FROM lineitem) c WHERE (s.s_suppkey + c.transaction_category) % 3 > 0""",
    "gl_accounts": """
SELECT n_nationkey AS account_id, CONCAT('E', CAST(e.code AS VARCHAR(2))) AS legal_entity_code, CONCAT(n_name, ' ', CAST(e.code AS VARCHAR(2))) AS account_name, CONCAT('holder ',
  n_name) AS account_holder
FROM nation CROSS JOIN (SELECT 0 AS code UNION ALL SELECT 1) e WHERE (n_nationkey + e.code) % 9 > 0""",
    "gl_summary": """
SELECT txn_id AS gl_posting_id, supp_id AS rule_id, supp_id % 5 AS cch_rules_set_id, line_no AS transaction_category, CASE WHEN txn_id % 3 = 0 THEN -cents WHEN txn_id % 50 = 1 THEN
  0 ELSE cents END AS amount,
  ship_dtm AS posted_dtm, CAST(order_dtm AS DATE) AS summary_period, txn_id % 4 AS gl_summary_record_status_key, txn_id % 5 AS processing_type_id, flag AS user_ref_1, CAST(NULL AS
  VARCHAR(4)) AS user_ref_2,
  CONCAT('x', flag) AS user_ref_3, CONCAT('E', CAST(supp_id % 2 AS VARCHAR(2))) AS legal_entity_code FROM fare_base WHERE supp_id % 4 > 0""",
    "gl_statuses": "SELECT r_regionkey AS gl_summary_record_status_key, r_name AS gl_summary_record_stats_name FROM region WHERE r_regionkey < 3",
    "kpis": """
SELECT kpi_id, CONCAT('name ', kpi_id) AS kpi_name, CASE k % 3 WHEN 0 THEN 'minutes' WHEN 1 THEN 'events' END AS units,
  CASE k % 8 WHEN 0 THEN 'TOT' WHEN 1 THEN '%' WHEN 2 THEN 'AVG' WHEN 3 THEN '%Last' WHEN 4 THEN '%Base' WHEN 5 THEN 'Days' WHEN 6 THEN 'Each Day' ELSE '%' END AS kpi_type,
  CASE k % 6 WHEN 0 THEN 2 WHEN 1 THEN 9 WHEN 2 THEN 8 WHEN 3 THEN 4 WHEN 4 THEN 1 END AS metric_category_id, 40 + k AS base_qty, CASE WHEN k % 17 = 0 THEN k END AS deduction_basis_id,
  CASE WHEN k % 7 = 0 THEN 'sum/avg' WHEN k % 7 = 1 THEN 'max/sum' WHEN k % 7 = 2 THEN 'min' WHEN k % 7 = 3 THEN 'A1-1' WHEN k % 7 = 4 THEN 'P2-2' END AS grouped
FROM (SELECT DISTINCT CONCAT(CASE WHEN event_id % 3 = 0 THEN 'P' ELSE 'A' END, CAST(1 + event_id % 4 AS VARCHAR(2)), '-', CAST(1 + user_id % 19 AS VARCHAR(2))) AS kpi_id,
    1 + event_id % 4 + 5 * (user_id % 19) AS k FROM events WHERE event_id % 3 < 2
  UNION SELECT '6a', 3 FROM region UNION SELECT 'P2-20', 8 FROM region) x""",
    "kpi_by_day": f"""
SELECT CONCAT(CASE WHEN event_id % 3 = 0 THEN 'P' ELSE 'A' END, CAST(1 + event_id % 4 AS VARCHAR(2)), '-', CAST(1 + user_id % 19 AS VARCHAR(2))) AS kpi_id, {DATE_KEY.format('ts')} AS transit_day_key,
  CAST(sum(round(value * 100)) AS BIGINT) AS kpi_value, CAST(sum(event_id % 3) AS BIGINT) AS kpi_quantity
FROM events WHERE event_id % 3 < 2 GROUP BY CONCAT(CASE WHEN event_id % 3 = 0 THEN 'P' ELSE 'A' END, CAST(1 + event_id % 4 AS VARCHAR(2)), '-', CAST(1 + user_id % 19 AS
  VARCHAR(2))), {DATE_KEY.format('ts')}""",
    "kpi_events": f"""
SELECT CASE WHEN event_id % 29 = 0 THEN '6a' ELSE CONCAT(CASE WHEN event_id % 3 = 0 THEN 'P' ELSE 'A' END, CAST(1 + event_id % 4 AS VARCHAR(2)), '-', CAST(1 + user_id % 19 AS
  VARCHAR(2))) END AS kpi_id,
  {DATE_KEY.format('ts')} AS transit_day_key, event_id AS availability_event_id, CONCAT('place ', CAST(user_id % 8 AS VARCHAR(2))) AS facility_name, user_id % 30 AS bus_id, user_id
  AS device_id, ts AS start_dtm,
  ts + INTERVAL '2' HOUR AS end_dtm, CAST(round(value * 100) AS BIGINT) AS kpi_value, CAST(round(value * 130) AS BIGINT) AS gross_daily_value, event_id % 5 AS relief_value,
  CASE WHEN event_id % 4 = 0 THEN 999 ELSE event_id % 4 END AS failure_level, event_type AS fault_description, event_type, event_id % 50 AS performance_time_basis, user_id % 12 AS root_cause_id,
  CASE event_id % 7 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' WHEN 3 THEN 'D' WHEN 4 THEN 'E' WHEN 5 THEN 'PTT' END AS location_category, event_id % 7 AS base_cure_period,
  event_id % 8 AS base_recurrence_period, event_id % 9 AS cure_period, event_id % 10 AS recurrence_period, event_id % 4 AS recurrence_count, event_id % 4 AS excluded
FROM events WHERE event_id % 3 < 2
UNION ALL SELECT 'P2-20', {DATE_KEY.format('ts')}, event_id, 'twice', 0, user_id, ts, ts, 500, 600, 0, 999, 'twice', event_type, 5, 1, 'E', 1, 1, 1, 1, 1, 1 FROM events WHERE event_id % 40 < 2
UNION ALL SELECT 'P2-20', {DATE_KEY.format('ts')}, event_id, 'twice', 0, user_id, ts, ts, 500, 600, 0, 999, 'twice', event_type, 5, 1, 'E', 1, 1, 1, 1, 1, 1 FROM events WHERE event_id % 40 = 0""",
    "kpi_targets": """
SELECT k.kpi_id, b.band AS kpi_band, b.low AS kpi_minimum, b.high AS kpi_maximum, CASE WHEN k.n % 2 = 0 THEN '%' ELSE '$' END AS kpi_deduction_type, b.value + k.n AS kpi_deduction_value
FROM (SELECT DISTINCT CONCAT(CASE WHEN event_id % 3 = 0 THEN 'P' ELSE 'A' END, CAST(1 + event_id % 4 AS VARCHAR(2)), '-', CAST(1 + user_id % 19 AS VARCHAR(2))) AS kpi_id, user_id %
  19 AS n FROM events WHERE event_id % 3 < 2) k
CROSS JOIN (SELECT 'A' AS band, 0 AS low, 4000 AS high, 1000 AS value UNION ALL SELECT 'B', 4001, 90000, 500 UNION ALL SELECT 'C', 90001, 100000, 0 UNION ALL SELECT 'D', 100001,
  999999999, 90) b WHERE k.n < 17""",
    "kpi_calendar": f"""
SELECT DISTINCT {DATE_KEY.format('ts')} AS date_key, CAST(ts AS DATE) AS dtm, month(ts) AS month_nbr, year(ts) AS year, CASE WHEN month(ts) = 1 THEN 'January' WHEN month(ts) = 2
  THEN 'February' ELSE 'later' END AS month_desc FROM events""",
}
