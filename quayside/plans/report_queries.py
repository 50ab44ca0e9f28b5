"""Queries for the reports, with their SQL."""

from __future__ import annotations

from quayside.plans.fares import PAYG, fare, with_fares
from quayside.reports import orders, revenue, service_levels, settlement

REPORTS = {
    "wc700_comp_a": revenue.component_a,
    "wc700_comp_b": revenue.component_b,
    "wc700_comp_c": revenue.component_c,
    "wc700_comp_d": revenue.component_d,
    "edw_farerev_payg_trip_txn": revenue.trip_revenue,
    "farerev_payg_trip_txn_a_v2": revenue.trip_revenue_addendum,
    "farerev_payg_trip_txn_c_v2": revenue.trip_revenue_computation,
    "comp_b_addendum": revenue.component_b_addendum,
    "wc320_late_tap_adjustment": revenue.late_tap_adjustment,
    "farerev_recovery_txn_a": revenue.recovery_addendum,
    "farerev_recovery_txn_c": revenue.recovery_computation,
    "wc232_acq_conf": settlement.unsettled_confirmations,
    "wc232_sys_conf": settlement.unsettled_system_confirmations,
    "wc232_device_cash_stc": settlement.unsettled_device_cash,
    "wc232_misc": settlement.unsettled_misc,
    "wc232_patron_order": settlement.unsettled_orders,
    "wc232_payment_rejection": settlement.unsettled_chargebacks,
    "wc232_refund_sale": settlement.unsettled_refunds,
    "wc232_sale": settlement.unsettled_sales,
    "wc232_use": settlement.unsettled_uses,
    "wa160": settlement.use_transactions,
    "ad_hoc_processed_taps": settlement.processed_taps,
    "wo118": settlement.product_transfers,
    "ad_hoc_journal_entries": settlement.journal_entries,
    "wc210": settlement.ledger_summary,
    "wsp630": service_levels.outages_in,
    "wsp611_operation_performance": service_levels.operation_performance,
    "wsp611_system_availability": service_levels.system_availability,
    "wsp620_availability": service_levels.availability_events,
    "wsp620_performance": service_levels.performance_events,
    "comp_a_txn_a": orders.product_sales_addendum,
    "comp_a_txn_c": orders.product_sales_computation,
    "wo110": orders.order_lines,
    "wo150": orders.adjustments,
    "wc231_clearing_house": orders.clearing_house,
    "wc231_pass_id_adhoc": orders.clearing_house_passes,
}


def _query(report):
    return lambda spark, sf_dir: report(lambda name: fare(spark, sf_dir, name))


#: The same trips with a channel map that lacks one payment type of the adjustments.
ADJUSTED = {
    "edw_farerev_payg_trip_txn_adjusted": revenue.trip_revenue,
    "farerev_payg_trip_txn_a_v2_adjusted": revenue.trip_revenue_addendum,
    "farerev_payg_trip_txn_c_v2_adjusted": revenue.trip_revenue_computation,
}


def _adjusted(report):
    return lambda spark, sf_dir: report(lambda name: fare(spark, sf_dir, "payg_channel_map" if name == "txn_channel_map" else name))


QUERIES = {name: _query(report) for name, report in REPORTS.items()}
QUERIES |= {name: _adjusted(report) for name, report in ADJUSTED.items()}

SUMMARY = "settlement_day_key, operating_day_key, payment_type_key, txn_channel_display, sales_channel_display"
JOIN = "FROM payment_summary JOIN txn_channel_map USING (txn_source, sales_channel_key, payment_type_key)"
STORED = "coalesce(transit_value, 0) + coalesce(benefit_value, 0) + coalesce(bankcard_payment_value, 0) + coalesce(one_account_value, 0)"
RULE = """((p.je_is_fare_adjustment = 0 AND u.ride_type_key <> 24 AND p.is_reversal = 1 AND u.fare_due < 0) OR (p.je_is_fare_adjustment = 0 AND u.ride_type_key <> 24 AND p.is_reversal = 0
  AND u.fare_due > 0) OR (p.je_is_fare_adjustment = 1 AND u.ride_type_key = 24))"""
CHARGED = "(u.bankcard_payment_value <> 0 OR u.uncollectible_amount <> 0 OR u.value_changed <> 0)"
USES = """FROM use_txn u JOIN patron_trip tr ON tr.patron_trip_id = u.patron_trip_id AND tr.source = u.source JOIN trip_payment p ON p.patron_trip_id = u.patron_trip_id AND p.source =
  u.source AND p.trip_price_count = u.trip_price_count"""
EXTENSION = "CASE WHEN u.transfer_sequence_nbr > 0 AND u.fare_due <> 0 THEN 'Transfer' END"
RAW = """p.bankcard_value + CASE WHEN p.bankcard_payment_id IS NOT NULL OR payg_flag = 1 THEN p.uncollectible_amount ELSE 0 END
  + CASE WHEN s.purse_load_id IS NOT NULL AND payg_flag = 1 THEN p.stored_value ELSE 0 END"""
DAY = "strptime({0}::VARCHAR, '%Y%m%d')"


def _days(table: str) -> str:
    return ", ".join(f"{DAY.format(f'{table}.{role}_day_key')} AS {role}_date" for role in ("operating", "posting", "settlement"))


def _trips(channels: str = "txn_channel_map") -> str:
    """Taps, and adjustment sales; the channel map is a parameter."""
    return f"""SELECT m.txn_channel_display, 'B' AS computation_type, {_days('g')}, g.transaction_dtm, operator_name, g.device_id, g.dw_transaction_id, g.transit_account_id, g.patron_trip_id,
  NULL AS tap_id,
  g.fare_rule_description, g.transfer_sequence_nbr, y.payment_type_name, bin, -raw AS fare_revenue, extension_charge_reason, g.ref AS retrieval_ref_nbr, y.payment_type_key,
  g.operating_day_key, g.settlement_day_key, g.posting_day_key
FROM (SELECT u.operating_day_key, u.settlement_day_key, u.posting_day_key, u.transaction_dtm, u.device_id, u.dw_transaction_id, u.transit_account_id, u.patron_trip_id,
  u.transfer_sequence_nbr, u.operator_key, u.card_key,
    b.retrieval_ref_nbr AS ref, fare_rule_description, {EXTENSION} AS extension_charge_reason, sum({RAW})::BIGINT AS raw
  {USES} LEFT JOIN sale_txn s ON s.purse_load_id = p.purse_load_id AND s.sale_type_key = 26
  LEFT JOIN sale_txn b ON b.bankcard_payment_id = p.bankcard_payment_id AND b.sale_type_key = 20 AND b.bankcard_payment_type_key IN (1, 2, 3)
  JOIN media_types k ON k.media_type_key = u.media_type_key WHERE {RULE} AND {CHARGED} GROUP BY ALL HAVING sum({RAW}) <> 0) g
LEFT JOIN cards c ON c.card_key = g.card_key LEFT JOIN operators o ON o.operator_key = g.operator_key
CROSS JOIN (SELECT * FROM payment_types WHERE payment_type_key = 2) y CROSS JOIN (SELECT * FROM {channels} WHERE txn_source = 'UseTxn' AND sales_channel_key = 8 AND payment_type_key = 2) m
UNION ALL
SELECT m.txn_channel_display, 'B', {_days('s')}, s.transaction_dtm, operator_name, s.device_id, s.dw_transaction_id, s.transit_account_id, NULL, s.tap_id, NULL, NULL,
  y.payment_type_name, bin, sp.payment_value::BIGINT,
  NULL, sp.retrieval_ref_nbr, y.payment_type_key, s.operating_day_key, s.settlement_day_key, s.posting_day_key
FROM sale_adjustments s JOIN sale_payments sp USING (dw_transaction_id, transaction_dtm) JOIN media_types k ON k.media_type_key = s.media_type_key AND k.payg_flag = 1
JOIN {channels} m ON m.txn_source = 'UseTxn' AND m.sales_channel_key = 14 AND m.payment_type_key = CASE WHEN s.reason_key IN (990951, 990961) THEN 2 ELSE 4 END
JOIN payment_types y ON y.payment_type_key = m.payment_type_key LEFT JOIN reads r ON r.tap_id = s.tap_id LEFT JOIN operators o ON o.operator_key = r.operator_key LEFT JOIN cards c
  ON c.card_key = r.card_key
WHERE s.operating_day_key IS NOT NULL AND s.sale_type_key = 22 AND s.reason_key IN (990951, 990961, 990952, 990962)"""


MODE = """* EXCLUDE (operator_name, fare_revenue, payment_type_key), CASE WHEN operator_name = 'Subway' THEN 'Transit' ELSE operator_name END AS transit_mode_name,
  round(fare_revenue / 100, 2) AS fare_revenue"""
RECOVERY = """SELECT 'C' AS computation_type, od.dtm AS operating_date, t.transaction_dtm, pd.dtm AS posting_date, sd.dtm AS settlement_date, service_type_name, coalesce(stop_point_name,
  route_name) AS location,
  device_id, source_table_uk AS transaction_id, tap_id, trip_id, rider_class_name, fare_prod_name, fare_rule_description, recovery_txn_type, incident_id, supervening_event,
  round(minimum_fare_charge / 100, 2) AS recovery_calculation_amount, operating_day_key, settlement_day_key, posting_day_key
FROM recovery_txn t JOIN calendar od ON od.date_key = operating_day_key JOIN calendar pd ON pd.date_key = posting_day_key JOIN calendar sd ON sd.date_key = settlement_day_key
LEFT JOIN service_types USING (service_type_id) LEFT JOIN stop_points USING (stop_point_key) LEFT JOIN routes USING (route_key) LEFT JOIN rider_classes USING (rider_class_id)
LEFT JOIN (SELECT fare_prod_key, fare_prod_name FROM products WHERE monetary_inst_type_id = 2) USING (fare_prod_key)"""
ADDENDUM = """JOIN (SELECT DISTINCT due_day_key, adden_max_operating_day_key, adden_min_settlement_day_key, adden_max_settlement_day_key, deposit_due_day_key FROM schedule)
  ON operating_day_key <= adden_max_operating_day_key AND settlement_day_key BETWEEN adden_min_settlement_day_key AND adden_max_settlement_day_key"""
COMPUTATION = """JOIN (SELECT due_day_key, comp_operating_day_key, comp_max_settlement_day_key FROM schedule)
  ON operating_day_key = comp_operating_day_key AND settlement_day_key <= comp_max_settlement_day_key"""
NO_SCHEDULE_A = "EXCLUDE (due_day_key, adden_max_operating_day_key, adden_min_settlement_day_key, adden_max_settlement_day_key, deposit_due_day_key)"
NO_SCHEDULE_C = "EXCLUDE (due_day_key, comp_operating_day_key, comp_max_settlement_day_key)"


def _scheduled(rows: str, columns: str, join: str, drop: str, flag: str) -> str:
    return f"SELECT {columns} FROM (SELECT due_day_key AS report_due_day_key, '{flag}' AS addendum, * {drop} FROM ({rows}) r {join})"


def _money(*columns: str, table: str = "") -> str:
    return ", ".join(f"coalesce({table}{c}, 0) / 100 AS {c}" for c in columns)


def _plain(*columns: str, table: str = "") -> str:
    return ", ".join(f"{table}{c} / 100 AS {c}" for c in columns)


PRODUCT = "LEFT JOIN products USING (fare_prod_key)"
OPERATOR = "LEFT JOIN operators o ON o.operator_id = u.operator_id"
PAYMENT_TYPE = "LEFT JOIN payment_types y ON y.payment_type_key = u.payment_type_key"
PURSE = "LEFT JOIN purses USING (purse_sku)"
REASON = "LEFT JOIN reasons USING (reason_key)"
POSTED = DAY.format("posting_day_key") + " AS posting_day_key"

ORDER_SALES = """SELECT m.txn_channel_display, m.sales_channel_display, 'A' AS computation_type, od.dtm AS operating_date, o.order_dtm AS transaction_dtm, li.source_inserted_dtm::DATE AS
  posting_date, sd.dtm AS settlement_date,
  dd.facility_name, dd.device_id, p.dw_transaction_id AS transaction_id, NULL::VARCHAR AS group_account_id, li.subsystem_account_ref AS transit_account_id, o.order_nbr, 1 AS quantity,
  li.line_item_sequence AS order_line_item_sequence, y.payment_type_name, CASE WHEN p.payment_type_key = 1 THEN p.payment_amount ELSE 0 END AS cash_received,
  CASE WHEN p.payment_type_key = 1 AND li.line_item_type = 'Cash Overpayment' THEN -back.amount ELSE 0 END AS cash_returned,
  CASE WHEN p.payment_type_key <> 1 THEN 0 WHEN li.line_item_type = 'Cash Overpayment' THEN p.payment_amount + back.amount ELSE p.payment_amount END AS net_cash,
  coalesce(li.item_total_discount_amount, 0) AS discount_amount, p.transit_value AS v, p.benefit_value AS b, p.refundable_purse_value AS r, p.pass_cost AS pc, p.enablement_fee AS
  ef, p.replacement_fee AS rf,
  p.shipping_fee AS sf, p.card_fee AS cf, p.deposit_value AS dv, p.administrative_fee AS af, p.payment_amount AS paid, p.product_value AS pv, fare_prod_name, 0 AS
  retail_commission_amount, p.retrieval_ref_nbr,
  li.line_item_status, li.line_item_type, reason_name, li.operating_day_key, p.settlement_day_key
FROM order_payment p JOIN order_line_item li USING (dw_patron_order_line_item_id) JOIN patron_order o ON o.dw_patron_order_id = li.dw_patron_order_id
JOIN txn_channel_map m ON m.sales_channel_key = o.sales_channel_key AND m.payment_type_key = p.payment_type_key JOIN calendar od ON od.date_key = li.operating_day_key JOIN calendar
  sd ON sd.date_key = p.settlement_day_key
LEFT JOIN devices dd ON dd.device_key = o.device_key JOIN payment_types y ON y.payment_type_key = p.payment_type_key LEFT JOIN products fp ON fp.fare_prod_key = li.fare_prod_key
  LEFT JOIN reasons rd ON rd.reason_key = li.reason_key
LEFT JOIN (SELECT dw_patron_order_line_item_id AS line, sum(payment_amount)::BIGINT AS amount FROM order_payment WHERE retrieval_ref_nbr = 'cash returned' GROUP BY 1) back ON
  back.line = p.dw_patron_order_line_item_id
WHERE m.txn_group = 'Product Sales' AND m.txn_source IN ('SalesOrder', 'RefundOrder') AND lower(o.order_type) NOT LIKE '%refund%' AND coalesce(p.retrieval_ref_nbr, '.') <> 'cash returned'
  AND (p.transaction_category <> -9 OR o.order_type IN ('Sale', 'Refund'))"""
DEVICE_SALES = """SELECT m.txn_channel_display, m.sales_channel_display, 'A', od.dtm, st.transaction_dtm, pd.dtm, sd.dtm, dd.facility_name, dd.device_id, st.dw_transaction_id, fin_customer_id,
  st.transit_account_id::VARCHAR, po.order_nbr, 1,
  li.line_item_sequence, y.payment_type_name, CASE WHEN sp.payment_type_key = 1 THEN sp.payment_value ELSE 0 END, 0, CASE WHEN sp.payment_type_key = 1 THEN sp.payment_value ELSE 0
  END, coalesce(st.discount_amount, 0),
  sp.value_changed, sp.benefit_value, sp.refundable_purse_value, sp.pass_cost, sp.enablement_fee, sp.replacement_fee, sp.shipping_fee, sp.card_fee, sp.deposit_value,
  sp.administrative_fee, sp.payment_value, sp.net_value,
  fare_prod_name, coalesce(product_commission_amount, 0) + coalesce(fee_commission_amount, 0), sp.retrieval_ref_nbr, li.line_item_status, li.line_item_type, reason_name,
  st.operating_day_key, st.settlement_day_key
FROM product_sale st JOIN product_sale_payment sp ON sp.dw_transaction_id = st.dw_transaction_id AND sp.transaction_dtm = st.transaction_dtm
LEFT JOIN order_line_item li ON li.dw_patron_order_line_item_id = st.dw_patron_order_line_item_id LEFT JOIN patron_order po ON po.dw_patron_order_id = li.dw_patron_order_id
JOIN txn_channel_map m ON m.txn_group = 'Product Sales' AND m.sales_channel_key = st.sales_channel_key AND m.payment_type_key = sp.payment_type_key
  AND (m.txn_source IN ('SalesTxn', 'RefundTxn') OR (m.txn_source = 'SalesOrder' AND li.line_item_type = 'Refund Cash Overpayment'))
JOIN calendar od ON od.date_key = st.operating_day_key JOIN calendar sd ON sd.date_key = st.settlement_day_key JOIN calendar pd ON pd.date_key = st.posting_day_key LEFT JOIN
  devices dd ON dd.device_key = st.device_key
JOIN payment_types y ON y.payment_type_key = sp.payment_type_key LEFT JOIN products fp ON fp.fare_prod_key = st.fare_prod_key LEFT JOIN reasons rd ON rd.reason_key = st.reason_key
LEFT JOIN customers c ON c.customer_key = st.customer_key WHERE st.sale_type_key IN (21, 30, 31, 23)"""
PRODUCT_SALES = f"""SELECT * EXCLUDE (v, b, r, pc, ef, rf, sf, cf, dv, af, paid, pv, fare_prod_name), vs + bs + rs + pcs + efs AS fare_revenue,
  CASE WHEN fare_prod_name IS NULL AND (v <> 0 OR b <> 0 OR r <> 0) THEN 'Stored Value' ELSE fare_prod_name END AS fare_product, vs AS transit_value, bs AS benefit_value, rs AS refundable_purse_value,
  vs + bs + rs AS total_stored_value, pcs AS pass_cost, efs AS enablement_fee, coalesce(rf, 0) AS replacement_fee, coalesce(pv, 0) AS product_value,
  coalesce(paid, 0) - (pcs + vs + bs + rs + efs + coalesce(rf, 0) + coalesce(sf, 0) + coalesce(cf, 0) + coalesce(dv, 0) + coalesce(af, 0)) AS overpayment
FROM (SELECT *, coalesce(v, 0) AS vs, coalesce(b, 0) AS bs, coalesce(r, 0) AS rs, coalesce(pc, 0) AS pcs, coalesce(ef, 0) AS efs FROM ({ORDER_SALES} UNION ALL {DEVICE_SALES}))"""
SALE_DOLLARS = "DISTINCT * EXCLUDE (vs, bs, rs, pcs, efs) REPLACE (" + ", ".join(f"round({c} / 100, 2) AS {c}" for c in orders.SALE_CENTS) + ")"

DETAIL = """SELECT o.*, li.*, p.*, tad.transit_account_id AS card_account_id, CASE ot.order_type_enum WHEN 'TravelCorrection' THEN li.travel_operator_id ELSE coalesce(lo.operator_id,
  oo.operator_id) END AS detail_operator_id,
  CASE WHEN o.order_type = 'Refund' THEN rr.reason_name ELSE rd.reason_name END AS reason, CASE WHEN o.order_type = 'Refund' THEN coalesce(o.refund_reason_key, li.reason_key) ELSE
  o.reason_key END AS detail_reason_key,
  CASE WHEN li.card_key IS NULL AND li.subsystem_account_ref IS NOT NULL AND li.subsystem_enum IS NOT NULL THEN li.subsystem_account_ref || '(' || substr(li.subsystem_enum, 1, 1) || ')'
    WHEN tad.transit_account_id IS NOT NULL THEN tad.transit_account_id::VARCHAR || '(A)' WHEN cd.serial_nbr IS NOT NULL THEN cd.serial_nbr || '(C)'
    WHEN li.oa_account_id IS NOT NULL THEN li.oa_account_id::VARCHAR || '(O)' END AS card_or_account_number,
  coalesce(tad.transit_account_id, li.subsystem_account_ref::BIGINT) AS detail_account_id, cd.serial_nbr, cd.token_id, cd.media_type_name, coalesce(li.pg_card_id, cd.pg_card_id) AS detail_pg_card_id,
  CASE WHEN li.product_group = 'Not Applicable' THEN li.product_group ELSE coalesce(fp.fare_prod_name, li.line_item_name, li.product_group, 'Unknown') END AS product_description, fp.fare_prod_name,
  y.payment_type_name, coalesce(li.ticket_or_book_id, li.pass_id::VARCHAR) AS detail_pass_id, coalesce(fp.rider_class_name, rc.rider_class_name, tad.rider_class_name) AS rider_class_name,
  coalesce(pu.purse_name, li.subsystem_purse_restriction) AS purse_name, business_entity_name, address_1, address_2, city, state, country, postal_code,
  CASE WHEN p.subsystem_enum = 'ABP' THEN p.subsystem_account_ref END AS payment_transit_account_id, coalesce(o.notes, li.notes) AS adjustment_notes, li.operating_day_key AS
  line_day, p.settlement_day_key AS paid_day,
  CASE WHEN o.review_approved_rejected = 'Approved' THEN o.review_assigned_to_user_id END AS approved_by_user_id, o.retrieval_ref_nbr AS order_ref, li.line_item_type AS plain_type,
  CASE WHEN li.autoload_enroll_action IS NOT NULL THEN li.line_item_type || ' (' || li.autoload_enroll_action || ')' ELSE li.line_item_type END AS kind
FROM patron_order o LEFT JOIN order_line_item li ON li.dw_patron_order_id = o.dw_patron_order_id
LEFT JOIN order_payment p ON p.dw_patron_order_line_item_id = li.dw_patron_order_line_item_id AND p.dw_patron_order_id = li.dw_patron_order_id
LEFT JOIN operators oo ON oo.operator_key = o.operator_key LEFT JOIN operators lo ON lo.operator_key = li.responsible_operator_key LEFT JOIN products fp ON fp.fare_prod_key = li.fare_prod_key
LEFT JOIN reasons rd ON rd.reason_key = o.reason_key LEFT JOIN reasons rr ON rr.reason_key = coalesce(o.refund_reason_key, li.reason_key) LEFT JOIN payment_types y ON
  y.payment_type_key = p.payment_type_key
LEFT JOIN cards cd ON cd.card_key = li.card_key LEFT JOIN transit_accounts tad ON tad.transit_account_key = cd.transit_account_key
LEFT JOIN order_types ot ON ot.source = o.source AND ot.order_type_name = o.order_type LEFT JOIN rider_classes rc ON rc.rider_class_id = li.account_rider_class_id LEFT JOIN purses
  pu ON pu.purse_sku = li.purse_sku
LEFT JOIN business_entities be ON be.business_entity_key = try_cast(o.location_id AS INT) AND translate(o.location_id, 'x0123456789', 'x') IS NULL
WHERE (ot.include_on_reports_flag = 1 OR ot.send_to_cch_flag = 1) AND (NOT (o.order_type = 'Refund' AND o.source = 'PIVOTAL') OR (o.review_approved_rejected = 'Approved' AND
  coalesce(o.refund_is_opt_out, 0) = 0))"""
LINES = f"""SELECT 'WO110' AS report, {DAY.format('paid_day')} AS sales_settlement_date, order_dtm AS order_date, order_origin, order_nbr AS order_number, coalesce(line_item_count, 0) AS
  line_item_count,
  {_plain('order_total_product_value', 'order_total_deposit_value', 'order_total_value')},
  (order_total_replacement_fee + order_total_administrative_fee + order_total_shipping_fee + order_total_card_fee + order_total_enablement_fee) / 100 AS order_total_fees_value,
  order_status, kind AS line_item_type,
  media_type_name, card_or_account_number, product_description, payment_type_name AS payment_type, {_money('product_value')}, {_plain('deposit_value', 'replacement_fee', 'administrative_fee')},
  payment_amount / 100 AS line_item_total_value, line_item_status, line_item_sequence, shipping_fee / 100 AS line_item_shipping_fee, line_item_nbr AS order_detail_id,
  coalesce(reason, 'N/A') AS reason, collection_status,
  collection_date, submittal_count, coalesce(detail_account_id, 0) AS transit_account_id, card_fee / 100 AS line_item_card_fee, enablement_fee / 100 AS line_item_enablement_fee,
  replacement_fee / 100 AS line_item_replacement_fee, detail_pg_card_id AS pg_card_id, rider_class_name, {_money('discount_amount')}, business_entity_name, address_1 AS business_entity_address_1,
  address_2 AS business_entity_address_2, city AS business_entity_city, state AS business_entity_state, country AS business_entity_country, postal_code AS
  business_entity_postal_code, {_money('refund_fee')},
  detail_pass_id AS pass_id, employee_serial_nbr::BIGINT AS employee_serial_nbr, oa_account_id, coalesce(one_account_value, 0) / 100 AS line_item_one_account_value,
  coalesce(rounding_amount, 0) / 100 AS line_item_rounding_amount, destination_stop_point_desc, origin_stop_point_desc, {_money('prepaid_bankcard_value')},
  payment_transit_account_id, token_id, serial_nbr,
  {DAY.format('line_day')} AS operating_day, coalesce(operator_name, 'Undefined') AS operator_name, order_ref AS retrieval_ref_nbr
FROM ({DETAIL}) d LEFT JOIN employees e ON e.employee_key = d.employee_key JOIN operators w ON w.operator_id = d.detail_operator_id"""
ADJUSTMENT_LINES = f"""SELECT 'WO150' AS report, order_status, coalesce(reason, 'N/A') AS reason, coalesce(CASE WHEN upper(purse_type) = 'PRETAX PURSE' THEN 'Benefit Value' ELSE purse_type END,
  'Undefined') AS purse_type,
  {_money('product_value')}, coalesce(line_item_count, 0) AS line_item_count, coalesce(operator_name, 'Undefined') AS operator_name, order_dtm AS order_date,
  card_or_account_number, order_nbr AS order_number,
  CASE WHEN inserted_first_name || inserted_last_name IS NULL THEN inserted_first_name || ' ' || inserted_last_name ELSE coalesce(inserted_user_id, e.first_name || ' ' ||
  e.last_name) END AS inserted_by,
  review_approved_dtm AS approved_dtm, order_completed_dtm, fare_prod_name, x.reason_type, {_money('pass_cost', 'transit_value', 'benefit_value')}, adjustment_notes, order_origin,
  coalesce(approval_user_id::VARCHAR, a.rn_descriptor) AS approval_user_id, {DAY.format('paid_day')} AS sales_settlement_date, kind AS line_item_type, detail_pg_card_id AS
  pg_card_id, rider_class_name, media_type_name, purse_name,
  {_money('restricted_purse_value')}, CASE WHEN plain_type IN ('Transit Account Trip Fare Adjustment', 'Transit Account Trip Void', 'Transit Account Tap Void',
  'Transit Account Trip Correction') THEN line_item_amount / 100 ELSE 0 END AS line_item_amount,
  product_description, {_money('refundable_purse_value', 'prepaid_bankcard_value')}, order_ref AS retrieval_ref_nbr
FROM ({DETAIL}) d LEFT JOIN csr_users c ON c.user_id = d.created_by_user_id LEFT JOIN csr_employees e ON e.rn_employee_user_id = c.user_id JOIN operators w ON w.operator_id = d.detail_operator_id
JOIN calendar k ON k.date_key = d.order_day_key LEFT JOIN csr_employees a ON a.employee_id = d.approved_by_user_id LEFT JOIN reasons x ON x.reason_key = d.detail_reason_key
WHERE kind LIKE '%Adjustment%' OR kind IN ('Pass Removal', 'Pass Conversion', 'Transit Account Trip Correction', 'Transit Account Trip Void', 'Transit Account Tap Void') OR (kind
  LIKE '%Refund%' AND kind <> 'Refund Issue Media')"""

CLEARING_COLUMNS = f"""category_name, payment_type_name, route_name AS route_designator_desc, monetary_inst_type_name, f.business_entity_name AS responsible_business_entity_name, be.business_entity_name,
  sale_type_name, short_desc,
  credit_card_type_name, transaction_origin_name, rule_id, rule_name, description, mt.media_type_name, r.rider_class_name, purses.purse_name, {', '.join('c.' + x for x in orders.CLEARING_OWN)},
  CASE WHEN fare_prod_name IS NULL AND c.sv_transaction IS NOT NULL THEN 'Transit Value' ELSE fare_prod_name END AS fare_prod_name,
  CASE c.transaction_type_id WHEN 'U' THEN c.sv_transaction + c.benefit_value + c.bankcard_payment_value WHEN 'S' THEN c.net_value ELSE c.sv_transaction END / 100 AS transaction_value,
  CASE WHEN (c.transaction_type_id = 'U' AND c.pass_use_count = 1) OR c.transaction_type_id IN ('S', 'O', 'M') THEN c.pass_cost / 100 ELSE 0 END AS pass_cost, tt.transaction_type_id,
  {_plain(*orders.CLEARING_PLAIN, table='c.')}, {_money('refund_fee', 'card_fee', 'discount_applied', 'refundable_purse_value', table='c.')}"""
CLEARING_JOINS = """FROM clearing c JOIN categories g USING (transaction_category) LEFT JOIN products p USING (fare_prod_key) LEFT JOIN payment_types USING (payment_type_key) LEFT JOIN routes USING
  (route_key)
LEFT JOIN business_entities be ON be.business_entity_id = c.business_entity_id LEFT JOIN business_entities f ON f.business_entity_key = c.settlement_business_entity_id LEFT JOIN
  sale_types USING (sale_type_key)
LEFT JOIN reprocess_actions ON reprocess_action_id = c.processing_type_id LEFT JOIN credit_card_types ON cpa_credit_card_type_id = c.credit_card_type_id LEFT JOIN
  transaction_origins ON transaction_origin_key = c.transaction_origin_id
LEFT JOIN categorization_rules ON rule_id = c.categorization_rule_id LEFT JOIN transaction_types tt ON tt.transaction_type_id = c.transaction_type_id LEFT JOIN media_types mt ON
  mt.media_type_id = c.media_type_id
LEFT JOIN rider_classes r ON r.rider_class_id = c.rider_class_id LEFT JOIN purses USING (purse_sku)"""

LEDGER = f"""WITH rules AS (
  SELECT m.rule_id, m.cch_rules_set_id, m.transaction_category, rule_name, coalesce(negative_amount_flag, 0) = 1 AS negative, x.account_id AS to_id, x.account_name AS to_name,
  x.account_holder AS to_holder,
    y.account_id AS from_id, y.account_name AS from_name, y.account_holder AS from_holder
  FROM gl_rule_map m JOIN rule_sets USING (cch_rules_set_id) JOIN gl_rules r USING (rule_id) JOIN gl_accounts x ON x.account_id = r.rule_to_account_id AND x.legal_entity_code = r.legal_entity_code
  JOIN gl_accounts y ON y.account_id = r.rule_from_account_id AND y.legal_entity_code = r.legal_entity_code),
sided AS (
  SELECT *, CASE WHEN negative THEN from_id ELSE to_id END AS d_id, CASE WHEN negative THEN from_name ELSE to_name END AS d_name, CASE WHEN negative THEN from_holder ELSE to_holder END AS d_holder,
    CASE WHEN negative THEN to_id ELSE from_id END AS c_id, CASE WHEN negative THEN to_name ELSE from_name END AS c_name, CASE WHEN negative THEN to_holder ELSE from_holder END AS
  c_holder FROM rules),
posted AS (
  SELECT s.*, g.* EXCLUDE (rule_id, cch_rules_set_id, transaction_category), g.transaction_category AS posted_category, (negative AND amount > 0) OR (NOT negative AND amount < 0) AS swap
  FROM sided s LEFT JOIN gl_summary g ON g.rule_id = s.rule_id AND g.cch_rules_set_id = s.cch_rules_set_id AND g.transaction_category = s.transaction_category)
SELECT 'WC210' AS report, c.transaction_category AS category_id, category_name, rule_id AS apportionment_rule_id, rule_name AS apportionment_rule_name, legal_entity_code AS legal_entity,
  CASE WHEN swap THEN c_id ELSE d_id END AS debit_account_number, CASE WHEN swap THEN c_name ELSE d_name END AS debit_account_name, CASE WHEN swap THEN c_holder ELSE d_holder END
  AS debit_account_holder,
  CASE WHEN swap THEN d_id ELSE c_id END AS credit_account_number, CASE WHEN swap THEN d_name ELSE c_name END AS credit_account_name, CASE WHEN swap THEN d_holder ELSE c_holder END
  AS credit_account_holder,
  abs(amount / 100) AS absolute_value_amount, gl_posting_id AS record_id, user_ref_1, user_ref_2, user_ref_3, quarter(k.dtm) AS quarter, posted_dtm,
  CASE WHEN gl_posting_id IS NULL THEN 'Ignored-$0' ELSE gl_summary_record_stats_name END AS gl_record_status_name, short_desc AS processing_type, CASE WHEN negative THEN 'Y' ELSE
  'N' END AS negative_amount_rule, k.dtm AS date
FROM posted p LEFT JOIN categories c ON c.transaction_category = p.posted_category LEFT JOIN calendar k ON k.dtm = p.summary_period LEFT JOIN gl_statuses USING (gl_summary_record_status_key)
LEFT JOIN reprocess_actions ON reprocess_action_id = p.processing_type_id"""

JANUARY = "JOIN kpi_calendar ON date_key = transit_day_key AND month_desc = 'January' AND year = 2024"
PLACE = """CASE WHEN location_category IN ('A', 'B', 'C', 'D') THEN location_category WHEN kpi_id IN ('P1-18', 'P2-19.1', 'P2-19.2', 'P2-20', 'P3-21') AND failure_level = 999 THEN 'PTT' ELSE location_category END"""
PERFORMANCE = f"""SELECT 'January-2024' AS run_date, s.kpi_id, kpi_name, place AS location_category, n AS total_quantity, round(mean, 1) AS average_resolution, cure_period, units, recurrence_periods,
  CASE WHEN place IN ('A', 'B', 'C', 'D', 'PTT') AND e.due IS NOT NULL THEN e.due ELSE s.due END AS deduction_amount
FROM (SELECT d.kpi_id, kpi_name, units, sum(kpi_value)::BIGINT / 100 AS due FROM kpi_by_day d {JANUARY} JOIN kpis k ON k.kpi_id = d.kpi_id AND coalesce(grouped, 'xxx') NOT LIKE
  'sum%' WHERE metric_category_id = 8 GROUP BY ALL) s
LEFT JOIN (SELECT kpi_id, {PLACE} AS place, count(*) AS n, avg(performance_time_basis) AS mean, max(base_cure_period) AS cure_period, sum(recurrence_count)::BIGINT AS
  recurrence_periods, sum(kpi_value)::BIGINT / 100 AS due
  FROM kpi_events {JANUARY} GROUP BY ALL) e ON e.kpi_id = s.kpi_id"""
AVAILABILITY = f"""WITH base AS (
  SELECT d.kpi_id, kpi_name, kpi_type, units, metric_category_id, base_qty, grouped, sum(kpi_value)::BIGINT AS measured, sum(kpi_quantity)::BIGINT AS total_qty,
    max(CASE WHEN kpi_quantity > 0 THEN transit_day_key ELSE 0 END) AS last_day_key
  FROM kpi_by_day d {JANUARY} JOIN kpis k ON k.kpi_id = d.kpi_id AND deduction_basis_id IS NULL AND (metric_category_id <> 8 OR metric_category_id IS NULL) GROUP BY ALL),
child AS (
  SELECT k.kpi_id, CASE WHEN k.grouped LIKE 'max%' THEN max(measured) WHEN k.grouped LIKE 'min%' THEN min(measured) ELSE sum(measured)::BIGINT END AS measured,
    CASE WHEN k.grouped LIKE '%/avg' THEN avg(total_qty) ELSE sum(total_qty)::DOUBLE END AS total_qty
  FROM base b JOIN kpis k ON k.kpi_id = b.grouped GROUP BY k.kpi_id, k.grouped),
parent AS (
  SELECT b.* EXCLUDE (measured, total_qty), CASE WHEN substr(b.grouped, 1, 3) IN ('sum', 'max', 'min') THEN coalesce(c.measured, b.measured) ELSE b.measured END AS measured,
    CASE WHEN substr(b.grouped, 1, 3) IN ('sum', 'max', 'min') THEN coalesce(c.total_qty, b.total_qty) ELSE b.total_qty END AS total_qty
  FROM base b LEFT JOIN child c ON c.kpi_id = b.kpi_id),
against AS (
  SELECT p.* EXCLUDE (measured, total_qty, kpi_type), CASE WHEN kpi_type[1] = '%' THEN '%' ELSE kpi_type END AS kind, CASE kpi_type WHEN '%Last' THEN l.kpi_value ELSE measured END AS measured,
    CASE kpi_type WHEN '%Last' THEN l.kpi_quantity WHEN '%Base' THEN base_qty ELSE total_qty END AS total_qty
  FROM parent p LEFT JOIN kpi_by_day l ON l.kpi_id = p.kpi_id AND l.transit_day_key = p.last_day_key),
figured AS (
  SELECT a.*, t.kpi_minimum AS a_min, t.kpi_maximum AS a_max, t.kpi_band AS a_band, t.kpi_deduction_value AS a_due,
    CASE WHEN kind IN ('TOT', 'Each Day', 'Days') THEN measured WHEN total_qty > 0 AND kind = '%' AND metric_category_id IN (2, 4, 8) THEN round((1 - measured / total_qty) * 100000, 0)
      WHEN total_qty > 0 AND kind = '%' THEN round(measured / total_qty * 100000, 0) WHEN total_qty > 0 AND kind = 'AVG' THEN measured / total_qty WHEN kind = '%' AND t.kpi_minimum = 0 THEN 0
      WHEN kind = '%' THEN 100000 ELSE 0 END AS kpi
  FROM against a LEFT JOIN kpi_targets t ON t.kpi_id = a.kpi_id AND t.kpi_band = 'A')
SELECT 'January-2024' AS run_date, f.kpi_id, kpi_name, total_qty, measured AS measured_value, units,
  round((CASE WHEN a_min = 0 THEN a_max ELSE a_min END) / CASE WHEN kind = '%' THEN 1000 ELSE 1 END, 2) AS threshold_value,
  round(CASE WHEN kind = '%' THEN round(kpi / 1000, 3) ELSE round(kpi) END, 2) AS kpi_value, CASE WHEN metric_category_id = 9 AND total_qty = 0 THEN a_band ELSE b.kpi_band END AS band,
  CASE WHEN b.kpi_deduction_type = '%' THEN round((CASE WHEN metric_category_id = 9 AND total_qty = 0 THEN a_due ELSE b.kpi_deduction_value END) / 1000, 3)
    ELSE b.kpi_deduction_value END AS sim
FROM figured f LEFT JOIN kpi_targets b ON b.kpi_id = f.kpi_id AND kpi BETWEEN b.kpi_minimum AND b.kpi_maximum"""
EVENTS = f"""(SELECT DISTINCT dtm AS transit_day, e.*, CASE excluded WHEN 1 THEN 'Yes' WHEN 2 THEN 'Excluded' ELSE 'No' END AS exception, units FROM kpi_events e {JANUARY} JOIN kpis k ON
  k.kpi_id = e.kpi_id
  WHERE e.kpi_id NOT IN ('1', '2', '5', '6a', '8a', '8b'))"""

SQL = {
    "wc700_comp_a": f"""SELECT {SUMMARY}, sum({STORED})::BIGINT / 100 AS stored_value, sum(coalesce(pass_cost, 0))::BIGINT / 100 AS pass_cost, sum(coalesce(enablement_fee, 0))::BIGINT / 100 AS
  enablement_fee, sum({STORED} + coalesce(pass_cost, 0) + coalesce(enablement_fee, 0) + coalesce(replacement_fee, 0))::BIGINT / 100 AS total_fare_revenue {JOIN} WHERE txn_group =
  'Product Sales' GROUP BY {SUMMARY}""",
    "wc700_comp_b": f"SELECT {SUMMARY}, sum(coalesce(payment_value, 0))::BIGINT / 100 AS total_fare_revenue {JOIN} WHERE txn_group = 'Open Payment Trips' GROUP BY {SUMMARY}",
    "wc700_comp_c": """SELECT settlement_day_key, operating_day_key, c.rider_class_name, fare_prod_name, service_type_id, fare_rule_description, recovery_txn_type, sum(minimum_fare_charge)::BIGINT / 100
  AS recovery_calculation_amount FROM recovery_txn LEFT JOIN rider_classes c USING (rider_class_id) LEFT JOIN products p USING (fare_prod_key) WHERE monetary_inst_type_id = 2 AND
  minimum_fare_charge IS NOT NULL GROUP BY ALL""",
    "wc700_comp_d": f"""SELECT {SUMMARY}, reason_name, sum(payment_value)::BIGINT / 100 AS refund_value {JOIN} LEFT JOIN reasons USING (reason_key) WHERE txn_group = 'Direct Refunds Applied' GROUP BY
  {SUMMARY}, reason_name""",
    "wo118": """SELECT 'WO118' AS report, order_day_key, order_dtm, order_nbr, patron_account_id, subsystem_account_ref AS source_transit_account, xfer_to_subsystem_account_ref AS
  target_transit_account, pass_id, value_changed / 100 AS stored_value, refundable_purse_value / 100 AS refundable_purse_value, benefit_value / 100 AS benefit_value,
  sales_channel_name
FROM patron_order JOIN order_lines USING (dw_patron_order_id) JOIN sale_txn USING (dw_patron_order_line_item_id) JOIN channels USING (sales_channel_key) JOIN order_type_dimension
  USING (patron_order_type_key) WHERE order_type_enum = 'Transfer' AND sale_txn.reason_key = 990508""",
    "wsp630": """SELECT * FROM (SELECT operator_name, facility_name, bus_id, failure_level, fault_description, root_cause_id, location_category, deadline_dtm, availability_event_id, device_id,
  event_type, coalesce(outage_begin_dtm, open_dtm) AS outage_begin, coalesce(outage_end_dtm, close_dtm) AS outage_end, CASE WHEN excluded = 1 THEN 'Yes' ELSE 'No' END AS
  event_excluded FROM outages)
WHERE outage_end >= TIMESTAMP '2024-01-10 00:00:00' AND outage_begin <= TIMESTAMP '2024-01-20 23:59:59'""",
    "comp_a_txn_a": _scheduled(PRODUCT_SALES, SALE_DOLLARS, ADDENDUM, NO_SCHEDULE_A, "Y"),
    "comp_a_txn_c": _scheduled(PRODUCT_SALES, SALE_DOLLARS, COMPUTATION, NO_SCHEDULE_C, "N"),
    "wo110": LINES,
    "wo150": ADJUSTMENT_LINES,
    "wc231_clearing_house": f"""SELECT {CLEARING_COLUMNS}, {_money('rounding_amount', 'prepaid_bankcard_value', 'post_pay_amount', table='c.')}, b.stop_point_name AS boarding_stop_point_display_desc,
  a.stop_point_name AS alighting_stop_point_display_desc, {', '.join('c.' + x for x in orders.CLEARING_LATER)}, operator_name, year(k.dtm) AS year, k.dtm
{CLEARING_JOINS} LEFT JOIN operators o ON o.operator_id = c.operator_id LEFT JOIN calendar k ON k.dtm = c.summary_period
LEFT JOIN stop_points b ON b.stop_point_key = c.boarding_stop_key LEFT JOIN stop_points a ON a.stop_point_key = c.alighting_stop_key""",
    "wc231_pass_id_adhoc": f"SELECT {CLEARING_COLUMNS}, u.pass_id {CLEARING_JOINS} LEFT JOIN use_txn u ON u.transaction_id = c.transaction_id",
    "comp_b_addendum": f"""SELECT u.dw_transaction_id, u.transit_account_id, u.operating_day_key AS operating_date, u.posting_day_key AS posting_date, u.settlement_day_key AS settlement_date,
  u.transaction_dtm, u.patron_trip_id,
  fare_rule_description, u.transfer_sequence_nbr, bin, -(p.bankcard_value + CASE WHEN p.bankcard_payment_id IS NOT NULL THEN p.uncollectible_amount ELSE 0 END
    + CASE WHEN s.purse_load_id IS NOT NULL THEN p.stored_value ELSE 0 END) AS fare_revenue, {EXTENSION} AS extension_charge_reason, u.retrieval_ref_nbr
{USES} JOIN cards c ON c.card_key = u.card_key LEFT JOIN sale_txn s ON s.purse_load_id = p.purse_load_id
WHERE s.sale_type_key = 26 AND {CHARGED} AND ((p.journal_entry_type_id <> 131 AND p.is_reversal = 1 AND u.txn_status_key IN (36, 59))
  OR (p.journal_entry_type_id <> 131 AND p.is_reversal = 0 AND u.txn_status_key NOT IN (36, 59, 50)) OR (p.journal_entry_type_id = 131 AND u.ride_type_key = 24))""",
    "wc320_late_tap_adjustment": f"""SELECT s.settlement_day_key, s.operating_day_key, u.patron_trip_id, u.trip_price_count, p.is_reversal, u.token_id, s.purse_load_id, -p.stored_value / 100 AS uncollectible_amount,
  p.transaction_dtm,
  u.transit_account_id, travel_mode_name
FROM sale_txn s JOIN trip_payment p ON p.purse_load_id = s.purse_load_id JOIN patron_trip tr ON tr.patron_trip_id = p.patron_trip_id
JOIN use_txn u ON u.patron_trip_id = p.patron_trip_id AND u.trip_price_count = p.trip_price_count
LEFT JOIN operators o ON o.operator_key = u.operator_key LEFT JOIN travel_modes m ON m.travel_mode_id = o.travel_mode_id WHERE s.sale_type_key = 26 AND u.value_changed <> 0 AND {RULE}""",
    "farerev_recovery_txn_a": _scheduled(RECOVERY, "*", ADDENDUM, NO_SCHEDULE_A, "Y"),
    "farerev_recovery_txn_c": _scheduled(RECOVERY, "*", COMPUTATION, NO_SCHEDULE_C, "N"),
    "wc232_acq_conf": f"""SELECT posting_day_key, settlement_state, merchant_number, credit_card_type, equipment_name, capture_date, bank_settlement_date, transaction_id, retrieval_ref_nbr,
  {_money('transaction_amount')},
  transit_account_id FROM unsettled""",
    "wc232_sys_conf": f"""SELECT settlement_state, posting_day_key, merchant_number, credit_card_type, equipment_name, capture_date, msg_dtm AS transaction_dtm, transaction_id, retrieval_ref_nbr,
  {_money('transaction_amount')},
  transit_account_id FROM unsettled""",
    "wc232_device_cash_stc": f"SELECT {_money('value_cash')}, event_dtm, device_id, dw_cbx_tracking_id, ready_for_settlement_dtm, {POSTED}, settlement_state FROM unsettled",
    "wc232_misc": f"""SELECT settlement_state, {POSTED}, ready_for_settlement_dtm, txn_desc, operator_name, payment_type_name, fare_prod_name, transit_account_id, pass_id, {_money('pass_cost')},
  pass_use_count
FROM unsettled u {PRODUCT} {OPERATOR} {PAYMENT_TYPE}""",
    "wc232_patron_order": f"""SELECT posting_day_key, ready_for_settlement_dtm, order_origin, transaction_dtm, order_nbr, line_item_nbr, order_status, fare_prod_name, payment_type_name,
  {_money('deposit_value', 'pass_cost', 'transit_value', 'benefit_value', 'administrative_fee', 'replacement_fee', 'shipping_fee', 'refund_fee')}, transit_account_id, serial_nbr,
  operator_name, reason_code, reason_name,
  pass_id, settlement_state, {_money('one_account_value', 'discount_amount')}, purse_name, {_money('restricted_purse_value', 'refundable_purse_value', 'prepaid_bankcard_value')},
  retrieval_ref_nbr, payment_transit_account_id
FROM unsettled u {REASON} LEFT JOIN operators o ON o.operator_key = u.operator_key {PRODUCT} {PURSE} LEFT JOIN payment_types y ON y.payment_type_id = u.payment_type_key""",
    "wc232_payment_rejection": f"""SELECT settlement_state, {POSTED}, ready_for_settlement_dtm, chargeback_ref_nbr, chgbk_activity_type_name, {_money('chargeback_amount', 'chargeback_fee_amount')},
  retrieval_ref_nbr,
  merchant_number, credit_card_type, transaction_id, transit_account_id FROM unsettled LEFT JOIN chargeback_kinds USING (crdb_chgbk_activity_type_id)""",
    "wc232_refund_sale": f"""SELECT settlement_state, posting_day_key, ready_for_settlement_dtm, operator_name, transaction_dtm, transaction_id, device_id, payment_type_name, fare_prod_name,
  {_money('deposit_value', 'pass_cost', 'transit_value', 'benefit_value', 'orig_sale_amt_paid_by_bv', 'orig_sale_amt_paid_by_non_bv')}, order_nbr, transit_account_id, purse_name,
  {_money('restricted_purse_value', 'refund_fee', 'prepaid_bankcard_value')}, retrieval_ref_nbr, payment_transit_account_id
FROM unsettled u {OPERATOR} {PRODUCT} {PAYMENT_TYPE} {PURSE} WHERE sale_type_key = 24""",
    "wc232_sale": f"""SELECT settlement_state, device_id, fare_prod_name, operator_name, payment_type_name, transaction_dtm,
  {_money('administrative_fee', 'deposit_value', 'replacement_fee', 'overpay', 'transit_value', 'underpay', 'benefit_value', 'bankcard_payment_value', 'pass_cost', 'shipping_fee', 'one_account_value')},
  transaction_id,
  sale_type_name, ready_for_settlement_dtm, posting_day_key, order_nbr, transit_account_id, reason_code, pass_id, purse_name, retrieval_ref_nbr, payment_transit_account_id,
  {_money('uncollectible_amount', 'discount_amount', 'restricted_purse_value', 'refundable_purse_value', 'prepaid_bankcard_value')}
FROM unsettled u {PRODUCT} {OPERATOR} {PAYMENT_TYPE} LEFT JOIN sale_types USING (sale_type_key) {REASON} {PURSE} WHERE u.device_id IS NOT NULL""",
    "wc232_use": f"""SELECT DISTINCT settlement_state, transit_account_id, pass_id, operator_name, fare_prod_name, device_id, serial_nbr, pass_use_count, posting_day_key, ready_for_settlement_dtm,
  transaction_dtm, purse_name, retrieval_ref_nbr,
  {_money('transit_value', 'benefit_value', 'bankcard_payment_value', 'pass_cost', 'uncollectible_amount', 'restricted_purse_value', 'post_pay_amount', 'refundable_purse_value', 'prepaid_bankcard_value')},
  coalesce(one_account_value, 0) / 100 AS one_account_amount FROM unsettled u {OPERATOR} {PRODUCT} {PURSE}""",
    "wa160": f"""SELECT {', '.join(f"{DAY.format(f'u.{r}_day_key')}::DATE AS {r}_date" for r in ('posting', 'settlement', 'transit', 'operating'))}, transaction_dtm, source_inserted_dtm,
  voided_dtm, operator_name, fare_prod_name,
  u.transit_account_id, u.serial_nbr, pass_use_count, {_money(*settlement.USE_COSTS)}, ({' + '.join(f'coalesce({c}, 0)' for c in settlement.USE_COSTS)}) / 100 AS total_use_cost,
  transaction_status_name, fare_prod_users_list_name,
  trip_price_count, bus_id, txn_status_name, paygo_ride_count, ride_count, transaction_id, transfer_flag, transfer_sequence_nbr, account_status_name, dw_transaction_id, u.token_id,
  pass_id, u.pg_card_id, mt.media_type_name,
  purse_name, patron_trip_id, retrieval_ref_nbr, successful_use_flag, facility_id, tap_id, ride_type_name, calculated_fare, coalesce(p.rider_class_name, a.rider_class_name) AS rider_class_name,
  coalesce(one_account_value, 0) AS one_account_value, coalesce(restricted_purse_value, 0) AS restricted_purse_value, coalesce(refundable_purse_value, 0) AS refundable_purse_value,
  {_money('uncollectible_amount')}, is_registered,
  coalesce(discount_applied, 0) / 100 AS discount_amount, {_money('post_pay_amount')}
FROM use_txn u LEFT JOIN products p USING (fare_prod_key) LEFT JOIN operators o USING (operator_key) LEFT JOIN cards c ON c.card_key = u.card_key LEFT JOIN ride_types USING
  (ride_type_key) LEFT JOIN txn_statuses USING (txn_status_key)
LEFT JOIN media_types mt USING (media_type_key) LEFT JOIN transit_accounts a ON a.transit_account_key = c.transit_account_key LEFT JOIN users_lists USING (fare_prod_users_list_key)""",
    "ad_hoc_processed_taps": "SELECT * FROM taps",
    "ad_hoc_journal_entries": """SELECT * EXCLUDE (ledger_name), split_part(description, '|', 1) AS transaction_category, split_part(description, '|', 2) AS apportionment_rule, split_part(description, '|', 4) AS
  operating_date,
  split_part(description, '|', 5) AS fare_instrument_id FROM journal WHERE ledger_name = 'MAIN'""",
    "wsp611_operation_performance": PERFORMANCE,
    "wsp620_availability": f"""SELECT kpi_id, transit_day, availability_event_id AS ticket_id, facility_name, bus_id AS vehicle_id, device_id, start_dtm, end_dtm, gross_daily_value AS gross_value, kpi_value AS
  net_value, units, event_type,
  failure_level AS kpi_level, exception, root_cause_id, fault_description FROM {EVENTS} WHERE kpi_id NOT LIKE 'P%'""",
    "wsp620_performance": f"""SELECT kpi_id, availability_event_id AS ticket_id, facility_name, device_id, start_dtm, end_dtm, performance_time_basis AS accrued_time, units, kpi_value / 100 AS deduction_amount,
  failure_level AS kpi_level,
  fault_description, root_cause_id, location_category, base_cure_period AS cure_period, base_recurrence_period AS recurrence_period, cure_period AS adj_cure_period,
  recurrence_period AS adj_recurrence_period, recurrence_count
FROM {EVENTS} WHERE kpi_id NOT LIKE 'A%'""",
    "edw_farerev_payg_trip_txn": _trips(),
    "farerev_payg_trip_txn_a_v2": _scheduled(_trips(), MODE, ADDENDUM, NO_SCHEDULE_A, "Y"),
    "farerev_payg_trip_txn_c_v2": _scheduled(_trips(), MODE, COMPUTATION, NO_SCHEDULE_C, "N"),
    "edw_farerev_payg_trip_txn_adjusted": _trips("payg_channel_map"),
    "farerev_payg_trip_txn_a_v2_adjusted": _scheduled(_trips("payg_channel_map"), MODE, ADDENDUM, NO_SCHEDULE_A, "Y"),
    "farerev_payg_trip_txn_c_v2_adjusted": _scheduled(_trips("payg_channel_map"), MODE, COMPUTATION, NO_SCHEDULE_C, "N"),
}
#: These begin with expressions of their own.
NESTED = {"wc210": LEDGER, "wsp611_system_availability": AVAILABILITY}
SQL = {name: with_fares(text, PAYG) for name, text in SQL.items()} | {name: with_fares(f"SELECT * FROM ({text})", PAYG) for name, text in NESTED.items()}
