"""Unsettled transactions, uses, taps, transfers, and the ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.reports.naming import Tables, attach, day, distinct_rows, dollars, lookup, lookup_all, money, zero

# Fixed values of the feeds.
REFUND_SALE, TRANSFER_REASON = 24, 990508


def unsettled_confirmations(t: Tables) -> DataFrame:
    return t("unsettled").select(
        "posting_day_key", "settlement_state", "merchant_number", "credit_card_type", "equipment_name", "capture_date", "bank_settlement_date", "transaction_id", "retrieval_ref_nbr",
        *money("transaction_amount"), "transit_account_id",
    )


def unsettled_system_confirmations(t: Tables) -> DataFrame:
    return t("unsettled").select(
        "settlement_state", "posting_day_key", "merchant_number", "credit_card_type", "equipment_name", "capture_date", F.col("msg_dtm").alias("transaction_dtm"), "transaction_id",
        "retrieval_ref_nbr", *money("transaction_amount"), "transit_account_id",
    )


def unsettled_device_cash(t: Tables) -> DataFrame:
    return t("unsettled").select(*money("value_cash"), "event_dtm", "device_id", "dw_cbx_tracking_id", "ready_for_settlement_dtm", day("posting_day_key").alias("posting_day_key"), "settlement_state")


def _product(t: Tables, rows: DataFrame) -> DataFrame:
    return attach(rows, t("products"), {"fare_prod_key": "fare_prod_key"}, ["fare_prod_name"])


def _operator(t: Tables, rows: DataFrame, key: str = "operator_id") -> DataFrame:
    return attach(rows, t("operators"), {key: key}, ["operator_name"])


def _payment_type(t: Tables, rows: DataFrame, key: str = "payment_type_key") -> DataFrame:
    return attach(rows, t("payment_types"), {key: "payment_type_key"}, ["payment_type_name"])


def _reason(t: Tables, rows: DataFrame) -> DataFrame:
    return attach(rows, t("reasons"), {"reason_key": "reason_key"}, ["reason_code", "reason_name"])


def _purse(t: Tables, rows: DataFrame) -> DataFrame:
    return attach(rows, t("purses"), {"purse_sku": "purse_sku"}, ["purse_name"])


def unsettled_misc(t: Tables) -> DataFrame:
    rows = _payment_type(t, _operator(t, _product(t, t("unsettled"))))
    return rows.select(
        "settlement_state", day("posting_day_key").alias("posting_day_key"), "ready_for_settlement_dtm", "txn_desc", "operator_name", "payment_type_name", "fare_prod_name", "transit_account_id",
        "pass_id", *money("pass_cost"), "pass_use_count",
    )


def unsettled_orders(t: Tables) -> DataFrame:
    """Payment types are looked up by their id here, not by their key as elsewhere."""
    rows = _payment_type(t, _product(t, _operator(t, _reason(t, t("unsettled")), "operator_key")), "payment_type_id")
    return _purse(t, rows).select(
        "posting_day_key", "ready_for_settlement_dtm", "order_origin", "transaction_dtm", "order_nbr", "line_item_nbr", "order_status", "fare_prod_name", "payment_type_name",
        *money("deposit_value", "pass_cost", "transit_value", "benefit_value", "administrative_fee", "replacement_fee", "shipping_fee", "refund_fee"), "transit_account_id", "serial_nbr",
        "operator_name", "reason_code", "reason_name", "pass_id", "settlement_state", *money("one_account_value", "discount_amount"), "purse_name", *money("restricted_purse_value"),
        "retrieval_ref_nbr", *money("refundable_purse_value", "prepaid_bankcard_value"), "payment_transit_account_id",
    )


def unsettled_chargebacks(t: Tables) -> DataFrame:
    rows = attach(t("unsettled"), t("chargeback_kinds"), {"crdb_chgbk_activity_type_id": "crdb_chgbk_activity_type_id"}, ["chgbk_activity_type_name"])
    return rows.select(
        "settlement_state", day("posting_day_key").alias("posting_day_key"), "ready_for_settlement_dtm", "chargeback_ref_nbr", "chgbk_activity_type_name",
        *money("chargeback_amount", "chargeback_fee_amount"), "retrieval_ref_nbr", "merchant_number", "credit_card_type", "transaction_id", "transit_account_id",
    )


def unsettled_refunds(t: Tables) -> DataFrame:
    rows = t("unsettled").filter(F.col("sale_type_key") == REFUND_SALE)
    rows = _purse(t, _payment_type(t, _product(t, _operator(t, rows))))
    return rows.select(
        "settlement_state", "posting_day_key", "ready_for_settlement_dtm", "operator_name", "transaction_dtm", "transaction_id", "device_id", "payment_type_name", "fare_prod_name",
        *money("deposit_value", "pass_cost", "transit_value", "benefit_value", "orig_sale_amt_paid_by_bv", "orig_sale_amt_paid_by_non_bv"), "order_nbr", "transit_account_id", "purse_name",
        *money("restricted_purse_value", "refund_fee"), "retrieval_ref_nbr", *money("prepaid_bankcard_value"), "payment_transit_account_id",
    )


def unsettled_sales(t: Tables) -> DataFrame:
    rows = _payment_type(t, _operator(t, _product(t, t("unsettled").filter("device_id is not null"))))
    rows = attach(rows, t("sale_types"), {"sale_type_key": "sale_type_key"}, ["sale_type_name"])
    return _purse(t, _reason(t, rows)).select(
        "settlement_state", "device_id", "fare_prod_name", "operator_name", "payment_type_name", "transaction_dtm",
        *money("administrative_fee", "deposit_value", "replacement_fee", "overpay", "transit_value", "underpay", "benefit_value", "bankcard_payment_value", "pass_cost"), "transaction_id",
        *money("shipping_fee"), "sale_type_name", "ready_for_settlement_dtm", "posting_day_key", "order_nbr", "transit_account_id", "reason_code", "pass_id",
        *money("one_account_value", "uncollectible_amount", "discount_amount"), "purse_name", *money("restricted_purse_value"), "retrieval_ref_nbr",
        *money("refundable_purse_value", "prepaid_bankcard_value"), "payment_transit_account_id",
    )


USE = (
    "settlement_state", "transit_value", "transit_account_id", "pass_id", "operator_name", "fare_prod_name", "device_id", "serial_nbr", "pass_use_count", "posting_day_key", "benefit_value",
    "bankcard_payment_value", "pass_cost", "ready_for_settlement_dtm", "transaction_dtm", "one_account_amount", "uncollectible_amount", "purse_name", "restricted_purse_value", "post_pay_amount",
    "retrieval_ref_nbr", "refundable_purse_value", "prepaid_bankcard_value",
)
USE_MONEY = (
    "transit_value", "benefit_value", "bankcard_payment_value", "pass_cost", "uncollectible_amount", "restricted_purse_value", "post_pay_amount", "refundable_purse_value", "prepaid_bankcard_value",
)
USE_NAMES = {"products": ("fare_prod_key", "fare_prod_name"), "operators": ("operator_id", "operator_name"), "purses": ("purse_sku", "purse_name")}


def unsettled_uses(t: Tables) -> DataFrame:
    """Distinct uses. Their products are looked up within orders, by which uses lie dealt."""
    once = lambda name: t(name).select(*USE_NAMES[name]).distinct()
    names = lambda rows: _purse(once, _operator(once, lookup_all(rows, lambda keys: _product(once, keys), ["fare_prod_key"], "order_nbr")))
    more = [name for _, name in USE_NAMES.values()]
    own = [*money(*USE_MONEY), dollars(zero("one_account_value")).alias("one_account_amount"), *(c for c in USE if c not in (*USE_MONEY, *more, "one_account_amount"))]
    return distinct_rows(t("unsettled"), own, names, more).select(*USE)


USE_COSTS = ("pass_cost", "value_changed", "booking_prepaid_value", "benefit_value", "bankcard_payment_value", "merchant_service_fee")


def _use_names(t: Tables, keys: DataFrame) -> DataFrame:
    """Names of products and of the accounts of cards; what only these lead to is looked up first."""
    products = attach(t("products"), t("users_lists"), {"fare_prod_users_list_key": "fare_prod_users_list_key"}, ["fare_prod_users_list_name"])
    account = {"rider_class_name": "account_rider", "account_status_name": "account_status_name", "is_registered": "is_registered"}
    cards = attach(t("cards").select("card_key", "transit_account_key"), t("transit_accounts"), {"transit_account_key": "transit_account_key"}, account)
    keys = attach(keys, products, {"fare_prod_key": "fare_prod_key"}, {"fare_prod_name": "fare_prod_name", "rider_class_name": "product_rider", "fare_prod_users_list_name": "fare_prod_users_list_name"})
    return attach(keys, cards, {"card_key": "card_key"}, list(account.values()))


def use_transactions(t: Tables) -> DataFrame:
    """Uses with dates, names, states and costs; the rider class is the product's, else the
    account's."""
    rows = lookup(t("use_txn"), lambda keys: _use_names(t, keys), ["fare_prod_key", "card_key"])
    rows = _operator(t, rows, "operator_key")
    rows = attach(rows, t("ride_types"), {"ride_type_key": "ride_type_key"}, ["ride_type_name"])
    rows = attach(rows, t("txn_statuses"), {"txn_status_key": "txn_status_key"}, ["txn_status_name", "successful_use_flag"])
    rows = attach(rows, t("media_types"), {"media_type_key": "media_type_key"}, ["media_type_name"])
    dates = [day(f"{role}_day_key").cast("date").alias(f"{role}_date") for role in ("posting", "settlement", "transit", "operating")]
    return rows.select(
        *dates, "transaction_dtm", "source_inserted_dtm", "voided_dtm", "operator_name", "fare_prod_name", "transit_account_id", "serial_nbr", "pass_use_count", *money(*USE_COSTS),
        dollars(zero(*USE_COSTS)).alias("total_use_cost"), "transaction_status_name", "fare_prod_users_list_name", "trip_price_count", "bus_id", "txn_status_name", "paygo_ride_count", "ride_count",
        "transaction_id", "transfer_flag", "transfer_sequence_nbr", "account_status_name", "dw_transaction_id", "token_id", "pass_id", "pg_card_id", "media_type_name", "purse_name",
        "patron_trip_id", "retrieval_ref_nbr", "successful_use_flag", "facility_id", "tap_id", "ride_type_name", "calculated_fare",
        F.coalesce("product_rider", "account_rider").alias("rider_class_name"), *(zero(c).alias(c) for c in ("one_account_value", "restricted_purse_value", "refundable_purse_value")),
        *money("uncollectible_amount"), "is_registered", dollars(zero("discount_applied")).alias("discount_amount"), *money("post_pay_amount"),
    )


def processed_taps(t: Tables) -> DataFrame:
    return t("taps").select(
        "tap_id", "transaction_dtm", "device_id", "device_prefix", "token_id", "transit_account_id", "operator_id", "transaction_id", "tap_status_id", "tap_status_desc", "unmatched_flag", "trip_id",
        "sector_id", "voidable_until_dtm", "dw_transaction_id", "source_inserted_dtm",
    )


def product_transfers(t: Tables) -> DataFrame:
    orders = attach(t("patron_order"), t("order_type_dimension").filter("order_type_enum = 'Transfer'"), {"patron_order_type_key": "patron_order_type_key"}, how="inner")
    sales = t("sale_txn").filter(F.col("reason_key") == TRANSFER_REASON)
    rows = orders.join(t("order_lines"), "dw_patron_order_id").join(sales, "dw_patron_order_line_item_id").join(t("channels"), "sales_channel_key")
    return rows.select(
        F.lit("WO118").alias("report"), "order_day_key", "order_dtm", "order_nbr", "patron_account_id", F.col("subsystem_account_ref").alias("source_transit_account"),
        F.col("xfer_to_subsystem_account_ref").alias("target_transit_account"), "pass_id", dollars(F.col("value_changed")).alias("stored_value"),
        dollars(F.col("refundable_purse_value")).alias("refundable_purse_value"), dollars(F.col("benefit_value")).alias("benefit_value"), "sales_channel_name",
    )


def journal_entries(t: Tables, ledger: str = "MAIN") -> DataFrame:
    part = lambda k: F.split_part("description", F.lit("|"), F.lit(k))
    return t("journal").filter(F.col("ledger_name") == ledger).select(
        "accounting_date", "voucher", "ledger_account", "txn_currency_debit_amount", "txn_currency_credit_amount", "external_account_name", "description",
        part(1).alias("transaction_category"), part(2).alias("apportionment_rule"), part(4).alias("operating_date"), part(5).alias("fare_instrument_id"),
    )


def ledger_summary(t: Tables) -> DataFrame:
    """Every rule of every rule set and category with its postings, or, without any, as
    ignored. A rule debits the account it books to and credits the one it books from, the
    other way round if flagged negative; in a posting the two change sides once more if a
    flagged amount is positive or a plain one negative."""
    def account(role: str) -> DataFrame:
        return t("gl_accounts").select(F.col("account_id").alias(f"{role}_id"), "legal_entity_code", F.col("account_name").alias(f"{role}_name"), F.col("account_holder").alias(f"{role}_holder"))

    negative = F.coalesce(F.col("negative_amount_flag") == 1, F.lit(False))
    rules = t("gl_rule_map").join(t("rule_sets").select("cch_rules_set_id"), "cch_rules_set_id").join(t("gl_rules").withColumnRenamed("legal_entity_code", "rule_entity"), "rule_id")
    rules = attach(rules, account("to"), {"to_id": "rule_to_account_id", "legal_entity_code": "rule_entity"}, ["to_id", "to_name", "to_holder"], "inner")
    rules = attach(rules, account("from"), {"from_id": "rule_from_account_id", "legal_entity_code": "rule_entity"}, ["from_id", "from_name", "from_holder"], "inner")
    keys = ["rule_id", "cch_rules_set_id", "transaction_category"]
    rows = rules.join(t("gl_summary").withColumn("posted", F.col("transaction_category")), keys, "left")
    rows = attach(rows, t("categories"), {"transaction_category": "posted"}, {"transaction_category": "category_id", "category_name": "category_name"})
    rows = attach(rows, t("calendar"), {"dtm": "summary_period"}, {"dtm": "date"})
    rows = attach(rows, t("gl_statuses"), {"gl_summary_record_status_key": "gl_summary_record_status_key"}, ["gl_summary_record_stats_name"])
    rows = attach(rows, t("reprocess_actions"), {"reprocess_action_id": "processing_type_id"}, {"short_desc": "processing_type"})
    # the rule's own sides, then the posting's: both changes together swap twice
    swapped = F.coalesce((negative & (F.col("amount") > 0)) | (~negative & (F.col("amount") < 0)), F.lit(False))
    to_is_debit = negative == swapped
    side = lambda yes, c: F.when(yes, F.col(f"to_{c}")).otherwise(F.col(f"from_{c}"))
    accounts = [side(yes, c).alias(f"{role}_account_{name}") for role, yes in (("debit", to_is_debit), ("credit", ~to_is_debit)) for c, name in (("id", "number"), ("name", "name"), ("holder", "holder"))]
    return rows.select(
        F.lit("WC210").alias("report"), "category_id", "category_name", F.col("rule_id").alias("apportionment_rule_id"), F.col("rule_name").alias("apportionment_rule_name"),
        F.col("legal_entity_code").alias("legal_entity"), *accounts, F.abs(dollars(F.col("amount"))).alias("absolute_value_amount"), F.col("gl_posting_id").alias("record_id"),
        "user_ref_1", "user_ref_2", "user_ref_3", F.quarter("date").alias("quarter"), "posted_dtm",
        F.when(F.col("gl_posting_id").isNull(), "Ignored-$0").otherwise(F.col("gl_summary_record_stats_name")).alias("gl_record_status_name"), "processing_type",
        F.when(negative, "Y").otherwise("N").alias("negative_amount_rule"), "date",
    )
