"""Order details, product-sales transactions and clearing-house transactions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.reports.naming import Tables, alike, attach, day, dollars, lookup, lookup_all, lookup_within, money, plain_money, prefixed, zero
from quayside.reports.revenue import addendum, computation, in_addendum, in_computation

# Fixed values of the feeds: kinds of lines, statuses and codes that the reports name.
RETURNED = "cash returned"
CASH = 1
REMOVALS = ("Pass Removal", "Pass Conversion", "Transit Account Trip Correction", "Transit Account Trip Void", "Transit Account Tap Void")
TRIP_LINES = ("Transit Account Trip Fare Adjustment", "Transit Account Trip Void", "Transit Account Tap Void", "Transit Account Trip Correction")
PRODUCT_SALE_TYPES = (21, 30, 31, 23)
FEES = ("pass_cost", "transit_value", "benefit_value", "refundable_purse_value", "enablement_fee", "replacement_fee", "shipping_fee", "card_fee", "deposit_value", "administrative_fee")
SALE_CENTS = (
    "cash_received", "cash_returned", "net_cash", "discount_amount", "fare_revenue", "transit_value", "benefit_value", "refundable_purse_value", "total_stored_value",
    "pass_cost", "enablement_fee", "replacement_fee", "product_value", "overpayment", "retail_commission_amount",
)


def _sale_values(value: str) -> dict[str, Column]:
    """Amounts that both sides of the product sales share; ``value`` holds the stored value."""
    stored = [value, "benefit_value", "refundable_purse_value"]
    some_stored = reduce(lambda a, b: a | b, (F.col(c) != 0 for c in stored))
    fees = [value if c == "transit_value" else c for c in FEES]
    return {
        "fare_revenue": zero(*stored, "pass_cost", "enablement_fee"),
        "fare_product": F.when(F.col("fare_prod_name").isNull() & some_stored, "Stored Value").otherwise(F.col("fare_prod_name")),
        "transit_value": zero(value),
        "benefit_value": zero("benefit_value"),
        "refundable_purse_value": zero("refundable_purse_value"),
        "total_stored_value": zero(*stored),
        "pass_cost": zero("pass_cost"),
        "enablement_fee": zero("enablement_fee"),
        "replacement_fee": zero("replacement_fee"),
        "overpayment": zero("paid") - zero(*fees),
    }


def _sale_names(t: Tables, rows: DataFrame) -> DataFrame:
    """Dates (which must be known), device, payment type, product and reason of a sale."""
    rows = attach(rows, t("calendar"), {"date_key": "operating_day_key"}, {"dtm": "operating_date"}, "inner")
    rows = attach(rows, t("calendar"), {"date_key": "settlement_day_key"}, {"dtm": "settlement_date"}, "inner")
    rows = attach(rows, t("devices"), {"device_key": "device_key"}, ["facility_name", "device_id"])
    rows = attach(rows, t("payment_types"), {"payment_type_key": "payment_type_key"}, ["payment_type_name"], "inner")
    rows = attach(rows, t("products"), {"fare_prod_key": "fare_prod_key"}, ["fare_prod_name"])
    return attach(rows, t("reasons"), {"reason_key": "reason_key"}, ["reason_name"])


#: Leaves out rows of a fact that a report will not show, by the day keys that it has.
Due = Callable[[DataFrame], DataFrame]


def _order_sales(t: Tables, due: Due) -> DataFrame:
    """What orders paid. Cash given back for an overpayment is a payment of its own, found
    by its line; a line without one has no such amount (null, not 0)."""
    payments, cash = t("order_payment"), F.col("payment_type_key") == CASH
    back = payments.filter(F.col("retrieval_ref_nbr") == RETURNED).groupBy("dw_patron_order_line_item_id")
    back = back.agg(F.sum(zero("payment_amount")).alias("returned"))
    paid = payments.filter(~F.col("retrieval_ref_nbr").eqNullSafe(RETURNED)).withColumn("paid", F.col("payment_amount")).drop("dw_patron_order_id", "discount_amount")
    lines = t("order_line_item").select(
        "dw_patron_order_line_item_id", "dw_patron_order_id", "line_item_sequence", "fare_prod_key", "reason_key", "operating_day_key", "line_item_type", "line_item_status",
        "item_total_discount_amount", F.col("subsystem_account_ref").alias("account_ref"), F.col("source_inserted_dtm").cast("date").alias("posting_date"),
    )
    orders = t("patron_order").filter(~F.lower("order_type").like("%refund%")).select("dw_patron_order_id", "order_type", "order_dtm", "order_nbr", "sales_channel_key", "device_key")
    rows = due(paid).join(due(lines), "dw_patron_order_line_item_id").join(orders, "dw_patron_order_id")
    rows = rows.filter((F.col("transaction_category") != -9) | F.col("order_type").isin("Sale", "Refund"))
    channels = t("txn_channel_map").filter((F.col("txn_group") == "Product Sales") & F.col("txn_source").isin("SalesOrder", "RefundOrder"))
    keys = {c: c for c in ("sales_channel_key", "payment_type_key")}
    rows = attach(rows, channels, keys, ["txn_channel_display", "sales_channel_display"], "inner")
    rows = _sale_names(t, rows).join(back, "dw_patron_order_line_item_id", "left")
    over = cash & (F.col("line_item_type") == "Cash Overpayment")
    net = F.when(over, F.col("payment_amount") + F.col("returned")).otherwise(F.col("payment_amount"))
    return rows.select(
        "txn_channel_display", "sales_channel_display", F.lit("A").alias("computation_type"), "operating_date", F.col("order_dtm").alias("transaction_dtm"), "posting_date", "settlement_date",
        "facility_name", "device_id", F.col("dw_transaction_id").alias("transaction_id"), F.lit(None).cast("string").alias("group_account_id"), F.col("account_ref").alias("transit_account_id"),
        "order_nbr", F.lit(1).alias("quantity"), F.col("line_item_sequence").alias("order_line_item_sequence"), "payment_type_name",
        F.when(cash, F.col("payment_amount")).otherwise(0).alias("cash_received"), F.when(over, -F.col("returned")).otherwise(0).alias("cash_returned"), F.when(cash, net).otherwise(0).alias("net_cash"),
        zero("item_total_discount_amount").alias("discount_amount"), *(c.alias(n) for n, c in _sale_values("transit_value").items()), zero("product_value").alias("product_value"),
        F.lit(0).cast("long").alias("retail_commission_amount"), "retrieval_ref_nbr", "line_item_status", "line_item_type", "reason_name", "payment_type_key", "operating_day_key", "settlement_day_key",
    )


def _device_sales(t: Tables, due: Due) -> DataFrame:
    """What sales of products changed, with the order line that they belong to, if any."""
    sales = t("product_sale").filter(F.col("sale_type_key").isin(*PRODUCT_SALE_TYPES)).withColumnRenamed("discount_amount", "sale_discount")
    payments = t("product_sale_payment").withColumn("paid", F.col("payment_value"))
    rows = due(sales).join(payments, ["dw_transaction_id", "transaction_dtm"])
    line = {"line_item_sequence": "order_line_item_sequence", "dw_patron_order_id": "dw_patron_order_id", "line_item_status": "line_item_status", "line_item_type": "line_item_type"}
    rows = attach(rows, t("order_line_item"), {"dw_patron_order_line_item_id": "dw_patron_order_line_item_id"}, line)
    rows = attach(rows, t("patron_order"), {"dw_patron_order_id": "dw_patron_order_id"}, ["order_nbr"])
    channels = t("txn_channel_map").filter("txn_group = 'Product Sales'")
    keys = {c: c for c in ("sales_channel_key", "payment_type_key")}
    rows = attach(rows, channels, keys, ["txn_source", "txn_channel_display", "sales_channel_display"], "inner")
    overpaid = (F.col("txn_source") == "SalesOrder") & (F.col("line_item_type") == "Refund Cash Overpayment")
    rows = _sale_names(t, rows.filter(F.col("txn_source").isin("SalesTxn", "RefundTxn") | overpaid))
    rows = attach(rows, t("calendar"), {"date_key": "posting_day_key"}, {"dtm": "posting_date"}, "inner")
    rows = attach(rows, t("customers"), {"customer_key": "customer_key"}, {"fin_customer_id": "group_account_id"})
    cash = F.when(F.col("payment_type_key") == CASH, F.col("payment_value")).otherwise(0)
    return rows.select(
        "txn_channel_display", "sales_channel_display", F.lit("A").alias("computation_type"), "operating_date", "transaction_dtm", "posting_date", "settlement_date", "facility_name", "device_id",
        F.col("dw_transaction_id").alias("transaction_id"), "group_account_id", F.col("transit_account_id").cast("string").alias("transit_account_id"), "order_nbr", F.lit(1).alias("quantity"),
        "order_line_item_sequence", "payment_type_name", cash.alias("cash_received"), F.lit(0).cast("long").alias("cash_returned"), cash.alias("net_cash"), zero("sale_discount").alias("discount_amount"),
        *(c.alias(n) for n, c in _sale_values("value_changed").items()), zero("net_value").alias("product_value"),
        zero("product_commission_amount", "fee_commission_amount").alias("retail_commission_amount"), "retrieval_ref_nbr", "line_item_status", "line_item_type", "reason_name", "payment_type_key",
        "operating_day_key", "settlement_day_key",
    )


def product_sales(t: Tables, due: Due = lambda rows: rows) -> DataFrame:
    """Product sales in cents: what orders paid, and what sales of products changed."""
    return _order_sales(t, due).unionByName(_device_sales(t, due))


def _sales_report(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: F.round(dollars(F.col(c)), 2) for c in SALE_CENTS}).drop("payment_type_key").distinct()


def product_sales_addendum(t: Tables) -> DataFrame:
    return _sales_report(addendum(product_sales(t, lambda rows: in_addendum(rows, t("schedule"))), t("schedule")))


def product_sales_computation(t: Tables) -> DataFrame:
    return _sales_report(computation(product_sales(t, lambda rows: in_computation(rows, t("schedule"))), t("schedule")))


def _account_label() -> Column:
    """Which account or card a line is for: the subsystem's, else the card's account, else
    the card, else the one account; each with a letter that says which."""
    subsystem = F.col("l_card_key").isNull() & F.col("l_subsystem_account_ref").isNotNull() & F.col("l_subsystem_enum").isNotNull()
    return (
        F.when(subsystem, F.concat("l_subsystem_account_ref", F.lit("("), F.substring("l_subsystem_enum", 1, 1), F.lit(")")))
        .when(F.col("card_account_id").isNotNull(), F.concat(F.col("card_account_id").cast("string"), F.lit("(A)")))
        .when(F.col("serial_nbr").isNotNull(), F.concat("serial_nbr", F.lit("(C)")))
        .when(F.col("l_oa_account_id").isNotNull(), F.concat(F.col("l_oa_account_id").cast("string"), F.lit("(O)")))
    )


LINE_KEYS = ["l_fare_prod_key", "l_card_key"]


def _line_names(t: Tables, keys: DataFrame) -> DataFrame:
    """Names of products and cards for the keys of lines; what only these lead to comes first, so
    that neither orders nor payments move to meet a large dimension."""
    products = attach(t("products"), t("users_lists"), {"fare_prod_users_list_key": "fare_prod_users_list_key"}, ["fare_prod_users_list_name"])
    cards = attach(t("cards"), t("transit_accounts"), {"transit_account_key": "transit_account_key"}, {"transit_account_id": "card_account_id", "rider_class_name": "account_rider_class"})
    product = {"fare_prod_name": "fare_prod_name", "rider_class_name": "product_rider_class", "fare_prod_users_list_name": "fare_prod_users_list_name"}
    card = {"serial_nbr": "serial_nbr", "token_id": "token_id", "pg_card_id": "card_pg_id", "media_type_name": "media_type_name", "card_account_id": "card_account_id", "account_rider_class": "account_rider_class"}
    return attach(attach(keys, products, {"fare_prod_key": "l_fare_prod_key"}, product), cards, {"card_key": "l_card_key"}, card)


def _line_item_type() -> Column:
    enrolled = F.concat("l_line_item_type", F.lit(" ("), "l_autoload_enroll_action", F.lit(")"))
    return F.when(F.col("l_autoload_enroll_action").isNotNull(), enrolled).otherwise(F.col("l_line_item_type"))


def _orders(t: Tables) -> DataFrame:
    """Orders of types that are reported, without refunds of one source that nobody approved, with
    the names that an order has: before its lines and payments come, which are many more rows."""
    rows = prefixed(t("patron_order"), "o_")
    rows = attach(rows, t("order_types"), {"source": "o_source", "order_type_name": "o_order_type"}, {"order_type_enum": "type_enum", "include_on_reports_flag": "reported", "send_to_cch_flag": "sent"})
    rows = rows.filter("reported = 1 or sent = 1")
    refund = (F.col("o_order_type") == "Refund") & (F.col("o_source") == "PIVOTAL")
    approved = (F.col("o_review_approved_rejected") == "Approved") & (zero("o_refund_is_opt_out") == 0)
    rows = rows.filter(~refund | approved)
    rows = attach(rows, t("operators"), {"operator_key": "o_operator_key"}, {"operator_id": "order_operator_id"})
    rows = attach(rows, t("reasons"), {"reason_key": "o_reason_key"}, {"reason_name": "order_reason"})
    # only a place id without other characters than digits would do, and what is left of one is '', not null
    place = F.when(F.translate("o_location_id", "x0123456789", "x").isNull(), F.col("o_location_id").try_cast("int"))
    address = {"business_entity_name": "business_entity_name", **{c: f"business_entity_{c}" for c in ("address_1", "address_2", "city", "state", "country", "postal_code")}}
    return attach(rows, t("business_entities"), {"business_entity_key": place}, address)


def order_detail(t: Tables, names: Callable[[DataFrame], DataFrame] = lambda rows: rows, kinds: Column | None = None) -> DataFrame:
    """Orders with their lines and the lines' payments (columns o_, l_ and p_) and all names;
    ``names`` adds more to the orders. With ``kinds`` (of ``_line_item_type``), only lines of these.
    All three tables meet by the order alone, by which they lie: a line's payments are found
    among those of its order, since an equality of lines would deal by the line as well."""
    o, l, p = names(_orders(t)), prefixed(t("order_line_item"), "l_"), prefixed(t("order_payment"), "p_")
    l = l if kinds is None else l.filter(kinds)
    l = lookup_within(l, lambda lines: lookup(lines, lambda keys: _line_names(t, keys), LINE_KEYS), LINE_KEYS, "l_dw_patron_order_id")
    l = attach(l, t("operators"), {"operator_key": "l_responsible_operator_key"}, {"operator_id": "line_operator_id"})
    l = attach(l, t("rider_classes"), {"rider_class_id": "l_account_rider_class_id"}, {"rider_class_name": "line_rider_class"})
    l = attach(l, t("purses"), {"purse_sku": "l_purse_sku"}, {"purse_name": "line_purse"})
    p = attach(p, t("payment_types"), {"payment_type_key": "p_payment_type_key"}, {"payment_type_name": "payment_type"})
    rows = o.join(l, F.col("o_dw_patron_order_id") == F.col("l_dw_patron_order_id"), "left" if kinds is None else "inner")
    refund_key = F.coalesce("o_refund_reason_key", "l_reason_key")
    rows = attach(rows, t("reasons"), {"reason_key": refund_key}, {"reason_name": "refund_reason"})
    same_line = alike(F.col("l_dw_patron_order_line_item_id"), F.col("p_dw_patron_order_line_item_id"))
    rows = rows.join(p, (F.col("o_dw_patron_order_id") == F.col("p_dw_patron_order_id")) & same_line, "left")
    is_refund = F.col("o_order_type") == "Refund"
    return rows.withColumns({
        "operator_id": F.when(F.col("type_enum") == "TravelCorrection", F.col("l_travel_operator_id")).otherwise(F.coalesce("line_operator_id", "order_operator_id")),
        "reason": F.when(is_refund, F.col("refund_reason")).otherwise(F.col("order_reason")),
        "reason_key": F.when(is_refund, refund_key).otherwise(F.col("o_reason_key")),
        "card_or_account_number": _account_label(),
        "transit_account_id": F.coalesce("card_account_id", F.col("l_subsystem_account_ref").try_cast("long")),
        "product_description": F.when(F.col("l_product_group") == "Not Applicable", F.col("l_product_group")).otherwise(F.coalesce("fare_prod_name", "l_line_item_name", "l_product_group", F.lit("Unknown"))),
        "order_total_fees_value": reduce(lambda a, b: a + b, (F.col(f"o_order_total_{c}_fee") for c in ("replacement", "administrative", "shipping", "card", "enablement"))),
        "pass_id": F.coalesce("l_ticket_or_book_id", F.col("l_pass_id").cast("string")),
        "pg_card_id": F.coalesce("l_pg_card_id", "card_pg_id"),
        "rider_class_name": F.coalesce("product_rider_class", "line_rider_class", "account_rider_class"),
        "purse_name": F.coalesce("line_purse", "l_subsystem_purse_restriction"),
        "payment_transit_account_id": F.when(F.col("p_subsystem_enum") == "ABP", F.col("p_subsystem_account_ref")),
        "adjustment_notes": F.coalesce("o_notes", "l_notes"),
        "approved_by_user_id": F.when(F.col("o_review_approved_rejected") == "Approved", F.col("o_review_assigned_to_user_id")),
        "sales_settlement_date": day("p_settlement_day_key"),
        "line_item_type": _line_item_type(),
    })


def _own(prefix: str, *columns: str) -> list[Column]:
    """Columns of one of an order's tables under their names."""
    return [F.col(prefix + c).alias(c) for c in columns]


def order_lines(t: Tables) -> DataFrame:
    """Every payment of every order line, with the names of the operator that answers for it."""
    rows = order_detail(t, lambda o: attach(o, t("employees"), {"employee_key": "o_employee_key"}, ["employee_serial_nbr"]))
    rows = attach(rows, t("operators"), {"operator_id": "operator_id"}, ["operator_name"], "inner")
    line_value = lambda c, n: dollars(F.col(f"p_{c}")).alias(n)
    return rows.select(
        F.lit("WO110").alias("report"), "sales_settlement_date", F.col("o_order_dtm").alias("order_date"), *_own("o_", "order_origin"), F.col("o_order_nbr").alias("order_number"),
        zero("o_line_item_count").alias("line_item_count"), *(dollars(F.col(f"o_order_total_{c}")).alias(f"order_total_{c}") for c in ("product_value", "deposit_value", "value")),
        dollars(F.col("order_total_fees_value")).alias("order_total_fees_value"), *_own("o_", "order_status"), "line_item_type", "media_type_name", "card_or_account_number", "product_description",
        "payment_type", dollars(zero("p_product_value")).alias("product_value"), *(line_value(c, c) for c in ("deposit_value", "replacement_fee", "administrative_fee")),
        line_value("payment_amount", "line_item_total_value"), *_own("l_", "line_item_status", "line_item_sequence"), line_value("shipping_fee", "line_item_shipping_fee"),
        F.col("l_line_item_nbr").alias("order_detail_id"), F.coalesce("reason", F.lit("N/A")).alias("reason"), *_own("o_", "collection_status", "collection_date", "submittal_count"),
        zero("transit_account_id").alias("transit_account_id"), *(line_value(c, f"line_item_{c}") for c in ("card_fee", "enablement_fee", "replacement_fee")), "pg_card_id", "rider_class_name",
        dollars(zero("p_discount_amount")).alias("discount_amount"), "business_entity_name", *(f"business_entity_{c}" for c in ("address_1", "address_2", "city", "state", "country", "postal_code")),
        dollars(zero("p_refund_fee")).alias("refund_fee"), "pass_id", F.col("employee_serial_nbr").cast("long").alias("employee_serial_nbr"), *_own("l_", "oa_account_id"),
        dollars(zero("p_one_account_value")).alias("line_item_one_account_value"), dollars(zero("p_rounding_amount")).alias("line_item_rounding_amount"),
        *_own("l_", "destination_stop_point_desc", "origin_stop_point_desc"), dollars(zero("p_prepaid_bankcard_value")).alias("prepaid_bankcard_value"), "payment_transit_account_id", "token_id",
        "serial_nbr", day("l_operating_day_key").alias("operating_day"), F.coalesce("operator_name", F.lit("Undefined")).alias("operator_name"), *_own("o_", "retrieval_ref_nbr"),
    )


def adjustments(t: Tables) -> DataFrame:
    """The lines that adjust, remove, correct or refund, with who entered and approved them.
    An order entered under a name shows the user's id, one without shows nobody: a name that
    lacks a part is null, and so is the name then shown."""
    kind = _line_item_type()
    kinds = kind.like("%Adjustment%") | kind.isin(*REMOVALS) | (kind.like("%Refund%") & (kind != "Refund Issue Media"))

    def names(o: DataFrame) -> DataFrame:
        o = attach(o, t("csr_users"), {"user_id": "o_created_by_user_id"}, {"user_id": "csr_user_id"})
        return attach(o, t("csr_employees"), {"rn_employee_user_id": "csr_user_id"}, {"first_name": "csr_first", "last_name": "csr_last"})

    rows = order_detail(t, names, kinds)
    rows = attach(rows, t("operators"), {"operator_id": "operator_id"}, ["operator_name"], "inner")
    rows = attach(rows, t("calendar"), {"date_key": "o_order_day_key"}, how="inner")
    rows = attach(rows, t("csr_employees"), {"employee_id": "approved_by_user_id"}, {"rn_descriptor": "approver"})
    rows = attach(rows, t("reasons"), {"reason_key": "reason_key"}, ["reason_type"])
    nameless = F.concat("o_inserted_first_name", "o_inserted_last_name").isNull()
    name = F.concat("o_inserted_first_name", F.lit(" "), "o_inserted_last_name")
    purse = F.when(F.upper("l_purse_type") == "PRETAX PURSE", "Benefit Value").otherwise(F.col("l_purse_type"))
    of_trip = F.col("l_line_item_type").isin(*TRIP_LINES)
    cents = lambda c: dollars(zero(f"p_{c}")).alias(c)
    return rows.select(
        F.lit("WO150").alias("report"), *_own("o_", "order_status"), F.coalesce("reason", F.lit("N/A")).alias("reason"), F.coalesce(purse, F.lit("Undefined")).alias("purse_type"),
        cents("product_value"), zero("o_line_item_count").alias("line_item_count"), F.coalesce("operator_name", F.lit("Undefined")).alias("operator_name"), F.col("o_order_dtm").alias("order_date"),
        "card_or_account_number", F.col("o_order_nbr").alias("order_number"),
        F.when(nameless, name).otherwise(F.coalesce("o_inserted_user_id", F.concat("csr_first", F.lit(" "), "csr_last"))).alias("inserted_by"), F.col("o_review_approved_dtm").alias("approved_dtm"),
        *_own("o_", "order_completed_dtm"), "fare_prod_name", "reason_type", *(cents(c) for c in ("pass_cost", "transit_value", "benefit_value")), "adjustment_notes", *_own("o_", "order_origin"),
        F.coalesce(F.col("o_approval_user_id").cast("string"), "approver").alias("approval_user_id"), "sales_settlement_date", "line_item_type", "pg_card_id", "rider_class_name", "media_type_name",
        "purse_name", cents("restricted_purse_value"), F.when(of_trip, dollars(F.col("l_line_item_amount"))).otherwise(0).alias("line_item_amount"), "product_description",
        cents("refundable_purse_value"), cents("prepaid_bankcard_value"), *_own("o_", "retrieval_ref_nbr"),
    )


CLEARING_PLAIN = (
    "administrative_fee", "bonus_added", "deposit", "replacement_fee", "money_paid", "net_money_paid", "net_value", "overpay", "sv_transaction", "underpay", "benefit_value",
    "bankcard_payment_value", "shipping_fee", "payment_amount", "pass_load_amt_paid_by_bv", "pass_load_amt_not_paid_by_bv", "one_account_value", "uncollectible_amount",
    "booking_prepaid_value", "restricted_purse_value", "enablement_fee",
)
CLEARING_OWN = (
    "device_id", "load_type_id", "transaction_dtm", "transaction_id", "dw_transaction_id", "transaction_category", "user_ref_1", "user_ref_2", "user_ref_3", "merchant_number", "capture_date",
    "bank_settlement_date", "pass_use_count", "activity_type_id", "transaction_ref_nbr", "retrieval_ref_nbr", "transit_account_id",
)
CLEARING_LATER = ("payment_transit_account_id", "operating_date", "pass_id", "order_nbr", "line_item_nbr", "use_type")


def _known(t: Tables) -> DataFrame:
    """Transactions of known categories, before any of them are shuffled."""
    return t("clearing").join(t("categories").select("transaction_category"), "transaction_category", "left_semi")


def _clearing_products(t: Tables, rows: DataFrame) -> DataFrame:
    return attach(rows, t("products"), {"fare_prod_key": "fare_prod_key"}, {"fare_prod_name": "product", "monetary_inst_type_name": "monetary_inst_type_name"})


def _clearing_names(t: Tables, rows: DataFrame) -> DataFrame:
    """Clearing-house transactions of known categories, with their products, with all other
    names: after what may shuffle them, which then moves no names."""
    rows = attach(rows, t("categories"), {"transaction_category": "transaction_category"}, ["category_name"], "inner")
    rows = attach(rows, t("payment_types"), {"payment_type_key": "payment_type_key"}, ["payment_type_name"])
    rows = attach(rows, t("routes"), {"route_key": "route_key"}, {"route_name": "route_designator_desc"})
    rows = attach(rows, t("business_entities"), {"business_entity_id": "business_entity_id"}, ["business_entity_name"])
    rows = attach(rows, t("business_entities"), {"business_entity_key": "settlement_business_entity_id"}, {"business_entity_name": "responsible_business_entity_name"})
    rows = attach(rows, t("sale_types"), {"sale_type_key": "sale_type_key"}, ["sale_type_name"])
    rows = attach(rows, t("reprocess_actions"), {"reprocess_action_id": "processing_type_id"}, ["short_desc"])
    rows = attach(rows, t("credit_card_types"), {"cpa_credit_card_type_id": "credit_card_type_id"}, ["credit_card_type_name"])
    rows = attach(rows, t("transaction_origins"), {"transaction_origin_key": "transaction_origin_id"}, ["transaction_origin_name"])
    rows = attach(rows, t("categorization_rules"), {"rule_id": "categorization_rule_id"}, ["rule_id", "rule_name"])
    kind = {"description": "description", "transaction_type_id": "known_transaction_type_id"}
    rows = attach(rows, t("transaction_types"), {"transaction_type_id": "transaction_type_id"}, kind)
    rows = attach(rows, t("media_types"), {"media_type_id": "media_type_id"}, ["media_type_name"])
    rows = attach(rows, t("rider_classes"), {"rider_class_id": "rider_class_id"}, ["rider_class_name"])
    return attach(rows, t("purses"), {"purse_sku": "purse_sku"}, ["purse_name"])


def _clearing_columns() -> list[Column]:
    """What both clearing-house reports show. A use is worth what it took from value, benefit
    and bank card (null if one is missing), a sale its net value, the rest the stored value."""
    kind = F.col("transaction_type_id")
    worth = F.when(kind == "U", F.col("sv_transaction") + F.col("benefit_value") + F.col("bankcard_payment_value"))
    worth = worth.when(kind == "S", F.col("net_value")).otherwise(F.col("sv_transaction"))
    with_pass = ((kind == "U") & (F.col("pass_use_count") == 1)) | kind.isin("S", "O", "M")
    product = F.when(F.col("product").isNull() & F.col("sv_transaction").isNotNull(), "Transit Value").otherwise(F.col("product"))
    names = (
        "category_name", "payment_type_name", "route_designator_desc", "monetary_inst_type_name", "responsible_business_entity_name", "business_entity_name", "sale_type_name", "short_desc",
        "credit_card_type_name", "transaction_origin_name", "rule_id", "rule_name", "description", "media_type_name", "rider_class_name", "purse_name",
    )
    return [
        *names, *CLEARING_OWN, product.alias("fare_prod_name"), dollars(worth).alias("transaction_value"), F.when(with_pass, dollars(F.col("pass_cost"))).otherwise(0).alias("pass_cost"),
        *plain_money(*CLEARING_PLAIN), *money("refund_fee", "card_fee", "discount_applied", "refundable_purse_value"), F.col("known_transaction_type_id").alias("transaction_type_id"),
    ]


def clearing_house(t: Tables) -> DataFrame:
    """Clearing-house transactions with operator, date and stops, which play two roles."""
    rows = _clearing_names(t, attach(_clearing_products(t, _known(t)), t("operators"), {"operator_id": "operator_id"}, ["operator_name"]))
    rows = attach(rows, t("calendar"), {"dtm": "summary_period"}, {"date_key": "summary_key", "dtm": "dtm"})
    rows = attach(rows, t("stop_points"), {"stop_point_key": "boarding_stop_key"}, {"stop_point_name": "boarding_stop_point_display_desc"})
    rows = attach(rows, t("stop_points"), {"stop_point_key": "alighting_stop_key"}, {"stop_point_name": "alighting_stop_point_display_desc"})
    stops = ("boarding_stop_point_display_desc", "alighting_stop_point_display_desc")
    return rows.select(*_clearing_columns(), *money("rounding_amount", "prepaid_bankcard_value", "post_pay_amount"), *stops, *CLEARING_LATER, "operator_name", F.year("dtm").alias("year"), "dtm")


def clearing_house_passes(t: Tables) -> DataFrame:
    """The same up to the discount, with the pass of the matching use, which may be missing. Uses
    and products are looked up for the keys of each order's transactions alone, so that these and
    their many columns stay where they lie, dealt by the order."""
    uses = t("use_txn").select("transaction_id", "pass_id")
    names = lambda keys: _clearing_products(t, attach(keys, uses, {"transaction_id": "transaction_id"}, ["pass_id"]))
    rows = lookup_all(_known(t).drop("pass_id"), names, ["transaction_id", "fare_prod_key"], "order_nbr")
    return _clearing_names(t, rows).select(*_clearing_columns(), "pass_id")
