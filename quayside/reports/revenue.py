"""Fare revenue: summaries by component, schedules, trips, recovery and adjustments.

``t`` maps table names to DataFrames. Amounts are integer cents until the last step.
Dimensions are small, but only Catalyst decides to broadcast them, by their size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.reports.naming import Tables, attach, day, dollars, only_row, zero

MAP_KEYS = ["txn_source", "sales_channel_key", "payment_type_key"]
SUMMARY = ["settlement_day_key", "operating_day_key", "payment_type_key", "txn_channel_display", "sales_channel_display"]
# Fixed values of the feeds: sale and ride types, channels, payment types and reasons.
LATE_SALE, BANKCARD_SALE, ADJUSTMENT_SALE, ADJUSTMENT_RIDE = 26, 20, 22, 24
BANKCARD_TYPES = (1, 2, 3)
TAP_CHANNEL, TAP_PAYMENT_TYPE, ADJUSTMENT_CHANNEL = 8, 2, 14
TYPE_2_REASONS, TYPE_4_REASONS = (990951, 990961), (990952, 990962)


def _component(t: Tables, group: str) -> DataFrame:
    """Payments of a group's channels. The group's few sources are looked up first (one row), so
    that payments of others leave where they are read, before they are joined or moved."""
    channels = t("txn_channel_map").filter(F.col("txn_group") == group)
    sources = channels.agg(F.collect_set("txn_source")).scalar()
    return t("payment_summary").filter(F.array_contains(sources, F.col("txn_source"))).join(channels, MAP_KEYS)


def component_a(t: Tables) -> DataFrame:
    """Product sales by day, payment type and channel."""
    stored = ["transit_value", "benefit_value", "bankcard_payment_value", "one_account_value"]
    sums = {"stored_value": stored, "pass_cost": ["pass_cost"], "enablement_fee": ["enablement_fee"], "total_fare_revenue": [*stored, "pass_cost", "enablement_fee", "replacement_fee"]}
    return _component(t, "Product Sales").groupBy(*SUMMARY).agg(*(dollars(F.sum(zero(*c))).alias(name) for name, c in sums.items()))


def component_b(t: Tables) -> DataFrame:
    return _component(t, "Open Payment Trips").groupBy(*SUMMARY).agg(dollars(F.sum(zero("payment_value"))).alias("total_fare_revenue"))


def component_c(t: Tables) -> DataFrame:
    """Recovery amounts of one kind of product, by rider class and rule."""
    products = t("products").filter("monetary_inst_type_id = 2").select("fare_prod_key", "fare_prod_name")
    rows = t("recovery_txn").filter("minimum_fare_charge is not null").join(products, "fare_prod_key").join(t("rider_classes"), "rider_class_id", "left")
    keys = ["settlement_day_key", "operating_day_key", "rider_class_name", "fare_prod_name", "service_type_id", "fare_rule_description", "recovery_txn_type"]
    return rows.groupBy(*keys).agg(dollars(F.sum("minimum_fare_charge")).alias("recovery_calculation_amount"))


def component_d(t: Tables) -> DataFrame:
    rows = _component(t, "Direct Refunds Applied").join(t("reasons"), "reason_key", "left")
    return rows.groupBy(*SUMMARY, "reason_name").agg(dollars(F.sum("payment_value")).alias("refund_value"))


def _adjustment_rule() -> Column:
    """Which payments count for a trip's use: reversed refunds, unreversed fares, or an
    adjustment on an adjustment ride."""
    plain = (F.col("je_is_fare_adjustment") == 0) & (F.col("ride_type_key") != ADJUSTMENT_RIDE)
    return (plain & (F.col("is_reversal") == 1) & (F.col("fare_due") < 0)) | (plain & (F.col("is_reversal") == 0) & (F.col("fare_due") > 0)) | ((F.col("je_is_fare_adjustment") == 1) & (F.col("ride_type_key") == ADJUSTMENT_RIDE))


def _charged() -> Column:
    return (F.col("bankcard_payment_value") != 0) | (F.col("u_uncollectible") != 0) | (F.col("value_changed") != 0)


USE = (
    "patron_trip_id", "source", "trip_price_count", "dw_transaction_id", "transaction_dtm", "device_id", "transit_account_id", "transfer_sequence_nbr", "operator_key", "card_key", "media_type_key",
    "ride_type_key", "txn_status_key", "fare_due", "value_changed", "bankcard_payment_value", "retrieval_ref_nbr", "token_id", "operating_day_key", "settlement_day_key", "posting_day_key",
)


def _in_trip(rows: DataFrame, side: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined with ``side`` on the trip and on ``keys``. The trip alone deals both sides,
    as it does in every join and sum of a trip's rows, so none is moved twice: the few rows of a
    trip are compared with each other, and an equality there would deal by that key as well."""
    side = side.withColumnsRenamed({k: f"__in_{k}" for k in ("patron_trip_id", *keys)})
    on = F.col("patron_trip_id") == F.col("__in_patron_trip_id")
    for k in keys:
        on &= F.col(k).between(F.col(f"__in_{k}"), F.col(f"__in_{k}"))
    return rows.join(side, on, how).drop("__in_patron_trip_id", *(f"__in_{k}" for k in keys))


def _uses_with_payments(t: Tables, by_source: bool = True) -> DataFrame:
    """Uses with their trip and its payments of the same price and, where asked, source."""
    keys = ["source"] if by_source else []
    uses = t("use_txn").select(*USE, F.col("uncollectible_amount").alias("u_uncollectible"))
    trips = t("patron_trip").select("patron_trip_id", *keys, "fare_rule_description")
    payments = t("trip_payment").withColumnRenamed("transaction_dtm", "paid_dtm")
    if not by_source:
        payments = payments.drop("source")
    return _in_trip(_in_trip(uses, trips, keys), payments, [*keys, "trip_price_count"])


def _sales_by_trip(t: Tables, sales: DataFrame, key: str) -> DataFrame:
    """``sales`` beside each trip that has payments of their ``key``: two keys of the payments are
    all that meets the sales, and payments without that key are not moved for it."""
    ids = t("trip_payment").select("patron_trip_id", key).filter(F.col("patron_trip_id").isNotNull() & F.col(key).isNotNull())
    return ids.repartition(key).distinct().join(sales, key)


def _extension() -> Column:
    return F.when((F.col("transfer_sequence_nbr") > 0) & (F.col("fare_due") != 0), "Transfer")


TRIP = [
    "txn_channel_display", "computation_type", "operating_date", "transaction_dtm", "posting_date", "settlement_date", "operator_name", "device_id", "dw_transaction_id", "transit_account_id",
    "patron_trip_id", "tap_id", "fare_rule_description", "transfer_sequence_nbr", "payment_type_name", "bin", "fare_revenue", "extension_charge_reason", "retrieval_ref_nbr", "payment_type_key",
    "operating_day_key", "settlement_day_key", "posting_day_key",
]


def _trip_columns(rows: DataFrame, **columns: Column) -> DataFrame:
    """The columns of a trip's revenue; its dates are those of its day keys."""
    dates = {f"{role}_date": day(f"{role}_day_key") for role in ("operating", "posting", "settlement")}
    return rows.withColumns({"computation_type": F.lit("B"), **dates, **columns}).select(*TRIP)


def tap_revenue(t: Tables, few: bool = False) -> DataFrame:
    """Revenue of each tap in cents, summed over its payments; zero sums are left out. All
    taps have one payment type and one channel, looked up once (one row each). Sales come to
    the trips, or where the uses are ``few`` beside the payments, the uses go to the sales."""
    sales = t("sale_txn")
    late = sales.filter(F.col("sale_type_key") == LATE_SALE).select("purse_load_id", F.lit(True).alias("late")).filter("purse_load_id is not null")
    cards = sales.filter((F.col("sale_type_key") == BANKCARD_SALE) & F.col("bankcard_payment_type_key").isin(*BANKCARD_TYPES))
    cards = cards.select("bankcard_payment_id", F.col("retrieval_ref_nbr").alias("sale_ref_nbr")).filter("bankcard_payment_id is not null")
    rows = _uses_with_payments(t).filter(_adjustment_rule() & _charged())
    if few:
        rows = rows.join(late, "purse_load_id", "left").join(cards, "bankcard_payment_id", "left")
    else:
        for sale, key in ((late, "purse_load_id"), (cards, "bankcard_payment_id")):
            rows = _in_trip(rows, _sales_by_trip(t, sale, key), [key], "left")
    rows = attach(rows, t("media_types"), {"media_type_key": "media_type_key"}, ["payg_flag"], "inner")
    payg = F.col("payg_flag") == 1
    amount = F.col("bankcard_value") + F.when(F.col("bankcard_payment_id").isNotNull() | payg, F.col("uncollectible_amount")).otherwise(0)
    amount += F.when(F.col("late") & payg, F.col("stored_value")).otherwise(0)
    keys = [
        "operating_day_key", "settlement_day_key", "posting_day_key", "transaction_dtm", "device_id", "dw_transaction_id", "transit_account_id", "patron_trip_id", "transfer_sequence_nbr",
        "operator_key", "card_key", "fare_rule_description", "sale_ref_nbr",
    ]
    sums = rows.groupBy(*keys, _extension().alias("extension_charge_reason")).agg(F.sum(amount).alias("raw")).filter("raw <> 0")
    rows = attach(attach(sums, t("cards"), {"card_key": "card_key"}, ["bin"]), t("operators"), {"operator_key": "operator_key"}, ["operator_name"])
    kind = t("payment_types").filter(F.col("payment_type_key") == TAP_PAYMENT_TYPE).select("payment_type_name", "payment_type_key")
    channel = (F.col("txn_source") == "UseTxn") & (F.col("sales_channel_key") == TAP_CHANNEL) & (F.col("payment_type_key") == TAP_PAYMENT_TYPE)
    rows = rows.join(F.broadcast(only_row(kind))).join(F.broadcast(only_row(t("txn_channel_map").filter(channel).select("txn_channel_display"))))
    return _trip_columns(rows, fare_revenue=-F.col("raw"), tap_id=F.lit(None).cast("long"), retrieval_ref_nbr=F.col("sale_ref_nbr"))


def adjustment_revenue(t: Tables) -> DataFrame:
    """Adjustment sales of pay-as-you-go media in cents, a row per payment and read of the
    tap; their reason says which payment type of the adjustment channel they count to."""
    kind = F.when(F.col("reason_key").isin(*TYPE_2_REASONS), 2).otherwise(4)
    wanted = (F.col("sale_type_key") == ADJUSTMENT_SALE) & F.col("operating_day_key").isNotNull() & F.col("reason_key").isin(*TYPE_2_REASONS, *TYPE_4_REASONS)
    rows = t("sale_adjustments").filter(wanted).withColumn("payment_type_key", kind)
    rows = attach(rows, t("media_types").filter("payg_flag = 1"), {"media_type_key": "media_type_key"}, how="inner")
    channels = t("txn_channel_map").filter((F.col("txn_source") == "UseTxn") & (F.col("sales_channel_key") == ADJUSTMENT_CHANNEL))
    rows = attach(rows, channels, {"payment_type_key": "payment_type_key"}, ["txn_channel_display"], "inner")
    rows = attach(rows, t("payment_types"), {"payment_type_key": "payment_type_key"}, ["payment_type_name"], "inner")
    rows = rows.join(t("sale_payments"), ["dw_transaction_id", "transaction_dtm"]).join(t("reads"), "tap_id", "left")
    rows = attach(attach(rows, t("operators"), {"operator_key": "operator_key"}, ["operator_name"]), t("cards"), {"card_key": "card_key"}, ["bin"])
    none = {c: F.lit(None).cast("string") for c in ("fare_rule_description", "extension_charge_reason")} | {c: F.lit(None).cast("long") for c in ("patron_trip_id", "transfer_sequence_nbr")}
    return _trip_columns(rows, fare_revenue=F.col("payment_value"), **none)


def trip_revenue(t: Tables, few: bool = False) -> DataFrame:
    """Taps and adjustment sales, in cents; adjustments have no trip, rule or extension."""
    return tap_revenue(t, few).unionByName(adjustment_revenue(t))


def _addendum_days(schedule: DataFrame) -> DataFrame:
    """The days of each report's window, as keys."""
    s = schedule.select("due_day_key", "adden_max_operating_day_key", "adden_min_settlement_day_key", "adden_max_settlement_day_key", "deposit_due_day_key").distinct()
    s = s.filter("adden_min_settlement_day_key <= adden_max_settlement_day_key")  # a sequence would run backwards
    days = s.select("due_day_key", "adden_max_operating_day_key", F.explode(F.sequence("adden_min_settlement_day_key", "adden_max_settlement_day_key")).alias("__day"))
    return days.filter("__day % 100 between 1 and 31 and __day div 100 % 100 between 1 and 12")  # keys of days, across years too


def in_addendum(rows: DataFrame, schedule: DataFrame) -> DataFrame:
    """Rows of a fact that some addendum may show, by those of the two day keys that it has."""
    if "settlement_day_key" not in rows.columns:
        return rows
    on = F.col("settlement_day_key") == F.col("__day")
    if "operating_day_key" in rows.columns:
        on &= F.col("operating_day_key") <= F.col("adden_max_operating_day_key")
    return rows.join(_addendum_days(schedule), on, "left_semi")


def in_computation(rows: DataFrame, schedule: DataFrame) -> DataFrame:
    """Rows of a fact that some computation may show, by those of the two day keys that it has."""
    if "operating_day_key" not in rows.columns:
        return rows
    on = F.col("operating_day_key") == F.col("comp_operating_day_key")
    if "settlement_day_key" in rows.columns:
        on &= F.col("settlement_day_key") <= F.col("comp_max_settlement_day_key")
    return rows.join(schedule.select("comp_operating_day_key", "comp_max_settlement_day_key"), on, "left_semi")


def addendum(rows: DataFrame, schedule: DataFrame) -> DataFrame:
    """Rows of each report's addendum: operated up to its day, settled within its window.
    The window's days are an equi-join key, so a row meets the reports of its own day."""
    days = _addendum_days(schedule)
    on = (F.col("settlement_day_key") == F.col("__day")) & (F.col("operating_day_key") <= F.col("adden_max_operating_day_key"))
    return rows.join(days, on).select(F.col("due_day_key").alias("report_due_day_key"), F.lit("Y").alias("addendum"), *rows.columns)


def computation(rows: DataFrame, schedule: DataFrame) -> DataFrame:
    """Rows of each report's computation: operated on its day, settled by its last."""
    s = schedule.select("due_day_key", "comp_operating_day_key", "comp_max_settlement_day_key")
    on = (F.col("operating_day_key") == F.col("comp_operating_day_key")) & (F.col("settlement_day_key") <= F.col("comp_max_settlement_day_key"))
    return rows.join(s, on).select(F.col("due_day_key").alias("report_due_day_key"), F.lit("N").alias("addendum"), *rows.columns)


def _trip_report(rows: DataFrame) -> DataFrame:
    mode = F.when(F.col("operator_name") == "Subway", "Transit").otherwise(F.col("operator_name"))
    return rows.withColumns({"transit_mode_name": mode, "fare_revenue": F.round(dollars(F.col("fare_revenue")), 2)}).drop("operator_name", "payment_type_key")


def _due_trips(t: Tables, due: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """Trips of the uses and adjustments that a report may show; no others are joined."""
    return trip_revenue(lambda name: due(t(name), t("schedule")) if name in ("use_txn", "sale_adjustments") else t(name), few=True)


def trip_revenue_addendum(t: Tables) -> DataFrame:
    return _trip_report(addendum(_due_trips(t, in_addendum), t("schedule")))


def trip_revenue_computation(t: Tables) -> DataFrame:
    return _trip_report(computation(_due_trips(t, in_computation), t("schedule")))


def component_b_addendum(t: Tables) -> DataFrame:
    """Open-payment trip revenue with the older sign rules by journal type and status."""
    late = t("sale_txn").filter(F.col("sale_type_key") == LATE_SALE).select("purse_load_id").filter("purse_load_id is not null")
    rows = attach(_uses_with_payments(t).join(late, "purse_load_id"), t("cards"), {"card_key": "card_key"}, ["bin"], "inner")
    usual, status = F.col("journal_entry_type_id") != 131, F.col("txn_status_key")
    reversed_ = usual & (F.col("is_reversal") == 1) & status.isin(36, 59)
    plain = usual & (F.col("is_reversal") == 0) & ~status.isin(36, 59, 50)
    adjusted = (F.col("journal_entry_type_id") == 131) & (F.col("ride_type_key") == ADJUSTMENT_RIDE)
    amount = F.col("bankcard_value") + F.when(F.col("bankcard_payment_id").isNotNull(), F.col("uncollectible_amount")).otherwise(0) + F.col("stored_value")
    dates = [F.col(f"{role}_day_key").alias(f"{role}_date") for role in ("operating", "posting", "settlement")]
    return rows.filter((reversed_ | plain | adjusted) & _charged()).select(
        "dw_transaction_id", "transit_account_id", *dates, "transaction_dtm", "patron_trip_id", "fare_rule_description", "transfer_sequence_nbr", "bin", (-amount).alias("fare_revenue"),
        _extension().alias("extension_charge_reason"), "retrieval_ref_nbr",
    )


def late_tap_adjustment(t: Tables) -> DataFrame:
    sales = t("sale_txn").filter(F.col("sale_type_key") == LATE_SALE)
    sales = sales.select("purse_load_id", F.col("settlement_day_key").alias("s_settled"), F.col("operating_day_key").alias("s_operated"))
    rows = _uses_with_payments(t, by_source=False).filter((F.col("value_changed") != 0) & _adjustment_rule()).join(sales, "purse_load_id")
    rows = attach(rows, t("operators"), {"operator_key": "operator_key"}, {"travel_mode_id": "mode"})
    rows = attach(rows, t("travel_modes"), {"travel_mode_id": "mode"}, ["travel_mode_name"])
    return rows.select(
        F.col("s_settled").alias("settlement_day_key"), F.col("s_operated").alias("operating_day_key"), "patron_trip_id", "trip_price_count", "is_reversal", "token_id", "purse_load_id",
        dollars(-F.col("stored_value")).alias("uncollectible_amount"), F.col("paid_dtm").alias("transaction_dtm"), "transit_account_id", "travel_mode_name",
    )


def recovery(t: Tables) -> DataFrame:
    """Recovery transactions with their three dates and names, in cents."""
    rows = t("recovery_txn")
    for role in ("operating", "posting", "settlement"):
        rows = attach(rows, t("calendar"), {"date_key": f"{role}_day_key"}, {"dtm": f"{role}_date"}, "inner")
    rows = attach(rows, t("service_types"), {"service_type_id": "service_type_id"}, ["service_type_name"])
    rows = attach(rows, t("stop_points"), {"stop_point_key": "stop_point_key"}, ["stop_point_name"])
    rows = attach(rows, t("routes"), {"route_key": "route_key"}, ["route_name"])
    rows = attach(rows, t("rider_classes"), {"rider_class_id": "rider_class_id"}, ["rider_class_name"])
    rows = attach(rows, t("products").filter("monetary_inst_type_id = 2"), {"fare_prod_key": "fare_prod_key"}, ["fare_prod_name"])
    return rows.select(
        F.lit("C").alias("computation_type"), "operating_date", "transaction_dtm", "posting_date", "settlement_date", "service_type_name", F.coalesce("stop_point_name", "route_name").alias("location"),
        "device_id", F.col("source_table_uk").alias("transaction_id"), "tap_id", "trip_id", "rider_class_name", "fare_prod_name", "fare_rule_description", "recovery_txn_type", "incident_id",
        "supervening_event", F.col("minimum_fare_charge").alias("recovery_calculation_amount"), "operating_day_key", "settlement_day_key", "posting_day_key",
    )


def _in_dollars(rows: DataFrame) -> DataFrame:
    return rows.withColumn("recovery_calculation_amount", F.round(dollars(F.col("recovery_calculation_amount")), 2))


def recovery_addendum(t: Tables) -> DataFrame:
    return _in_dollars(addendum(recovery(t), t("schedule")))


def recovery_computation(t: Tables) -> DataFrame:
    return _in_dollars(computation(recovery(t), t("schedule")))
