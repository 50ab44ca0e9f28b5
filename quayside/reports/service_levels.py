"""Outages and measures of service: monthly performance, availability, and their events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.reports.naming import Tables, attach, dollars

# Fixed values of the contract: categories, places and measures that the reports name.
PERFORMANCE_CATEGORY, ALWAYS_BANDED = 8, 9
COMPLEMENT_CATEGORIES = (2, 4, 8)
PLACES = ("A", "B", "C", "D")
TRANSIT_MEASURES, WHOLE_FAILURE = ("P1-18", "P2-19.1", "P2-19.2", "P2-20", "P3-21"), 999
LEFT_OUT = ("1", "2", "5", "6a", "8a", "8b")


def outages_in(t: Tables, start: str = "2024-01-10 00:00:00", end: str = "2024-01-20 23:59:59") -> DataFrame:
    """Outages that overlap a period; unknown bounds fall back on opening and closing."""
    begin, over = F.coalesce("outage_begin_dtm", "open_dtm"), F.coalesce("outage_end_dtm", "close_dtm")
    stamp = lambda x: F.lit(x).cast("timestamp_ntz")
    excluded = F.when(F.col("excluded") == 1, "Yes").otherwise("No")
    rows = t("outages").filter((over >= stamp(start)) & (begin <= stamp(end)))
    return rows.select(
        "operator_name", "facility_name", "availability_event_id", "event_type", "bus_id", "device_id", begin.alias("outage_begin"), over.alias("outage_end"), excluded.alias("event_excluded"),
        "failure_level", "fault_description", "root_cause_id", "location_category", "deadline_dtm",
    )


def _in_month(t: Tables, rows: DataFrame, month: str, year: int, take: dict[str, str]) -> DataFrame:
    days = t("kpi_calendar").filter((F.col("month_desc") == month) & (F.col("year") == year))
    return attach(rows, days, {"date_key": "transit_day_key"}, take, "inner")


def operation_performance(t: Tables, month: str = "January", year: int = 2024) -> DataFrame:
    """A month's deductions of the performance measures that are not sums of others, with
    their events by place; some measures' whole failures are a place of their own (PTT). A
    known place's deduction is its events', else the measure's."""
    run_date = F.lit(f"{month}-{year}")
    wanted = ~F.coalesce("grouped", F.lit("")).like("sum%") & (F.col("metric_category_id") == PERFORMANCE_CATEGORY)
    days = attach(_in_month(t, t("kpi_by_day"), month, year, {}), t("kpis").filter(wanted), {"kpi_id": "kpi_id"}, ["kpi_name", "units"], "inner")
    measures = days.groupBy("kpi_id", "kpi_name", "units").agg(dollars(F.sum("kpi_value")).alias("of_measure"))
    place = F.when(F.col("location_category").isin(*PLACES), F.col("location_category"))
    place = place.when(F.col("kpi_id").isin(*TRANSIT_MEASURES) & (F.col("failure_level") == WHOLE_FAILURE), "PTT").otherwise(F.col("location_category"))
    events = _in_month(t, t("kpi_events"), month, year, {}).groupBy("kpi_id", place.alias("location_category")).agg(
        F.count(F.lit(1)).alias("total_quantity"), F.round(F.avg("performance_time_basis"), 1).alias("average_resolution"), F.max("base_cure_period").alias("cure_period"),
        F.sum("recurrence_count").alias("recurrence_periods"), dollars(F.sum("kpi_value")).alias("of_place"),
    )
    known = F.col("location_category").isin(*PLACES, "PTT") & F.col("of_place").isNotNull()
    return measures.join(events, "kpi_id", "left").select(
        run_date.alias("run_date"), "kpi_id", "kpi_name", "location_category", "total_quantity", "average_resolution", "cure_period", "units", "recurrence_periods",
        F.when(known, F.col("of_place")).otherwise(F.col("of_measure")).alias("deduction_amount"),
    )


def _measured(t: Tables, month: str, year: int) -> DataFrame:
    """A month's measures: sums of value and quantity and the last day with a quantity. A
    measure that groups others takes its value and quantity from these, as its rule says
    (sum, max or min of values; sum or mean of quantities)."""
    wanted = F.col("deduction_basis_id").isNull() & (F.coalesce("metric_category_id", F.lit(0)) != PERFORMANCE_CATEGORY)
    about = ["kpi_name", "kpi_type", "units", "metric_category_id", "base_qty", "grouped"]
    days = attach(_in_month(t, t("kpi_by_day"), month, year, {}), t("kpis").filter(wanted), {"kpi_id": "kpi_id"}, about, "inner")
    last = F.max(F.when(F.col("kpi_quantity") > 0, F.col("transit_day_key")).otherwise(0))
    base = days.groupBy("kpi_id", *about).agg(F.sum("kpi_value").alias("own_value"), F.sum("kpi_quantity").alias("own_qty"), last.alias("last_day_key"))
    parts = attach(base.select(F.col("grouped").alias("of"), "own_value", "own_qty"), t("kpis"), {"kpi_id": "of"}, {"kpi_id": "parent_id", "grouped": "rule"}, "inner")
    parts = parts.groupBy("parent_id", "rule").agg(
        F.sum("own_value").alias("v_sum"), F.max("own_value").alias("v_max"), F.min("own_value").alias("v_min"), F.sum("own_qty").alias("q_sum"), F.avg("own_qty").alias("q_avg")
    )
    value = F.when(F.col("rule").like("max%"), F.col("v_max")).when(F.col("rule").like("min%"), F.col("v_min")).otherwise(F.col("v_sum"))
    quantity = F.when(F.col("rule").like("%/avg"), F.col("q_avg")).otherwise(F.col("q_sum").cast("double"))
    rows = attach(base, parts.select("parent_id", value.alias("part_value"), quantity.alias("part_qty")), {"parent_id": "kpi_id"}, ["part_value", "part_qty"])
    groups = F.coalesce(F.substring("grouped", 1, 3).isin("sum", "max", "min"), F.lit(False))
    return rows.select(
        "kpi_id", "kpi_name", "kpi_type", "units", "metric_category_id", "base_qty", "last_day_key",
        F.when(groups, F.coalesce("part_value", "own_value")).otherwise(F.col("own_value")).alias("measured"),
        F.when(groups, F.coalesce("part_qty", F.col("own_qty").cast("double"))).otherwise(F.col("own_qty").cast("double")).alias("total_qty"),
    )


def _kpi() -> Column:
    """A measure's figure: a total as it is, a share in thousandths of a percent (of some
    categories its complement), a mean; without a quantity a share is met in full."""
    kind, some = F.col("kind"), F.col("total_qty") > 0
    share = F.col("measured") / F.col("total_qty")
    value = F.when(kind.isin("TOT", "Each Day", "Days"), F.col("measured").cast("double"))
    value = value.when(some & (kind == "%") & F.col("metric_category_id").isin(*COMPLEMENT_CATEGORIES), F.round((1 - share) * 100000, 0))
    value = value.when(some & (kind == "%"), F.round(share * 100000, 0)).when(some & (kind == "AVG"), share)
    return value.when((kind == "%") & (F.col("a_minimum") == 0), 0.0).when(kind == "%", 100000.0).otherwise(0.0)


def system_availability(t: Tables, month: str = "January", year: int = 2024) -> DataFrame:
    """A month's measures with threshold, figure, band and deduction. The kind of a measure
    says what it is measured against: its last day, a base quantity, or the month."""
    rows, kind = _measured(t, month, year), F.col("kpi_type")
    last_day = t("kpi_by_day").select(F.col("kpi_id").alias("k"), F.col("transit_day_key").alias("d"), F.col("kpi_value").alias("last_value"), F.col("kpi_quantity").alias("last_qty"))
    rows = attach(rows, last_day, {"k": "kpi_id", "d": "last_day_key"}, ["last_value", "last_qty"])
    rows = rows.withColumns({
        "kind": F.when(kind.like("\\%%"), "%").otherwise(kind),
        "total_qty": F.when(kind == "%Last", F.col("last_qty").cast("double")).when(kind == "%Base", F.col("base_qty").cast("double")).otherwise(F.col("total_qty")),
        "measured": F.when(kind == "%Last", F.col("last_value")).otherwise(F.col("measured")),
    })
    best = t("kpi_targets").filter("kpi_band = 'A'")
    rows = attach(rows, best, {"kpi_id": "kpi_id"}, {"kpi_minimum": "a_minimum", "kpi_maximum": "a_maximum", "kpi_band": "a_band", "kpi_deduction_value": "a_deduction"})
    bands = t("kpi_targets").select(F.col("kpi_id").alias("b_id"), "kpi_band", "kpi_minimum", "kpi_maximum", "kpi_deduction_type", "kpi_deduction_value")
    rows = rows.withColumn("kpi", _kpi())
    rows = rows.join(bands, (F.col("kpi_id") == F.col("b_id")) & F.col("kpi").between(F.col("kpi_minimum"), F.col("kpi_maximum")), "left")
    bound = F.when(F.col("a_minimum") == 0, F.col("a_maximum")).otherwise(F.col("a_minimum"))
    percent, idle = F.col("kind") == "%", (F.col("metric_category_id") == ALWAYS_BANDED) & (F.col("total_qty") == 0)
    due = F.col("kpi_deduction_value")  # in percent, an idle measure is due what its best band is
    in_percent = F.round(F.when(idle, F.col("a_deduction")).otherwise(due) / 1000, 3)
    return rows.select(
        F.lit(f"{month}-{year}").alias("run_date"), "kpi_id", "kpi_name", "total_qty", F.col("measured").alias("measured_value"), "units",
        F.round(F.when(percent, bound / 1000).otherwise(bound.cast("double")), 2).alias("threshold_value"),
        F.round(F.when(percent, F.round(F.col("kpi") / 1000, 3)).otherwise(F.round("kpi")), 2).alias("kpi_value"),
        F.when(idle, F.col("a_band")).otherwise(F.col("kpi_band")).alias("band"),
        F.when(F.col("kpi_deduction_type") == "%", in_percent).otherwise(due.cast("double")).alias("sim"),
    )


EVENT = (
    "availability_event_id", "facility_name", "bus_id", "device_id", "start_dtm", "end_dtm", "kpi_value", "relief_value", "failure_level", "fault_description", "performance_time_basis",
    "root_cause_id", "location_category", "base_cure_period", "base_recurrence_period", "cure_period", "recurrence_period", "recurrence_count", "event_type", "gross_daily_value",
)


def _events(t: Tables, month: str, year: int, not_like: str) -> DataFrame:
    """A month's distinct events of measures that are reported and not of one family."""
    rows = _in_month(t, t("kpi_events"), month, year, {"dtm": "transit_day"})
    rows = rows.filter(~F.col("kpi_id").isin(*LEFT_OUT) & ~F.col("kpi_id").like(not_like))
    rows = attach(rows, t("kpis"), {"kpi_id": "kpi_id"}, ["kpi_name", "units", "metric_category_id", "deduction_basis_id"], "inner")
    excluded = F.when(F.col("excluded") == 1, "Yes").when(F.col("excluded") == 2, "Excluded").otherwise("No")
    return rows.select("transit_day", "kpi_id", "kpi_name", "units", "metric_category_id", "deduction_basis_id", *EVENT, excluded.alias("exception")).distinct()


def availability_events(t: Tables, month: str = "January", year: int = 2024) -> DataFrame:
    return _events(t, month, year, "P%").select(
        "kpi_id", "transit_day", F.col("availability_event_id").alias("ticket_id"), "facility_name", F.col("bus_id").alias("vehicle_id"), "device_id", "start_dtm", "end_dtm",
        F.col("gross_daily_value").alias("gross_value"), F.col("kpi_value").alias("net_value"), "units", "event_type", F.col("failure_level").alias("kpi_level"), "exception", "root_cause_id",
        "fault_description",
    )


def performance_events(t: Tables, month: str = "January", year: int = 2024) -> DataFrame:
    return _events(t, month, year, "A%").select(
        "kpi_id", F.col("availability_event_id").alias("ticket_id"), "facility_name", "device_id", "start_dtm", "end_dtm", F.col("performance_time_basis").alias("accrued_time"), "units",
        dollars(F.col("kpi_value")).alias("deduction_amount"), F.col("failure_level").alias("kpi_level"), "fault_description", "root_cause_id", "location_category",
        F.col("base_cure_period").alias("cure_period"), F.col("base_recurrence_period").alias("recurrence_period"), F.col("cure_period").alias("adj_cure_period"),
        F.col("recurrence_period").alias("adj_recurrence_period"), "recurrence_count",
    )
