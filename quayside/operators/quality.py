"""Data quality, incremental ingestion, and freshness of tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions.scratch import saved
from quayside.operators.carry import running
from quayside.sources.files import delete


def count_reconcile(data: DataFrame, announced: DataFrame, key: str = "job_id") -> DataFrame:
    """Rows per job against announced counts, jobs of either side alone included."""
    seen = data.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    status = F.when(F.col("data_count").isNull(), "missing_in_counts").when(F.col("n_rows").isNull(), "missing_in_data").when(F.col("n_rows") != F.col("data_count"), "different").otherwise("ok")
    return seen.join(announced, key, "full_outer").select(key, "n_rows", "data_count", status.alias("status"))


def column_set_check(rows: DataFrame, json_col: str, expected: list[str]) -> DataFrame:
    """(column, issue, n_rows): keys in the data that the schema lacks, and the reverse; the
    data are read once."""
    want = F.array(*map(F.lit, expected))
    keys = F.coalesce(F.json_object_keys(json_col), F.array())
    told = lambda names, issue: F.transform(names, lambda c: F.struct(c.alias("column"), F.lit(issue).alias("issue")))
    issues = F.concat(told(F.array_except(keys, want), "extra"), told(F.array_except(want, keys), "missing"))
    return rows.select(F.explode(issues).alias("i")).groupBy("i.column", "i.issue").agg(F.count(F.lit(1)).alias("n_rows"))


def json_page_check(rows: DataFrame, json_col: str, page: str, order: str, numbers: list[str], objects: list[str], known: list[str]) -> DataFrame:
    """(column, issue, first_page) of each page's first record (by ``order``): columns that
    are not ``known``, numbers that are none, and objects that are scalars; null is always
    fine. Each is told once, with its first page."""
    first = rows.groupBy(page).agg(F.min_by(json_col, order).alias(json_col))

    def value(c: str) -> Column:
        return F.get_json_object(json_col, f"$.{c}")

    def told(bad: Column, c: str, issue: str) -> Column:
        return F.when(bad, F.struct(F.lit(c).alias("column"), F.lit(issue).alias("issue")))

    bad = [told(value(c).isNotNull() & value(c).try_cast("double").isNull(), c, "not_number") for c in numbers]
    bad += [told(value(c).isNotNull() & ~value(c).rlike(r"^\s*[\[{]"), c, "not_json") for c in objects]
    extra = F.array_except(F.coalesce(F.json_object_keys(json_col), F.array()), F.array(*map(F.lit, known)))
    extra = F.transform(extra, lambda c: F.struct(c.alias("column"), F.lit("extra").alias("issue")))
    issues = F.concat(F.filter(F.array(*bad), lambda x: x.isNotNull()), extra)
    found = first.select(page, F.explode(issues).alias("b"))
    return found.groupBy("b.column", "b.issue").agg(F.min(page).alias("first_page"))


def numeric_coerce(df: DataFrame, columns: list[str]) -> DataFrame:
    """Strings to doubles; what isn't a number becomes null."""
    return df.withColumns({c: F.expr(f"try_cast({c} as double)") for c in columns})


def coercion_warnings(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n_bad) of the columns that hold something else than numbers."""
    pairs = ", ".join(f"'{c}', {c}" for c in columns)
    long = df.selectExpr(f"stack({len(columns)}, {pairs}) as (column, value)")
    return long.filter("value is not null and try_cast(value as double) is null").groupBy("column").agg(F.count(F.lit(1)).alias("n_bad"))


def json_serialize(df: DataFrame, columns: list[str]) -> DataFrame:
    """Arrays, maps and structs as JSON text; scalars as they are."""
    nested = {f.name for f in df.schema if f.dataType.typeName() in ("array", "map", "struct")}
    return df.withColumns({c: F.to_json(c) for c in columns if c in nested})


def load_invariants(history: DataFrame, dated: str | None = None) -> DataFrame:
    """One row: load rows, those without a date, and whether the load may go on."""
    loads = F.col("change_oper") == "L"
    undated = F.count_if(loads & F.col(dated).isNull()) if dated else F.lit(0).cast("long")
    return history.agg(F.count_if(loads).alias("n_loads"), undated.alias("n_undated")).withColumn("ok", F.expr("n_loads > 0 and n_undated = 0"))


def cdc_invariants(cdc: DataFrame, keys: list[str], date: str | None = None, required: tuple[str, ...] = ()) -> DataFrame:
    """One row of counts that must all be 0: records without sequence, key or known
    operation, inserts without a date (of tables that are kept by date), and required
    columns that the records lack."""
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    undated = F.count_if((F.col("change_oper") == "I") & F.col(date).isNull()) if date else F.lit(0).cast("long")
    absent = len({*keys, *required} - set(cdc.columns))
    return cdc.agg(
        F.count_if(F.col("change_seq").isNull()).alias("null_seq"), F.count_if(null_key).alias("null_key"),
        F.count_if(F.col("change_oper").isNull() | ~F.col("change_oper").isin("I", "U", "D", "L", "B")).alias("unknown_oper"),
        undated.alias("undated_inserts"), F.lit(absent).cast("long").alias("absent_columns"),
    )


def assert_load(history: DataFrame, dated: str | None = None) -> None:
    """Raise unless ``load_invariants`` hold."""
    found = load_invariants(history, dated).first()
    if not found["ok"]:
        raise ValueError(f"the snapshot can't be loaded: {found['n_loads']} load rows, {found['n_undated']} of them without a date")


def assert_cdc(cdc: DataFrame, keys: list[str], date: str | None = None, required: tuple[str, ...] = ()) -> None:
    """Raise if any of ``cdc_invariants`` is broken."""
    absent = sorted({*keys, *required} - set(cdc.columns))
    if absent:
        raise ValueError(f"the change records lack the columns {', '.join(absent)}")
    broken = {k: n for k, n in cdc_invariants(cdc, keys, date, required).first().asDict().items() if n}
    if broken:
        raise ValueError("broken change records: " + ", ".join(f"{k} {n}" for k, n in broken.items()))


def assert_stable(cdc: DataFrame, keys: list[str], date: str) -> None:
    """Raise if a key's date takes more than one value, for tables whose rows may not move."""
    moving = partition_stability(cdc, keys, date)
    some = moving.limit(5).collect()
    if some:
        raise ValueError(f"{moving.count()} keys with more than one {date}, such as {[tuple(r[k] for k in keys) for r in some]}")


def partition_stability(cdc: DataFrame, keys: list[str], date: str) -> DataFrame:
    """Keys whose date takes more than one value in a batch."""
    return cdc.groupBy(*keys).agg(F.countDistinct(date).alias("n_dates")).filter("n_dates > 1")


def table_health(before: DataFrame, after: DataFrame, key: str = "table_id") -> DataFrame:
    """(table, issues): what got worse between two measurements of rows, files, bytes and
    smallest and largest id."""
    j = before.alias("b").join(after.alias("a"), key)
    tests = {
        "max_id_fell": "a.max_id < b.max_id", "min_id_rose": "a.min_id > b.min_id", "rows_fell": "a.n_rows < b.n_rows",
        "bytes_fell": "a.n_bytes < 0.75 * b.n_bytes", "files_fell": "a.n_files < b.n_files",
    }
    issues = F.filter(F.array(*(F.when(F.expr(t), name) for name, t in tests.items())), lambda x: x.isNotNull())
    return j.select(key, F.array_join(issues, ",").alias("issues")).filter("issues <> ''")


def drop_private(df: DataFrame, private: list[str], allowed: tuple[str, ...] = ()) -> DataFrame:
    """Without private columns, but for those a restricted run may read."""
    return df.drop(*(c for c in private if c not in allowed))


# ---- incremental ingestion -------------------------------------------------------


def high_watermark(loaded: DataFrame, column: str, start) -> DataFrame:
    """One row: where to resume, the largest loaded value or the configured start."""
    return loaded.agg(F.greatest(F.max(column), F.lit(start)).alias("watermark"))


def boundary_drop(rows: DataFrame, ts: str) -> DataFrame:
    """Without the rows at the batch's last time: the next run, which starts above what is
    kept, reads them whole."""
    last = rows.agg(F.max(ts).alias("__last"))
    return rows.join(F.broadcast(last), F.col(ts) < F.col("__last")).drop("__last")  # one row


def range_batches(jobs: DataFrame, above: int, target: int, key: str = "job_id", size: str = "data_count", rounds: int = 40) -> DataFrame:
    """Jobs above the watermark in order, each with the batch it is asked for in: a batch
    closes with the job that brings its size beyond the target, and the next one starts at
    zero. From every job's running sum the job that would close a batch after it is found, in
    one pass over both in order; the closing jobs are reached from the start by jumps that
    double, so nothing is read in turn; and a job's batch is how many closed before it."""
    spark, number = jobs.sparkSession, lambda v: F.lit(v).cast("long")
    rows = running(jobs.filter(F.col(key) > above).select(key, size), [key], {"running": ("sum", F.col(size))})
    points = rows.filter(F.col(size) > 0).select(F.col("running").alias("p")).distinct()
    start = spark.range(1).select(number(0).alias("p"))
    asked = points.union(start).select(F.col("p").alias("id"), (F.col("p") + target).alias("at"), number(None).alias("p"), F.lit(0).alias("kind"))
    met = asked.union(points.select(number(None), "p", "p", F.lit(1))).withColumn("down", -F.col("at"))
    # from the largest sum down, the last point passed is the least one above what is asked
    jump = running(met, ["down", "kind", "id"], {"next": ("last", F.col("p"))}).filter("kind = 0 and next is not null")
    own: list[str] = []  # scratch tables that the result does not read
    try:
        jump, reached = saved(jump.select("id", F.col("next").alias("p")), "jump", own), start.select(F.col("p").alias("id"))
        for _ in range(rounds):  # each doubles how far a jump goes: 2**40 batches at most
            more = reached.join(jump, "id").select(F.col("p").alias("id"))
            if more.isEmpty():
                break
            reached = saved(reached.union(more).distinct(), "reached", own)
            jump = saved(jump.alias("a").join(jump.alias("b"), F.col("a.p") == F.col("b.id")).select("a.id", "b.p"), "jump", own)
        else:
            raise RuntimeError(f"more than 2**{rounds} batches")
        closes = reached.filter("id > 0").select(number(None).alias(key), number(None).alias(size), F.col("id").alias("running"), F.lit(1).alias("closes"))
        asked_for = rows.select(F.col(key).cast("long").alias(key), F.col(size).cast("long").alias(size), "running", F.lit(0).alias("closes"))
        out = running(asked_for.union(closes), ["running", "closes", key], {"batch_no": ("sum", F.col("closes"))})
    finally:
        for path in own:
            delete(spark, path)
    return out.filter("closes = 0").select(key, size, "running", "batch_no")


def backlog(jobs: DataFrame, ingested: int, page_limit: int = 10_000, key: str = "job_id", size: str = "data_count") -> DataFrame:
    pending = F.col(key) > ingested
    out = jobs.agg(F.count_if(pending).alias("jobs_lag"), F.coalesce(F.sum(F.when(pending, F.col(size))), F.lit(0)).alias("rows_lag"), F.max(key).alias("latest"), (F.count(F.lit(1)) >= page_limit).alias("truncated"))
    return out.withColumn("rerun_soon", F.col("jobs_lag") > 1)


def row_capped_run(rows: DataFrame, ts: str, tie: str, limit: int) -> DataFrame:
    """The first ``limit`` rows by time, each with whether the run was capped."""
    some = rows.orderBy(ts, tie).limit(limit + 1)
    ranked = some.withColumn("__n", F.row_number().over(Window.orderBy(ts, tie)))  # limit + 1 rows
    capped = ranked.agg((F.count(F.lit(1)) > limit).alias("capped"))
    return ranked.filter(F.col("__n") <= limit).drop("__n").join(F.broadcast(capped))


def out_of_order_pages(rows: DataFrame, feed: str, page: str, ts: str) -> DataFrame:
    """Pages of a feed whose first time precedes an earlier page's last."""
    pages = rows.groupBy(feed, page).agg(F.min(ts).alias("low"), F.max(ts).alias("high"))
    pages = running(pages, [page], {"before": ("max", F.col("high"))}, by=(feed,), before=True)
    return pages.filter("low < before").select(feed, page, "low", "before")


# ---- freshness -------------------------------------------------------------------


def seq_to_timestamp(seq: Column) -> Column:
    """The time in a change sequence's first 14 digits; null if there is none."""
    return F.try_to_timestamp(F.substring(seq, 1, 14), F.lit("yyyyMMddHHmmss"))


def ms_to_timestamp(ms: Column) -> Column:
    return F.timestamp_millis(ms.cast("long"))


def lag_seconds(newer: str, older: str) -> Column:
    """Whole seconds, cut towards zero, negative if the order is the other way round."""
    return F.expr(f"timestampdiff(SECOND, {older}, {newer})")


def progress(history: DataFrame, key: str = "table_id") -> DataFrame:
    """Each run against the one before it of the same table. Throughput is by the time the
    run worked (``run_s``): rows a second, days of data an hour, and the seconds of work left
    to catch up. Keeping up is by the time since the run before: the watermark's advance over
    it, and how long catching up takes while the source moves on, null if it never will.
    Where the run before measured something else, another ``snapshot`` or time column
    (``time_column``, where the history has them), nothing but the run's duration is told."""
    w = Window.partitionBy(key).orderBy("run_at")
    told = [c for c in ("snapshot", "time_column") if c in history.columns]
    rows = history.withColumns({f"p_{c}": F.lag(c).over(w) for c in ("run_at", "row_count", "watermark_at", *told)}).filter("p_run_at is not null")
    for c in told:
        rows = rows.withColumns({p: F.when(F.col(c).eqNullSafe(F.col(f"p_{c}")), F.col(p)) for p in ("p_run_at", "p_row_count", "p_watermark_at")})
    rows = rows.withColumns({
        "took": lag_seconds("run_at", "p_run_at"), "advance": lag_seconds("watermark_at", "p_watermark_at"), "rows_added": F.expr("row_count - p_row_count"),
    })
    known = F.col("advance").isNotNull()
    worked, timed, caught = F.col("run_s") > 0, F.col("took") > 0, known & (F.col("lag_s") <= 0)
    advance, took, run_s, lag = (F.col(c).cast("double") for c in ("advance", "took", "run_s", "lag_s"))
    gaining = timed & (F.col("advance") > F.col("took"))
    work_left = F.when(caught, 0).when(worked & (F.col("advance") > 0), F.floor(lag / (advance / run_s)))
    wall_left = F.when(caught, 0).when(gaining, F.floor(lag / ((advance - took) / took)))
    projected = F.when(~caught & gaining, F.expr("timestampadd(SECOND, cast(catchup_wall_s as int), run_at)"))
    return rows.withColumn("catchup_wall_s", wall_left.cast("long")).select(
        key, "run_at", F.col("run_s").alias("run_duration_s"), "rows_added", "took", "advance", F.when(worked, F.round(F.col("rows_added") / run_s, 2)).alias("rows_per_second"),
        F.when(worked, F.round((advance / 86400.0) / (run_s / 3600.0), 3)).alias("data_days_per_hour"), F.when(timed, F.round(advance / took, 3)).alias("catchup_ratio"),
        work_left.cast("long").alias("catchup_processing_s"), "catchup_wall_s", projected.alias("projected_caught_up"),
    )


def rows_catchup(history: DataFrame, key: str = "table_id") -> DataFrame:
    """Of a feed without event times, each run's rows a second since the one before and the
    seconds of work that its waiting rows (``rows_lag``) still take: 0 if none wait, null if
    none were added."""
    before = F.lag("row_count").over(Window.partitionBy(key).orderBy("run_at"))
    rate = F.when(F.col("run_s") > 0, F.round((F.col("row_count") - before) / F.col("run_s"), 2))
    left = F.when(F.col("rows_per_second") > 0, F.floor(F.col("rows_lag") / F.col("rows_per_second"))).when(F.col("rows_lag") == 0, 0)
    return history.withColumn("rows_per_second", rate).select(key, "run_at", "rows_lag", "rows_per_second", left.cast("long").alias("catchup_processing_s"))


def latest_status(history: DataFrame, key: str = "table_id") -> DataFrame:
    columns = [c for c in history.columns if c != key]
    return history.groupBy(key).agg(F.max_by(F.struct(*columns), "run_at").alias("s")).select(key, "s.*")


def is_behind(lag_hours: int = 4) -> Column:
    """Has a table not caught up, by the signals that its feed gives (null: no such signal)?
    A full budget, an open feed or waiting jobs say so; nothing pending and room in the
    budget say it has; else its sequences' lag decides. The clock's lag never does."""
    says = lambda c, value: F.coalesce(F.col(c) == value, F.lit(False))
    behind = says("budget_nearly_full", True) | says("budget_full", True) | says("caught_up", False) | F.coalesce(F.col("jobs_lag") > 0, F.lit(False))
    done = says("pending", 0) & says("budget_nearly_full", False)
    return F.when(behind, True).when(done, False).otherwise(F.coalesce(F.col("lag_s") > lag_hours * 3600, F.lit(False)))


def table_state(latest: DataFrame, now: str, stale_hours: int = 24, lag_hours: int = 4) -> DataFrame:
    """STALE (no record, or none for a day), BEHIND (see ``is_behind``) or OK."""
    age = F.expr(f"timestampdiff(SECOND, run_at, timestamp_ntz'{now}')")
    stale = F.col("run_at").isNull() | (age > stale_hours * 3600)
    return latest.withColumns({"age_s": age, "state": F.when(stale, "STALE").when(is_behind(lag_hours), "BEHIND").otherwise("OK")})


def feed_status(latest: DataFrame, upstream: DataFrame, now: str, feed: str = "feed") -> DataFrame:
    """Per feed: tables, rows, watermark, the upstream's newest sequence, how far the feed is
    behind it, how long its newest event is ago, and how many of its tables say that they are
    behind, have a full budget, or wait for jobs."""
    rows = latest.groupBy(feed).agg(
        F.count(F.lit(1)).alias("n_tables"), F.sum("row_count").alias("row_count"), F.max("watermark").alias("watermark"), F.max("watermark_at").alias("__at"), F.max("lag_s").alias("lag_s"),
        F.count_if(is_behind()).alias("n_behind"), F.count_if(F.coalesce(F.col("budget_nearly_full"), F.lit(False))).alias("n_nearly_full"),
        F.count_if(F.coalesce(F.col("jobs_lag") > 0, F.lit(False))).alias("n_waiting"),
    )
    newest = upstream.groupBy(feed).agg(F.max("watermark").alias("upstream_max"), F.max("watermark_at").alias("__newest"))
    rows = rows.join(newest, feed, "left").withColumn("__now", F.lit(now).cast("timestamp_ntz"))
    return rows.withColumns({"seq_lag_s": lag_seconds("__newest", "__at"), "clock_lag_s": lag_seconds("__now", "__at")}).drop("__at", "__newest", "__now")


def state_summary(states: DataFrame, expected: DataFrame, group: str = "feed", key: str = "table_id") -> DataFrame:
    """Tables of each group by state, worst group first; an expected table without a
    record counts as stale."""
    all_ = expected.join(states.select(key, "state"), key, "left").withColumn("state", F.coalesce("state", F.lit("STALE")))
    counts = all_.groupBy(group).agg(*(F.count_if(F.col("state") == s).alias(s.lower()) for s in ("STALE", "BEHIND", "OK")))
    return counts.orderBy(F.desc("stale"), F.desc("behind"), group)


def _tenths(value: Column) -> Column:
    """A double >= 0 in tenths, rounded as C's printf rounds it: by its binary value (1.15 lies
    below the tie, and is 1.1), ties to even. Java's own formatting rounds the shortest decimal.
    The distance from the tie is exact, as the value is split in two halves."""
    down = F.floor(value * 10)
    high = value.cast("float").cast("double")
    above = (high * 20 - (2 * down + 1)) + (value - high) * 20
    return down + F.when(above > 0, 1).when(above == 0, down % 2).otherwise(0)


def duration_text(seconds: Column) -> Column:
    """Seconds below 90 s, minutes below 90 min, else hours with one decimal below 48 h, or
    days; of either sign, '?' if unknown."""
    s = F.abs(seconds).cast("double")
    decimal = lambda value, unit: F.format_string(f"%d.%d{unit}", F.floor(_tenths(value) / 10), _tenths(value) % 10)
    return (
        F.when(seconds.isNull(), "?")
        .when(s < 90, F.format_string("%.0fs", s))
        .when(s < 5400, F.format_string("%.0fm", F.bround(s / 60)))
        .when(s < 172800, decimal(s / 3600, "h"))
        .otherwise(decimal(s / 86400, "d"))
    )


def state_note(states: DataFrame) -> DataFrame:
    lag = F.when(F.col("lag_s") > 0, F.concat(F.lit("lag "), duration_text(F.col("lag_s"))))
    rows = F.concat(F.format_number("row_count", 0), F.lit(" rows"))
    seen = F.concat(F.lit("seen "), duration_text(F.col("age_s")), F.lit(" ago"))
    return states.withColumn("note", F.concat_ws("; ", "state", rows, lag, seen))
