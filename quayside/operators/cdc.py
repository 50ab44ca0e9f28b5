"""Change-data-capture: fold a change log to one action per key and apply it.

Operations: I carries a full image (null means null), U patches its non-null columns, D
deletes. ``change_seq`` orders a key's records and is unique per record. Null keys match
each other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.scratch import saved, scratch_scope
from quayside.operators.carry import running

SEQ, OPER = "change_seq", "change_oper"
META = (SEQ, OPER, "change_ts")


def all_equal(left: str, right: str, keys: list[str]) -> Column:
    """Null-safe equality on all keys: still an equi-join."""
    return reduce(lambda a, b: a & b, (F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys))


def cdc_fold(cdc: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: ``change_oper`` (latest I or D, else U), ``change_seq`` (the key's
    last) and each column's latest non-null value at or after that I or D. One aggregate,
    combined before its shuffle: a key's whole log is never in one place. A column's latest
    value comes with its sequence, and counts unless the I or D is later."""
    columns = [c for c in cdc.columns if c not in keys and c not in META]
    resets, seq = F.col(OPER).isin("I", "D"), F.col(SEQ)
    latest = [F.max_by(F.struct(F.col(c).alias("value"), seq.alias("seq")), F.when(F.col(c).isNotNull(), seq)).alias(f"__{c}") for c in columns]
    rows = cdc.groupBy(*keys).agg(
        F.max_by(OPER, F.when(resets, seq)).alias("__oper"), F.max(F.when(resets, seq)).alias("__reset"), F.max(SEQ).alias(SEQ), *latest
    )
    live = lambda c: F.col("__reset").isNull() | (F.col(f"__{c}.seq") >= F.col("__reset"))
    oper = F.when(F.col("__reset").isNull(), "U").otherwise(F.col("__oper"))
    return rows.select(*keys, oper.alias(OPER), SEQ, *(F.when(live(c), F.col(f"__{c}.value")).alias(c) for c in columns))


def cdc_apply(
    target: DataFrame, folded: DataFrame, keys: list[str], keep_old: tuple[str, ...] = ("part_year", "part_month"), only_newer: bool = False, seen: Observation | None = None
) -> DataFrame:
    """The target after one folded batch: D removes, I replaces or inserts, U patches a
    match; an unmatched U or D does nothing. ``change_seq`` comes from the batch;
    ``keep_old`` columns change only to non-null values; columns that the batch lacks
    keep theirs (null in new rows). With ``only_newer``, an action whose sequence is not
    beyond the one that the row holds does nothing. ``seen`` is told, while the result is
    written, how many rows there were and how many were inserted, dropped, updated and moved
    to another value of ``keep_old``."""
    t = target.withColumn("__t", F.lit(True)).alias("t")
    s = folded.withColumn("__s", F.lit(True)).alias("s")
    old, new, oper = F.col("__t").isNotNull(), F.col("__s").isNotNull(), F.col(f"s.{OPER}")
    if only_newer:
        new = new & (F.col(f"t.{SEQ}").isNull() | (F.col(f"s.{SEQ}") > F.col(f"t.{SEQ}")))
    keep = F.when(~new, True).when(oper == "D", False).when(oper == "I", True).otherwise(old)

    def value(c: str) -> Column:
        have = c in folded.columns
        if c in keys:
            return F.coalesce(f"t.{c}", f"s.{c}")
        if not have:
            return F.col(f"t.{c}")
        if c == SEQ:
            return F.when(new, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
        patch = F.coalesce(f"s.{c}", f"t.{c}")
        if only_newer:
            patch = F.when(new, patch).otherwise(F.col(f"t.{c}"))
        return patch if c in keep_old else F.when(new & (oper == "I"), F.col(f"s.{c}")).otherwise(patch)

    joined = t.join(s, all_equal("t", "s", keys), "full_outer")
    if seen is not None:
        stays = old & new & (oper != "D")
        moves = reduce(lambda a, b: a | b, (F.coalesce(F.col(f"s.{c}") != F.col(f"t.{c}"), F.lit(False)) for c in keep_old if c in target.columns and c in folded.columns), F.lit(False))
        joined = joined.observe(
            seen, F.count_if(old).alias("initial"), F.count_if(~old & (oper == "I")).alias("inserted"), F.count_if(old & new & (oper == "D")).alias("dropped"),
            F.count_if(stays).alias("updated"), F.count_if(stays & moves).alias("moved"),
        )
    joined = joined.filter(keep)
    return joined.select(*(value(c).alias(c) for c in target.columns))


def cdc_apply_last_op(target: DataFrame, cdc: DataFrame, keys: list[str]) -> DataFrame:
    """The older rule: a key's last record wins. D drops, I stands as it is, U patches the
    existing row (else the batch's latest I) by the latest non-null of all its U's."""
    columns = [c for c in target.columns if c not in keys and c != SEQ]
    row = F.struct(*(F.col(c) for c in columns))
    is_u, is_i = F.col(OPER) == "U", F.col(OPER) == "I"
    last = cdc.groupBy(*keys).agg(
        F.max_by(OPER, SEQ).alias("__oper"), F.max(SEQ).alias("__seq"), F.max_by(row, SEQ).alias("__last"),
        F.max_by(F.when(is_i, row), F.when(is_i, F.col(SEQ))).alias("__insert"),
        *(F.max_by(F.when(is_u, F.col(c)), F.when(is_u & F.col(c).isNotNull(), F.col(SEQ))).alias(f"__u_{c}") for c in columns),
    )
    t, s = target.withColumn("__t", F.lit(True)).alias("t"), last.withColumn("__s", F.lit(True)).alias("s")
    old, oper = F.col("__t").isNotNull(), F.col("__oper")
    out = t.join(s, all_equal("t", "s", keys), "full_outer")
    out = out.filter(F.col("__s").isNull() | (oper == "I") | ((oper == "U") & (old | F.col("__insert").isNotNull())))

    def value(c: str) -> Column:
        base = F.when(old, F.col(f"t.{c}")).otherwise(F.col(f"__insert.{c}"))
        return F.when(F.col("__s").isNull(), F.col(f"t.{c}")).when(oper == "I", F.col(f"__last.{c}")).otherwise(F.coalesce(f"__u_{c}", base))

    return out.select(*(F.coalesce(f"t.{k}", f"s.{k}").alias(k) for k in keys), *(value(c).alias(c) for c in columns), F.coalesce("__seq", f"t.{SEQ}").alias(SEQ))


def silver_rebuild(history: DataFrame, snapshot: str, date_column: str | None = None) -> DataFrame:
    """A snapshot's load rows (oper L) as a new current-state table."""
    rows = history.filter((F.col("snapshot") == snapshot) & (F.col(OPER) == "L")).drop(OPER, "change_ts")
    rows = rows.withColumn("load_snapshot", F.lit(snapshot)).drop("snapshot")
    if date_column:
        rows = rows.withColumns({"part_year": F.coalesce(F.year(date_column), F.lit(0)), "part_month": F.coalesce(F.month(date_column), F.lit(0))})
    return rows


#: Batches up to this size are found by one sort of their records; larger ones range by range.
SORTED_BATCH = 10_000


def batch_ceiling(cdc: DataFrame, watermark: str, size: int) -> DataFrame:
    """One row (n, ceiling): of the next ``size`` I, U and D records above the watermark.
    A null sequence sorts first, so that it shows. A large batch's end is found by counts of
    ranges of sequences, and by a sort of the range that it falls in: no task holds the batch."""
    rows = cdc.filter(F.col(OPER).isin("I", "U", "D") & (F.col(SEQ).isNull() | (F.col(SEQ) > watermark))).select(SEQ)
    first = lambda some, n: some.orderBy(F.asc_nulls_first(SEQ)).limit(n).agg(F.count(F.lit(1)).alias("n"), F.max(SEQ).alias("ceiling"))
    if size <= SORTED_BATCH:
        return first(rows, size)
    spark, before, ceiling = cdc.sparkSession, 0, None
    with scratch_scope(spark):
        dealt = saved(rows.repartitionByRange(F.asc_nulls_first(SEQ)).withColumn("__range", F.spark_partition_id()), "sequences")
        ranges = dealt.groupBy("__range").agg(F.count(F.lit(1)).alias("n"), F.max(SEQ).alias("high")).orderBy("__range").collect()  # a row a range
        for r in ranges:
            if before + r.n > size:
                last = first(dealt.filter(F.col("__range") == r["__range"]), size - before).first()
                before, ceiling = size, ceiling if last.ceiling is None else last.ceiling
                break
            before, ceiling = before + r.n, ceiling if r.high is None else r.high
    return spark.createDataFrame([(before, ceiling)], T.StructType([T.StructField("n", T.LongType()), T.StructField("ceiling", cdc.schema[SEQ].dataType)]))


def read_batch(cdc: DataFrame, watermark: str, size: int) -> DataFrame:
    """The records up to that ceiling, ties at it included, and all of null sequence."""
    ceiling = batch_ceiling(cdc, watermark, size).first()["ceiling"]
    null_seq = F.col(SEQ).isNull()
    inside = null_seq if ceiling is None else null_seq | ((F.col(SEQ) > watermark) & (F.col(SEQ) <= ceiling))
    return cdc.filter(F.col(OPER).isin("I", "U", "D") & inside)


def accumulate(cdc: DataFrame, watermark: str, max_rows: int, max_bytes: int, size: Column) -> DataFrame:
    """The next records above the watermark within a budget of rows and of bytes, in order
    of sequence: up to ``max_rows``, and up to the one whose bytes (``size``) reach
    ``max_bytes``."""
    rows = cdc.filter(F.col(OPER).isin("I", "U", "D") & (F.col(SEQ) > watermark)).withColumn("__size", size)
    rows = rows.orderBy(SEQ).limit(max_rows)
    rows = running(rows, [SEQ], {"__before": ("sum", F.col("__size"))}, before=True)
    return rows.filter(F.coalesce("__before", F.lit(0)) < max_bytes).drop("__size", "__before")


def asof_snapshot(files: DataFrame, snapshots: DataFrame, table: str = "table_id") -> DataFrame:
    """Each file's newest strictly older snapshot of its table; files older than all are
    dropped. One pass over both in order of time, no range join; a table's files may be many."""
    f = files.select(table, "file", "ts", F.lit(None).cast("timestamp_ntz").alias("taken"), F.lit(0).alias("kind"))
    s = snapshots.select(table, F.lit(None).cast("long").alias("file"), "ts", F.col("ts").alias("taken"), F.lit(1).alias("kind"))
    out = running(f.union(s), ["ts", "kind", "file"], {"snapshot": ("last", F.col("taken"))}, by=(table,))
    return out.filter("kind = 0 and snapshot is not null").select(table, "file", "ts", "snapshot")


def load_groups(files: DataFrame, table: str = "table_id") -> DataFrame:
    """Number of the load that a file belongs to: a first part opens a new one."""
    return running(files, ["ts", "file"], {"load_no": ("sum", F.col("is_first").cast("int"))}, by=(table,))


def stale_files(files: DataFrame, oldest_kept: DataFrame, table: str = "table_id") -> DataFrame:
    """Files older than the oldest archived snapshot, or without one than the newest load."""
    groups = load_groups(files, table)
    newest = groups.groupBy(table, "load_no").agg(F.min("ts").alias("start")).groupBy(table).agg(F.max_by("start", "load_no").alias("newest"))
    cut = groups.join(newest, table).join(oldest_kept, table, "left")
    return cut.filter(F.col("ts") < F.coalesce("oldest", "newest")).select(table, "file", "ts")


def surrogate_index(df: DataFrame, key: str, start: int = 0) -> DataFrame:
    """``row_index`` without gaps from ``start``, in order of the unique ``key``; no task
    numbers more than a range of keys."""
    return running(df, [key], {"row_index": ("sum", F.lit(1))}).withColumn("row_index", F.col("row_index") + (start - 1))


def null_safe_update(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left rows, with the right's non-null values where its keys match; null keys match."""
    j = left.alias("l").join(right.alias("r"), all_equal("l", "r", keys), "left")
    return j.select(*((F.coalesce(f"r.{c}", f"l.{c}") if c in right.columns and c not in keys else F.col(f"l.{c}")).alias(c) for c in left.columns))


def keyed_lookup(big: DataFrame, match: DataFrame, keys: list[str], how: str = "left_semi") -> DataFrame:
    """Rows of ``big`` whose keys do (left_semi) or don't (left_anti) occur in ``match``."""
    return big.alias("b").join(match.select(*keys).distinct().alias("m"), all_equal("b", "m", keys), how)


def key_range_lookup(big: DataFrame, match: DataFrame, key: str) -> DataFrame:
    """The same after a filter to the key's range, which reaches the scan."""
    lo, hi = match.agg(F.min(key), F.max(key)).first()
    if lo is None:
        return keyed_lookup(big, match, [key])
    return keyed_lookup(big.filter(F.col(key).between(lo, hi)), match, [key])


def topk_after(df: DataFrame, column: str, above, k: int | None = None, descending: bool = False, condition: str | None = None) -> DataFrame:
    """The first k rows (all without k) by ``column`` strictly above a bound; nulls out."""
    rows = df.filter(F.col(column).isNotNull() & (F.col(column) > F.lit(above)))
    rows = rows.filter(condition) if condition else rows
    return rows if k is None else rows.orderBy(F.desc(column) if descending else F.asc(column)).limit(k)


def touched_partitions(batch: DataFrame, date: str = "edw_inserted_dtm", cap: int = 24) -> DataFrame:
    """One row: partitions a batch touches, its null dates, whether pruning is safe, and
    the first ``cap`` labels with '+n more'."""
    parts = batch.groupBy(F.year(date).alias("y"), F.month(date).alias("m")).agg(F.count(F.lit(1)).alias("n"))
    label = F.format_string("%04d-%02d:%d", "y", "m", "n")
    known = F.col("y").isNotNull()
    out = parts.agg(F.count_if(known).alias("n_parts"), F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("null_dates"), F.array_sort(F.collect_list(F.when(known, label))).alias("labels"))
    more = F.when(F.size("labels") > cap, F.concat(F.lit(" +"), (F.size("labels") - cap).cast("string"), F.lit(" more"))).otherwise("")
    return out.select("n_parts", "null_dates", (F.col("null_dates") == 0).alias("pruned"), F.concat(F.array_join(F.slice("labels", 1, cap), ","), more).alias("labels"))


def write_applied(target: DataFrame, folded: DataFrame, keys: list[str], path: str) -> DataFrame:
    """Write the target after a folded batch to ``path``; one row: rows read, inserted and
    dropped, as seen while writing, the rows in the files (from their footers), and whether
    initial - dropped + inserted is what they hold."""
    seen, spark = Observation(), target.sparkSession
    cdc_apply(target, folded, keys, seen=seen).write.mode("overwrite").parquet(path)
    counts = [seen.get[c] or 0 for c in ("initial", "inserted", "dropped")]
    row = (*counts, spark.read.schema(target.schema).parquet(path).count())
    return spark.createDataFrame([row], "initial long, inserted long, dropped long, actual long").withColumn("ok", F.expr("initial - dropped + inserted = actual"))
