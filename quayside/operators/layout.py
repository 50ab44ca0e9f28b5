"""File layout and statistics of datasets, recluster planning, catalog, and rewrites."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.scratch import saved
from quayside.operators.carry import running
from quayside.sources.feeds import materialize_report
from quayside.sources.files import child_dirs, delete, exists, list_files, list_uris, rename, total_bytes
from quayside.sources.footers import column_extremes, footer_statistics, rewrite_without


def column_min_max(df: DataFrame, column: str, condition: str | None = None) -> DataFrame:
    rows = df.filter(condition) if condition else df
    return rows.agg(F.min(column).alias("low"), F.max(column).alias("high"))


def columns_min_max(spark: SparkSession, path: str, columns: list[str]) -> list[DataFrame]:
    """One row (low, high) for each of some columns of a parquet dataset, from one pass of tasks
    over the footers of its files; a row group whose footer doesn't tell, or tells a text that may
    be cut, is read for that column by the task that has it open. Files of other kinds of columns
    that tell nothing are read as rows. Of a path partition, from the folders' names, as strings.
    Null if all values are."""
    files = list_uris(spark, path)
    folders = {tuple(f.split("/")[:-1]) for f in files}
    parts = {c: [p.split("=", 1)[1] for f in folders for p in f if p.startswith(f"{c}=")] for c in columns}
    schema = spark.read.parquet(path).schema
    kinds = {c: schema[c].dataType for c in columns if not parts[c]}
    if kinds:
        told = column_extremes(spark, files, kinds)
        ends = [f(f"{end}_{k}").alias(f"{end}_{k}") for k in range(len(kinds)) for f, end in ((F.min, "low"), (F.max, "high"))]
        unread = [F.collect_set(F.when(F.array_contains("unknown", c), F.col("file"))).alias(f"unread_{k}") for k, c in enumerate(kinds)]
        known = told.agg(*ends, *unread).first()
    out = []
    for c in columns:
        if parts[c]:
            out.append(spark.createDataFrame([(min(parts[c]), max(parts[c]))], "low string, high string"))
            continue
        k = list(kinds).index(c)
        found = spark.createDataFrame([(known[f"low_{k}"], known[f"high_{k}"])], T.StructType([T.StructField(e, kinds[c]) for e in ("low", "high")]))
        if known[f"unread_{k}"]:
            found = found.unionByName(column_min_max(spark.read.parquet(*known[f"unread_{k}"]), c)).agg(F.min("low").alias("low"), F.max("high").alias("high"))
        out.append(found)
    return out


def stats_min_max(spark: SparkSession, path: str, column: str) -> DataFrame:
    """``columns_min_max`` of one column."""
    return columns_min_max(spark, path, [column])[0]


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns).distinct()


def file_key_ranges(df: DataFrame, key: str, parts: tuple[str, ...] = ()) -> DataFrame:
    """Per file (and partition): smallest and largest key and rows."""
    rows = df.select(F.col("_metadata.file_path").alias("file"), *parts, key)
    return rows.groupBy("file", *parts).agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("n_rows"))


def overlapping_files(ranges: DataFrame, unit: str) -> DataFrame:
    """Per unit: files, and those whose range starts within an earlier one's; null if a
    file has no range."""
    seen = running(ranges, ["low", "file"], {"before": ("max", F.col("high"))}, by=(unit,), before=True)
    none = F.max(F.col("low").isNull().cast("int")) == 1
    return seen.groupBy(unit).agg(F.count(F.lit(1)).alias("n_files"), F.when(~none, F.count_if(F.col("low") <= F.col("before"))).alias("overlap"))


def recluster_plan(overlaps: DataFrame) -> DataFrame:
    """Units whose overlap is at least 4 and twice the root of their files."""
    limit = F.greatest(F.lit(4), F.ceil(2 * F.sqrt("n_files")))
    return overlaps.withColumn("threshold", limit.cast("long")).withColumn("recluster", F.coalesce(F.col("overlap") >= F.col("threshold"), F.lit(False)))


def recluster(df: DataFrame, key: str, path: str, bytes_total: int, file_bytes: int = 32 << 20) -> None:
    """Write the rows sorted by their key across files of about ``file_bytes``."""
    files = max(1, math.ceil(bytes_total / file_bytes))
    df.repartitionByRange(files, key).sortWithinPartitions(key).write.mode("overwrite").option("compression", "zstd").parquet(path)


def recluster_units(spark: SparkSession, path: str, key: str, parts: tuple[str, ...], file_bytes: int = 32 << 20) -> DataFrame:
    """Rewrite, in place, the partitions of a dataset whose files overlap too much (see
    ``recluster_plan``), sorted by ``key`` in files of about ``file_bytes``; all others keep
    their files. Returns a row a partition: its columns, n_files, overlap, recluster, and
    n_files_after and overlap_after."""
    unit = F.concat_ws("/", *(F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in parts))

    def overlaps() -> DataFrame:
        ranges = file_key_ranges(spark.read.parquet(path), key, parts)
        named = ranges.withColumn("unit", unit)
        return overlapping_files(named, "unit").join(named.select("unit", *parts).distinct(), "unit")

    before = saved(recluster_plan(overlaps()), "plan")
    chosen = before.filter("recluster").select(*parts)
    if not chosen.isEmpty():
        rows = spark.read.parquet(path)
        same = reduce(lambda a, b: a & b, (F.col(f"r.{c}").eqNullSafe(F.col(f"c.{c}")) for c in parts))
        rows = rows.alias("r").join(F.broadcast(chosen.alias("c")), same, "left_semi")  # a row a partition
        size = rows.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("b")).groupBy("f").agg(F.max("b").alias("b")).agg(F.sum("b")).first()[0]
        dealt = rows.repartitionByRange(max(1, math.ceil(size / file_bytes)), *parts, key).sortWithinPartitions(*parts, key)
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(*parts).parquet(path)
        spark.catalog.refreshByPath(path)
    after = saved(overlaps().select("unit", F.col("n_files").alias("n_files_after"), F.col("overlap").alias("overlap_after")), "after")
    return before.join(after, "unit").select(*parts, "n_files", "overlap", "recluster", "n_files_after", "overlap_after")


def size_profile(spark: SparkSession, path: str) -> DataFrame:
    """One row: rows, files, bytes and rows per MB (1000 at least) of a parquet dataset, from
    its footers, read by tasks."""
    files = list_uris(spark, path)
    first = spark.read.parquet(path).schema[0]
    told = footer_statistics(spark, files, first.name, first.dataType)
    out = told.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("n_files"), F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("n_bytes"))
    return out.withColumn("rows_per_mb", F.greatest(F.lit(1000).cast("long"), F.coalesce(F.floor(F.col("n_rows") / (F.col("n_bytes") / 1048576.0)), F.lit(0))))


def path_partitions(paths: DataFrame, column: str = "path") -> DataFrame:
    """The k=v parts of a path, in order."""
    return paths.withColumn("parts", F.regexp_extract_all(column, F.lit("([^/=]+=[^/]*)(?=/)"), 1))


def datasets_below(spark: SparkSession, path: str, group: str = "") -> Iterator[tuple[str, str, str]]:
    """(group, name, path) of every dataset below a folder: a folder without folders, or
    with path partitions, that holds parquet files. The group is the path in between."""
    below = child_dirs(spark, path)
    if below and not any("=" in name for name in below):
        for name in below:
            yield from datasets_below(spark, f"{path}/{name}", f"{group}/{path.rsplit('/', 1)[1]}" if group else "/")
    elif list_files(spark, path):
        yield "/".join(group.split("/")[2:]), path.rsplit("/", 1)[1], path


def data_dictionary(spark: SparkSession, root: str, descriptions: DataFrame | None = None) -> DataFrame:
    """One row per column of every dataset below ``root``: group, dataset, path, size_mb
    (whole), n_files, ordinal, column, type, is_partition, and remarks where
    ``descriptions(dataset, column, remarks)`` has them."""
    rows = []
    for group, name, path in datasets_below(spark, root.rstrip("/")):
        files = list_files(spark, path)
        inside = {p.split("=")[0] for f in files for p in f[f.index(name) :].split("/") if "=" in p}
        size = total_bytes(spark, path) >> 20
        rows += [(group, name, path, size, len(files), k, f.name, f.dataType.simpleString(), f.name in inside) for k, f in enumerate(spark.read.parquet(path).schema)]
    out = spark.createDataFrame(rows, "group string, dataset string, path string, size_mb long, n_files int, ordinal int, column string, type string, is_partition boolean")
    if descriptions is None:
        return out.withColumn("remarks", F.lit(None).cast("string"))
    return column_descriptions(out, descriptions)


def column_descriptions(columns: DataFrame, descriptions: DataFrame) -> DataFrame:
    """``columns`` (dataset, column, ...) with their remarks, null where none are given;
    of several remarks for one column the smallest counts, so no row multiplies."""
    known = descriptions.groupBy("dataset", "column").agg(F.min("remarks").alias("remarks"))
    return columns.join(known, ["dataset", "column"], "left")


def register_views(spark, datasets: dict[str, str]) -> list[tuple[str, str]]:
    """A view per dataset, lower case, dots as underscores; returns those that failed."""
    failed = []
    for name, path in datasets.items():
        try:
            spark.read.parquet(path).createOrReplaceTempView(name.lower().replace(".", "_"))
        except Exception as error:  # one bad dataset must not hide the others
            failed.append((name, str(error).splitlines()[0]))
    return failed


def dataset_records(spark: SparkSession, root: str, descriptions: DataFrame | None = None) -> DataFrame:
    """A nested record per dataset below ``root``: group, name, path, size_mb (whole),
    child_files (names, sorted) and schema (name, type, is_partition, description of each
    column). Files are listed by Spark, in parallel for many folders; a dataset is the folder
    above the first path partition, or that of the file."""
    root = root.rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(root).select("path", "length")
    place = F.regexp_replace("path", "/[^/]*$", "")
    files = files.withColumn("at", F.regexp_replace(place, "/[^/=]+=.*$", ""))
    rows = files.groupBy("at").agg(F.floor(F.sum("length") / (1 << 20)).alias("size_mb"), F.array_sort(F.collect_list("path")).alias("child_files"))
    below = F.regexp_replace("at", "^.*?" + re.escape(re.sub("^[a-z]+:/*", "", root)) + "/?", "")
    rows = saved(rows.select(F.regexp_replace(below, "/?[^/]*$", "").alias("group"), F.regexp_extract("at", "[^/]*$", 0).alias("name"), F.col("at").alias("path"), "size_mb", "child_files"), "datasets")
    columns = []
    for path, file in rows.select("path", F.col("child_files")[0]).collect():  # a row a dataset: schemas are the driver's
        inside = {p.split("=")[0] for p in file[len(path) :].split("/") if "=" in p}
        columns += [(path, k, f.name, f.dataType.simpleString(), f.name in inside) for k, f in enumerate(spark.read.parquet(path).schema)]
    known = spark.createDataFrame(columns, "path string, ordinal int, column string, type string, is_partition boolean")
    known = known.withColumn("dataset", F.regexp_extract("path", "[^/]*$", 0))
    known = known.withColumn("remarks", F.lit(None).cast("string")) if descriptions is None else column_descriptions(known, descriptions)
    field = F.struct("ordinal", F.col("column").alias("name"), "type", "is_partition", F.col("remarks").alias("description"))
    schema = known.groupBy("path").agg(F.transform(F.array_sort(F.collect_list(field)), lambda f: f.dropFields("ordinal")).alias("schema"))
    return rows.join(schema, "path").select("group", "name", "path", "size_mb", "child_files", "schema")


def register_schemas(spark: SparkSession, datasets: dict[str, dict[str, str]]) -> list[tuple[str, str]]:
    """A database per schema and in it a view per dataset, lower case, dots as underscores,
    of an explicit list of columns: those the dataset has now, so that later files don't
    change the view. Returns the views that failed, which hide no others."""
    quoted = lambda name: "`" + name.replace("`", "``") + "`"
    failed = []
    for database, views in datasets.items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database.lower())}")
        for name, path in views.items():
            try:
                columns = ", ".join(quoted(c) for c in spark.read.parquet(path).columns)
                view = f"{quoted(database.lower())}.{quoted(name.lower().replace('.', '_'))}"
                spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {columns} FROM parquet.{quoted(path)}")
            except Exception as error:  # one bad dataset must not hide the others
                failed.append((f"{database}.{name}", str(error).splitlines()[0]))
    return failed


def register_reports(spark, folder: str, materialized: dict, views: dict) -> list[tuple[str, str]]:
    """Register reports under their names, in order: first those to be written (each as
    parquet below ``folder``), then views. A report is a function of the session, so it
    may read those before it; one that fails is returned and hides no other."""
    failed = []
    for written, reports in ((True, materialized), (False, views)):
        for name, report in reports.items():
            try:
                df = report(spark)
                if written:
                    materialize_report(df, f"{folder}/{name}", name)
                else:
                    df.createOrReplaceTempView(name)
            except Exception as error:  # one bad report must not hide the others
                failed.append((name, str(error).splitlines()[0]))
    return failed


def drop_columns_rewrite(spark, path: str, to: str, columns: list[str]) -> bool:
    """Write a version without the columns; False, and nothing written, if it has none."""
    df = spark.read.parquet(path)
    if not set(columns) & set(df.columns):
        return False
    df.drop(*columns).write.mode("overwrite").parquet(to)
    return True


def drop_columns_in_place(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Take columns out of a dataset file by file; returns (file, rewritten, n_rows) of all
    files, once they are done."""
    if any(f"/{c}=" in f for f in list_uris(spark, path) for c in columns):
        raise ValueError("a path partition is no column of the files")
    done = saved(rewrite_without(spark, list_uris(spark, path), columns), "rewritten")
    spark.catalog.refreshByPath(path)
    return done


def cast_column_rewrite(spark, path: str, to: str, column: str, type_: str) -> None:
    df = spark.read.parquet(path)
    df.withColumn(column, F.col(column).cast(type_)).write.mode("overwrite").parquet(to)


def guarded_swap(spark: SparkSession, live: str, backfill: str, backup: str) -> int:
    """Keep the live data as ``backup`` and put the backfill in its place; an empty
    backfill is refused. The new data are written whole beside the live ones first, then
    two renames swap them; if the second fails, the first is undone. Returns the rows now
    live."""
    rows = spark.read.parquet(backfill)
    n = rows.count()
    if not n:
        raise ValueError(f"the backfill {backfill} is empty")
    staged = f"{live.rstrip('/')}.staged"
    rows.write.mode("overwrite").parquet(staged)
    had = exists(spark, live)
    if had:
        delete(spark, backup)
        rename(spark, live, backup)
    try:
        rename(spark, staged, live)
    except OSError:
        if had:
            rename(spark, backup, live)
        raise
    return n
