"""Feeds under declared schemas: snapshot and change CSV, NDJSON, paged JSON; archives."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.sources.files import child_dirs
from quayside.sources.footers import first_lines


def snapshot_csv_load(spark: SparkSession, paths, schema: T.StructType, start: str) -> DataFrame:
    """A full snapshot: load rows (L) without sequence, timed at its start."""
    rows = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(paths)
    at = F.lit(start).cast("timestamp_ntz")
    return rows.select("*", F.lit(None).cast("string").alias("change_seq"), F.lit("L").alias("change_oper"), at.alias("change_ts"), F.year(at).alias("part_year"), F.month(at).alias("part_month"), F.col("_metadata.file_path").alias("from_file"))


def cdc_csv_load(spark: SparkSession, paths: list[str], types: dict[str, str]) -> DataFrame:
    """Change files, read once per distinct header line (schema version) and united by
    name; columns that ``types`` doesn't name are strings. Tasks find the header lines in the
    files' first bytes. A bad file fails the load."""
    heads = first_lines(spark, paths).filter(F.col("head").isNotNull())
    versions = heads.groupBy("head").agg(F.collect_list("file").alias("files")).collect()  # one row per schema version
    parts = []
    for version in sorted(versions, key=lambda r: r["head"]):
        names = [c.strip().strip('"').lower() for c in version["head"].split(",")]
        schema = ", ".join(f"`{c}` {types.get(c, 'string')}" for c in names)
        rows = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(version["files"])
        parts.append(rows.withColumn("from_file", F.col("_metadata.file_path")))
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return out.withColumns({"part_year": F.year("change_ts"), "part_month": F.month("change_ts")})


def history_archive_write(df: DataFrame, path: str, parts: tuple[str, ...] = ("snapshot", "part_year", "part_month")) -> None:
    df.write.mode("append").partitionBy(*parts).option("compression", "zstd").parquet(path)


def ndjson_typed_load(spark: SparkSession, paths, schema: T.StructType, timestamps: list[str], private: tuple[str, ...] = ()) -> DataFrame:
    """Lines of JSON; times are their first 19 characters, private columns are left out."""
    text = T.StructType([T.StructField(f.name, T.StringType() if f.name in timestamps else f.dataType) for f in schema])
    rows = spark.read.schema(text).json(paths)
    rows = rows.withColumns({c: F.to_timestamp_ntz(F.substring(c, 1, 19), F.lit("yyyy-MM-dd HH:mm:ss")) for c in timestamps})
    return rows.drop(*private)


def append_table_write(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def static_table_overwrite(df: DataFrame, path: str, key: str = "job_id") -> None:
    """Replace a static table by a load, which must come from exactly one job."""
    jobs = df.select(key).distinct().limit(2).count()
    if jobs != 1:
        raise ValueError(f"a static load must hold one {key}, not {'several' if jobs else 'none'}")
    df.write.mode("overwrite").parquet(path)


def restricted_split(df: DataFrame, secret: str, key: str) -> tuple[DataFrame, DataFrame]:
    """The public table without ``secret``, and the distinct (key, secret) lookup."""
    return df.drop(secret), df.select(key, secret).distinct()


def json_cols_load(spark: SparkSession, paths, types: dict[str, str], json_columns: list[str], time: str | None = None) -> DataFrame:
    """JSON records whose arrays and objects stay text as they were written. Numbers that
    come as text are read as numbers, what is none becomes null. With ``time``, the records
    of the latest time are withheld: more of that time may follow, and the next run, which
    starts above what is kept, reads them whole."""
    schema = ", ".join(f"`{c}` string" for c in types)
    rows = spark.read.schema(schema).json(paths)
    rows = rows.withColumns({c: F.expr(f"try_cast(`{c}` as {t})") for c, t in types.items() if c not in json_columns and t != "string"})
    if time is None:
        return rows
    last = rows.agg(F.max(time).alias("__last"))  # one row
    return rows.join(F.broadcast(last), F.col(time) < F.col("__last")).drop("__last")


def union_by_name_scan(spark: SparkSession, path: str) -> DataFrame:
    """All files of a dataset, columns united by name, path partitions as columns."""
    return spark.read.option("mergeSchema", True).option("basePath", path).parquet(path)


def latest_snapshot_scan(spark: SparkSession, path: str, part: str = "snapshot") -> DataFrame:
    """Only the newest partition, with that partition's own columns."""
    newest = max(d for d in child_dirs(spark, path) if d.startswith(f"{part}="))
    return spark.read.option("basePath", path).parquet(f"{path}/{newest}")


def dealt_to_files(df: DataFrame, parts: tuple[str, ...], rows_per_file: int) -> DataFrame:
    """Rows dealt to tasks so that each holds about ``rows_per_file`` rows of a partition. Sizes
    are a row a partition's folder, so they go to all tasks: met by key, the rows of a large
    partition would all be one task's."""
    sizes = F.broadcast(df.groupBy(*parts).agg(F.ceil(F.count(F.lit(1)) / rows_per_file).alias("__tasks")))
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"s.{c}")) for c in parts]
    rows = df.alias("d").join(sizes.alias("s"), reduce(lambda a, b: a & b, same)).select("d.*", "__tasks")
    deal = F.pmod(F.xxhash64(*[c for c in df.columns if c not in parts]), F.col("__tasks"))
    return rows.withColumn("__task", deal).repartition(*parts, "__task").drop("__tasks", "__task")


def partitioned_write(df: DataFrame, path: str, parts: tuple[str, ...], rows_per_file: int = 5_000_000) -> None:
    """Partitioned parquet in files of about ``rows_per_file`` rows: a partition of n rows is
    written by n / rows_per_file tasks, so a large one is not one task's and a small one is
    one file."""
    spread = dealt_to_files(df, parts, rows_per_file)
    spread.write.mode("overwrite").partitionBy(*parts).option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).parquet(path)


@contextmanager
def unsorted_writes(spark: SparkSession, writers: int = 16) -> Iterator[None]:
    """Writes by partition within keep the rows' order: a task holds open files of as many
    partitions, instead of sorting its rows by partition in memory; beyond, it does sort."""
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(writers))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def materialize_report(df: DataFrame, path: str, view: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    out = df.sparkSession.read.parquet(path)
    out.createOrReplaceTempView(view)
    return out


def incremental_export(df: DataFrame, index: str, watermark, casts: dict[str, str], private: tuple[str, ...] = ()) -> DataFrame:
    """Rows above the watermark, cast without failing, private columns left out; write
    with ``maxRecordsPerFile`` for batches, and take max(index) as the next watermark."""
    rows = df if watermark is None else df.filter(F.col(index) > F.lit(watermark))
    return rows.withColumns({c: F.expr(f"try_cast(`{c}` as {t})") for c, t in casts.items()}).drop(*private)
