"""A current-state table that is merged file by file.

Rows lie in files sorted by the leading key, below a folder per batch (and per year and month,
of dated tables). A manifest per batch lists the table's files with their range of keys, rows
and bytes. A batch finds the files that hold its keys, by range and then by a look at their
keys alone, rewrites these and keeps all others, whatever month its rows are of: so a key
whose month changes is moved. Readers follow the newest whole manifest; a batch that runs
again after a failure replaces nothing that is being read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.scratch import saved, scratch_scope
from quayside.operators.carry import running
from quayside.operators.cdc import all_equal, cdc_apply, cdc_fold
from quayside.sources.files import child_dirs, delete, exists

PARTS = ["part_year", "part_month"]
KEEP = 2  # manifests whose files stay for readers
FULL_LOAD = -1
COUNTS = ("initial", "inserted", "dropped", "updated", "moved")


def batches(spark: SparkSession, root: str) -> list[int]:
    """Committed batches, newest first; -1 is the first full load."""
    if not exists(spark, f"{root}/manifests"):
        return []
    names = [n for n in child_dirs(spark, f"{root}/manifests") if exists(spark, f"{root}/manifests/{n}/_SUCCESS")]
    return sorted((int(n.split("=")[1]) for n in names), reverse=True)


def table_schema(spark: SparkSession, root: str) -> T.StructType:
    return spark.read.parquet(f"{root}/empty").schema


def manifest(spark: SparkSession, root: str, batch: int | None = None) -> DataFrame:
    """A row a file: file (below data), low, high (keys), n_rows, nulls (keys), n_bytes."""
    batch = batches(spark, root)[0] if batch is None else batch
    return spark.read.parquet(f"{root}/manifests/batch={batch}")


def measure(spark: SparkSession, root: str, batch: int | None = None) -> DataFrame:
    """One row of a version's rows, files, bytes and smallest and largest key, as its
    manifest has them: no data are read."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return manifest(spark, root, batch).agg(total("n_rows"), F.count(F.lit(1)).alias("n_files"), total("n_bytes"), F.min("low").alias("min_id"), F.max("high").alias("max_id"))


def _open(spark: SparkSession, root: str, schema: T.StructType, files: list[str]) -> DataFrame:
    return spark.read.schema(schema).parquet(*(f"{root}/data/{f}" for f in files)) if files else spark.createDataFrame([], schema)


def read_current(spark: SparkSession, root: str, months: list[tuple[int, int]] | None = None) -> DataFrame:
    """The newest version's rows; of a dated table, only some months' files on demand."""
    files = [r.file for r in manifest(spark, root).select("file").collect()]  # names, as any table's listing
    if months is not None:
        files = [f for f in files if any(f"/__part_year={y}/__part_month={m}/" in f for y, m in months)]
    return _open(spark, root, table_schema(spark, root), sorted(files))


def _file() -> F.Column:
    return F.regexp_extract(F.col("_metadata.file_path"), "/data/(.*)$", 1)


def _commit(spark: SparkSession, rows: DataFrame, root: str, batch: int, kept: DataFrame | None, key: str, rows_per_file: int) -> None:
    """Write ``rows`` in files sorted by key, and the manifest of these and ``kept``."""
    folder, parts = f"{root}/data/batch={batch}", [c for c in PARTS if c in rows.columns]
    order = [f"__{c}" for c in parts] + [key]
    dealt = rows.withColumns({f"__{c}": F.col(c) for c in parts}).repartitionByRange(*order).sortWithinPartitions(*order)
    writer = dealt.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).option("compression", "zstd")
    writer.partitionBy(*order[:-1]).parquet(folder) if parts else writer.parquet(folder)
    new = spark.read.schema(rows.schema).parquet(folder).select(_file().alias("file"), F.col("_metadata.file_size").alias("b"), key)
    new = new.groupBy("file").agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(key).isNull()).alias("nulls"), F.max("b").alias("n_bytes"))
    lines = new if kept is None else kept.unionByName(new)
    lines.coalesce(1).write.mode("overwrite").parquet(f"{root}/manifests/batch={batch}")  # a row a file


def start_table(target: DataFrame, root: str, key: str | None = None, batch: int = FULL_LOAD, rows_per_file: int = 1_000_000) -> None:
    """A new version, from a full load; ``key`` is the leading key, the first column if
    none is named. Later loads take the next batch's number."""
    spark = target.sparkSession
    target.limit(0).write.mode("overwrite").parquet(f"{root}/empty")
    _commit(spark, target, root, batch, None, key or target.columns[0], rows_per_file)
    expire(spark, root)


def expire(spark: SparkSession, root: str) -> None:
    """Delete files that none of the newest manifests names, and older manifests."""
    done = batches(spark, root)
    live = [manifest(spark, root, b).select("file") for b in done[:KEEP]]
    for batch in done[KEEP:]:
        gone = manifest(spark, root, batch).select("file")
        for names in live:
            gone = gone.join(names, "file", "left_anti")
        for row in gone.toLocalIterator():  # what batches since have rewritten
            delete(spark, f"{root}/data/{row.file}")
        delete(spark, f"{root}/manifests/batch={batch}")


def files_in_reach(files: DataFrame, folded: DataFrame, key: str) -> DataFrame:
    """Those ``files`` of a manifest whose range holds a key of the batch: in order of keys,
    the last key up to a file's high is not below its low. No range join."""
    kind = lambda k: F.lit(k).alias("kind")
    keys = folded.select(F.col(key).alias("at"), kind(0), F.lit("").alias("file"), F.col(key).alias("found")).filter("at is not null").distinct()
    nothing = F.lit(None).cast(folded.schema[key].dataType)
    marks = keys.unionByName(files.select(F.col("high").alias("at"), kind(1), "file", nothing.alias("found")))
    below = running(marks, ["at", "kind", "file"], {"below": ("last", F.col("found"))}).filter("kind = 1").select("file", "below")
    inside = files.join(below, "file").filter("below >= low").select(*files.columns)
    return inside if folded.filter(F.col(key).isNull()).isEmpty() else inside.unionByName(files.filter("nulls > 0")).distinct()


def holding_files(spark: SparkSession, root: str, folded: DataFrame, keys: list[str], key: str) -> list[str]:
    """The files that hold keys of the batch; of those in reach only the keys are read."""
    reach = [r.file for r in files_in_reach(manifest(spark, root), folded, key).select("file").collect()]  # files of one batch
    held = _open(spark, root, table_schema(spark, root), reach) if reach else None
    if held is None:
        return []
    found = held.select(*keys, _file().alias("__file")).alias("t").join(folded.select(*keys).alias("s"), all_equal("t", "s", keys), "left_semi")
    return sorted(r[0] for r in found.select("__file").distinct().collect())


def merge(spark: SparkSession, rows: DataFrame, root: str, keys: list[str], batch: int, rows_per_file: int = 1_000_000) -> dict | None:
    """Fold a batch of changes and apply it, unless it is committed already or empty (None);
    returns what was seen while it was written: rows read, inserted, dropped, updated, moved
    and written, files rewritten. A key's action is passed over if the table holds a newer
    one. Raises if the rows written are not those read less dropped and plus inserted."""
    done = batches(spark, root)
    if batch in done:
        return None
    with scratch_scope(spark):
        folded = saved(cdc_fold(rows, keys), "folded")
        if folded.isEmpty():
            return None
        touched = holding_files(spark, root, folded, keys, keys[0])
        before, seen = _open(spark, root, table_schema(spark, root), touched), Observation()
        applied = saved(cdc_apply(before, folded, keys, only_newer=True, seen=seen), "applied")
        names = spark.createDataFrame([(f,) for f in touched], "file string")
        _commit(spark, applied, root, batch, manifest(spark, root, done[0]).join(names, "file", "left_anti"), keys[0], rows_per_file)
        counts = {c: seen.get.get(c) or 0 for c in COUNTS}
        wrote = manifest(spark, root, batch).filter(F.col("file").startswith(f"batch={batch}/")).agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]
    if wrote != counts["initial"] - counts["dropped"] + counts["inserted"]:
        delete(spark, f"{root}/manifests/batch={batch}")
        raise ValueError(f"batch {batch} of {root} wrote {wrote} rows, not as counted: {counts}")
    expire(spark, root)
    return counts | {"written": wrote, "rewritten_files": len(touched)}
