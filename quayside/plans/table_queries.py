"""Queries on data quality, ingestion, freshness, layout, schemas and sources, with their SQL.

Those that write and read files do so in the session's shared scratch folder.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.scratch import scratch_dir
from quayside.operators import layout, quality, versions
from quayside.plans.adapters import load, with_adapters
from quayside.sources import export, feeds, schema
from quayside.sources.files import list_uris

NOW = "2024-02-01 00:00:00"


def _folder(spark) -> str:
    return f"{scratch_dir(spark)}/tables-{uuid.uuid4().hex}"


def _jobs(spark, d):
    return load(spark, d, "events").select(F.col("user_id").alias("job_id"), "event_id", "ts", "value", "props")


def _counts(spark, d):
    return load(spark, d, "api_counts")


# ---- quality

def count_reconcile(spark, d):
    return quality.count_reconcile(_jobs(spark, d), _counts(spark, d))


def column_set_check(spark, d):
    return quality.column_set_check(load(spark, d, "events"), "props", ["k", "v"])


def _pages(spark, d):
    odd = F.when(F.col("event_id") % 100 == 0, F.when(F.col("event_id") % 300 == 0, F.lit('{"k": "x", "tags": 3}')).otherwise(F.lit('{"k": null, "tags": [1, 2], "new": 1}'))).otherwise(F.col("props"))
    return load(spark, d, "events").select((F.floor(F.col("event_id") / 100)).alias("page"), "event_id", odd.alias("record"))


def json_page_check(spark, d):
    return quality.json_page_check(_pages(spark, d), "record", "page", "event_id", ["k"], ["tags"], ["k", "tags"])


def _strings(spark, d):
    return load(spark, d, "orders").select("o_orderkey", F.expr("case when o_orderkey % 7 = 0 then 'n/a' else cast(o_orderkey * 3 as string) end").alias("a"), F.expr("case when o_orderkey % 3 > 0 then o_orderpriority end").alias("b"))


def numeric_coerce(spark, d):
    return quality.numeric_coerce(_strings(spark, d), ["a", "b"])


def coercion_warnings(spark, d):
    return quality.coercion_warnings(_strings(spark, d), ["a", "b"])


def json_serialize(spark, d):
    rows = load(spark, d, "nation").select("n_nationkey", F.array("n_nationkey", "n_regionkey").alias("pair"), "n_name")
    return quality.json_serialize(rows, ["pair", "n_name"])


def load_invariants(spark, d):
    rows = load(spark, d, "orders").select(F.lit("L").alias("change_oper"), F.expr("case when o_orderkey % 100 > 0 then o_orderdate end").alias("edw_inserted_dtm"))
    return quality.load_invariants(rows, "edw_inserted_dtm")


def cdc_invariants(spark, d):
    log = load(spark, d, "cdc_log").withColumns({
        "change_seq": F.expr("case when txn_id % 40 > 0 then change_seq end"), "key": F.expr("case when txn_id % 30 > 0 then txn_id end"),
        "change_oper": F.expr("case when txn_id % 20 = 1 then 'X' else change_oper end"), "day": F.expr("case when txn_id % 3 > 0 then change_ts end"),
    })
    return quality.cdc_invariants(log, ["key"], "day", required=("amount", "gone"))


def partition_stability(spark, d):
    return quality.partition_stability(load(spark, d, "cdc_log").withColumn("day", F.expr("case when txn_id % 2 = 0 then cast(change_ts as date) end")), ["txn_id"], "day")


def pii_drop(spark, d):
    return quality.drop_private(load(spark, d, "customer"), ["c_name", "c_acctbal"], allowed=("c_acctbal",))


# ---- ingestion

def high_watermark(spark, d):
    return quality.high_watermark(load(spark, d, "events"), "event_id", 5)


def boundary_drop(spark, d):
    rows = load(spark, d, "events").select("event_id", F.date_trunc("hour", "ts").alias("hour"))
    return quality.boundary_drop(rows, "hour").select("event_id")


def job_range_batches(spark, d):
    return quality.range_batches(_counts(spark, d), 20, 60)


def backlog(spark, d):
    return quality.backlog(_counts(spark, d), 90)


def row_capped_run(spark, d):
    return quality.row_capped_run(load(spark, d, "events").select("event_id", "ts"), "ts", "event_id", 700)


def out_of_order_pages(spark, d):
    return quality.out_of_order_pages(load(spark, d, "events").select("event_type", F.floor(F.col("user_id") / 10).alias("page"), "ts"), "event_type", "page", "ts")


# ---- freshness

def seq_to_timestamp(spark, d):
    seq = F.concat(F.date_format("o_orderdate", "yyyyMMddHHmmss"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0"))
    rows = load(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 5 > 0, seq).otherwise("bad").alias("seq"))
    return rows.select("o_orderkey", quality.seq_to_timestamp(F.col("seq")).cast("timestamp_ntz").alias("at"))


def ms_to_timestamp(spark, d):
    return load(spark, d, "orders").select("o_orderkey", quality.ms_to_timestamp(F.col("o_orderkey") * 86400123).cast("timestamp_ntz").alias("at"))


def lag_seconds(spark, d):
    rows = load(spark, d, "lineitem").join(load(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select("l_orderkey", "l_linenumber", quality.lag_seconds("l_shipdate", "o_orderdate").alias("lag"))


def progress(spark, d):
    return quality.progress(load(spark, d, "status_history"))


def _states(spark, d):
    return quality.table_state(quality.latest_status(load(spark, d, "status_history")), NOW, stale_hours=72)


def table_state(spark, d):
    return _states(spark, d).select("table_id", "age_s", "state")


def state_summary(spark, d):
    expected = load(spark, d, "status_history").select("table_id", "feed").distinct()
    expected = expected.union(expected.filter("table_id % 10 = 0").select(F.col("table_id") + 100000, "feed"))
    return quality.state_summary(_states(spark, d), expected)


def state_note(spark, d):
    return quality.state_note(_states(spark, d)).select("table_id", "note")


def feed_status(spark, d):
    rows = load(spark, d, "status_history")
    return quality.feed_status(quality.latest_status(rows.filter("table_id % 4 > 0")), rows, NOW)


# ---- layout and catalog

def column_min_max(spark, d):
    return layout.column_min_max(load(spark, d, "lineitem"), "l_shipdate", "l_quantity > 10")


def stats_min_max(spark, d):
    path = _folder(spark)
    rows = load(spark, d, "lineitem").select("l_orderkey", F.lpad(F.col("l_orderkey").cast("string"), 20, "0").alias("seq"), F.rpad("l_linestatus", 80, "x").alias("long_text"), "l_returnflag")
    feeds.partitioned_write(rows, path, ("l_returnflag",), rows_per_file=5000)
    found = zip(rows.columns, layout.columns_min_max(spark, path, rows.columns), strict=True)
    out = [ends.select(F.lit(c).alias("column"), F.col("low").cast("string").alias("low"), F.col("high").cast("string").alias("high")) for c, ends in found]
    return reduce(DataFrame.union, out)


def distinct_values(spark, d):
    return layout.distinct_values(load(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"])


def _ranges(spark, d):
    """Key ranges of real files: events written by type, sixteen files a type at most."""
    path = _folder(spark)
    rows = load(spark, d, "events").select(F.col("event_type").alias("unit"), (F.col("user_id") % 16).alias("deal"), "event_id")
    rows.repartition("unit", "deal").write.partitionBy("unit", "deal").parquet(path)
    return layout.file_key_ranges(spark.read.parquet(path), "event_id", ("unit",))


def file_key_ranges(spark, d):
    rows = layout.file_key_ranges(load(spark, d, "orders"), "o_orderkey")
    return rows.select(F.element_at(F.split("file", "/"), -1).alias("file"), "low", "high", "n_rows")


def overlapping_files(spark, d):
    return layout.overlapping_files(_ranges(spark, d), "unit")


def recluster_plan(spark, d):
    return layout.recluster_plan(layout.overlapping_files(_ranges(spark, d), "unit"))


def recluster(spark, d):
    """Orders by status in six files each: those of one status by ranges of keys, which stay
    as they are, the others dealt in turn."""
    path, orders = _folder(spark), load(spark, d, "orders").select("o_orderstatus", "o_orderkey", "o_totalprice")
    top = orders.agg(F.max("o_orderkey")).first()[0]
    deal = F.when(F.col("o_orderstatus") == "P", F.floor(F.col("o_orderkey") * 6 / (top + 1))).otherwise(F.col("o_orderkey") % 6)
    orders.withColumn("deal", deal.cast("int")).repartition("o_orderstatus", "deal").sortWithinPartitions("o_orderkey").write.partitionBy("o_orderstatus", "deal").parquet(f"{path}/dealt")
    for k in range(6):
        spark.read.parquet(f"{path}/dealt").filter(F.col("deal") == k).drop("deal").coalesce(1).write.mode("append").partitionBy("o_orderstatus").parquet(f"{path}/table")
    before = {f for f in list_uris(spark, f"{path}/table") if "o_orderstatus=P" in f}
    done = layout.recluster_units(spark, f"{path}/table", "o_orderkey", ("o_orderstatus",))
    kept = before == {f for f in list_uris(spark, f"{path}/table") if "o_orderstatus=P" in f}
    sums = spark.read.parquet(f"{path}/table").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("o_orderkey").alias("keys"))
    return done.join(sums, "o_orderstatus").select("o_orderstatus", "n_files", "overlap", "recluster", "overlap_after", "n_rows", "keys", F.lit(kept).alias("others_kept"))


def dataset_size_profile(spark, d):
    path = _folder(spark)
    with feeds.unsorted_writes(spark):  # a task writes a whole line number, which must not be sorted
        load(spark, d, "lineitem").repartition("l_linenumber").write.partitionBy("l_linenumber").parquet(path)
    size = layout.size_profile(spark, path)
    per_mb = F.col("rows_per_mb") == F.greatest(F.lit(1000), F.floor(F.col("n_rows") * 1048576.0 / F.col("n_bytes")))
    return size.select("n_rows", "n_files", (F.col("n_bytes") > 0).alias("has_bytes"), per_mb.alias("per_mb"))


def path_partitions(spark, d):
    rows = load(spark, d, "orders").select("o_orderkey", F.concat(F.lit("/a/table/year="), F.year("o_orderdate").cast("string"), F.lit("/month="), F.month("o_orderdate").cast("string"), F.lit("/f.parquet")).alias("path"))
    return layout.path_partitions(rows).select("o_orderkey", F.array_join("parts", ",").alias("parts"))


def data_dictionary(spark, d):
    path = _folder(spark)
    for place, table in (("geo/small", "region"), ("geo/small", "nation"), ("sales", "customer")):
        load(spark, d, table).coalesce(1).write.parquet(f"{path}/{place}/{table}")
    load(spark, d, "orders").repartition("o_orderstatus").write.partitionBy("o_orderstatus").parquet(f"{path}/sales/orders")
    remarks = load(spark, d, "region").select(F.lit("nation").alias("dataset"), F.lit("n_name").alias("column"), F.concat(F.lit("a name of "), F.col("r_name")).alias("remarks"))
    out = layout.data_dictionary(spark, path, remarks)
    return out.select("group", "dataset", "n_files", "ordinal", "column", "type", "is_partition", "remarks")


def dataset_records(spark, d):
    path = _folder(spark)
    for place, table in (("geo/small", "region"), ("geo/small", "nation"), ("sales", "customer")):
        load(spark, d, table).coalesce(1).write.parquet(f"{path}/{place}/{table}")
    load(spark, d, "orders").repartition("o_orderstatus").write.partitionBy("o_orderstatus").parquet(f"{path}/sales/orders")
    remarks = load(spark, d, "region").select(F.lit("nation").alias("dataset"), F.lit("n_name").alias("column"), F.concat(F.lit("a name of "), F.col("r_name")).alias("remarks"))
    out = layout.dataset_records(spark, path, remarks)
    told = F.array_join(F.transform("schema", lambda f: F.concat_ws(":", f["name"], f["type"], f["is_partition"].cast("string"), f["description"])), ",")
    return out.select("group", "name", F.size("child_files").alias("n_files"), told.alias("columns"))


def register_schemas(spark, d):
    """A view keeps its columns when the dataset gets files with more."""
    path = _folder(spark)
    load(spark, d, "nation").select("n_nationkey", "n_name").write.parquet(path)
    failed = layout.register_schemas(spark, {"Geo": {"Fare.Nation": path, "Gone": f"{path}-gone"}, "Sales": {"Orders": f"{d}/orders.parquet"}})
    load(spark, d, "nation").withColumn("n_more", F.lit(1)).write.mode("append").parquet(path)
    spark.catalog.refreshByPath(path)
    count = spark.sql("select count(*) as n_orders from sales.orders")
    return spark.sql("select * from geo.fare_nation").distinct().crossJoin(F.broadcast(count)).withColumn("n_failed", F.lit(len(failed)))  # one row


def register_views(spark, d):
    failed = layout.register_views(spark, {"Fare.Nation": f"{d}/nation.parquet", "Fare.Gone": f"{d}/gone.parquet"})
    return spark.sql("select n_nationkey, n_name from fare_nation").withColumn("n_failed", F.lit(len(failed)))


def column_descriptions(spark, d):
    part = load(spark, d, "part")
    columns = part.select(F.col("p_brand").alias("dataset"), F.col("p_partkey").cast("string").alias("column"))
    remarks = part.filter("p_partkey % 3 = 0").select(F.col("p_brand").alias("dataset"), F.col("p_partkey").cast("string").alias("column"), F.col("p_type").alias("remarks"))
    return layout.column_descriptions(columns, remarks)


def register_reports(spark, d):
    written = {
        "report_by_flag": lambda s: load(s, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n")),
        "report_broken": lambda s: s.table("report_no_such_table"),
    }
    failed = layout.register_reports(spark, _folder(spark), written, {"report_totals": lambda s: s.sql("select l_returnflag, sum(n) as n from report_by_flag group by l_returnflag")})
    return spark.table("report_totals").withColumn("n_failed", F.lit(len(failed)))


# ---- schemas

def _descriptors(spark, d):
    kind = F.expr("element_at(array('REAL4','REAL8','BOOLEAN','DATE','DATETIME','TIME','INT4','NUMERIC','NUMERIC','STRING'), cast(p_partkey % 10 + 1 as int))")
    return load(spark, d, "part").select(
        F.col("p_brand").alias("table"), F.col("p_partkey").cast("int").alias("ordinal"), F.concat(F.lit("COL_"), F.col("p_partkey").cast("string")).alias("name"), kind.alias("type"),
        (F.col("p_size") % 30 + 1).cast("int").alias("precision"), F.when(F.col("p_partkey") % 20 < 10, 0).otherwise(2).alias("scale"), F.when(F.col("p_size") < 8, F.col("p_size")).otherwise(0).alias("key_pos"),
    )


def _written(rows, path, key):
    """Documents as files, one a key, as a vendor delivers them."""
    rows.repartition(key).write.partitionBy(key).text(path)
    return path


def _vendor_documents(spark, d):
    """A document a table, with its columns listed under dataInfo, read back."""
    column = F.struct("ordinal", "name", "type", "precision", "scale", F.col("key_pos").alias("primaryKeyPos"))
    docs = _descriptors(spark, d).groupBy("table").agg(F.collect_list(column).alias("columns"))
    text = F.to_json(F.struct(F.struct(F.col("table").alias("sourceTable"), "columns").alias("dataInfo")))
    path = _written(docs.select(text.alias("value"), F.regexp_replace("table", "[^A-Za-z0-9]", "_").alias("t")), _folder(spark), "t")
    return schema.dfm_descriptors(spark, path)


def dfm_schema(spark, d):
    return schema.dfm_schema(_vendor_documents(spark, d))


def precision_pin(spark, d):
    rows = _vendor_documents(spark, d)
    pins = rows.filter("ordinal % 3 = 0 and precision % 2 = 0").select(F.upper("name").alias("name"), "type", "scale", F.col("precision").alias("drift_precision"), F.lit(19).alias("archive_precision"))
    off = rows.filter("ordinal % 3 = 1").select("name", "type", "scale", (F.col("precision") + 1).alias("drift_precision"), F.lit(21).alias("archive_precision"))  # of another precision
    return schema.precision_pin(rows, pins.union(off)).select("table", "ordinal", "precision", "scale")


def type_drift(spark, d):
    """The documents of two deliveries; the second has other precisions in part."""
    first = _vendor_documents(spark, d)
    second = first.withColumn("precision", F.when(F.col("ordinal") % 4 == 0, F.col("precision") + 3).otherwise(F.col("precision")))
    return schema.type_drift(first.union(second))


def afc_schema(spark, d):
    kind = F.expr("element_at(array('bigint','integer','character varying','timestamp with time zone'), cast(p_partkey % 4 + 1 as int))")
    columns = load(spark, d, "part").select(F.col("p_brand").alias("table"), F.struct(F.concat(F.lit("c"), F.col("p_partkey").cast("string")).alias("column_name"), kind.alias("data_type")).alias("c"))
    docs = columns.groupBy("table").agg(F.collect_list("c").alias("table_infos"))
    text = F.to_json(F.struct(F.col("table").alias("table_name"), "table_infos"))
    path = _written(docs.select(text.alias("value"), F.regexp_replace("table", "[^A-Za-z0-9]", "_").alias("t")), _folder(spark), "t")
    return schema.api_schema(schema.api_infos(spark, path))


def _properties(spark, d):
    """The properties of one OpenAPI document about all tables."""
    kind = F.expr("element_at(array('string','boolean','number','array','object',cast(null as string)), cast(p_partkey % 6 + 1 as int))")
    parts = load(spark, d, "part").select(F.col("p_brand").alias("table"), F.concat(F.lit("c"), F.col("p_partkey").cast("string")).alias("column"), F.struct(kind.alias("type")).alias("p"))
    tables = parts.groupBy("table").agg(F.map_from_entries(F.collect_list(F.struct("column", "p"))).alias("properties"))
    schemas = tables.agg(F.map_from_entries(F.collect_list(F.struct("table", F.struct("properties")))).alias("schemas"))
    path = _folder(spark)
    schemas.select(F.to_json(F.struct(F.struct("schemas").alias("components"))).alias("value")).coalesce(1).write.text(path)
    names = [r.table for r in tables.select("table").collect()]  # a row a table
    return schema.openapi_properties(spark, path, names)


def openapi_schema(spark, d):
    rows = _properties(spark, d)
    private = rows.filter("cast(substr(column, 2) as int) % 7 = 0").select("table", "column")
    return schema.openapi_schema(rows, private, allowed=("c14", "c28"))


def schema_compat_check(spark, d):
    rows = schema.dfm_schema(_descriptors(spark, d))
    existing = rows.filter("ordinal % 9 > 0").withColumn("type", F.when(F.col("ordinal") % 11 == 0, "varchar(20)").otherwise(F.col("type")))
    return schema.schema_compat(existing, rows.filter("ordinal % 8 > 0"), private=("col_16",))


def export_type_map(spark, d):
    return schema.dfm_schema(_descriptors(spark, d)).select("table", "ordinal", schema.export_type(F.col("type")).alias("export_type"))


def key_discovery(spark, d):
    return schema.key_discovery(_descriptors(spark, d).withColumn("key_pos", F.when(F.col("key_pos") > 0, F.col("ordinal")).otherwise(0)))


def key_issues(spark, d):
    rows = _descriptors(spark, d).withColumn("key_pos", F.when(F.col("table") == "Brand#11", 0).otherwise(F.col("key_pos")))
    columns = rows.filter("ordinal % 5 > 0").select("table", F.col("name").alias("column"))
    return schema.key_issues(rows, columns)


# ---- sources and sinks: what is written is read back

def snapshot_csv_load(spark, d):
    path, rows = _folder(spark), load(spark, d, "customer")
    rows.write.option("header", True).option("compression", "gzip").csv(path)
    out = feeds.snapshot_csv_load(spark, path, rows.schema, "2024-03-05 01:00:00")
    return out.select("c_custkey", "c_name", "change_oper", "change_seq", "part_year", "part_month")


def cdc_csv_load(spark, d):
    path, log = _folder(spark), load(spark, d, "cdc_log").select("txn_id", "change_seq", "change_oper", "change_ts", "amount", "status")
    log.filter("txn_id % 2 = 0").drop("status").coalesce(2).write.option("header", True).csv(f"{path}/a")
    log.filter("txn_id % 2 = 1").coalesce(2).write.option("header", True).csv(f"{path}/b")
    files = [f"file:{f}" if "://" not in path else path.split("://")[0] + "://" + f for k in "ab" for f in feeds_files(spark, f"{path}/{k}")]
    return feeds.cdc_csv_load(spark, files, {"txn_id": "bigint", "amount": "bigint", "change_ts": "timestamp_ntz"}).select("txn_id", "change_seq", "change_oper", "amount", "status", "part_year", "part_month")


def feeds_files(spark, path):
    from quayside.sources.files import list_files

    return list_files(spark, path, ".csv")


def history_archive_write(spark, d):
    path, log = _folder(spark), load(spark, d, "cdc_log").withColumn("snapshot", F.lit("s1"))
    feeds.history_archive_write(log.filter("txn_id % 2 = 0"), path)
    feeds.history_archive_write(log.filter("txn_id % 2 = 1"), path)
    return feeds.union_by_name_scan(spark, path).groupBy("snapshot", "part_year", "part_month").agg(F.count(F.lit(1)).alias("n"))


def ndjson_typed_load(spark, d):
    path = _folder(spark)
    rows = load(spark, d, "events").select("event_id", F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(".123+00")).alias("ts"), "props", "user_id")
    rows.write.option("compression", "gzip").json(path)
    spec = T.StructType().add("event_id", "long").add("ts", "timestamp_ntz").add("props", "string").add("user_id", "long")
    return feeds.ndjson_typed_load(spark, path, spec, ["ts"], private=("user_id",))


def append_table_write(spark, d):
    path, rows = _folder(spark), load(spark, d, "nation").select("n_nationkey")
    feeds.append_table_write(rows, path)
    feeds.append_table_write(rows, path)
    return spark.read.parquet(path).groupBy("n_nationkey").agg(F.count(F.lit(1)).alias("n"))


def static_table_overwrite(spark, d):
    path, rows = _folder(spark), load(spark, d, "nation").select("n_nationkey", F.lit(7).alias("job_id"))
    feeds.static_table_overwrite(rows, path)
    feeds.static_table_overwrite(rows.withColumn("job_id", F.lit(8)), path)
    return spark.read.parquet(path)


def restricted_split_load(spark, d):
    rows = load(spark, d, "orders").select("o_custkey", F.col("o_orderstatus").alias("secret"), "o_orderkey")
    public, lookup = feeds.restricted_split(rows, "secret", "o_custkey")
    return lookup.join(public.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")), "o_custkey")


def json_cols_load(spark, d):
    path = _folder(spark)
    number = F.when(F.col("event_id") % 5 == 0, F.lit('"n/a"')).when(F.col("event_id") % 2 == 0, F.concat(F.lit('"'), F.col("user_id").cast("string"), F.lit('"'))).otherwise(F.col("user_id").cast("string"))
    hour = F.concat(F.lit('"'), F.date_format("ts", "yyyy-MM-dd HH:00:00"), F.lit('"'))
    parts = [F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(', "user_id": '), number, F.lit(', "hour": '), hour, F.lit(', "props": '), F.col("props"), F.lit("}")]
    load(spark, d, "events").select(F.concat(*parts).alias("value")).write.text(path)
    return feeds.json_cols_load(spark, path, {"event_id": "bigint", "user_id": "bigint", "hour": "string", "props": "string"}, ["props"], "hour")


def union_by_name_scan(spark, d):
    path, rows = _folder(spark), load(spark, d, "supplier")
    rows.select("s_suppkey").write.parquet(f"{path}/part_no=1")
    rows.select("s_suppkey", "s_name").write.parquet(f"{path}/part_no=2")
    return feeds.union_by_name_scan(spark, path)


def latest_snapshot_scan(spark, d):
    path, rows = _folder(spark), load(spark, d, "supplier")
    rows.write.parquet(f"{path}/snapshot=20240101")
    rows.filter("s_suppkey % 2 = 0").drop("s_acctbal").write.parquet(f"{path}/snapshot=20240201")
    return feeds.latest_snapshot_scan(spark, path).drop("snapshot")


def silver_scan(spark, d):
    path = _folder(spark)
    load(spark, d, "silver_initial").write.partitionBy("part_year", "part_month").parquet(path)
    return spark.read.parquet(path).select("txn_id", "amount", "part_year", "part_month")


def partitioned_write(spark, d):
    path = _folder(spark)
    feeds.partitioned_write(load(spark, d, "orders"), path, ("o_orderstatus",), rows_per_file=2000)
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("s"))


def materialize_report(spark, d):
    rows = load(spark, d, "lineitem").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    feeds.materialize_report(rows, _folder(spark), "report_flags")
    return spark.sql("select l_returnflag, n from report_flags")


def incremental_export(spark, d):
    """Two runs, the first when the table held less, and then all rows of the export."""
    to, rows = _folder(spark), load(spark, d, "orders").withColumn("o_orderpriority", F.substring("o_orderpriority", 1, 1))
    casts = {"o_orderpriority": "int", "o_orderstatus": "int"}
    for held in (rows.filter("o_orderkey <= 900"), rows, rows):  # the third finds nothing new
        export.export_run(held, to, "o_orderkey", casts, private=("o_custkey",), batch_rows=4000)
    return export.read_export(spark, to).select("o_orderkey", "o_orderpriority", "o_orderstatus", "run", "batch")


def drop_columns_rewrite(spark, d):
    a, b = _folder(spark), _folder(spark)
    load(spark, d, "customer").write.parquet(a)
    assert layout.drop_columns_rewrite(spark, a, b, ["c_name"]) and not layout.drop_columns_rewrite(spark, a, b, ["gone"])
    return spark.read.parquet(b).select("*")


def drop_columns_in_place(spark, d):
    """Customers in files with and without the column; how many files changed is told too."""
    path, rows = _folder(spark), load(spark, d, "customer").repartition(3, "c_custkey")
    rows.filter("c_custkey % 2 = 0").write.parquet(f"{path}/even=1")
    rows.filter("c_custkey % 2 = 1").drop("c_name").write.parquet(f"{path}/even=0")
    done = layout.drop_columns_in_place(spark, path, ["c_name"])
    right = done.agg(F.count_if(F.col("rewritten") != F.col("file").contains("even=1")).alias("wrong"), F.sum("n_rows").alias("n_rows"))
    return feeds.union_by_name_scan(spark, path).crossJoin(F.broadcast(right))  # one row


def versioned_swap(spark, d):
    """Two versions, a refused empty one, and what is live then."""
    root, rows = _folder(spark), load(spark, d, "supplier")
    versions.publish(rows.filter("s_suppkey % 2 = 0"), root)
    versions.publish(rows, root)
    try:
        versions.publish(rows.filter("s_suppkey < 0"), root)
    except ValueError:
        return versions.read_live(spark, root).withColumn("version", F.lit(versions.live_version(spark, root)))
    raise AssertionError("an empty version was published")


def cast_column_rewrite(spark, d):
    a, b = _folder(spark), _folder(spark)
    load(spark, d, "part").select("p_partkey", "p_size").write.parquet(a)
    layout.cast_column_rewrite(spark, a, b, "p_size", "string")
    return spark.read.parquet(b)


def guarded_swap(spark, d):
    live, fill, old = _folder(spark), _folder(spark), _folder(spark)
    rows = load(spark, d, "supplier").select("s_suppkey", "s_name")
    rows.filter("s_suppkey % 2 = 0").write.parquet(live)
    rows.write.parquet(fill)
    n = layout.guarded_swap(spark, live, fill, old)
    return spark.read.parquet(live).withColumns({"n_live": F.lit(n), "n_backup": F.lit(spark.read.parquet(old).count())})


LATEST = ", ".join(["max(run_at) AS run_at", *(f"arg_max({c}, run_at) AS {c}" for c in ("row_count", "watermark", "watermark_at", "lag_s"))])
LATEST += ", " + ", ".join(f"arg_max_null({c}, run_at) AS {c}" for c in ("caught_up", "budget_nearly_full", "budget_full", "jobs_lag", "pending"))
BEHIND = """CASE WHEN budget_nearly_full OR budget_full OR NOT caught_up OR jobs_lag > 0 THEN true WHEN pending = 0 AND NOT budget_nearly_full THEN false ELSE lag_s > 14400 END"""
STATE_SQL = f"""latest AS (SELECT table_id, {LATEST} FROM status_history GROUP BY 1),
aged AS (SELECT *, (epoch_us(TIMESTAMP '{NOW}') - epoch_us(run_at)) // 1000000 AS age_s FROM latest),
stated AS (SELECT *, CASE WHEN age_s > 72 * 3600 THEN 'STALE' WHEN {BEHIND} THEN 'BEHIND' ELSE 'OK' END AS state FROM aged)
"""
DUR = """CASE WHEN abs({0}) < 90 THEN printf('%.0fs', abs({0})::DOUBLE) WHEN abs({0}) < 5400 THEN printf('%.0fm', abs({0}) / 60::DOUBLE) WHEN abs({0}) < 172800 THEN printf('%.1fh', abs({0}) / 3600::DOUBLE) ELSE printf('%.1fd', abs({0}) / 86400::DOUBLE) END"""
DESC = """d AS (SELECT p_brand AS "table", p_partkey::INT AS ordinal, 'col_' || p_partkey AS "column",
  ['REAL4','REAL8','BOOLEAN','DATE','DATETIME','TIME','INT4','NUMERIC','NUMERIC','STRING'][p_partkey % 10 + 1] AS vtype, (p_size % 30 + 1)::INT AS precision, (CASE WHEN p_partkey %
  20 < 10 THEN 0 ELSE 2 END)::INT AS scale, CASE WHEN p_size < 8 THEN p_partkey ELSE 0 END AS key_pos FROM part),
s AS (SELECT "table", ordinal, "column", CASE vtype WHEN 'REAL4' THEN 'float' WHEN 'REAL8' THEN 'double' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'DATE' THEN 'date' WHEN 'DATETIME' THEN
  'timestamp_ntz' WHEN 'TIME' THEN 'string' WHEN 'INT4' THEN 'bigint'
  WHEN 'NUMERIC' THEN CASE WHEN scale = 0 AND precision < 19 THEN 'bigint' ELSE 'decimal(' || precision || ',' || scale || ')' END ELSE 'string' END AS type FROM d)
"""
RANGES = """r AS (SELECT event_type AS unit, 'f' || (user_id % 16) AS file, min(event_id) AS low, max(event_id) AS high FROM events GROUP BY ALL), o AS (SELECT unit, count(*) AS n_files,
  count(*) FILTER (WHERE low <= before) AS overlap FROM (SELECT *, max(high) OVER (PARTITION BY unit ORDER BY low, file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM r) GROUP BY unit)"""
STRINGS = "WITH x AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'n/a' ELSE (o_orderkey * 3)::VARCHAR END AS a, CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END AS b FROM orders)"

SQL = {
    "count_reconcile": with_adapters("""+ s AS (SELECT user_id AS job_id, count(*) AS n_rows FROM events GROUP BY 1)
SELECT job_id, n_rows, data_count, CASE WHEN data_count IS NULL THEN 'missing_in_counts' WHEN n_rows IS NULL THEN 'missing_in_data' WHEN n_rows <> data_count THEN 'different' ELSE
  'ok' END AS status FROM s FULL JOIN api_counts USING (job_id)""", "api_counts"),
    "column_set_check": """WITH k AS (SELECT json_keys(props) AS ks FROM events)
SELECT "column", issue, count(*) AS n_rows FROM (SELECT unnest(list_filter(ks, lambda x: x NOT IN ('k', 'v'))) AS "column", 'extra' AS issue FROM k UNION ALL SELECT
  unnest(list_filter(['k', 'v'], lambda x: NOT list_contains(ks, x))), 'missing' FROM k) GROUP BY ALL""",
    "json_page_check": """WITH p AS (
  SELECT event_id // 100 AS page, arg_min(CASE WHEN event_id % 300 = 0 THEN '{"k": "x", "tags": 3}' WHEN event_id % 100 = 0 THEN '{"k": null, "tags": [1, 2], "new": 1}' ELSE props
  END, event_id) AS r FROM events GROUP BY 1)
SELECT "column", issue, min(page) AS first_page FROM (
  SELECT page, 'k' AS "column", 'not_number' AS issue FROM p WHERE json_extract_string(r, '$.k') IS NOT NULL AND try_cast(json_extract_string(r, '$.k') AS DOUBLE) IS NULL
  UNION ALL SELECT page, 'tags', 'not_json' FROM p WHERE json_type(r, '$.tags') NOT IN ('ARRAY', 'OBJECT', 'NULL')
  UNION ALL SELECT page, c, 'extra' FROM (SELECT page, unnest(json_keys(r)) AS c FROM p) WHERE c NOT IN ('k', 'tags')) GROUP BY ALL""",
    "numeric_coerce": STRINGS + " SELECT o_orderkey, try_cast(a AS DOUBLE) AS a, try_cast(b AS DOUBLE) AS b FROM x",
    "coercion_warnings": STRINGS + """ SELECT "column", count(*) AS n_bad FROM (SELECT 'a' AS "column", a AS v FROM x UNION ALL SELECT 'b', b FROM x) WHERE v IS NOT NULL AND try_cast(v AS DOUBLE) IS NULL GROUP BY 1""",
    "json_serialize": "SELECT n_nationkey, '[' || n_nationkey || ',' || n_regionkey || ']' AS pair, n_name FROM nation",
    "load_invariants": "SELECT count(*) AS n_loads, count(*) FILTER (WHERE o_orderkey % 100 = 0) AS n_undated, count(*) > 0 AND count(*) FILTER (WHERE o_orderkey % 100 = 0) = 0 AS ok FROM orders",
    "cdc_invariants": with_adapters(
        """SELECT count(*) FILTER (WHERE txn_id % 40 = 0) AS null_seq, count(*) FILTER (WHERE txn_id % 30 = 0) AS null_key, count(*) FILTER (WHERE txn_id % 20 = 1) AS unknown_oper,
  count(*) FILTER (WHERE txn_id % 20 <> 1 AND change_oper = 'I' AND txn_id % 3 = 0) AS undated_inserts, 1 AS absent_columns FROM cdc_log""",
        "cdc_log",
    ),
    "partition_stability": "SELECT user_id AS txn_id, count(DISTINCT CAST(ts AS DATE)) AS n_dates FROM events WHERE user_id % 2 = 0 GROUP BY 1 HAVING count(DISTINCT CAST(ts AS DATE)) > 1",
    "pii_drop": "SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "high_watermark": "SELECT greatest(max(event_id), 5) AS watermark FROM events",
    "boundary_drop": "SELECT event_id FROM events WHERE date_trunc('hour', ts) < (SELECT max(date_trunc('hour', ts)) FROM events)",
    "job_range_batches": with_adapters(
        """+ j AS (SELECT job_id, data_count, row_number() OVER (ORDER BY job_id) AS i, sum(data_count) OVER (ORDER BY job_id)::BIGINT AS running FROM api_counts WHERE job_id > 20),
walk AS (SELECT i, job_id, data_count, running, 0 AS batch_no, data_count AS held FROM j WHERE i = 1
  UNION ALL SELECT j.i, j.job_id, j.data_count, j.running, w.batch_no + (w.held > 60)::INT, CASE WHEN w.held > 60 THEN j.data_count ELSE w.held + j.data_count END FROM walk w JOIN j ON j.i = w.i + 1)
SELECT job_id, data_count, running, batch_no::BIGINT AS batch_no FROM walk""",
        "api_counts",
    ).replace("WITH ", "WITH RECURSIVE ", 1),
    "backlog": with_adapters("SELECT count(*) FILTER (WHERE job_id > 90) AS jobs_lag, coalesce(sum(data_count) FILTER (WHERE job_id > 90), 0)::BIGINT AS rows_lag, max(job_id) AS latest, count(*) >= 10000 AS truncated, count(*) FILTER (WHERE job_id > 90) > 1 AS rerun_soon FROM api_counts", "api_counts"),
    "row_capped_run": "SELECT event_id, ts, (SELECT count(*) FROM events) > 700 AS capped FROM events ORDER BY ts, event_id LIMIT 700",
    "out_of_order_pages": """SELECT * FROM (SELECT event_type, page, low, max(high) OVER (PARTITION BY event_type ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM (SELECT
  event_type, user_id // 10 AS page, min(ts) AS low, max(ts) AS high FROM events GROUP BY ALL)) WHERE low < before""",
    "seq_to_timestamp": "SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 THEN date_trunc('second', o_orderdate) END AS at FROM orders",
    "ms_to_timestamp": "SELECT o_orderkey, make_timestamp(o_orderkey * 86400123 * 1000) AS at FROM orders",
    "lag_seconds": "SELECT l_orderkey, l_linenumber, trunc((epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 1000000)::BIGINT AS lag FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    "progress": with_adapters(
        """+ w AS (SELECT *, lag(run_at) OVER v AS pr, lag(row_count) OVER v AS pc, lag(watermark_at) OVER v AS pw FROM status_history WINDOW v AS (PARTITION BY table_id ORDER BY run_at)),
x AS (SELECT *, row_count - pc AS rows_added, (epoch_us(run_at) - epoch_us(pr)) // 1000000 AS took, (epoch_us(watermark_at) - epoch_us(pw)) // 1000000 AS advance FROM w WHERE pr IS NOT NULL),
y AS (SELECT *, CASE WHEN lag_s <= 0 THEN 0 WHEN took > 0 AND advance > took THEN floor(lag_s / ((advance - took) / took)) END::BIGINT AS wall FROM x)
SELECT table_id, run_at, run_s AS run_duration_s, rows_added, took, advance, round(rows_added / run_s, 2) AS rows_per_second, round(advance / 86400.0::DOUBLE / (run_s /
  3600.0::DOUBLE), 3) AS data_days_per_hour,
  CASE WHEN took > 0 THEN round(advance / took, 3) END AS catchup_ratio, CASE WHEN lag_s <= 0 THEN 0 WHEN advance > 0 THEN floor(lag_s / (advance / run_s)) END::BIGINT AS catchup_processing_s,
  wall AS catchup_wall_s, CASE WHEN lag_s > 0 THEN run_at + to_seconds(wall) END AS projected_caught_up FROM y""",
        "status_history",
    ),
    "table_state": with_adapters("+" + STATE_SQL + "SELECT table_id, age_s, state FROM stated", "status_history"),
    "state_summary": with_adapters("+" + STATE_SQL + """, e AS (SELECT DISTINCT table_id, feed FROM status_history), a AS (SELECT * FROM e UNION ALL SELECT table_id + 100000, feed FROM e WHERE table_id % 10 = 0)
SELECT a.feed, count(*) FILTER (WHERE coalesce(state, 'STALE') = 'STALE') AS stale, count(*) FILTER (WHERE state = 'BEHIND') AS behind, count(*) FILTER (WHERE state = 'OK') AS ok
  FROM a LEFT JOIN stated s ON a.table_id = s.table_id GROUP BY 1""", "status_history"),
    "state_note": with_adapters(
        "+" + STATE_SQL + f"SELECT table_id, concat_ws('; ', state, format('{{:,}}', row_count) || ' rows', CASE WHEN lag_s > 0 THEN 'lag ' || {DUR.format('lag_s')} END, 'seen ' || {DUR.format('age_s')} || ' ago') AS note FROM stated",
        "status_history",
    ),
    "feed_status": with_adapters(
        f"""+ latest AS (SELECT table_id, arg_max(feed, run_at) AS feed, {LATEST} FROM status_history WHERE table_id % 4 > 0 GROUP BY 1),
up AS (SELECT feed, max(watermark) AS upstream_max, max(watermark_at) AS newest FROM status_history GROUP BY 1)
SELECT feed, count(*) AS n_tables, sum(row_count)::BIGINT AS row_count, max(watermark) AS watermark, max(lag_s) AS lag_s, count(*) FILTER (WHERE {BEHIND}) AS n_behind,
  count(*) FILTER (WHERE budget_nearly_full) AS n_nearly_full, count(*) FILTER (WHERE jobs_lag > 0) AS n_waiting, any_value(upstream_max) AS upstream_max,
  trunc((epoch_us(any_value(newest)) - epoch_us(max(watermark_at))) / 1000000)::BIGINT AS seq_lag_s, trunc((epoch_us(TIMESTAMP '{NOW}') - epoch_us(max(watermark_at))) / 1000000)::BIGINT AS clock_lag_s
FROM latest JOIN up USING (feed) GROUP BY 1""",
        "status_history",
    ),
    "column_min_max": "SELECT min(l_shipdate) AS low, max(l_shipdate) AS high FROM lineitem WHERE l_quantity > 10",
    "stats_min_max": """SELECT 'l_orderkey' AS "column", min(l_orderkey)::VARCHAR AS low, max(l_orderkey)::VARCHAR AS high FROM lineitem
UNION ALL SELECT 'seq', min(lpad(l_orderkey::VARCHAR, 20, '0')), max(lpad(l_orderkey::VARCHAR, 20, '0')) FROM lineitem
UNION ALL SELECT 'long_text', min(rpad(l_linestatus, 80, 'x')), max(rpad(l_linestatus, 80, 'x')) FROM lineitem
UNION ALL SELECT 'l_returnflag', min(l_returnflag), max(l_returnflag) FROM lineitem""",
    "distinct_values": "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem",
    "file_key_ranges": "SELECT 'orders.parquet' AS file, min(o_orderkey) AS low, max(o_orderkey) AS high, count(*) AS n_rows FROM orders",
    "overlapping_files": f"WITH {RANGES} SELECT * FROM o",
    "recluster_plan": f"WITH {RANGES} SELECT *, greatest(4, ceil(2 * sqrt(n_files)))::BIGINT AS threshold, overlap >= greatest(4, ceil(2 * sqrt(n_files))) AS recluster FROM o",
    "recluster": """WITH t AS (SELECT o_orderstatus, o_orderkey, CASE WHEN o_orderstatus = 'P' THEN floor(o_orderkey * 6 / (max(o_orderkey) OVER () + 1)) ELSE o_orderkey % 6 END AS deal FROM orders),
f AS (SELECT o_orderstatus, deal, min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM t GROUP BY 1, 2),
b AS (SELECT *, max(hi) OVER (PARTITION BY o_orderstatus ORDER BY lo ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM f),
o AS (SELECT o_orderstatus, count(*) AS n_files, count(*) FILTER (WHERE lo <= before) AS overlap FROM b GROUP BY 1),
p AS (SELECT *, overlap >= greatest(4, ceil(2 * sqrt(n_files))) AS recluster FROM o)
SELECT o_orderstatus, n_files, overlap, recluster, CASE WHEN recluster THEN 0 ELSE overlap END AS overlap_after, n_rows, keys, true AS others_kept FROM p
JOIN (SELECT o_orderstatus, count(*) AS n_rows, sum(o_orderkey)::BIGINT AS keys FROM orders GROUP BY 1) USING (o_orderstatus)""",
    "dataset_size_profile": "SELECT count(*) AS n_rows, count(DISTINCT l_linenumber) AS n_files, count(*) > 0 AS has_bytes, true AS per_mb FROM lineitem",
    "path_partitions": "SELECT o_orderkey, 'year=' || year(o_orderdate) || ',month=' || month(o_orderdate) AS parts FROM orders",
    "data_dictionary": """WITH c AS (SELECT * FROM (VALUES ('geo/small', 'region', 0, 'r_regionkey', 'int'), ('geo/small', 'region', 1, 'r_name', 'string'), ('geo/small', 'nation', 0, 'n_nationkey', 'int'),
  ('geo/small', 'nation', 1, 'n_name', 'string'),
  ('geo/small', 'nation', 2, 'n_regionkey', 'int'), ('sales', 'customer', 0, 'c_custkey', 'bigint'), ('sales', 'customer', 1, 'c_name', 'string'), ('sales', 'customer', 2, 'c_nationkey', 'int'),
  ('sales', 'customer', 3, 'c_acctbal', 'double'), ('sales', 'customer', 4, 'c_mktsegment', 'string'), ('sales', 'orders', 0, 'o_orderkey', 'bigint'), ('sales', 'orders', 1, 'o_custkey', 'bigint'),
  ('sales', 'orders', 2, 'o_totalprice', 'double'), ('sales', 'orders', 3, 'o_orderdate', 'timestamp_ntz'), ('sales', 'orders', 4, 'o_orderpriority', 'string'), ('sales', 'orders',
  5, 'o_orderstatus', 'string')) v("group", dataset, ordinal, "column", type))
SELECT *, CASE dataset WHEN 'orders' THEN (SELECT count(DISTINCT o_orderstatus) FROM orders) ELSE 1 END AS n_files, "column" = 'o_orderstatus' AS is_partition,
  CASE WHEN "column" = 'n_name' THEN 'a name of ' || (SELECT min(r_name) FROM region) END AS remarks FROM c""",
    "column_descriptions": "SELECT p_brand AS dataset, p_partkey::VARCHAR AS \"column\", CASE WHEN p_partkey % 3 = 0 THEN p_type END AS remarks FROM part",
    "register_reports": "SELECT l_returnflag, count(*) AS n, 1 AS n_failed FROM lineitem GROUP BY 1",
    "dataset_records": """WITH c AS (SELECT * FROM (VALUES ('geo/small', 'region', 0, 'r_regionkey:int:false'), ('geo/small', 'region', 1, 'r_name:string:false'), ('geo/small', 'nation', 0,
  'n_nationkey:int:false'),
  ('geo/small', 'nation', 1, (SELECT 'n_name:string:false:' || min('a name of ' || r_name) FROM region)), ('geo/small', 'nation', 2, 'n_regionkey:int:false'),
  ('sales', 'customer', 0, 'c_custkey:bigint:false'), ('sales', 'customer', 1, 'c_name:string:false'), ('sales', 'customer', 2, 'c_nationkey:int:false'), ('sales', 'customer', 3,
  'c_acctbal:double:false'), ('sales', 'customer', 4, 'c_mktsegment:string:false'),
  ('sales', 'orders', 0, 'o_orderkey:bigint:false'), ('sales', 'orders', 1, 'o_custkey:bigint:false'), ('sales', 'orders', 2, 'o_totalprice:double:false'), ('sales', 'orders', 3,
  'o_orderdate:timestamp_ntz:false'), ('sales', 'orders', 4, 'o_orderpriority:string:false'),
  ('sales', 'orders', 5, 'o_orderstatus:string:true')) x("group", name, k, told))
SELECT "group", name, CASE WHEN name = 'orders' THEN (SELECT count(DISTINCT o_orderstatus) FROM orders) ELSE 1 END AS n_files, string_agg(told, ',' ORDER BY k) AS columns FROM c GROUP BY 1, 2""",
    "register_schemas": "SELECT n_nationkey, n_name, (SELECT count(*) FROM orders) AS n_orders, 1 AS n_failed FROM nation",
    "register_views": "SELECT n_nationkey, n_name, 1 AS n_failed FROM nation",
    "dfm_schema": f"WITH {DESC} SELECT * FROM s",
    "precision_pin": f'WITH {DESC} SELECT "table", ordinal, CASE WHEN ordinal % 3 = 0 AND precision % 2 = 0 THEN 19 ELSE precision END AS precision, scale FROM d',
    "type_drift": f"""WITH {DESC}, d2 AS (SELECT "table", ordinal, "column", vtype, CASE WHEN ordinal % 4 = 0 THEN precision + 3 ELSE precision END AS precision, scale, key_pos FROM d),
s2 AS (SELECT "table", "column", CASE WHEN vtype = 'NUMERIC' THEN CASE WHEN scale = 0 AND precision < 19 THEN 'bigint' ELSE 'decimal(' || precision || ',' || scale || ')' END END
  AS type FROM d2 WHERE vtype = 'NUMERIC'),
b AS (SELECT s."table", s."column", s.type AS t1, s2.type AS t2 FROM s JOIN s2 ON s."table" = s2."table" AND s."column" = s2."column")
SELECT "table", "column", least(t1, t2) || ' | ' || greatest(t1, t2) AS types FROM b WHERE t1 <> t2""",
    "afc_schema": """SELECT p_brand AS "table", 'c' || p_partkey AS "column", ['bigint','int','string','timestamp_ntz'][p_partkey % 4 + 1] AS type, p_partkey % 4 = 3 AS is_timestamp FROM part""",
    "openapi_schema": """SELECT p_brand AS "table", 'c' || p_partkey AS "column", ['string','boolean','double','string','string','string'][p_partkey % 6 + 1] AS type, p_partkey % 6 IN (3, 4) AS is_json
  FROM part WHERE p_partkey % 7 <> 0 OR p_partkey IN (14, 28)""",
    "schema_compat_check": f"""WITH {DESC}, e AS (SELECT "table", "column", CASE WHEN ordinal % 11 = 0 THEN 'varchar(20)' ELSE type END AS actual FROM s WHERE ordinal % 9 > 0), x AS (SELECT "table", "column",
  type AS expected FROM s WHERE ordinal % 8 > 0)
SELECT * FROM (SELECT "table", "column", actual, expected, CASE WHEN expected IS NULL THEN 'extra' WHEN actual IS NULL THEN 'missing' WHEN replace(actual, 'varchar(20)', 'string')
  <> expected THEN 'mismatch' END AS issue FROM e FULL JOIN x USING ("table", "column")) WHERE issue IS NOT NULL AND NOT (issue = 'extra' AND "column" = 'col_16')""",
    "export_type_map": f"""WITH {DESC} SELECT "table", ordinal, CASE WHEN type LIKE 'timestamp%' THEN 'timestamp' WHEN type = 'bigint' THEN 'bigint' WHEN type IN ('float', 'double') THEN 'double' WHEN type =
  'boolean' THEN 'bool' WHEN type = 'date' THEN 'date' ELSE 'text' END AS export_type FROM s""",
    "key_discovery": f"""WITH {DESC} SELECT "table", string_agg("column", ',' ORDER BY key_pos) AS keys FROM d WHERE key_pos > 0 GROUP BY 1""",
    "key_issues": """WITH k AS (SELECT p_brand AS "table", 'col_' || p_partkey AS "column", p_partkey, CASE WHEN p_brand <> 'Brand#11' AND p_size < 8 THEN p_size ELSE 0 END AS pos FROM part)
SELECT "table", 'no_keys' AS issue, '' AS told FROM k GROUP BY 1 HAVING max(pos) = 0
UNION ALL SELECT "table", 'repeated_position', pos || ': ' || string_agg("column", ',' ORDER BY "column") FROM k WHERE pos > 0 GROUP BY "table", pos HAVING count(*) > 1
UNION ALL SELECT "table", 'absent_key', "column" FROM k WHERE pos > 0 AND p_partkey % 5 = 0""",
    "snapshot_csv_load": "SELECT c_custkey, c_name, 'L' AS change_oper, NULL AS change_seq, 2024 AS part_year, 3 AS part_month FROM customer",
    "cdc_csv_load": with_adapters("SELECT txn_id, change_seq, change_oper, amount, CASE WHEN txn_id % 2 = 1 THEN status END AS status, year(change_ts)::INT AS part_year, month(change_ts)::INT AS part_month FROM cdc_log", "cdc_log"),
    "history_archive_write": with_adapters("SELECT 's1' AS snapshot, part_year, part_month, count(*) AS n FROM cdc_log GROUP BY ALL", "cdc_log"),
    "ndjson_typed_load": "SELECT event_id, date_trunc('second', ts) AS ts, props FROM events",
    "append_table_write": "SELECT n_nationkey, 2 AS n FROM nation",
    "static_table_overwrite": "SELECT n_nationkey, 8 AS job_id FROM nation",
    "restricted_split_load": "SELECT DISTINCT o_custkey, o_orderstatus AS secret, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders",
    "json_cols_load": """SELECT event_id, CASE WHEN event_id % 5 > 0 THEN user_id END AS user_id, strftime(ts, '%Y-%m-%d %H:00:00') AS hour, props FROM events
WHERE date_trunc('hour', ts) < (SELECT max(date_trunc('hour', ts)) FROM events)""",
    "union_by_name_scan": "SELECT s_suppkey, NULL AS s_name, 1 AS part_no FROM supplier UNION ALL SELECT s_suppkey, s_name, 2 FROM supplier",
    "latest_snapshot_scan": "SELECT s_suppkey, s_name, s_nationkey FROM supplier WHERE s_suppkey % 2 = 0",
    "silver_scan": with_adapters("SELECT txn_id, amount, part_year, part_month FROM silver_initial", "silver_initial"),
    "partitioned_write": "SELECT o_orderstatus, count(*) AS n, sum(o_orderkey)::BIGINT AS s FROM orders GROUP BY 1",
    "materialize_report": "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1",
    "incremental_export": """SELECT o_orderkey, try_cast(o_orderpriority[1] AS INT) AS o_orderpriority, try_cast(o_orderstatus AS INT) AS o_orderstatus, (o_orderkey > 900)::INT AS run,
  ((row_number() OVER (PARTITION BY o_orderkey > 900 ORDER BY o_orderkey) - 1) // 4000)::INT AS batch FROM orders""",
    "drop_columns_rewrite": "SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "drop_columns_in_place": "SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment, (c_custkey % 2 = 0)::INT AS even, 0 AS wrong, (SELECT count(*) FROM customer) AS n_rows FROM customer",
    "versioned_swap": "SELECT *, 1 AS version FROM supplier",
    "cast_column_rewrite": "SELECT p_partkey, p_size::VARCHAR AS p_size FROM part",
    "guarded_swap": "SELECT s_suppkey, s_name, count(*) OVER () AS n_live, (SELECT count(*) FROM supplier WHERE s_suppkey % 2 = 0) AS n_backup FROM supplier",
}
QUERIES = {name: globals()[name] for name in SQL}
