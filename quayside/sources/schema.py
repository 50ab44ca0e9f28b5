"""Schemas as tables of column descriptors: types, drift and compatibility."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def vendor_type(name: Column, type_: Column, precision: Column, scale: Column) -> Column:
    """Spark type of a vendor descriptor; the change sequence is text always."""
    numeric = F.when((scale == 0) & (precision < 19), "bigint").otherwise(F.concat(F.lit("decimal("), precision.cast("string"), F.lit(","), scale.cast("string"), F.lit(")")))
    simple = {"REAL4": "float", "REAL8": "double", "BOOLEAN": "boolean", "DATE": "date", "TIME": "string", "DATETIME": "timestamp_ntz"}
    out = F.when(F.lower(name) == "header__change_seq", "string")
    for vendor, own in simple.items():
        out = out.when(type_ == vendor, own)
    return out.when(type_.contains("INT"), "bigint").when(type_ == "NUMERIC", numeric).otherwise("string")


def dfm_descriptors(spark: SparkSession, paths) -> DataFrame:
    """(table, ordinal, name, type, precision, scale, key_pos) of vendor documents, a JSON
    file a table that lists its columns under dataInfo."""
    column = "struct<ordinal:int,name:string,type:string,precision:int,scale:int,primaryKeyPos:int>"
    docs = spark.read.schema(f"dataInfo struct<sourceTable:string,columns:array<{column}>>").option("multiLine", True).json(paths)
    rows = docs.select(F.col("dataInfo.sourceTable").alias("table"), F.explode("dataInfo.columns").alias("c"))
    return rows.select("table", "c.ordinal", "c.name", "c.type", "c.precision", "c.scale", F.col("c.primaryKeyPos").alias("key_pos"))


def api_infos(spark: SparkSession, paths) -> DataFrame:
    """(table, column, data_type) of answers about tables, a JSON file a table."""
    docs = spark.read.schema("table_name string, table_infos array<struct<column_name:string,data_type:string>>").option("multiLine", True).json(paths)
    return docs.select(F.col("table_name").alias("table"), F.explode("table_infos").alias("c")).select("table", F.col("c.column_name").alias("column"), "c.data_type")


def openapi_properties(spark: SparkSession, path: str, tables: list[str]) -> DataFrame:
    """(table, column, type) of an OpenAPI document's component schemas; type is null where
    a property has none. A table that the document lacks is an error."""
    schemas = "components struct<schemas:map<string,struct<properties:map<string,struct<type:string>>>>>"
    docs = spark.read.schema(schemas).option("multiLine", True).json(path)
    found = docs.select(F.explode("components.schemas").alias("table", "s")).filter(F.col("table").isin(*tables))
    known = {r.table for r in found.select("table").distinct().collect()}  # a row a table
    if missing := sorted(set(tables) - known):
        raise ValueError(f"the document has no schema of {', '.join(missing)}")
    return found.select("table", F.explode("s.properties").alias("column", "p")).select("table", "column", F.col("p.type").alias("type"))


def dfm_schema(descriptors: DataFrame) -> DataFrame:
    """(table, ordinal, column, type) from (table, ordinal, name, type, precision, scale)."""
    kind = vendor_type(F.col("name"), F.col("type"), F.col("precision"), F.col("scale"))
    return descriptors.select("table", "ordinal", F.lower("name").alias("column"), kind.alias("type"))


def precision_pin(descriptors: DataFrame, pins: DataFrame) -> DataFrame:
    """Precisions that drifted put back to archived ones: ``pins(name, type, scale,
    drift_precision, archive_precision)`` holds for a column of its name (in any case), type,
    scale and drifted precision, in whatever table."""
    p = pins.select(F.lower("name").alias("__n"), F.col("type").alias("__t"), F.col("scale").alias("__s"), F.col("drift_precision").alias("__d"), F.col("archive_precision").alias("__p"))
    same = (F.lower("name") == F.col("__n")) & (F.col("type") == F.col("__t")) & (F.col("scale") == F.col("__s")) & (F.col("precision") == F.col("__d"))
    return descriptors.join(p, same, "left").withColumn("precision", F.coalesce("__p", "precision")).drop("__n", "__t", "__s", "__d", "__p")


def type_drift(descriptors: DataFrame) -> DataFrame:
    """(table, column, types): columns that descriptors, of several documents a table, give
    more than one type."""
    rows = dfm_schema(descriptors).groupBy("table", "column").agg(F.array_sort(F.collect_set("type")).alias("types"))
    return rows.filter(F.size("types") > 1).select("table", "column", F.array_join("types", " | ").alias("types"))


def api_schema(infos: DataFrame) -> DataFrame:
    """(table, column, type, is_timestamp) from (table, column, data_type)."""
    stamp = F.col("data_type").startswith("timestamp")
    kind = F.when(F.col("data_type") == "bigint", "bigint").when(F.col("data_type") == "integer", "int").when(stamp, "timestamp_ntz").otherwise("string")
    return infos.select("table", "column", kind.alias("type"), stamp.alias("is_timestamp"))


def openapi_schema(properties: DataFrame, private: DataFrame, allowed: tuple[str, ...] = ()) -> DataFrame:
    """(table, column, type, is_json) from (table, column, type); no type means string;
    private (table, column) pairs go, but for allowed columns."""
    kept = properties.join(private.filter(~F.col("column").isin(*allowed)) if allowed else private, ["table", "column"], "left_anti")
    kind = F.coalesce("type", F.lit("string"))
    own = F.when(kind == "number", "double").when(kind == "boolean", "boolean").otherwise("string")
    return kept.select("table", "column", own.alias("type"), kind.isin("array", "object").alias("is_json"))


#: Names of text types, of any length.
TEXT = r"^(string|text|utf8|large_string|(var)?char(acter)?( varying)?)(\([0-9]+\))?$"


def schema_compat(existing: DataFrame, expected: DataFrame, private: tuple[str, ...] = ()) -> DataFrame:
    """(table, column, issue, expected, actual): extra, missing and mismatched columns. All
    text types are equal; private columns are no extra ones."""
    e = existing.select("table", "column", F.col("type").alias("actual"))
    x = expected.select("table", "column", F.col("type").alias("expected"))
    text = lambda c: F.when(F.lower(c).rlike(TEXT), "string").otherwise(F.col(c))
    issue = F.when(F.col("expected").isNull(), "extra").when(F.col("actual").isNull(), "missing").when(text("expected") != text("actual"), "mismatch")
    out = e.join(x, ["table", "column"], "full_outer").withColumn("issue", issue).filter("issue is not null")
    return out.filter(~((F.col("issue") == "extra") & F.col("column").isin(*private))) if private else out


def assert_compatible(existing: DataFrame, expected: DataFrame, private: tuple[str, ...] = ()) -> DataFrame:
    """The extra and missing columns, which are only told; a column of another type raises."""
    issues = schema_compat(existing, expected, private)
    wrong = issues.filter("issue = 'mismatch'").orderBy("table", "column").limit(20).collect()
    if wrong:
        raise ValueError("types differ, the data must be migrated: " + "; ".join(f"{r.table}.{r.column} is {r.actual}, not {r.expected}" for r in wrong))
    return issues


def export_type(type_: Column) -> Column:
    """Type of the BI export: integers by width, float and double, date, timestamp, text."""
    same = {"tinyint": "smallint", "smallint": "smallint", "int": "int", "bigint": "bigint", "float": "double", "double": "double", "boolean": "bool", "date": "date", "string": "text"}
    out = F.when(type_.startswith("timestamp"), "timestamp")
    for own, export in same.items():
        out = out.when(type_ == own, export)
    return out.otherwise("text")


def key_discovery(descriptors: DataFrame) -> DataFrame:
    """(table, keys): lower-case key columns in their order."""
    keys = descriptors.filter("key_pos > 0").groupBy("table").agg(F.array_sort(F.collect_list(F.struct("key_pos", F.lower("name").alias("name")))).alias("k"))
    return keys.select("table", F.array_join(F.col("k.name"), ",").alias("keys"))


def key_issues(descriptors: DataFrame, columns: DataFrame | None = None) -> DataFrame:
    """(table, issue, told): tables without keys, positions that several keys share, and keys
    that are not among the ``columns(table, column)`` of the data."""
    keys = descriptors.filter("key_pos > 0").select("table", "key_pos", F.lower("name").alias("column"))
    none = descriptors.select("table").distinct().join(keys, "table", "left_anti").select("table", F.lit("no_keys").alias("issue"), F.lit("").alias("told"))
    shared = keys.groupBy("table", "key_pos").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("column")).alias("c")).filter("n > 1")
    issues = none.union(shared.select("table", F.lit("repeated_position"), F.concat(F.col("key_pos").cast("string"), F.lit(": "), F.array_join("c", ","))))
    if columns is None:
        return issues
    absent = keys.join(columns.select("table", F.lower("column").alias("column")), ["table", "column"], "left_anti")
    return issues.union(absent.select("table", F.lit("absent_key"), "column"))


def discovered_keys(descriptors: DataFrame, table: str, columns: list[str]) -> list[str]:
    """One table's key columns in order; raises if they are none, ambiguous or not in the data."""
    own = descriptors.filter(F.col("table") == table)
    spark = descriptors.sparkSession
    issues = key_issues(own, spark.createDataFrame([(table, c) for c in columns], "table string, column string")).collect()  # one table's
    if issues or own.isEmpty():
        raise ValueError(f"keys of {table}: " + ("; ".join(f"{r.issue} {r.told}".strip() for r in issues) or "no descriptor"))
    return key_discovery(own).first()["keys"].split(",")
