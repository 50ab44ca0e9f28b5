"""Mixing sources to target weights by Poisson replication.

A document's copies follow a Poisson distribution whose mean is its source's repetition
rate (target share of the output over the source's size). The draw inverts the
distribution at a number hashed from seed and document, so it needs no state and a lost
task draws the same again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Means above this are drawn as a sum of independent parts, whose means add up.
PART = 8.0
TERMS = 64  # of the distribution; the rest is below 1e-30 for a mean of PART
#: Sources whose rates are broadcast; with more, the rates are joined by a shuffle.
BROADCAST_SOURCES = 10_000
HASH_RANGE = float(1 << 52)


def unit(*parts: Column) -> Column:
    """A number in [0, 1) from the md5 of the joined parts."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("double") / HASH_RANGE


def source_rates(docs: DataFrame, weights: dict[str, float] | None, size: Column, total: float | None) -> DataFrame:
    """(source, rate, parts): a source's mean number of copies. A source without a weight
    has weight 1 (all, if none are given); weights are shares among the sources present."""
    given = F.lit(None).cast("double")
    for name, weight in (weights or {}).items():
        given = F.when(F.col("source") == F.lit(name), F.lit(float(weight))).otherwise(given)
    sizes = docs.groupBy("source").agg(F.sum(size).cast("double").alias("size"))
    sizes = sizes.withColumn("weight", F.coalesce(given, F.lit(1.0)))
    all_ = sizes.agg(F.sum("size").alias("all_size"), F.sum("weight").alias("all_weight"))  # one row
    target = F.lit(float(total)) if total is not None else F.col("all_size")
    rate = F.when(F.col("size") > 0, target * F.col("weight") / F.col("all_weight") / F.col("size")).otherwise(0.0)
    rates = sizes.join(F.broadcast(all_)).select("source", rate.alias("rate"))
    return rates.withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / PART)).cast("int"))


def poisson(rate: Column, draw: Column) -> Column:
    """The least k whose cumulative probability exceeds ``draw``."""
    start = F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("c"), F.when(draw < F.exp(-rate), 0).otherwise(1).alias("k"))

    def step(acc: Column, i: Column) -> Column:
        p = acc["p"] * rate / i
        c = acc["c"] + p
        return F.struct(p.alias("p"), c.alias("c"), (acc["k"] + F.when(draw >= c, 1).otherwise(0)).alias("k"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, step, lambda acc: acc["k"])


def row_key(df: DataFrame, id_col: str, text_col: str) -> Column:
    """What a row draws by: its id, or, without one, the md5 of its text behind a sign that
    no id has, so that rows without an id are not all drawn and dealt as one."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")) if text_col in df.columns else F.lit("")
    return F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text:"), F.md5(text)))


def mix_sources(
    df: DataFrame,
    weights: dict[str, float] | None = None,
    total: float | None = None,
    seed: str = "mix-1",
    id_col: str = "doc_id",
    source_col: str = "source",
    size_col: Column | None = None,
    text_col: str = "text",
) -> DataFrame:
    """``df`` with each row repeated by its draw and shuffled over all partitions; three
    columns more: mix_rate, mix_copy (from 1) and mix_key, the md5 the order follows.
    Columns of ``df`` with these names give way to them, so an output can be mixed again;
    names beginning with ``__mix_`` are the operator's own.

    ``weights`` are target shares of the output by source, 1 where not given; ``total`` is
    the output's size (the input's by default) in units of ``size_col`` (rows by default).
    A null source is a source of its own, written '' for the draw; a null id draws by its
    text. Rows repeated under one id draw alike. A source of size or weight 0 gives no
    rows, nor does an empty table.
    """
    size = F.lit(1) if size_col is None else size_col
    docs = df.withColumns({
        "__mix_source": F.coalesce(F.col(source_col).cast("string"), F.lit("")),
        "__mix_id": row_key(df, id_col, text_col),
        "__mix_size": size,
    }).drop("mix_rate", "mix_copy", "mix_key")
    sizes = docs.select(F.col("__mix_source").alias("source"), "__mix_size")
    rates = source_rates(sizes, weights, F.col("__mix_size"), total)
    rates = rates.select(F.col("source").alias("__mix_of"), F.col("rate").alias("__mix_rate"), F.col("parts").alias("__mix_parts"))
    if rates.count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    key, seed = F.col("__mix_id"), F.lit(seed)
    rows = docs.join(rates, F.col("__mix_source") == F.col("__mix_of"))
    mean = F.col("__mix_rate") / F.col("__mix_parts")
    one = poisson(mean, unit(seed, key, F.lit("1")))
    parts = F.sequence(F.lit(1), F.col("__mix_parts"))
    sum_of_parts = F.aggregate(parts, F.lit(0), lambda acc, i: acc + poisson(mean, unit(seed, key, i.cast("string"))))
    rows = rows.withColumn("__mix_n", F.when(F.col("__mix_parts") == 1, one).otherwise(sum_of_parts)).filter("__mix_n > 0")
    rows = rows.withColumn("__mix_copy", F.explode(F.sequence(F.lit(1), F.col("__mix_n"))))
    rows = rows.withColumn("__mix_key", F.md5(F.concat_ws("|", seed, F.lit("order"), key, F.col("__mix_copy").cast("string"))))
    rows = rows.drop("__mix_source", "__mix_size", "__mix_id", "__mix_of", "__mix_parts", "__mix_n")
    rows = rows.repartition(F.col("__mix_key")).sortWithinPartitions("__mix_key")
    return rows.withColumnsRenamed({"__mix_rate": "mix_rate", "__mix_copy": "mix_copy", "__mix_key": "mix_key"})


MIX_WEIGHTS = {"src0": 2.0, "src1": 1.5, "src2": 0.5}

MIX_SQL = """
WITH sizes AS (
  SELECT coalesce(source, '') AS source, count(*)::DOUBLE AS size,
    CASE coalesce(source, '') WHEN 'src0' THEN 2.0::DOUBLE WHEN 'src1' THEN 1.5::DOUBLE WHEN 'src2' THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM documents GROUP BY 1, 3),
totals AS (SELECT sum(size) AS all_size, sum(weight) AS all_weight FROM sizes),
rates AS (
  SELECT source, all_size * weight / all_weight / size AS rate,
    greatest(1, ceil(all_size * weight / all_weight / size / 8.0))::INT AS parts
  FROM sizes, totals),
terms AS (
  SELECT source, i, exp(-rate / parts) * list_product(list_transform(range(1, i + 1), lambda j: rate / parts / j)) AS p
  FROM rates, range(0, 65) t(i)),
law AS (
  SELECT source, i, sum(coalesce(p, exp(0))) OVER (PARTITION BY source ORDER BY i) AS c
  FROM (SELECT t.source, i, CASE WHEN i = 0 THEN exp(-r.rate / r.parts) ELSE p END AS p FROM terms t JOIN rates r USING (source))),
draws AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, r.source AS s, r.rate, k.part,
    ('0x' || substr(md5('mix-1|' || coalesce(d.doc_id::VARCHAR, 'text:' || md5(coalesce(d.text, ''))) || '|' || k.part), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM documents d JOIN rates r ON coalesce(d.source, '') = r.source, LATERAL (SELECT unnest(range(1, r.parts + 1)) AS part) k),
counts AS (
  SELECT doc_id, text, lang, source, n_chars, rate, sum((SELECT count(*) FROM law WHERE law.source = draws.s AND law.c <= draws.u)) AS n
  FROM draws GROUP BY ALL)
SELECT doc_id, text, lang, source, n_chars, rate AS mix_rate, copy::INT AS mix_copy,
  md5('mix-1|order|' || coalesce(doc_id::VARCHAR, 'text:' || md5(coalesce(text, ''))) || '|' || copy) AS mix_key
FROM counts, LATERAL (SELECT unnest(range(1, n::BIGINT + 1)) AS copy) c
"""
