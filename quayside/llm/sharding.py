"""Sharding by jump consistent hashing: no ring table, and one more shard takes only its own share."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import ship
from quayside.operators.carry import running

#: Of rows that are alike, those that are written out together.
COPIES_PER_TASK = 200_000


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Each uint64 key's shard in 0..shards-1: jumps of a pseudo-random walk (Lamping and
    Veach) until the next one would leave the range, for all keys at once."""
    keys = keys.astype(np.uint64, copy=True)
    out = np.zeros(len(keys), np.int64)
    open_ = np.arange(len(keys))
    while len(open_):
        k = keys[open_] * np.uint64(2862933555777941757) + np.uint64(1)
        keys[open_] = k
        step = (out[open_] + 1) * (float(1 << 31) / ((k >> np.uint64(33)).astype(np.float64) + 1))
        inside = step < shards
        open_, step = open_[inside], step[inside]
        out[open_] = step.astype(np.int64)
    return out.astype(np.int32)


def jump_shard(key: Column, shards: int) -> Column:
    """Shard of a stable long key."""

    ship(SparkSession.active())

    @F.pandas_udf("int")
    def apply(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(np.int64).view(np.uint64), shards))

    return apply(key)


def stable_key(id_: Column) -> Column:
    """A long from 0 to 2**60 - 1 from the md5 of an id; of a null one, of no characters.
    md5 is in every engine, so a shard can be found without this library."""
    return F.conv(F.substring(F.md5(F.coalesce(id_.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def shard_documents(df: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The law is ``key``: doc_id and the shard count alone decide (null ids are one key), so
    equal texts under different ids go where their ids go. size is UTF-8 bytes plus 1 and
    text_crc32 that of the bytes; a null text has none (1 and 0). slot numbers a shard's
    rows without gaps from 0, by key, id, checksum and size, at any size of the table by
    running sums from range to range. Rows alike in all of these are counted before they are
    dealt, and each get a slot. An empty table gives no rows; other columns are ignored.
    """
    raw = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    order = ["key", "doc_id", "text_crc32", "size"]
    rows = df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        stable_key(F.col(id_col).cast("long")).alias("key"),
    )
    alike = rows.groupBy(*order).agg(F.count(F.lit(1)).alias("copies"))
    alike = alike.select("*", jump_shard(F.col("key"), shards).alias("shard"), jump_shard(F.col("key"), shards + 1).alias("grown_shard"))
    summed = running(alike, order, {"upto": ("sum", F.col("copies"))}, by=("shard",))
    # many copies are written out by several tasks
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPIES_PER_TASK))).alias("chunk")
    low = F.col("upto") - F.col("copies") + F.col("chunk") * COPIES_PER_TASK
    spread = summed.select("*", chunk).repartition("key", "text_crc32", "chunk")
    slots = F.explode(F.sequence(low, F.least(low + COPIES_PER_TASK, F.col("upto")) - 1)).alias("slot")
    return spread.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", slots, "grown_shard")


#: The jump by recursion, the checksum byte by byte.
SHARD_SQL = """
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY b) AS crc FROM (
    SELECT b, list_reduce(range(0, 8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) AS c FROM range(0, 256) t(b))),
docs AS (
  SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS raw,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS key FROM documents),
bytes AS (SELECT r, list_transform(regexp_extract_all(hex(raw), '..'), lambda x: ('0x' || x)::BIGINT) AS b FROM docs),
crcs AS (
  SELECT r, len(b) + 1 AS size, xor(list_reduce(b, lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS text_crc32
  FROM bytes, crc_table),
walk AS (
  SELECT r, n, key::UHUGEINT AS k, -1::BIGINT AS b, 0::BIGINT AS j FROM docs, (VALUES (16), (17)) s(n)
  UNION ALL
  SELECT r, n, k2, j, floor((j + 1) * (2147483648.0::DOUBLE / ((k2 // 8589934592)::DOUBLE + 1)))::BIGINT
  FROM (SELECT *, (k * 2862933555777941757 + 1) % 18446744073709551616 AS k2 FROM walk WHERE j < n) w),
shards AS (SELECT r, CAST(max(b) FILTER (WHERE n = 16) AS INT) AS shard, CAST(max(b) FILTER (WHERE n = 17) AS INT) AS grown_shard FROM walk GROUP BY r)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY key, doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard
FROM docs JOIN crcs USING (r) JOIN shards USING (r)
"""
