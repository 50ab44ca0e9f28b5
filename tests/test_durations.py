"""Durations as text are rounded as C's printf, and Python's formatting, round them."""

from pyspark.sql import functions as F

from quayside.operators.quality import duration_text


def test_durations_round_by_their_binary_value(spark):
    rows = spark.range(0, 2_000_000, 180).withColumn("text", duration_text(F.col("id"))).filter("id >= 5400").collect()
    want = lambda s: f"{s / 3600:.1f}h" if s < 172800 else f"{s / 86400:.1f}d"
    assert [(r.id, r.text) for r in rows] == [(r.id, want(r.id)) for r in rows]
    odd = spark.createDataFrame([(None,), (-89,), (150,), (5399,), (-172799,)], "id long").select(duration_text(F.col("id"))).collect()
    assert [r[0] for r in odd] == ["?", "89s", "2m", "90m", "48.0h"]
