"""Running totals over an order of any size, by carry from range to range.

Rows are dealt to ranges of the order, each range is summed up, the sums of the ranges before
it are carried into each, and the rest is a window within a range. No task sees more than a
range of rows, or more sums than there are ranges.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions.scratch import saved

#: How a column is summed up over rows, and how two such sums become one (null: no rows).
KINDS = {
    "sum": (F.sum, lambda a, b: F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)),
    "max": (F.max, lambda a, b: F.greatest(a, b)),
    "last": (lambda c: F.last(c, ignorenulls=True), lambda a, b: F.coalesce(b, a)),
}


def running(rows: DataFrame, order: list[str], folds: dict[str, tuple[str, Column]], by: tuple[str, ...] = (), before: bool = False) -> DataFrame:
    """``rows`` with a column for each of ``folds`` (name: kind and column): its sum, maximum
    or last value that is not null over the rows of the same ``by`` from the first in
    ``order`` to this one, or to the one before it.

    Equal values of ``by`` and ``order`` are in one range: end the order with a key of the
    rows. There are at most spark.sql.shuffle.partitions ranges. Nulls in ``by`` are equal."""
    dealt = rows.repartitionByRange(*by, *order).withColumn("__range", F.spark_partition_id())
    dealt = saved(dealt.withColumns({f"__{n}": c for n, (_, c) in folds.items()}), "ranges")  # keeps the ranges that were drawn
    earlier = Window.unboundedPreceding
    within = Window.partitionBy(*by, "__range").orderBy(*order).rowsBetween(earlier, -1 if before else 0)
    here = dealt.withColumns({f"__{n}": KINDS[kind][0](F.col(f"__{n}")).over(within) for n, (kind, _) in folds.items()})
    # of "last", the range's value is that of its last row
    sums = dealt.groupBy(*by, "__range").agg(*(_whole(kind, f"__{n}", order).alias(f"__{n}") for n, (kind, _) in folds.items()))
    ranges = Window.partitionBy(*by).orderBy("__range").rowsBetween(earlier, -1)  # a row a range
    carried = sums.select(*(F.col(c).alias(f"__by_{c}") for c in by), F.col("__range").alias("__at"), *(KINDS[kind][0](F.col(f"__{n}")).over(ranges).alias(f"__carried_{n}") for n, (kind, _) in folds.items()))
    carried = carried.filter(reduce(lambda a, b: a | b, (F.col(f"__carried_{n}").isNotNull() for n in folds)))
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"__by_{c}")) for c in by), F.col("__range") == F.col("__at"))
    out = here.join(F.broadcast(carried), same, "left")  # a row a range: of one ``by`` or another, a range follows but once
    return out.select(*rows.columns, *(KINDS[kind][1](F.col(f"__carried_{n}"), F.col(f"__{n}")).alias(n) for n, (kind, _) in folds.items()))


def _whole(kind: str, column: str, order: list[str]) -> Column:
    if kind == "last":
        return F.max_by(column, F.when(F.col(column).isNotNull(), F.struct(*order)))
    return KINDS[kind][0](F.col(column))
