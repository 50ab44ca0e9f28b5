"""Connected components over an edge table, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quayside.llm.common import drop_scratch, hot_join, materialize


def _local_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the edges of one batch by an equivalent star forest (union-find)."""
    for batch in batches:
        a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        up = np.arange(len(nodes))
        ia, ib = at[: len(a)], at[len(a) :]
        while len(ia):  # hook the larger root below the smaller, then flatten
            ra, rb = up[ia], up[ib]
            open_ = ra != rb
            ia, ib, ra, rb = ia[open_], ib[open_], ra[open_], rb[open_]
            np.minimum.at(up, np.maximum(ra, rb), np.minimum(ra, rb))
            while not np.array_equal(flat := up[up], up):
                up = flat
        low = up != np.arange(len(nodes))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[low]), pa.array(nodes[up[low]])], names=["v", "u"])


def _least(edges: DataFrame) -> tuple[DataFrame, int, int]:
    """The least u and the rows of each v of ``edges(v, u)``; and, seen while that is written,
    the sum of rows and how many v are above their least u and have other rows."""
    seen = Observation()
    least = edges.groupBy("v").agg(F.min("u").alias("m"), F.count(F.lit(1)).alias("rows"))
    least = materialize(least.observe(seen, F.sum("rows").alias("rows"), F.count_if((F.col("m") < F.col("v")) & (F.col("rows") > 1)).alias("open")), "least")
    return least, seen.get.get("rows") or 0, seen.get.get("open") or 0


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges(a, b)``; a component is named by its
    smallest node. Loops and repeated edges are harmless; no edges give no rows.

    Every step is a grouped minimum (partially aggregated before its shuffle) joined back
    to the edges: a hub's edges stay where they are, see ``hot_join``. Nothing is gathered
    per component or on the driver. Edges that ``max_rounds`` do not settle raise.
    """
    star = materialize(
        edges.select(F.col("a").cast("long"), F.col("b").cast("long"))
        .filter("a <> b")
        .mapInArrow(_local_stars, "v long, u long")
        .distinct(),
        "stars",
    )
    for _ in range(max_rounds):
        both = star.select("v", "u").union(star.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least, rows, open_ = _least(both)
        if not open_:  # every node with a smaller neighbour has that one alone: stars
            drop_scratch(least)
            break
        reached = hot_join(both, least, ["v"], "rows", rows)
        large = reached.filter("u > v").select(F.col("u").alias("v"), F.least("m", "v").alias("u")).distinct()
        large = materialize(large, "large")
        down, rows, _ = _least(large)
        reached = hot_join(large, down, ["v"], "rows", rows)
        ends = F.array(F.struct("v", F.col("m").alias("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))
        small = reached.select(F.explode(ends).alias("e")).select("e.*").filter("v <> u").distinct()
        after = materialize(small, "stars")
        drop_scratch(star, least, large, down)
        star = after
    else:
        raise RuntimeError(f"components: not settled after {max_rounds} rounds")
    nodes = star.select(F.col("v").alias("node"), F.col("u").alias("component"))
    return nodes.union(star.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())
