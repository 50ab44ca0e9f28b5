"""Approximate nearest neighbours: one hierarchical navigable small-world graph per shard.

A shard's graph is a row of flat arrays (ids, vectors, and per layer a fixed-width table
of neighbours). Queries travel in blocks to every shard and the shards' results merge.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import materialize

SHARD_ROWS = 16_384
LINKS = 16  # per node and upper layer; twice that in the base layer
CANDIDATES = 48
FAR = 16  # more candidates drawn at random, which tie separate clusters together
BEAM = 160
ENTRIES = 16  # nodes of an upper layer from which the next one starts
BLOCK, BLOCKS_PER_TASK = 256, 256  # queries searched side by side, and such blocks for one copy of a shard
INDEX = "shard int, dim int, ids binary, counts binary, vectors binary, sizes binary, links binary"


def clean_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v) with v as doubles; vectors null, empty, zero or holding null or
    non-finite components, and rows with a null id, take no part."""
    v = F.col(vector_col).cast("array<double>")
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("vec_id").isNotNull() & (F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0))


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.unique(column.value_lengths().to_numpy(zero_copy_only=False))
    if len(sizes) > 1:
        raise ValueError(f"vectors of different lengths: {sizes[:5].tolist()}")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _scaled(x: np.ndarray) -> np.ndarray:
    """Each row times a power of two, exactly: its largest entry is then between a half and
    one, so that squares neither overflow nor vanish."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])


def _unit(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return (x / np.sqrt((x * x).sum(1, keepdims=True))).astype(np.float32)


def layer_links(x: np.ndarray, width: int) -> np.ndarray:
    """Each node's neighbours in one layer: the nearest that are nearer to it than to any
    neighbour already taken, then others, with links back; ``width`` columns, -1 for none."""
    n, k = len(x), min(CANDIDATES, len(x) - 1)
    out = np.full((n, width), -1, np.int32)
    if k <= 0:
        return out
    keep = max(1, width // 2)
    sources, targets, sims = [], [], []
    for lo in range(0, n, 512):
        sim = x[lo : lo + 512] @ x.T
        rows = np.arange(len(sim))
        sim[rows, lo + rows] = -np.inf
        near = np.argpartition(-sim, k - 1, axis=1)[:, :k]
        near_sim = np.take_along_axis(sim, near, 1)
        if n > 4 * CANDIDATES:
            far = np.random.default_rng(lo).integers(0, n, (len(sim), FAR))
            near, near_sim = np.concatenate([near, far], 1), np.concatenate([near_sim, np.take_along_axis(sim, far, 1)], 1)
        order = np.argsort(-near_sim, axis=1, kind="stable")
        near, near_sim = np.take_along_axis(near, order, 1), np.take_along_axis(near_sim, order, 1)
        among = np.einsum("rkd,rjd->rkj", x[near], x[near])
        taken = np.zeros(near.shape, bool)
        for j in range(near.shape[1]):
            closest = np.where(taken, among[:, j], -np.inf).max(1)
            taken[:, j] = np.isfinite(near_sim[:, j]) & (near_sim[:, j] > closest) & (taken.sum(1) < keep)
        # room left goes to the nearest of those passed over: tight groups need the links
        spare = np.isfinite(near_sim) & ~taken
        taken |= spare & (np.cumsum(spare, 1) <= keep - taken.sum(1, keepdims=True))
        r, c = np.nonzero(taken)
        sources.append(lo + r), targets.append(near[r, c]), sims.append(near_sim[r, c])
    s, t, w = map(np.concatenate, (sources, targets, sims))
    s, t, w = np.concatenate([s, t]), np.concatenate([t, s]), np.concatenate([w, w])
    order = np.lexsort((t, -w, s))
    s, t = s[order], t[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (t[1:] != t[:-1])
    s, t = s[new], t[new]
    place = np.arange(len(s)) - np.searchsorted(s, s)
    ok = place < width
    out[s[ok], place[ok]] = t[ok]
    return out


class Graph:
    """Nodes in falling order of level, so that each layer is a prefix of the arrays."""

    def __init__(self, ids, counts, vectors, sizes, links) -> None:
        self.ids, self.counts, self.vectors, self.sizes, self.links = ids, counts, vectors, sizes, links
        self.x = _unit(vectors)

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray, k: int) -> Graph:
        """Equal vectors are one node, which keeps its k + 1 smallest ids: no query can
        use more of them."""
        vectors = np.ascontiguousarray(vectors)
        order = np.lexsort((ids, *vectors.T[::-1]))
        ids, vectors = ids[order], vectors[order]
        new = np.ones(len(ids), bool)
        new[1:] = (vectors[1:] != vectors[:-1]).any(1)
        firsts = np.append(np.flatnonzero(new), len(ids))
        node_ids = np.full((len(firsts) - 1, k + 1), -1, np.int64)
        counts = np.minimum(np.diff(firsts), k + 1).astype(np.int32)
        for j in range(k + 1):
            has = counts > j
            node_ids[has, j] = ids[firsts[:-1][has] + j]
        vectors = vectors[firsts[:-1]]
        level = np.floor(-np.log(np.random.default_rng(11).random(len(vectors))) / math.log(LINKS)).astype(int)
        order = np.argsort(-level, kind="stable")
        level, node_ids, counts, vectors = level[order], node_ids[order], counts[order], vectors[order]
        sizes = [int((level >= top).sum()) for top in range(level.max() + 1)]
        x = _unit(vectors)
        links = [layer_links(x[:size], LINKS * (2 if top == 0 else 1)) for top, size in enumerate(sizes)]
        return cls(node_ids, counts, vectors, sizes, links)

    def _walk(self, q: np.ndarray, start: np.ndarray, top: int, beam: int) -> np.ndarray:
        """Best-first search in one layer for all queries at once, from ``start`` nodes;
        the ``beam`` nearest, filled up with the layer's size."""
        links, n, rows = self.links[top], self.sizes[top], np.arange(len(q))[:, None]
        seen = np.zeros((len(q), n + 1), bool)
        seen[:, n] = True
        node = np.full((len(q), beam), n, np.int64)
        sim = np.full((len(q), beam), -np.inf, np.float32)
        done = np.ones((len(q), beam), bool)
        k, real = start.shape[1], start < n
        node[:, :k], done[:, :k] = start, ~real
        sim[:, :k] = np.where(real, np.einsum("qd,qkd->qk", q, self.x[np.minimum(start, n - 1)]), -np.inf)
        seen[rows, start] = True
        while True:
            live = np.flatnonzero(~done.all(1))
            if not len(live):
                return node
            at = np.where(done[live], -np.inf, sim[live]).argmax(1)
            done[live, at] = True
            near = links[node[live, at]].astype(np.int64)
            near[near < 0] = n
            fresh = ~seen[live[:, None], near]
            seen[live[:, None], near] = True
            near_sim = np.einsum("qd,qkd->qk", q[live], self.x[np.minimum(near, n - 1)])
            near_sim[~fresh] = -np.inf
            all_sim = np.concatenate([sim[live], near_sim], 1)
            best = np.argpartition(-all_sim, beam - 1, axis=1)[:, :beam]
            node[live] = np.take_along_axis(np.concatenate([node[live], near], 1), best, 1)
            sim[live] = np.take_along_axis(all_sim, best, 1)
            done[live] = np.take_along_axis(np.concatenate([done[live], ~fresh], 1), best, 1) | ~np.isfinite(sim[live])

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query id, vec id, cosine) of each query's k nearest found, its own id apart."""
        q, n = _unit(queries), len(self.x)
        if n <= 2 * beam:
            found = np.broadcast_to(np.arange(n), (len(q), n))
        else:
            at = np.zeros((len(q), 1), np.int64)
            for top in range(len(self.sizes) - 1, 0, -1):
                at = self._walk(q, at, top, ENTRIES)
                at = np.where(at < self.sizes[top], at, n)
                at = at if (at < n).all() or top == 1 else np.where(at < n, at, self.sizes[top - 1])
            found = self._walk(q, at, 0, beam)
            short = np.flatnonzero((found < n).sum(1) <= k)  # a graph in pieces: look at all
            if len(short):
                found = found.copy()
                found[short] = np.argpartition(-(q[short] @ self.x.T), beam - 1, axis=1)[:, :beam]
        row = np.repeat(np.arange(len(q)), found.shape[1])
        node = found.ravel()
        row, node = row[node < n], node[node < n]
        a, b = _scaled(queries)[row], _scaled(self.vectors)[node]
        score = (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))
        counts = self.counts[node]
        pick = np.repeat(np.arange(len(node)), counts)
        ids = self.ids[node[pick], np.arange(len(pick)) - np.repeat(np.cumsum(counts) - counts, counts)]
        row, score = row[pick], score[pick]
        other = ids != query_ids[row]
        row, ids, score = row[other], ids[other], score[other]
        order = np.lexsort((ids, -score, row))
        row, ids, score = row[order], ids[order], score[order]
        ok = np.arange(len(row)) - np.searchsorted(row, row) < k
        return query_ids[row[ok]], ids[ok], score[ok]


def build_index(vectors: DataFrame, k: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard of vectors(vec_id, v): its graph as flat arrays."""
    shards = max(1, math.ceil(vectors.count() / shard_rows))

    def build(key: tuple, table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        g = Graph.build(table["vec_id"].to_numpy(), _matrix(table["v"]), k)
        row = {"shard": [key[0].as_py()], "dim": [g.vectors.shape[1]], "ids": [g.ids.tobytes()], "counts": [g.counts.tobytes()], "vectors": [g.vectors.tobytes()], "sizes": [np.array(g.sizes, np.int64).tobytes()], "links": [b"".join(x.tobytes() for x in g.links)]}
        return pa.table(row, schema=pa.schema([("shard", pa.int32()), ("dim", pa.int32()), *((c, pa.binary()) for c in ("ids", "counts", "vectors", "sizes", "links"))]))

    rows = vectors.select(F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"), "vec_id", "v")
    return rows.groupBy("shard").applyInArrow(build, INDEX)


def _load(row: dict, k: int) -> Graph:
    ids = np.frombuffer(row["ids"], np.int64).reshape(-1, k + 1)
    sizes = np.frombuffer(row["sizes"], np.int64).tolist()
    flat, links, at = np.frombuffer(row["links"], np.int32), [], 0
    for top, size in enumerate(sizes):
        width = LINKS * (2 if top == 0 else 1)
        links.append(flat[at : at + size * width].reshape(size, width))
        at += size * width
    return Graph(ids, np.frombuffer(row["counts"], np.int32), np.frombuffer(row["vectors"], np.float64).reshape(len(ids), row["dim"]), sizes, links)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, BLOCK):
            part = batch.slice(lo, BLOCK)
            ids, v = part.column(0).to_numpy(), _matrix(part.column(1))
            yield pa.RecordBatch.from_arrays([pa.array([v.shape[1]], pa.int32()), pa.array([ids.tobytes()]), pa.array([v.tobytes()])], names=["dim", "ids", "vectors"])


def search_index(index: DataFrame, queries: DataFrame, k: int, beam: int = BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score) over all shards of ``index``. A shard, or a copy of
    it, and the query blocks sent to it meet in one task, the shard first; blocks stream
    past it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, graph = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                if row["links"] is not None:
                    shard, graph = row["shard"], _load(row, k)
                elif graph is not None and shard == row["shard"]:
                    ids = np.frombuffer(row["ids"], np.int64)
                    q = np.frombuffer(row["vectors"], np.float64).reshape(len(ids), -1)
                    if q.shape[1] != graph.vectors.shape[1]:
                        raise ValueError(f"a query has {q.shape[1]} components, the index {graph.vectors.shape[1]}")
                    out = graph.search(ids, q, k, beam)
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["query_id", "vec_id", "score"])

    # a shard asked by many blocks is copied, and each copy takes its share of them
    copies = max(1, math.ceil(queries.count() / BLOCK / BLOCKS_PER_TASK))
    blocks = queries.select("vec_id", "v").mapInArrow(_blocks, "dim int, ids binary, vectors binary")
    last = index.select("shard").agg(F.max("shard")).first()[0]
    every = F.sequence(F.lit(0), F.lit(0 if last is None else last))
    sent = blocks.withColumn("copy", F.pmod(F.xxhash64("ids"), F.lit(copies)).cast("int")).select("*", F.explode(every).alias("shard"), F.lit(1).alias("kind"))
    held = index.select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy"), F.lit(0).alias("kind"))
    met = held.unionByName(sent, allowMissingColumns=True).repartition("shard", "copy").sortWithinPartitions("shard", "copy", "kind").drop("kind", "copy")
    near = met.mapInArrow(run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest_neighbours(
    df: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 50, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """The k nearest found, by cosine in double precision, of each row whose id is
    divisible by ``every`` among all other rows: query_id, rank, vec_id, score.

    Nearest first, ties to the smaller id. Vectors null, empty, zero or holding null or
    non-finite components, and null ids, neither ask nor answer. Equal vectors tie. Of
    several vectors under one id the smallest, component by component, stands for it, so a
    repeated row is one candidate and never answers its own query. Vectors of different
    lengths raise. Fewer than k candidates: all; none: no rows. Other columns are ignored.
    A shard of at most 2 * BEAM nodes is read whole: the beam would visit nearly all.
    """
    vectors = clean_vectors(df, id_col, vector_col).groupBy("vec_id").agg(F.min("v").alias("v"))
    vectors = materialize(vectors, "vectors")
    index = materialize(build_index(vectors, k, shard_rows), "hnsw")
    return search_index(index, vectors.filter(F.pmod("vec_id", F.lit(every)) == 0), k)
