"""Near-duplicate groups by an LSH forest over MinHash signatures.

Every tree sorts the signatures in an order of its own (rotated by ``FIRST`` hashes) and
pairs each document with its neighbours in that order, those of longest common prefix:
a sparse region is compared at the shallow least depth, a crowded one at whatever depth
parts it. Candidates that a short sketch doesn't rule out are confirmed on full sets.
Where more share a region than a document has neighbours, an exact join on rare shingles
takes up the rest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quayside.llm import words
from quayside.llm.common import drop_scratch, hot_join, id_text, materialize, scratch_scope
from quayside.llm.graph import components

FIRST, TREES = 3, 42  # least prefix depth, and trees: together they use each hash once
HASHES = FIRST * TREES
LEVELS = (4, 5, 6, 7, 9, 12, 16, 24)  # deeper prefixes that order a region, 16 bits each
REACH = 4  # neighbours each way in every tree
_RNG = np.random.default_rng(77003)
MUL = _RNG.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
XOR = _RNG.integers(0, 2**64, HASHES, dtype=np.uint64)
#: A pair of similarity 0.8 agrees in 101 of 126 hashes on average, with deviation 4.5.
LEAST_AGREEING = 68
BITS = 4  # longs of 64 bits that sum up a set of the prefix filter


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingle hashes, sorted, with n+1 offsets."""
    data, offsets = words.text_bytes(column)
    data = words.lower_ascii(data)
    starts, ends, first = words.split(data, offsets)
    hashes = words.word_hashes(data, starts, ends)
    counts = np.diff(first)
    whole = words.grams(hashes, size)
    at = np.flatnonzero(words.fits(first, size)[: len(whole)])
    owner = np.repeat(np.arange(len(counts)), counts)[at]
    short = np.flatnonzero((counts > 0) & (counts < size))
    values = np.concatenate([whole[at], words.spans(hashes, first[short], first[short + 1], words.GRAM_BASE_A)])
    owner = np.concatenate([owner, short])
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[new], owner[new]
    return values, np.searchsorted(owner, np.arange(len(counts) + 1))


def signatures(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """uint32 minima, one row per text; texts without shingles get all ones."""
    out = np.full((len(offsets) - 1, HASHES), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(np.diff(offsets))
    lo = 0
    while lo < len(full):
        hi = max(lo + 1, int(np.searchsorted(offsets[full], offsets[full[lo]] + 32768)))
        hi = min(hi, len(full))
        own = full[lo:hi]
        part = values[offsets[own[0]] : offsets[own[-1] + 1]]
        cuts = offsets[own] - offsets[own[0]]
        for k in range(HASHES):
            out[own, k] = np.minimum.reduceat(((part ^ XOR[k]) * MUL[k] >> np.uint64(32)).astype(np.uint32), cuts)
        lo = hi
    return out


def _profile(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, offsets = shingle_sets(batch.column(1), size)
            sums = []
            for salt in (0x1234567, 0x89ABCDEF):
                total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words.mix(values + np.uint64(salt)), dtype=np.uint64)])
                sums.append(words.signed(total[offsets[1:]] - total[offsets[:-1]]))
            sig = signatures(values, offsets)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(offsets)), *map(pa.array, sums), pa.array([x.tobytes() for x in sig], pa.binary())],
                names=["doc_id", "n", "sa", "sb", "sig"],
            )

    return run


def _forest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document and tree: least prefix, deeper prefixes in two sortable longs."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sig = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint32).reshape(-1, HASHES)
        nibble = (sig.astype(np.uint64) * np.uint64(0x9E3779B1) >> np.uint64(20)).astype(np.uint8) & 15
        sketch = pa.array([x.tobytes() for x in (nibble[:, ::2] << 4 | nibble[:, 1::2])], pa.binary())
        for tree in range(TREES):
            turned = np.roll(sig, -FIRST * tree, axis=1)
            level, done, key = np.full(len(sig), tree + 1, np.uint64), 0, []
            for depth in (FIRST, *LEVELS):
                for k in range(done, depth):
                    level = words.mix(level * np.uint64(0x9E3779B97F4A7C15) + turned[:, k])
                done = depth
                key.append(level)
            bits = [k >> np.uint64(48) for k in key[1:]]
            deep = [words.signed(w << np.uint64(48) | x << np.uint64(32) | y << np.uint64(16) | z) for w, x, y, z in (bits[:4], bits[4:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(words.signed(key[0])), *map(pa.array, deep), batch.column(0), batch.column(1), sketch],
                names=["k1", "k2", "k3", "doc", "n", "sketch"],
            )


SCAN = "kind byte, g int, k1 long, k2 long, k3 long, doc long, n long, sketch binary, other long, agree int"


def _scan(least_num: int, least_den: int, edges: bool):
    """Pair neighbours in sorted rows (g, k1, k2, k3, doc, n, sketch), and tell documents
    whose window is full (kind 3): the outermost neighbour is still of their region. With
    ``edges``, also pass on the partition's first and last rows, whose neighbours lie in
    other tasks."""

    def pairs(rows: list[np.ndarray], fresh: int) -> Iterator[pa.RecordBatch]:
        g, k1, _, _, doc, n, sketch = rows
        left, right, agree = [], [], []
        i = np.arange(max(0, fresh - REACH), len(k1) - REACH)
        i = i[(k1[i] == k1[i + REACH]) & (g[i] == g[i + REACH])]
        yield batch(3, doc=np.unique(np.concatenate([doc[i], doc[i + REACH]])))
        for step in range(1, REACH + 1):
            i = np.arange(max(0, fresh - step), len(k1) - step)
            j = i + step
            ok = (k1[i] == k1[j]) & (g[i] == g[j]) & (doc[i] != doc[j])
            ok &= least_den * np.minimum(n[i], n[j]) >= least_num * np.maximum(n[i], n[j])
            i, j = i[ok & (j >= fresh)], j[ok & (j >= fresh)]
            x = sketch[i] ^ sketch[j]
            same = ((x & 0xF0) == 0).sum(1) + ((x & 0x0F) == 0).sum(1)
            ok = same >= LEAST_AGREEING
            left.append(doc[i[ok]]), right.append(doc[j[ok]]), agree.append(same[ok])
        a, b, agree = map(np.concatenate, (left, right, agree))
        yield batch(0, doc=np.minimum(a, b), other=np.maximum(a, b), agree=agree.astype(np.int32))

    def batch(kind: int, **cols) -> pa.RecordBatch:
        size = len(next(iter(cols.values())))
        types = {"kind": pa.int8(), "g": pa.int32(), "k1": pa.int64(), "k2": pa.int64(), "k3": pa.int64(), "doc": pa.int64(), "n": pa.int64(), "sketch": pa.binary(), "other": pa.int64(), "agree": pa.int32()}
        cols["kind"] = np.full(size, kind, np.int8)
        return pa.RecordBatch.from_arrays([pa.array(cols[k], t) if k in cols else pa.nulls(size, t) for k, t in types.items()], names=list(types))

    def edge(kind: int, seg: int, rows: list[np.ndarray]) -> pa.RecordBatch:
        return batch(kind, g=np.full(len(rows[1]), seg, np.int32), k1=rows[1], k2=rows[2], k3=rows[3], doc=rows[4], n=rows[5], sketch=[x.tobytes() for x in rows[6]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, carry, head = TaskContext.get().partitionId() if edges else 0, None, 0
        for b in batches:
            if not b.num_rows:
                continue
            rows = [b.column(k).to_numpy() for k in range(6)]
            rows.append(np.frombuffer(b"".join(b.column(6).to_pylist()), np.uint8).reshape(b.num_rows, -1))
            if edges and head < REACH:
                yield edge(1, part, [x[: REACH - head] for x in rows])
                head += b.num_rows
            fresh = 0
            if carry is not None:
                fresh = len(carry[1])
                rows = [np.concatenate([c, x]) for c, x in zip(carry, rows, strict=True)]
            yield from pairs(rows, fresh)
            carry = [x[-REACH:] for x in rows]
        if edges and carry is not None:
            yield edge(1, part + 1, carry)

    return run


def candidate_pairs(reps: DataFrame, threshold: tuple[int, int]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(a, b, agree) with a < b of documents that are neighbours in some tree, (doc_id) of
    those with a full window in some tree, and the scratch table that both are read from.
    Two documents of one region that are not neighbours both have a full window."""
    num, den = threshold
    rows = reps.select("doc_id", "n", "sig").mapInArrow(_forest_rows, "k1 long, k2 long, k3 long, doc long, n long, sketch binary")
    rows = rows.select(F.lit(0).alias("g"), "*")
    order = ["k1", "k2", "k3", "doc"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    found = materialize(ordered.mapInArrow(_scan(num, den, True), SCAN), "forest")
    # rows at partition ends: the last ones of one task meet the first ones of the next
    ends = found.filter("kind = 1").select("g", "k1", "k2", "k3", "doc", "n", "sketch")
    ends = ends.repartition("g").sortWithinPartitions("g", *order)
    more = ends.mapInArrow(_scan(num, den, False), SCAN)
    both = found.unionByName(more)
    pairs = both.filter("kind = 0").groupBy(F.col("doc").alias("a"), F.col("other").alias("b")).agg(F.max("agree").alias("agree"))
    return pairs, both.filter("kind = 3").select(F.col("doc").alias("doc_id")).distinct(), found


def _shingle_rows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, offsets = shingle_sets(batch.column(1), size)
            counts = np.diff(offsets)
            owner = np.repeat(np.arange(len(counts)), counts)
            doc, c, t = (batch.column(k).take(pa.array(owner)) for k in (0, 2, 3))
            yield pa.RecordBatch.from_arrays([doc, c, t, pa.array(counts[owner]), pa.array(words.signed(values))], names=["doc", "c", "t", "n", "h"])

    return run


def crowded_pairs(texts: DataFrame, size: int, threshold: tuple[int, int]) -> DataFrame:
    """(a, b) of all documents of ``texts`` (doc_id, text, c, t), where t is a hash of the
    text, that may link though their groups ``c`` differ: an exact prefix filter.

    Shingles are ordered: first those that one group alone holds, which no link between
    groups can rest on, then from rare to common. Texts of similarity num/den share one
    within the larger text's first n - num/den n + 1 and the smaller one's first
    n - 2 num/(num + den) n + 1; and of the first that they share, enough are left behind
    it in both for the overlap that the similarity needs. Sets meet in bands of their size,
    which at most num/den of a size spans, so a shingle's list is cut by size; what one set
    has of hash bits that the other lacks bounds their overlap before a pair is written. A
    list that is still long is dealt anew by Spark's handling of skewed merge joins."""
    num, den = threshold
    rows = materialize(texts.select("doc_id", "text", "c", "t").mapInArrow(_shingle_rows(size), "doc long, c long, t long, n long, h long"), "shingles")
    counts = rows.groupBy("h").agg(F.count(F.lit(1)).alias("rows"), F.min("c").alias("lo"), F.max("c").alias("hi"))
    counts = materialize(counts.select("h", "rows", F.when(F.col("lo") < F.col("hi"), F.col("rows")).otherwise(0).alias("common")), "counts")
    bit = F.expr("shiftleft(1L, CAST(h & 63 AS INT))")
    bits = [F.coalesce(F.bit_or(F.when(F.shiftrightunsigned("h", 62) == k, bit)), F.lit(0).cast("long")).alias(f"b{k}") for k in range(BITS)]
    ordered = hot_join(rows, counts, ["h"], "rows").groupBy("doc", "c", "t", "n").agg(F.array_sort(F.collect_list(F.struct("common", "h"))).alias("s"), *bits)
    band = lambda n: F.floor(F.log(n.cast("double")) / (math.log(den / num) or 1.0)).cast("int")
    ordered = ordered.withColumns({"band": band(F.col("n")), "low": band(F.expr(f"({num} * n + {den - 1}) DIV {den}"))})
    probe = F.expr(f"CAST(n - ({num} * n + {den - 1}) DIV {den} + 1 AS INT)")
    index = F.expr(f"CAST(n - ({2 * num} * n + {num + den - 1}) DIV {num + den} + 1 AS INT)")
    signs = [f"b{k}" for k in range(BITS)]
    first = ordered.withColumn("least", index).select("doc", "c", "n", "least", "band", "low", *signs, F.posexplode(F.slice("s", F.lit(1), probe)).alias("at", "x"))
    first = first.filter("x.common > 0").select("x.h", "band", "low", *signs, "doc", "c", "n", (F.col("n") - F.col("at")).alias("left"), (F.col("at") < F.col("least")).alias("listed"))
    first = materialize(first, "prefixes")
    bands = F.explode(F.sequence("low", "band")).alias("band")  # of sizes from num/den n to n
    x = first.select("h", bands, F.col("doc").alias("x"), F.col("c").alias("cx"), F.col("n").alias("nx"), F.col("left").alias("lx"), *(F.col(b).alias(f"x{b}") for b in signs))
    y = first.filter("listed").select("h", "band", F.col("doc").alias("y"), F.col("c").alias("cy"), F.col("n").alias("ny"), F.col("left").alias("ly"), *(F.col(b).alias(f"y{b}") for b in signs))
    on = (F.col("cx") != F.col("cy")) & (F.struct("ny", "y") < F.struct("nx", "x")) & (den * F.col("ny") >= num * F.col("nx"))
    on &= (num + den) * F.least("lx", "ly") >= num * (F.col("nx") + F.col("ny"))
    lacks = lambda a, b: reduce(lambda p, q: p + q, (F.bit_count(F.col(f"{a}{s}").bitwiseAND(F.bitwise_not(f"{b}{s}"))) for s in signs))
    on &= (num + den) * F.least(F.col("nx") - lacks("x", "y"), F.col("ny") - lacks("y", "x")) >= num * (F.col("nx") + F.col("ny"))
    both = x.join(y.hint("merge"), ["h", "band"]).filter(on)
    pairs = materialize(both.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "rest")
    drop_scratch(rows, counts, first)
    return pairs


def _confirm(size: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            va, oa = shingle_sets(batch.column(2), size)
            vb, ob = shingle_sets(batch.column(3), size)
            ok = []
            for k in range(batch.num_rows):
                x, y = va[oa[k] : oa[k + 1]], vb[ob[k] : ob[k + 1]]
                both = np.concatenate([x, y])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                ok.append(common > 0 and den * common >= num * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ok, pa.bool_())], names=["a", "b", "ok"])

    return run


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, threshold: tuple[int, int]) -> DataFrame:
    """Those pairs (a, b) whose full shingle sets reach the threshold."""
    a = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    # merge joins at every size: texts are dealt by id, never sent to all tasks
    both = pairs.select("a", "b").join(a.hint("merge"), "a").join(b.hint("merge"), "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(_confirm(size, *threshold), "a long, b long, ok boolean").filter("ok").select("a", "b")


def _one_id(sets: DataFrame, classes: DataFrame) -> DataFrame | None:
    """Links (a, b) between the classes of ids that have texts of different sets; None if
    there are no such ids."""
    several = sets.groupBy("doc_id").agg(F.min(F.struct("sa", "sb", "n")).alias("lo"), F.max(F.struct("sa", "sb", "n")).alias("hi"))
    seen = Observation()
    several = materialize(several.filter("lo <> hi").select("doc_id").observe(seen, F.count(F.lit(1)).alias("n")), "several")
    if not seen.get.get("n"):
        drop_scratch(several)
        return None
    mine = sets.select("doc_id", "sa", "sb", "n").join(several, "doc_id").join(classes.select("sa", "sb", "n", "rep"), ["sa", "sb", "n"])
    links = materialize(mine.filter("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b")).distinct(), "links")
    drop_scratch(several)
    return links


def _grouped(links: list[DataFrame]) -> DataFrame:
    """Components of all links, as a scratch table."""
    mine: list[str] = []
    with scratch_scope(links[0].sparkSession):
        groups = materialize(components(reduce(DataFrame.union, links)), "groups", mine)
    return groups


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_size: int = 5,
    threshold: tuple[int, int] = (80, 100),
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Texts are lower-cased (A-Z) and cut into words ``[^\\x20\\x09-\\x0D]+``; a document's
    set holds its distinct ``shingle_size``-word shingles, or all its words as one
    shingle if it has fewer. Documents link at intersection/union >= threshold;
    component_id is the smallest id reachable. Null, empty and blank texts have no
    shingles and link with nothing. A null id gets a null component and is kept. Rows
    repeated under one id are one document. An empty table gives no rows.

    Documents of equal sets collapse to one before the forest, so copies cost no pairs.
    Of the candidates, each document first confirms three (smallest id, best sketch,
    smallest hash); then all that still join different groups are confirmed. Documents
    with a full window in some tree are then compared by an exact prefix filter, so a
    crowd hides no link. Sets are taken for equal when their sizes and two 64-bit sums of
    mixed shingle hashes are (a chance below 1e-16 among 10**11 sets), and shingles when
    their 64-bit hashes are. Texts under one id are one document, linked to whatever one of
    them is; each row reports its own text's set size, and a blank one's component is its
    own id.
    """
    docs = id_text(df, id_col, text_col)
    profile = materialize(docs.mapInArrow(_profile(shingle_size), "doc_id long, n long, sa long, sb long, sig binary"), "profile")
    sets = profile.filter("n > 0 and doc_id is not null")
    classes = sets.groupBy("sa", "sb", "n").agg(F.min("doc_id").alias("rep"), F.min_by("sig", "doc_id").alias("sig"), F.count(F.lit(1)).alias("rows"))
    classes = materialize(classes, "classes")
    one_id = _one_id(sets, classes)
    links = [] if one_id is None else [one_id]
    pairs, full, forest = candidate_pairs(classes.select(F.col("rep").alias("doc_id"), "n", "sig"), threshold)
    pairs, full = materialize(pairs, "pairs"), materialize(full, "full")
    drop_scratch(forest)

    both = pairs.select("a", "b", "agree").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "agree"))
    chosen = both.groupBy("a").agg(
        F.min("b").alias("low"), F.max_by("b", F.struct("agree", "b")).alias("best"), F.min_by("b", F.xxhash64("b")).alias("some")
    )
    chosen = chosen.select("a", F.explode(F.array_distinct(F.array("low", "best", "some"))).alias("b"))
    chosen = materialize(chosen.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "chosen")
    needed = both.select(F.col("a").alias("doc_id")).distinct()
    texts = materialize(docs.join(needed.hint("merge"), "doc_id", "left_semi"), "texts")

    links.append(materialize(confirmed(chosen, texts, shingle_size, threshold), "links"))
    groups = _grouped(links)
    rest = pairs.join(chosen, ["a", "b"], "left_anti").select("a", "b")
    ga = groups.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    gb = groups.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    rest = rest.join(ga, "a", "left").join(gb, "b", "left")
    rest = materialize(rest.filter("coalesce(ca, a) <> coalesce(cb, b)").select("a", "b"), "rest")
    first = len(links)
    if not rest.isEmpty():
        links.append(materialize(confirmed(rest, texts, shingle_size, threshold), "links"))
    drop_scratch(texts, pairs, chosen, rest)
    if not full.isEmpty():
        crowd = docs.withColumn("t", F.xxhash64("text")).join(full.hint("merge"), "doc_id", "left_semi").dropDuplicates(["doc_id", "t"])
        crowd = crowd.join(groups.withColumnRenamed("node", "doc_id").hint("merge"), "doc_id", "left")
        crowd = materialize(crowd.select("doc_id", "text", F.coalesce("component", "doc_id").alias("c"), "t"), "crowd")
        rest = crowded_pairs(crowd, shingle_size, threshold)
        links.append(materialize(confirmed(rest, crowd.select("doc_id", "text"), shingle_size, threshold), "links"))
        drop_scratch(crowd, rest)

    if any(not new.isEmpty() for new in links[first:]):
        drop_scratch(groups)
        groups = _grouped(links)

    named = classes.select("sa", "sb", "rep", "rows").join(groups, F.col("rep") == F.col("node"), "left")
    named = materialize(named.select("sa", "sb", "rows", F.coalesce("component", "rep").alias("component_id")), "named")
    drop_scratch(classes, full, groups, *links)
    alone = F.col("doc_id").isNull() | (F.col("n") == 0)
    linked = hot_join(profile.filter(~alone).select("doc_id", "n", "sa", "sb"), named, ["sa", "sb"], "rows")
    out = linked.select("doc_id", "n", "component_id").union(profile.filter(alone).select("doc_id", "n", "doc_id"))
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``df`` with one document of each near-duplicate group; all columns as they were."""
    gone = near_duplicates(df, id_col, text_col, **options).filter("not kept").select(F.col("doc_id").alias("__llm_id")).distinct()
    return df.join(gone, F.col(id_col).cast("long") == F.col("__llm_id"), "left_anti")
