"""Removal of repeated passages by seed and extend.

Seeds are winnowed anchors: of every ``span`` consecutive ``SEED``-word grams the one of
least hash, so any repeated window of ``window`` words holds an anchor in both places.
Documents join on anchors. An anchor is extended both ways by up to window - SEED words
(clipped at the text's ends): occurrences with one extended context share all windows
around the anchor, and only the smallest document of each context goes on. Where one
anchor has several contexts, every extension of it that makes a whole window is grouped
with its equals: no pairs are formed, so a passage that many documents share in part
costs each of them its own windows. Matching windows merge to maximal repeats (start,
length), which are what is removed. A window answers to its own least gram, which its
words alone decide.

Equality is that of 64-bit seeds with 64-bit contexts, and of 128-bit windows. A text is
named by its id and a 64-bit hash, since one id may stand on several texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm import words
from quayside.llm.common import drop_scratch, hot_join, id_text, materialize

SEED = 20
TOP = np.uint64(2**64 - 1)
#: What an anchor's group says of the windows around one occurrence.
SHARED, OPEN, FIRST = 1, 2, 3


def _sliding(x: np.ndarray, n: int, op) -> np.ndarray:
    """op over x[i : i + n], by doubling."""
    have = 1
    while 2 * have <= n:
        x = op(x[:-have], x[have:]) if len(x) > have else x[:0]
        have *= 2
    if have < n:
        d = n - have
        x = op(x[:-d], x[d:]) if len(x) > d else x[:0]
    return x


class Texts:
    """A batch's words: hashes, bounds, and per text its first word."""

    def __init__(self, column: pa.Array) -> None:
        self.data, offsets = words.text_bytes(column)
        self.starts, self.ends, self.first = words.split(self.data, offsets)
        self.hashes = words.word_hashes(self.data, self.starts, self.ends)
        self.owner = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def least(self, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Every gram's hash, and for each gram the least one of the window it opens
        (one more than the hash; 0 where no whole window starts)."""
        seed = np.minimum(words.grams(self.hashes, SEED), TOP - np.uint64(1))
        span = window - SEED + 1
        if len(seed) < span:
            return seed, np.zeros(0, np.uint64)
        least = _sliding(seed, span, np.minimum)
        return seed, np.where(words.fits(self.first, window)[: len(least)], least + np.uint64(1), np.uint64(0))

    def anchors(self, window: int) -> np.ndarray:
        """Word positions (in the batch) of the anchors: least of some window's grams."""
        seed, least = self.least(window)
        if not len(least):
            return np.zeros(0, np.int64)
        pad = np.zeros(window - SEED, np.uint64)
        most = _sliding(np.concatenate([pad, least, pad]), window - SEED + 1, np.maximum)[: len(seed)]
        return np.flatnonzero(most == seed + np.uint64(1))

    def own_anchors(self, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of all whole windows, and each one's own (leftmost least) anchor."""
        seed, least = self.least(window)
        starts, anchors = np.flatnonzero(least), self.anchors(window)
        at = np.searchsorted(anchors, starts)
        while len(off := np.flatnonzero(seed[anchors[at]] + np.uint64(1) != least[starts])):
            at[off] += 1
        return starts, anchors[at]


def _seeds(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reach = window - SEED
        for batch in batches:
            t = Texts(batch.column(1))
            lo, hi = t.first[:-1], t.first[1:]
            at = t.anchors(window)
            own = t.owner[at]
            left, right = np.maximum(at - reach, lo[own]), np.minimum(at + SEED + reach, hi[own])
            seed = words.spans(t.hashes, at, at + SEED, words.GRAM_BASE_A)
            context = words.spans(t.hashes, left, right, words.GRAM_BASE_B) ^ words.mix((at - left).astype(np.uint64))
            cuts = pa.array(np.searchsorted(own, np.arange(batch.num_rows + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(cuts, pa.array(x)) for x in (words.signed(seed), words.signed(context), (at - lo[own]).astype(np.int32))]
            whole = [pa.array(words.signed(words.spans(t.hashes, lo, hi, base))) for base in (words.GRAM_BASE_A, words.GRAM_BASE_B)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(hi - lo), *whole, *lists], names=["doc_id", "t", "n", "wa", "wb", "seeds", "contexts", "places"])

    return run


def _windows(window: int):
    """Rows: a window's hashes and start (open ones), or its start with null hashes
    where it is already known to be shared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = Texts(batch.column(1))
            if not len(t.hashes):
                continue
            lo = t.first[:-1]
            state = np.zeros(len(t.hashes), np.int8)
            known, states = batch.column(3), batch.column(4)
            owner = np.repeat(np.arange(batch.num_rows), known.value_lengths().to_numpy())
            state[lo[owner] + known.flatten().to_numpy()] = states.flatten().to_numpy()
            at, anchor = t.own_anchors(window)
            done, todo = at[state[anchor] == SHARED], at[state[anchor] == OPEN]
            for at, hashed in ((done, False), (todo, True)):
                if len(at):
                    own = t.owner[at]
                    pair = [words.signed(words.spans(t.hashes, at, at + window, b)) for b in (words.GRAM_BASE_A, words.GRAM_BASE_B)] if hashed else [pa.nulls(len(at), pa.int64())] * 2
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x) if isinstance(x, np.ndarray) else x for x in pair] + [batch.column(c).take(pa.array(own)) for c in (0, 2)] + [pa.array((at - lo[own]).astype(np.int32))],
                        names=["wa", "wb", "doc_id", "t", "at"],
                    )

    return run


def _maximal(window: int):
    """Merge each text's shared windows that overlap or touch: (start, length) in words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts, starts, lengths = [0], [], []
            for k in range(batch.num_rows):
                at = np.unique(batch.column(2)[k].values.to_numpy())
                opens = np.flatnonzero(np.diff(at, prepend=at[0] - window - 1) > window)
                ends = np.append(at[opens[1:] - 1], at[-1]) + window
                starts.append(at[opens]), lengths.append(ends - at[opens])
                cuts.append(cuts[-1] + len(opens))
            lists = [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *x]), pa.int32())) for x in (starts, lengths)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], names=["doc_id", "t", "starts", "lengths"])

    return run


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = words.text_bytes(batch.column(1))
        raw, cuts = data.tobytes(), offsets.tolist()
        n, removed, sha, kept_text = [], [], [], []
        for k in range(batch.num_rows):
            own = raw[cuts[k] : cuts[k + 1]].split()
            n.append(len(own))
            gone = 0
            if batch.column(4)[k].as_py():
                gone, own = len(own), []
            elif (at := batch.column(2)[k]).is_valid:
                keep = np.ones(len(own), bool)
                for start, length in zip(at.as_py(), batch.column(3)[k].as_py(), strict=True):
                    keep[start : start + length] = False
                gone = int((~keep).sum())
                own = [w for w, k2 in zip(own, keep.tolist(), strict=True) if k2]
            removed.append(gone)
            kept = b" ".join(own)
            sha.append(hashlib.sha256(kept).hexdigest())
            kept_text.append(kept)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha), pa.array(kept_text, pa.binary()).cast(pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"],
        )


def maximal_repeats(docs: DataFrame, window: int = 50) -> tuple[DataFrame, DataFrame]:
    """Of docs(doc_id, text, t), where t is a hash of the text: (doc_id, t, starts,
    lengths), the maximal runs of words whose every ``window`` words also start in a
    document of smaller id; and (doc_id, t) of documents that repeat a smaller one's words
    as a whole, which the first table leaves out."""
    spec = "doc_id long, t long, n long, wa long, wb long, seeds array<long>, contexts array<long>, places array<int>"
    seeds = materialize(docs.filter("doc_id is not null").mapInArrow(_seeds(window), spec), "seeds")
    again = not seeds.groupBy("doc_id", "t").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()
    if again:  # rows repeated under one id are one document: its places are listed once
        every, seeds = seeds, materialize(seeds.dropDuplicates(["doc_id", "t"]), "seeds")
        drop_scratch(every)
    whole = seeds.filter(F.col("n") >= window).select("doc_id", "t", "n", "wa", "wb")
    firsts = whole.groupBy("n", "wa", "wb").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count(F.lit(1)).alias("rows"))
    firsts = materialize(firsts.filter("low < high").drop("high"), "firsts")
    copies = hot_join(whole, firsts, ["n", "wa", "wb"], "rows").filter("doc_id > low")
    copies = materialize(copies.select("doc_id", "t").distinct(), "copies")

    places = seeds.select("doc_id", "t", "seeds", "contexts", "places").join(copies, ["doc_id", "t"], "left_anti")
    places = places.select("doc_id", "t", F.explode(F.arrays_zip("seeds", "contexts", "places")).alias("s"))
    places = places.select(F.col("s.seeds").alias("seed"), F.col("s.contexts").alias("context"), "doc_id", "t", F.col("s.places").alias("place"))
    by_context = places.groupBy("seed", "context").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count(F.lit(1)).alias("rows"))
    by_seed = by_context.groupBy("seed").agg(F.min("low").alias("lo"), F.max("high").alias("hi"), F.count(F.lit(1)).alias("contexts"), F.sum("rows").alias("rows"))
    anchors = materialize(by_seed.filter("lo < hi").drop("lo", "hi"), "anchors")
    shared = materialize(hot_join(places, anchors, ["seed"], "rows"), "shared")
    contexts = materialize(shared.groupBy("seed", "context").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("rows")), "contexts")
    hits = hot_join(shared, contexts, ["seed", "context"], "rows")
    state = F.when(F.col("doc_id") > F.col("low"), SHARED).when(F.col("contexts") > 1, OPEN).otherwise(FIRST)
    hits = hits.select("doc_id", "t", "place", state.cast("byte").alias("state"))
    hits = hits.groupBy("doc_id", "t").agg(F.collect_list(F.struct("place", "state")).alias("h"), F.min("state").alias("least"))
    hits = materialize(hits.filter(F.col("least") < FIRST).select("doc_id", "t", "h.place", "h.state"), "hits")
    drop_scratch(seeds, firsts, anchors, shared, contexts)

    rows = docs.join(hits, ["doc_id", "t"]).select("doc_id", "text", "t", "place", "state")
    rows = rows.dropDuplicates(["doc_id", "t"]) if again else rows
    windows = materialize(rows.mapInArrow(_windows(window), "wa long, wb long, doc_id long, t long, at int"), "windows")
    open_ = windows.filter("wa is not null")
    lows = open_.groupBy("wa", "wb").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count(F.lit(1)).alias("rows"))
    lows = materialize(lows.filter("low < high").drop("high"), "lows")
    found = hot_join(open_, lows, ["wa", "wb"], "rows").filter("doc_id > low").select("doc_id", "t", "at")
    found = found.union(windows.filter("wa is null").select("doc_id", "t", "at")).groupBy("doc_id", "t").agg(F.collect_list("at").alias("at"))
    repeats = materialize(found.mapInArrow(_maximal(window), "doc_id long, t long, starts array<int>, lengths array<int>"), "repeats")
    drop_scratch(hits, windows, lows)
    return repeats, copies


def substring_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256, kept_text.

    A word goes if a run of ``window`` consecutive words that covers it also starts in a
    document with a smaller id; kept words are joined by one space. Words are
    ``[^\\x20\\x09-\\x0D]+``, unchanged. A null, empty or short text loses nothing. A null
    id neither loses words nor makes others lose any; rows repeated under one id, of one
    text or several, don't act on each other. An empty table gives no rows; other columns
    are ignored.
    """
    if window < SEED + 1:
        raise ValueError(f"window must be over {SEED} words")
    docs = id_text(df, id_col, text_col).withColumn("t", F.xxhash64("text"))
    repeats, copies = maximal_repeats(docs, window)
    rows = docs.join(repeats, ["doc_id", "t"], "left").join(copies.withColumn("copy", F.lit(True)), ["doc_id", "t"], "left")
    rows = rows.select("doc_id", "text", "starts", "lengths", F.coalesce("copy", F.lit(False)).alias("copy"))
    return rows.mapInArrow(_keep, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")
