"""Source divergence audit by in-mapper stripes.

Each task folds whole documents into stripes, one per language and term: how many documents
hold the term, and how often each source has it. A task whose stripes outgrow their budget
emits them and starts anew; stripes are then merged by key. The merged stripes of the kept
terms, a few thousand at a time, give the divergences: sums for pairs of sources, and each
source's best terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayside.llm import words
from quayside.llm.common import drop_scratch, hot_join, materialize

MIN_DOCUMENTS, TOP_TERMS, SCALE, SMOOTHING = 30, 50, 1_000_000_000, 5
#: Entries (term and source) that a task's stripes hold before they are emitted, and bytes
#: of documents counted together.
STRIPE_ENTRIES, FOLD_BYTES = 1_000_000, 8 << 20
#: Terms of a language that are compared together (its sources, if more: their pairs are then
#: no more than the stripes' entries), and differences held at a time.
BUCKET_TERMS, BLOCK = 128, 1 << 21
STRIPES = "lang string, term string, entries array<struct<source:string,df:long,n:long>>"
PARTIAL_NAMES = ["lang", "source", "part", "item", "value"]
PARTIALS = "lang string, source string, part string, item string, value long"
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True


def term_counts(texts: pa.Array, group: np.ndarray) -> pa.Table:
    """(group, term, df, n) of some documents, each of a numbered group: how many of the
    group's documents hold a term, and how often."""
    data, offsets = words.text_bytes(texts)
    inside = LETTER[data]
    starts, ends, first = words.runs(inside, offsets)
    cuts = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    letters = pa.py_buffer(words.lower_ascii(data[inside]))
    terms = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(cuts), letters]).dictionary_encode()
    size = max(1, len(terms.dictionary))
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    in_doc, occurs = np.unique(doc * size + terms.indices.to_numpy().astype(np.int64), return_counts=True)
    key, at = np.unique(group[in_doc // size] * size + in_doc % size, return_inverse=True)
    df, n = np.bincount(at, minlength=len(key)), np.bincount(at, occurs, minlength=len(key)).astype(np.int64)
    return pa.table({"group": key // size, "term": terms.dictionary.take(pa.array(key % size)), "df": df, "n": n})


def _emit(table: pa.Table, groups: dict[tuple[str, str], int]) -> Iterator[pa.RecordBatch]:
    """One stripe a language and term: sort the entries by key and cut where it changes."""
    if not table.num_rows:
        return
    langs, sources = pa.array([g[0] for g in groups], pa.string()), pa.array([g[1] for g in groups], pa.string())
    lang_codes = langs.dictionary_encode().indices.to_numpy()
    group, terms = table["group"].to_numpy(), table["term"].combine_chunks().dictionary_encode()
    codes = terms.indices.to_numpy()
    order = np.lexsort((codes, lang_codes[group]))
    group, codes = group[order], codes[order]
    key = lang_codes[group].astype(np.int64) * len(terms.dictionary) + codes
    heads = np.flatnonzero(np.diff(key, prepend=-1))
    entries = pa.StructArray.from_arrays([sources.take(pa.array(group)), *(table[c].combine_chunks().take(pa.array(order)) for c in ("df", "n"))], ["source", "df", "n"])
    lists = pa.ListArray.from_arrays(pa.array(np.append(heads, len(key)).astype(np.int32)), entries)
    names = terms.dictionary.take(pa.array(codes[heads])).cast(pa.large_string()).cast(pa.string())
    out = pa.RecordBatch.from_arrays([langs.take(pa.array(group[heads])), names, lists], names=["lang", "term", "entries"])
    for lo in range(0, out.num_rows, 16_384):
        yield out.slice(lo, 16_384)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches by ``FOLD_BYTES``: what is counted together needs no merge."""
    some: list[pa.RecordBatch] = []
    for batch in batches:
        some.append(batch)
        if sum(b.nbytes for b in some) >= FOLD_BYTES:
            yield pa.Table.from_batches(some)
            some = []
    if some:
        yield pa.Table.from_batches(some)


def fold_stripes(batches: Iterator[pa.RecordBatch], budget: int = STRIPE_ENTRIES) -> Iterator[pa.RecordBatch]:
    """The stripes of a task's documents (lang, source, text). Entries are hashed by key as
    documents come; beyond the ``budget`` what is held is emitted, so a key may come again."""
    groups: dict[tuple[str, str], int] = {}
    held: list[pa.Table] = []

    def combined() -> pa.Table:
        if len(held) == 1:
            return held[0]
        if not held:
            return pa.table({"group": pa.array([], pa.int64()), "term": pa.array([], pa.large_binary()), "df": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        total = pa.concat_tables(held).group_by(["group", "term"], use_threads=False).aggregate([("df", "sum"), ("n", "sum")])
        return total.rename_columns({"df_sum": "df", "n_sum": "n"})

    for some in _gathered(batches):
        keys = zip(some["lang"].to_pylist(), some["source"].to_pylist(), strict=True)
        group = np.array([groups.setdefault(k, len(groups)) for k in keys], np.int64)
        held.append(term_counts(some["text"].cast(pa.large_string()).combine_chunks(), group))
        if sum(t.num_rows for t in held) > budget:
            held = [combined()]
            if 2 * held[0].num_rows > budget:
                yield from _emit(held[0], groups)
                groups, held = {}, []
    yield from _emit(combined(), groups)


def shares(counts: np.ndarray, totals: np.ndarray, terms: int) -> np.ndarray:
    """1 + floor(SCALE * (count + SMOOTHING) / (total + SMOOTHING * terms)), exactly: three
    digits of the quotient at a time, for totals below 9 * 10**15."""
    divisor = totals + SMOOTHING * terms
    rest = counts + SMOOTHING
    out = np.zeros(np.broadcast_shapes(rest.shape, divisor.shape), np.int64)
    for _ in range(3):
        rest = rest * 1000
        digit = rest // divisor
        rest = rest - digit * divisor
        out = out * 1000 + digit
    return out + 1


def _divergences(top: int):
    def run(stripes: pa.Table, groups: pa.Table) -> pa.Table:
        """Of one language's bucket of terms: partial sums of pairs (a < b in order of the
        sources' rows), and each source's ``top`` terms here."""
        facts, found = groups.sort_by("source"), []
        lang, sources, totals = facts["lang"][0].as_py(), facts["source"].to_pylist(), facts["total"].to_numpy()
        n_terms, all_words = facts["n_terms"][0].as_py(), facts["lang_total"][0].as_py()
        at = {s: k for k, s in enumerate(sources)}
        names, rows, cols, values = [], [], [], []
        for term, entries in zip(stripes["term"].to_pylist(), stripes["entries"].to_pylist(), strict=True):
            for e in entries:
                rows.append(len(names))
                cols.append(at[e["source"]])
                values.append(e["n"])
            names.append(term.encode())
        size = len(sources)
        counts = np.zeros((len(names), size), np.int64)
        counts[rows, cols] = values
        p = shares(counts, totals[None, :], n_terms) if n_terms else np.zeros((0, size), np.int64)
        q = shares(counts.sum(1), np.array(all_words), n_terms) if n_terms else np.zeros(0, np.int64)

        def add(part: str, source: str, item: list, value: list) -> None:
            texts = [[lang] * len(item), [source] * len(item), [part] * len(item), item]
            found.append(pa.table([*(pa.array(t, pa.string()) for t in texts), pa.array(value, pa.int64())], names=PARTIAL_NAMES))

        for a in range(size):  # a row of the pairs' matrix at a time
            sums = np.zeros(size - a - 1, np.int64)
            step = max(1, BLOCK // size)
            for lo in range(0, len(names), step):
                sums += np.abs(p[lo : lo + step, a + 1 :] - p[lo : lo + step, a : a + 1]).sum(0)
            add("pair", sources[a], sources[a + 1 :], sums.tolist())
            over = np.flatnonzero((counts[:, a] > 0) & (p[:, a] > q))
            best = sorted(over.tolist(), key=lambda k: (q[k] - p[k, a], names[k]))[:top]
            add("term", sources[a], [names[k].decode() for k in best], [int(p[k, a] - q[k]) for k in best])
        return pa.concat_tables(found)

    return run


def source_divergence(
    df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_documents: int = MIN_DOCUMENTS, top_terms: int = TOP_TERMS
) -> DataFrame:
    """(lang, source, part, item, value, rank) for every language and source of ``df``.

    Terms are runs of letters and of characters from U+0080 on, A-Z in lower case; a
    language keeps those in at least ``min_documents`` of its rows. Shares of a source and
    of its language are smoothed over the kept terms and scaled to whole numbers. Part
    ``pair``: the sum of differences to each other source of the language, all ranks; 0 where
    no term is kept. Part ``term``: the kept terms that a source holds and uses more than the
    language does, by difference, the first ``top_terms``. Ties go to the smaller item.

    A null text, language or source counts as ''. A source of one language alone has no
    pairs; a language of empty texts has pairs of 0 and no terms. Repeated rows count each.
    An empty table gives no rows; other columns are ignored. A task holds the square of a
    language's sources: these may be thousands, not millions.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    docs = df.select(blank(lang_col).alias("lang"), blank(source_col).alias("source"), blank(text_col).alias("text"))
    stripes = docs.mapInArrow(fold_stripes, STRIPES).repartition("lang", "term")  # the merges below need no other shuffle
    merged = stripes.select("lang", "term", F.inline("entries")).groupBy("lang", "term", "source").agg(F.sum("df").alias("df"), F.sum("n").alias("n"))
    merged = merged.groupBy("lang", "term").agg(F.sum("df").alias("df"), F.collect_list(F.struct("source", "n")).alias("entries"))  # an entry a source
    kept = materialize(merged.filter(F.col("df") >= min_documents).drop("df"), "stripes")
    totals = kept.select("lang", F.inline("entries")).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    by_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("n_terms"), F.sum(F.aggregate("entries", F.lit(0).cast("long"), lambda s, e: s + e["n"])).alias("lang_total"))
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(by_lang, "lang", "left")
    groups = groups.select("lang", "source", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("total", "n_terms", "lang_total")))
    groups = materialize(groups, "groups")
    size = F.greatest(F.lit(BUCKET_TERMS), F.count(F.lit(1)))
    langs = groups.groupBy("lang").agg(F.greatest(F.lit(1), F.ceil(F.max("n_terms") / size)).alias("buckets"), F.max("n_terms").alias("rows"))
    langs = materialize(langs, "langs")
    left = hot_join(kept, langs, ["lang"], "rows").withColumn("bucket", F.pmod(F.xxhash64("term"), "buckets")).drop("buckets")
    right = groups.join(langs.drop("rows"), "lang").withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.col("buckets") - 1))).drop("buckets")
    partial = left.groupBy("lang", "bucket").cogroup(right.groupBy("lang", "bucket")).applyInArrow(_divergences(top_terms), PARTIALS)
    partial = materialize(partial, "divergences")
    sums = partial.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    both = F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))
    pairs = sums.select("lang", "part", F.inline(both), "value").select("lang", "source", "part", "item", "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    terms = partial.filter("part = 'term'").withColumn("rank", rank).filter(F.col("rank") <= top_terms)  # cut before the shuffle, too
    drop_scratch(kept, groups, langs)
    return pairs.withColumn("rank", rank).unionByName(terms)


DIVERGENCE_SQL = r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms, row_number() OVER () AS r FROM documents),
grp AS (SELECT DISTINCT lang, source FROM d),
words AS (SELECT lang, source, r, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term FROM words GROUP BY ALL HAVING count(DISTINCT r) >= 30),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
n AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
counts AS (SELECT g.lang, g.source, k.term, coalesce(n.n, 0) AS n FROM grp g JOIN kept k USING (lang) LEFT JOIN n USING (lang, source, term)),
p AS (SELECT lang, source, term, n, (1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v))::BIGINT AS p FROM counts JOIN v USING (lang)),
whole AS (SELECT lang, term, sum(n) AS n FROM counts GROUP BY ALL),
q AS (SELECT lang, term, (1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang) + 5 * v))::BIGINT AS q FROM whole JOIN v USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value FROM p a JOIN p b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM found)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
"""
