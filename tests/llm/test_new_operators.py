"""Main text, whitening and divergence against brute force, odd rows included."""

import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import divergence, htmltext, whitening
from quayside.llm.common import documents, prepare

# ---- main text

S = "The quick brown fox jumps over the lazy dog, and then it goes home to sleep until the next day comes around again."
PAGES = {
    "landmarks": (
        f"<html><body><header><a href=/>Site</a><p>Best site</p></header><main><h1>T &eacute; &#x41;</h1><p>{S}</p><p>Short.</p></main><aside><p>{S}</p></aside><footer>c</footer></body></html>",
        f"T é A\n{S}\nShort.",
    ),
    "named places": (
        f"<div id=cookie-banner><p>We use cookies. {S}</p></div><div class='content'><h2>Hi</h2><p>{S}<p>{S}</div><div id='comments'><h3>2 comments</h3><div class=comment><p>{S}</p></div></div>",
        f"Hi\n{S}\n{S}",
    ),
    "parts of an article": (
        f"<article><header><h1>A</h1></header><p>one<br>two</p><form><input><label>Name</label></form><ul><li>x<li>y</ul><section class='comments'><article><p>{S}</p></article></section></article>",
        "A\none two\nx\ny",
    ),
    "short": ("<article><p>last</p></article>", "last"),
    "cut off": ("<nav>a</nav><article><h1>B</h1><p>last one", "B\nlast one"),
    "no places": (f"<h1>Heading here</h1><p>{S}</p><p>{S}</p><script>if(a<b){{x='<p>no</p>'}}</script><p>{S}", f"Heading here\n{S}\n{S}\n{S}"),
    "references": ("<article><!-- <p>no</p> --><p>a &lt; b &amp;amp; c&nbsp;d</p><style>p{}</style><p><b>bold</b>er\n\t text</p></article>", "a < b &amp; c d\nbolder text"),
    "adverts within": (
        f"<div class='post-list with-sidebar'><article class='post'><h1>Q</h1><div class='article-body'><p>{S}</p><div class='ad-slot'>Buy now</div><p>tail</p></div></article></div><div class='sidebar'><p>{S}</p></div>",
        f"Q\n{S}\ntail",
    ),
    "notices": (
        f"<div class='notice'>Maintenance. {S}</div><article><h1>R</h1><p>{S}</p><div class='share'><a href=x>Tweet</a></div><p>end</p></article><div class='newsletter'><form>{S}</form></div>",
        f"R\n{S}\nend",
    ),
    "cells": (f"<table><tr><td class=menu><a href=1>Home</a><td><h1>Old</h1><p>{S}</p><p>{S}</p></table>", f"Old\n{S}\n{S}"),
    "links": (
        f"<nav><a href=1>x</a></nav><article><h1>Two words</h1><p>See <a href=2>this page</a> and <a href=3>that one</a> for more of it.</p><p><a href=4>One link</a></p><p>{S}</p><aside>Read <a href=5>more</a> of us here today</aside><div class='related-posts'>Also <a href=6>old posts</a> here</div></article>",
        f"Two words\nSee this page and that one for more of it.\nOne link\n{S}",
    ),
    "hidden": (f"<main><p>{S}</p><div style='display: none'>{S}</div><p hidden>{S}</p><p>b</p></main>", f"{S}\nb"),
    "nothing": ("", ""),
    "no text": ("<p", ""),
    "a comment": ("<!-- x", ""),
}
HOSTILE = ("<a " * 200_000, "<a \"'" * 100_000 + ">", "<!--" * 200_000, "</script" * 100_000, "<div>" * 50_000, "<li>" * 50_000, "&" * 300_000, "<p title='" * 100_000, "<" * 300_000, "<div>" * 20_000 + "</section>" * 20_000)


@pytest.mark.parametrize("name", PAGES)
def test_main_text(name):
    page, want = PAGES[name]
    assert htmltext.main_text(page, htmltext.article_tree()) == want


def test_the_tree_fits_its_table_and_whole_pages_left_out():
    x, y = htmltext.labelled_blocks()
    assert ((htmltext.predict(htmltext.article_tree(), x) >= 0.5) == (y == 1)).mean() > 0.99
    right = total = 0
    for k in range(len(htmltext.LABELLED)):  # each page by a tree grown on the others
        rest = htmltext.LABELLED[:k] + htmltext.LABELLED[k + 1 :]
        own_x, own_y = htmltext.labelled_blocks(htmltext.LABELLED[k : k + 1])
        found = htmltext.predict(htmltext.grow(*htmltext.labelled_blocks(rest)), own_x) >= 0.5
        right, total = right + int((found == (own_y == 1)).sum()), total + len(own_y)
    assert right / total > 0.85


@pytest.mark.parametrize("k", range(len(HOSTILE)))
def test_hostile_pages_take_linear_time(k):
    began = time.monotonic()
    htmltext.main_text(HOSTILE[k], htmltext.article_tree())
    assert time.monotonic() - began < 5


def test_pages_as_rows(spark, sf):
    prepare(spark)
    rows = [(1, "u", PAGES["short"][0]), (1, "u", PAGES["short"][0]), (2, None, None), (None, "v", ""), (3, "w", "<article>" + f"<p>{S}</p>" * 80_000 + "</article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x")).withColumn("n_chars", F.lit(0))
    got = sorted(((r.page_id or 0, r.url, r.text, r.n_chars) for r in htmltext.extract_text(df).collect()), key=str)
    long = "\n".join([S] * 80_000)
    assert got == sorted([(1, "u", "last", 4), (1, "u", "last", 4), (2, None, "", 0), (0, "v", "", 0), (3, "w", long, len(long))], key=str)
    assert htmltext.extract_text(df.limit(0)).collect() == []


# ---- whitening


def plain_whitening(rows, top=16):
    """{id: (deviation, whitened)} by an eigendecomposition; variances and their shares."""
    x = np.array([np.floor(64 * np.array(v, np.float64)) for _, v in rows]).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    y = (n * fit - sums) / n
    cov = y.T @ y / n
    e, basis = np.linalg.eigh(cov)
    order = np.argsort(-e)[:top]
    order = order[e[order] > 1e-9 * e.max()]
    w = ((n * x - sums) / n) @ basis[:, order] / np.sqrt(e[order])
    return n, ((n * x - sums) ** 2).sum(1), w, e[order], e[order] / np.trace(cov)


def check_whitening(spark, rows, unique=True):
    prepare(spark)
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)).orderBy("vec_id", "component").collect()
    n, deviation, w, e, explained = plain_whitening(rows)
    c = len(e)
    assert len(got) == len(rows) * c and {r.n for r in got} == {n} and max(r.identity_error for r in got) < 1e-8
    own = np.array([r.whitened for r in got]).reshape(len(rows), c)
    order = np.argsort([i for i, _ in rows], kind="stable")
    assert [r.deviation for r in got[::c]] == deviation[order].tolist()
    assert np.allclose([r.explained for r in got[:c]], explained, rtol=1e-9)
    if unique:
        assert np.allclose(np.abs(own), np.abs(w[order]), atol=1e-8) and np.allclose((own * w[order]).sum(0) ** 2, (own**2).sum(0) * (w[order] ** 2).sum(0))
    else:  # components of equal variance: only the space they span is one
        assert np.allclose(own @ own.T, w[order] @ w[order].T, atol=1e-6)


def test_whitening(spark, sf):
    rows = [(r.vec_id, [float(v) for v in r.embedding]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check_whitening(spark, rows)
    again = rows + [(1000 + k, v) for k, (_, v) in enumerate(rows[:7])]  # repeated vectors count once
    check_whitening(spark, again)


def test_whitening_of_few_vectors_and_flat_dimensions(spark):
    rng = np.random.default_rng(2)
    rows = [(k, [*rng.standard_normal(4).round(2).tolist(), 0.5, 0.5]) for k in range(5)]
    check_whitening(spark, rows)
    check_whitening(spark, [(k, [float(k), 2.0 * k]) for k in range(9)])  # one direction


def test_whitening_of_equal_variances(spark):
    rows = [(2 * k + s, [(1.0 if s else -1.0) * (j == k) for j in range(6)]) for k in range(6) for s in (0, 1)]
    check_whitening(spark, rows, unique=False)


def test_whitening_on_odd_rows(spark):
    prepare(spark)
    nan, inf = float("nan"), float("inf")
    good = [(k, [float(k), float(k * k % 7)]) for k in range(6)]
    odd = [(50, None), (51, [nan, 1.0]), (52, [1.0, inf]), (53, [1.0, None]), (54, []), (55, [1.0]), (56, [1e300, 0.0]), (None, [2.5, 1.0])]
    df = spark.createDataFrame(good + odd, "vec_id long, embedding array<double>")
    got = whitening.whiten(df.withColumn("x", F.lit(1)).withColumn("n", F.lit("n"))).collect()
    assert Counter(r.vec_id for r in got) == Counter({k: 2 for k in [*range(6), None]}) and {r.n for r in got} == {7}
    assert whitening.whiten(df.limit(0)).collect() == [] and whitening.whiten(df.filter("vec_id = 3")).collect() == []
    check_whitening(spark, [(k, [3e4 * k, 1e4 * (k % 3), -2e4 * (k % 5)]) for k in range(11)])


def test_deviations_beyond_machine_words():
    x, sums = np.array([[2**52, 5], [7, 9]]), np.array([2**52 + 7, 14], object)
    z = [[2 * a - s for a, s in zip(r, (2**52 + 7, 14), strict=True)] for r in x.tolist()]
    assert whitening.scattered(x, 2**12, sums * 2**11).tolist() == [[2**12 * a - s * 2**11 for a, s in zip(r, sums, strict=True)] for r in x.tolist()]
    assert whitening.deviations(x, 2, sums).to_pylist() == [v if v < 2**63 else None for v in (sum(c * c for c in r) for r in z)]


# ---- divergence


def plain_divergence(rows, least=30, top=50):
    words_of = [(lang or "", source or "", [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]) for text, lang, source in rows]
    df, counts, sources = Counter(), defaultdict(Counter), defaultdict(set)
    for lang, source, found in words_of:
        df.update((lang, w) for w in set(found))
        counts[lang, source].update(found)
        sources[lang].add(source)
    out = set()
    for lang, own in sources.items():
        kept = [w for (g, w), n in df.items() if g == lang and n >= least]
        share = {}
        for s in [*own, None]:
            tally = {w: counts[lang, s][w] if s is not None else sum(counts[lang, o][w] for o in own) for w in kept}
            total = sum(tally.values()) + 5 * len(kept)
            share[s] = {w: 1 + 1_000_000_000 * (n + 5) // total for w, n in tally.items()}
        for s in own:
            pairs = sorted((-sum(abs(share[s][w] - share[o][w]) for w in kept), o.encode(), o) for o in own if o != s)
            terms = sorted((share[None][w] - share[s][w], w.encode(), w) for w in kept if counts[lang, s][w] and share[s][w] > share[None][w])[:top]
            for part, found in (("pair", pairs), ("term", terms)):
                out |= {(lang, s, part, item, -value, k + 1) for k, (value, _, item) in enumerate(found)}
    return out


COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def rows_of(df, **options):
    rows = list(map(tuple, divergence.source_divergence(df, **options).select(*COLUMNS).collect()))
    assert len(rows) == len(set(rows))
    return set(rows)


def test_divergence(spark, sf):
    prepare(spark)
    docs = documents(spark, sf)
    rows = [(r.text, r.lang, r.source) for r in docs.collect()]
    assert rows_of(docs) == plain_divergence(rows)
    assert rows_of(docs.repartition(7), min_documents=3, top_terms=4) == plain_divergence(rows, 3, 4)


def test_divergence_on_odd_rows(spark):
    prepare(spark)
    rows = [
        (None, "en", "a"), ("one Two two", "en", "a"), ("one three", "en", None), ("ONE öne Öne x1y", "en", "b"), ("", None, None), ("only", "xx", "y"), ("one Two two", "en", "a"),
        ("z" * 1_000_000 + " one", "en", "c"), ("1 2 3", "de", "p"), (None, "de", "q"),
    ]
    df = spark.createDataFrame(rows, "text string, lang string, source string").withColumn("term", F.lit(1)).withColumn("n", F.lit(2))
    for least in (1, 2, 5):
        assert rows_of(df, min_documents=least) == plain_divergence(rows, least)
    assert rows_of(df.limit(0)) == set()


def test_stripes_that_spill_are_merged():
    import pyarrow as pa

    texts = [f"w{chr(97 + k % 20)} common W{chr(97 + k % 7)}" for k in range(400)]
    batch = pa.record_batch([pa.array(["en"] * 400), pa.array([f"s{k % 3}" for k in range(400)]), pa.array(texts)], names=["lang", "source", "text"])

    def merged(budget, size):
        total = defaultdict(lambda: [0, 0])
        for out in divergence.fold_stripes((batch.slice(lo, size) for lo in range(0, 400, size)), budget):
            for r in out.to_pylist():
                for e in r["entries"]:
                    total[r["lang"], r["term"], e["source"]][0] += e["df"]
                    total[r["lang"], r["term"], e["source"]][1] += e["n"]
        return dict(total)

    whole = merged(10**6, 400)
    divergence.FOLD_BYTES, before = 1, divergence.FOLD_BYTES
    try:
        assert merged(10, 30) == whole and whole["en", "common", "s0"] == [134, 134]
    finally:
        divergence.FOLD_BYTES = before


def test_shares_are_exact():
    counts, totals = np.array([[0, 10**15], [3, 7]]), np.array([10**15 + 3, 10**15 + 7])
    want = [[1 + 10**9 * (c + 5) // (t + 10) for c, t in zip(r, totals.tolist(), strict=True)] for r in counts.tolist()]
    assert divergence.shares(counts, totals, 2).tolist() == want
