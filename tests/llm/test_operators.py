"""The corpus operators against brute force on small tables, odd rows included."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from quayside.llm import ann, bpe, exact, graph, mixing, neardup, pii, quality, sharding, substring, urlfilter
from quayside.llm.common import documents, hot_join, prepare

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, sig int, rep int, h long"
PATH = str(public_tokenizers.path("word_bpe_49k.json"))
P = " ".join(f"w{k}" for k in range(60))
ODD = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE two"), (6, P), (7, P + " tail"), (8, "x y " + P), (9, P), (10, "a b\tc"), (11, "abc"), (12, "\x1c\x85é  Ünï 123-45"), (13, "z" * 30000), (14, "word " * 400), (9, P), (None, "no id"), (15, "<|endoftext|>Hi 's")]


@pytest.fixture(scope="module")
def odd(spark):
    prepare(spark)
    return spark.createDataFrame([(i, t, "en", "s", 0, 1, 2, 3) for i, t in ODD], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark, sf):
    prepare(spark)
    return documents(spark, sf)


@pytest.fixture(scope="module")
def empty(spark, odd):
    return odd.limit(0)


def rows_of(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


@pytest.mark.parametrize("table", ["docs", "odd"])
def test_exact(table, request):
    df = request.getfixturevalue(table)
    groups = defaultdict(list)
    for i, t in rows_of(df):
        groups[re.sub(r"[\x20\x09-\x0D]", "", t)].append((-len(t), i is None, i))
    want = []
    for norm, members in groups.items():
        keep = min(members, key=lambda m: (m[0], m[1], m[2] or 0))[2]
        want += [(i, keep, len(members), i == keep, hashlib.sha256(norm.encode()).hexdigest()) for *_, i in members]
    assert sorted(map(tuple, exact.exact_dedup(df).collect()), key=str) == sorted(want, key=str)


def test_exact_spills_to_files():
    texts = [f"text {k % 700}".encode() * 3 for k in range(3000)]
    records = [(k % 700 * 0x9E3779B97F4A7C15 % 2**64, t, k, len(t), 1, 1) for k, t in enumerate(texts)]
    found = list(exact.grace(iter(records), memory=4000))
    assert len(found) == 700 and sum(r[4] for r in found) == 3000 and all(r[2] < 700 for r in found)


@pytest.mark.parametrize("table", ["docs", "odd"])
def test_substring(table, request):
    df = request.getfixturevalue(table)
    texts, first = rows_of(df), {}
    for i, t in texts:
        w = split(t)
        for k in range(len(w) - 49 if i is not None else 0):
            key = tuple(w[k : k + 50])
            first[key] = min(first.get(key, i), i)
    want = []
    for i, t in texts:
        w = split(t)
        gone = [False] * len(w)
        for k in range(len(w) - 49 if i is not None else 0):
            if first[tuple(w[k : k + 50])] < i:
                gone[k : k + 50] = [True] * 50
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        want.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    assert sorted(map(tuple, substring.substring_dedup(df).drop("kept_text").collect()), key=str) == sorted(want, key=str)


def near_groups(texts, size):
    """The smallest linked id of each id, by comparing all pairs; and the shingle sets."""
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = {}
    for i, t in texts:
        w = split(t.translate(low))
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
    up = {i: i for i in sets if i is not None}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(up)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}, sets


@pytest.mark.parametrize("table", ["docs", "odd"])
def test_near_duplicates(table, request):
    df = request.getfixturevalue(table)
    roots, sets = near_groups(rows_of(df), 4)
    for r in neardup.near_duplicates(df, shingle_size=4).collect():
        root = roots[r.doc_id] if r.doc_id is not None else None
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), root, r.doc_id == root)


def test_single_links_in_a_crowd_are_found(spark):
    """Texts that share four words in five, below the threshold; some have one near copy."""
    prepare(spark)
    shared = [f"b{k}" for k in range(160)]
    rows = [(k, shared + [f"u{k}x{j}" for j in range(40)]) for k in range(800)]
    rows += [(800 + k, shared + [f"v{k}x{j}" for j in range(17)] + rows[k][1][177:]) for k in range(200)]
    df = spark.createDataFrame([(k, " ".join(w)) for k, w in rows], "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(df, shingle_size=4).collect()}
    assert got == {k: k if k < 800 else k - 800 for k in range(1000)}


def test_links_hardly_nearer_than_the_crowd_are_found(spark):
    """A crowd 0.77 alike hides links of 0.81 from neighbours in the forest's orders."""
    prepare(spark)
    shared = [f"b{k}" for k in range(160)]
    rows = [(k, shared + [f"u{k}x{j}" for j in range(24)]) for k in range(1000)]
    rows += [(1000 + k, rows[k][1][:165] + [f"v{k}x{j}" for j in range(19)]) for k in range(100)]
    df = spark.createDataFrame([(k, " ".join(w)) for k, w in rows], "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(df, shingle_size=4).collect()}
    assert got == {k: k if k < 1000 else k - 1000 for k in range(1100)}


def test_components(spark):
    edges = [(k, k + 1) for k in range(50)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(51)} | {k: 100 for k in range(100, 140)}


@pytest.mark.parametrize("table", ["docs", "odd"])
def test_bpe(table, request):
    df = request.getfixturevalue(table)
    library = Tokenizer.from_file(PATH)
    texts = [t for _, t in rows_of(df)]
    mine = bpe.load(PATH).encode(texts)
    ids = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert mine == ids
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = [(len(x), digest(" ".join(map(str, x))), digest(library.decode(x, skip_special_tokens=False))) for x in ids]
    assert sorted(tuple(r)[1:] for r in bpe.token_digests(df, PATH).collect()) == sorted(want)


def test_sharding(docs, odd):
    for df in (docs, odd):
        out = sharding.shard_documents(df, 16).collect()
        slots = defaultdict(list)
        for r in out:
            slots[r.shard].append(r.slot)
            assert r.grown_shard in (r.shard, 16)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        want = sorted((len(t.encode()) + 1, zlib.crc32(t.encode())) for _, t in rows_of(df))
        assert sorted((r["size"], r.text_crc32) for r in out) == want


def test_jump_moves_only_to_the_new_shard():
    keys = np.random.default_rng(1).integers(0, 2**63, 20000).astype(np.uint64)
    for n in (1, 2, 9, 64):
        a, b = sharding.jump(keys, n), sharding.jump(keys, n + 1)
        assert ((a == b) | (b == n)).all() and abs((a != b).mean() - 1 / (n + 1)) < 0.02


def test_mixing_means_follow_the_weights(docs):
    import pyspark.sql.functions as F

    out = mixing.mix_sources(docs, {"src0": 5.0}, total=20000).groupBy("source").agg(F.count("*").alias("n"), F.first("mix_rate").alias("rate")).collect()
    n = sum(r.n for r in out)
    assert abs(n - 20000) < 800
    share = {r.source: r.n / n for r in out}
    assert abs(share["src0"] - 5 / (5 + len(share) - 1)) < 0.02


@pytest.mark.parametrize("table", ["docs", "odd"])
def test_pii_base_spans(table, request):
    df = request.getfixturevalue(table)
    plain = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    texts = dict(rows_of(df))
    for r in pii.find_pii(df).collect():
        text = texts[r.doc_id]
        spans = []
        for k, (kind, pattern) in enumerate(plain.items()):
            for m in re.finditer(pattern, text):
                digits = re.sub("[^0-9]", "", m[0])
                ok = {"email": True, "ip": all(int(x) < 256 for x in m[0].split(".")) if kind == "ip" else True, "card": 14 <= len(digits) <= 19 and pii.luhn(digits or "0"), "phone": 10 <= len(digits) <= 15}[kind]
                if ok:
                    spans.append((m.start(), k, kind, m.end()))
        base = ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(spans))
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert not base or set(base.split(",")) <= set(r.spans.split(","))


def test_pii_field_finds_variants_and_leaves_numbers():
    field = pii.fitted()
    found = lambda t: [(pii.KINDS[k], t[a:b]) for a, k, b in pii.added_spans(t, pii.base_spans(t), field)]
    assert found("write to jo at mail dot com today") == [("email", "jo at mail dot com")]
    assert found("call (555) 123-4567 now") == [("phone", "(555) 123-4567")]
    assert found("the year 2021 had 365 days and 1234567 people, key 45ac953709720d07d9") == []


def test_pii_field_reads_islands_of_any_length():
    field, one = pii.fitted(), "(617) 555-0142"
    found = lambda t: pii.added_spans(t, pii.base_spans(t), field)
    for n in (40, 3000):
        assert found(" ".join([one] * n)) == [(15 * k, 3, 15 * k + 14) for k in range(n)]
    rng = random.Random(8)
    for _ in range(20):  # pieces choose what the whole island would
        text = " ".join(x for x in pii._sentence(rng)[0].split() * 20 if any(c in "0123456789@" for c in x))
        whole, size = found(text), pii.PIECE_TOKENS
        try:
            pii.PIECE_TOKENS = 1
            assert found(text) == whole
        finally:
            pii.PIECE_TOKENS = size


def test_ann_recall(spark, sf, odd):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    got = defaultdict(list)
    for r in ann.nearest_neighbours(e).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    p = e.toPandas()
    x, ids = np.array(p.embedding.tolist(), float), p.vec_id.to_numpy()
    norm, hits = np.linalg.norm(x, axis=1), 0
    queries = np.flatnonzero(ids % 50 == 0)
    for q in queries:
        s = x @ x[q] / (norm * norm[q])
        s[q] = -9
        hits += len({v for _, v, _ in got[ids[q]]} & set(ids[np.lexsort((ids, -s))[:5]].tolist()))
    assert hits / (5 * len(queries)) >= 0.9


def test_ann_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [None, 1.0]), (6, [0.0, 1.0]), (None, [1.0, 1.0]), (6, [0.0, 1.0]), (50, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in ann.nearest_neighbours(df).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 50, 1.0), (0, 3, 6, 0.0), (50, 1, 0, 1.0), (50, 2, 1, 1.0), (50, 3, 6, 0.0)]
    assert ann.nearest_neighbours(df.limit(0)).count() == 0


def test_ann_graph_finds_neighbours_in_a_large_shard():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((3000, 24))
    x[:600] = x[0] + 0.05 * rng.standard_normal((600, 24))
    g = ann.Graph.build(np.arange(3000), x, 5)
    q = np.arange(0, 3000, 50)
    ids, near, _ = g.search(q, x[q], 5, ann.BEAM)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = u[q] @ u.T
    s[np.arange(len(q)), q] = -9
    want = {(i, v) for k, i in enumerate(q) for v in np.argsort(-s[k])[:5]}
    assert len(want & set(zip(ids.tolist(), near.tolist(), strict=True))) / len(want) >= 0.95


def test_url_lists(spark):
    day = lambda x: __import__("datetime").date.fromisoformat(x)
    captures = spark.createDataFrame([(1, "http://a.b.com/x", day("2024-01-05")), (2, "https://u@B.com:8/", day("2024-02-10")), (3, None, day("2024-01-05")), (4, "http://a.b.com/", day("2024-03-01")), (5, "nonsense", None)], "page_id long, url string, day date")
    entries = spark.createDataFrame([("l", "b.com", "add", day("2024-01-01")), ("l", "b.com", "remove", day("2024-02-10")), ("l", "b.com", "add", day("2024-02-10")), ("m", "a.b.com", "add", day("2024-02-20")), ("m", None, "add", day("2024-02-20"))], "list string, key string, action string, day date")
    got = {r.page_id: (r.blocked, r.matches) for r in urlfilter.filter_captures(captures, entries, "2025-01-01").collect()}
    assert got == {1: (True, "l:b.com"), 2: (False, ""), 3: (False, ""), 4: (True, "m:a.b.com"), 5: (False, "")}


def test_quality_held_out(spark, docs, odd):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    large = documents(spark, "/root/testdata/sf0.01")
    rows = quality.score_documents(large, labels).join(labels, "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.95
    out = quality.score_documents(odd, labels.limit(0)).collect()
    assert len(out) == len(ODD) and all(0 <= r.score <= 1 for r in out)


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    runs = (exact.exact_dedup(empty), substring.substring_dedup(empty), neardup.near_duplicates(empty), bpe.token_digests(empty, PATH), sharding.shard_documents(empty), mixing.mix_sources(empty), pii.find_pii(empty), quality.score_documents(empty, labels))
    assert [df.count() for df in runs] == [0] * len(runs)


def test_pipeline(spark, sf):
    docs = documents(spark, sf)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == columns, name
    assert corpus_pipeline.run(spark, sf).count() > 0


def test_pipeline_against_brute_force(spark, sf, docs):
    """run() against plain versions of its stages; the classifier's scores are its own
    (their accuracy is tested above), its decisions are applied here."""
    scores = quality.score_documents(docs, spark.read.parquet(f"{sf}/labels.parquet")).collect()
    good = {r.doc_id for r in scores if r.score >= 0.3}
    rows = {i: t for i, t in rows_of(docs) if i in good}
    best = {}
    for i, t in rows.items():
        key = re.sub(r"[\x20\x09-\x0D]", "", t)
        best[key] = min(best.get(key, (0, i)), (-len(t), i))
    rows = {i: rows[i] for _, i in best.values()}
    roots, _ = near_groups(rows.items(), 5)
    left = [i for i in rows if roots[i] == i]
    assert 0 < len(left) < len(good) < len(scores)
    table = docs.filter(docs.doc_id.isin(left)).toArrow()
    con = duckdb.connect()
    con.register("documents", table)
    weights = " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in mixing.MIX_WEIGHTS.items())
    assert weights in mixing.MIX_SQL
    library = Tokenizer.from_file(PATH)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t in con.execute(f"SELECT doc_id, coalesce(text, '') FROM ({mixing.MIX_SQL})").fetchall():
        ids = library.encode(t, add_special_tokens=False).ids
        want.append((i, len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids, skip_special_tokens=False))))
    out = corpus_pipeline.run(spark, sf).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, out)) == sorted(want)


def test_pipeline_stages_on_odd_rows(spark, odd, sf):
    docs = odd
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        docs.count()


def test_hot_join_equals_a_plain_join(spark):
    """A key of half the rows is broadcast and 10,000 others are dealt by key."""
    prepare(spark)
    left = spark.range(20000).selectExpr("if(id % 2 = 0, -1, if(id % 7 = 0, null, id)) as k", "id")
    right = left.groupBy("k").agg(F.count(F.lit(1)).alias("rows"), F.min("id").alias("low")).filter("k is null or k % 5 <> 3")
    got = hot_join(left, right, ["k"], "rows")
    want = left.join(right.drop("rows"), ["k"])
    assert got.columns == want.columns and sorted(got.collect()) == sorted(want.collect())
    assert hot_join(left, right.limit(0), ["k"], "rows").isEmpty()
