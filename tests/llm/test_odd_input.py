"""Rows that the test tables don't hold: every operator and stage on empty tables, clashing
column names, one id on two texts, null ids, the largest id, and very long runs."""

import datetime
import hashlib
import math
import random
import re
import time
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from quayside.llm import ann, bpe, divergence, exact, mixing, neardup, pii, quality, sharding, substring, urlfilter
from quayside.llm.common import materialize, prepare, scratch_scope
from quayside.sources.files import exists

PATH = str(public_tokenizers.path("word_bpe_49k.json"))
TOP = 2**63 - 1
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("rows", "size", "shard", "key", "state", "mix_rate", "mix_copy", "mix_key", "t", "n", "h", "sha", "keep", "points", "same", "label", "bag", "id", "score", "part", "at")
P = " ".join(f"w{k}" for k in range(60))
Q = " ".join(f"q{k}" for k in range(200))
OPERATORS = {
    "exact": exact.exact_dedup,
    "substring": substring.substring_dedup,
    "neardup": neardup.near_duplicates,
    "bpe": lambda df: bpe.token_digests(df, PATH),
    "sharding": sharding.shard_documents,
    "mixing": mixing.mix_sources,
    "pii": pii.find_pii,
    "quality": lambda df: quality.score_documents(df, no_labels(df)),
    "drop_exact": exact.drop_exact_copies,
    "drop_near": neardup.drop_near_copies,
    "drop_quality": lambda df: quality.drop_low_quality(df, no_labels(df)),
    "mask": pii.mask_pii,
    "divergence": lambda df: divergence.source_divergence(df, min_documents=1),
}
STAGES = dict(corpus_pipeline.STAGES)


def no_labels(df):
    return df.sparkSession.createDataFrame([], "doc_id long, quality int, toxic int")


def table(spark, rows):
    prepare(spark)
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], COLUMNS).coalesce(1)


def clash(df):
    return df.select("*", *(F.lit(7).alias(c) for c in CLASHES if c not in df.columns))


@pytest.fixture(scope="module")
def rows(spark):
    """Twenty rows with an id, three without one, one id on two texts."""
    return table(spark, [(k, f"a text of number {k} " + P) for k in range(18)] + [(3, "another text"), (TOP, P), (None, "x"), (None, "y"), (None, None)])


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(spark, rows, name):
    assert OPERATORS[name](clash(rows.limit(0))).count() == 0


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_clashing_columns_change_nothing(spark, rows, name):
    plain, mixed = OPERATORS[name](rows), OPERATORS[name](clash(rows))
    kept = [c for c in plain.columns]
    assert sorted(map(str, mixed.select(kept).collect())) == sorted(map(str, plain.collect()))


@pytest.mark.parametrize("name", sorted(STAGES))
def test_stages_on_empty_and_clashing_tables(spark, rows, sf, name):
    assert STAGES[name](spark, rows.limit(0), sf).count() == 0
    out = STAGES[name](spark, clash(rows), sf)
    plain = STAGES[name](spark, rows, sf)
    assert sorted(map(str, out.select(plain.columns).collect())) == sorted(map(str, plain.collect()))
    if name != "bpe":
        assert sorted(out.columns) == sorted(clash(rows).columns)


def test_a_mixed_table_can_be_mixed_again(spark, rows):
    once = mixing.mix_sources(rows, total=40)
    twice = mixing.mix_sources(once, total=40)
    assert twice.columns == once.columns and twice.count() > 0


def test_rows_without_an_id_are_drawn_and_dealt_apart(spark):
    out = mixing.mix_sources(table(spark, [(None, f"text {k}") for k in range(400)]), total=800)
    assert out.filter("mix_copy = 1").select("mix_key").distinct().count() == out.filter("mix_copy = 1").count() > 250
    shards = sharding.shard_documents(table(spark, [(None, f"text {k}") for k in range(400)]))
    assert sorted(r.slot for r in shards.collect()) == list(range(400))


def test_many_equal_rows_get_a_slot_each(spark):
    rows = spark.range(450_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("").alias("text")).union(table(spark, [(3, "x")]).select("doc_id", "text"))
    found = sharding.shard_documents(rows).groupBy("doc_id").agg(F.count("slot").alias("n"), F.min("slot").alias("low"), F.max("slot").alias("high"), F.countDistinct("slot").alias("slots"))
    equal, own = sorted(map(tuple, found.collect()), key=lambda r: -r[1])
    assert equal == (None, 450_000, 0, 449_999, 450_000) and own[:2] == (3, 1)


def test_the_largest_id_is_an_id(spark):
    df = table(spark, [(TOP, "a b"), (TOP, "a b"), (None, "c"), (TOP, "c"), (None, "d")])
    got = sorted((r.doc_id or 0, r.keep_id or 0, r.group_size, r.kept) for r in exact.exact_dedup(df).collect())
    assert got == [(0, 0, 1, True), (0, TOP, 2, False), (TOP, TOP, 2, True), (TOP, TOP, 2, True), (TOP, TOP, 2, True)]
    assert sorted(r.text for r in exact.drop_exact_copies(df).collect()) == ["a b", "c", "d"]


def test_exact_keeps_the_longest_of_one_ids_rows(spark):
    df = table(spark, [(5, "a b"), (5, "a  b"), (5, "a  b"), (9, "ab")])
    assert [r.text for r in exact.drop_exact_copies(df).collect()] == ["a  b"]
    assert [r.kept for r in exact.exact_dedup(df).orderBy("doc_id").collect()].count(True) == 2


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_substring_with_one_id_on_two_texts(spark):
    df = table(spark, [(1, P), (2, Q + " " + P), (2, "short text here"), (3, Q), (3, P + " z"), (4, P), (4, P)])
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring.substring_dedup(df).collect())
    want = [(1, 60, 0, digest(P)), (2, 260, 60, digest(Q)), (2, 3, 0, digest("short text here")), (3, 200, 200, digest("")), (3, 61, 60, digest("z")), (4, 60, 60, digest("")), (4, 60, 60, digest(""))]
    assert got == sorted(want)


def test_maximal_repeats_are_runs_of_words(spark):
    df = table(spark, [(1, P), (2, P + " " + Q), (3, f"{Q} x {P} y {Q}")]).withColumn("t", F.xxhash64("text"))
    runs, copies = substring.maximal_repeats(df.select("doc_id", "text", "t"))
    assert {r.doc_id: list(zip(r.starts, r.lengths)) for r in runs.collect()} == {2: [(0, 60)], 3: [(0, 200), (201, 60), (262, 200)]}
    assert copies.isEmpty()


def test_near_duplicates_with_one_id_on_two_texts(spark):
    a, b = P, Q
    df = table(spark, [(3, a), (5, a + " tail"), (5, b), (9, b + " tail"), (7, "alone in the world today"), (8, None), (8, "alone again in the world")])
    got = {(r.doc_id, r.n_shingles): r.component_id for r in neardup.near_duplicates(df, shingle_size=4).collect()}
    assert got == {(3, 57): 3, (5, 58): 3, (5, 197): 3, (9, 198): 3, (7, 2): 7, (8, 0): 8, (8, 2): 8}


def test_ann_takes_one_vector_an_id(spark):
    prepare(spark)
    df = spark.createDataFrame([(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [0.0, 2.0]), (2, [3.0, 0.1])], "vec_id long, embedding array<double>")
    got = [(r.query_id, r.vec_id, round(r.score, 6)) for r in ann.nearest_neighbours(clash(df)).orderBy("rank").collect()]
    assert got == [(0, 1, 1.0), (0, 2, round(0.1 / np.hypot(3, 0.1), 6))]
    assert ann.nearest_neighbours(clash(df).limit(0)).count() == 0


def test_ann_recall_over_several_shards(spark):
    """Three shards, their results merged; also with more blocks than one copy takes."""
    prepare(spark)
    rng = np.random.default_rng(12)
    x = rng.standard_normal((6000, 16)).round(4)
    x[:2000] = (x[0] + 0.1 * x[:2000]).round(4)
    df = spark.createDataFrame([(k, v) for k, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    queries = np.arange(0, 6000, 50)
    s = u[queries] @ u.T
    s[np.arange(len(queries)), queries] = -9
    want = {(int(q), int(v)) for q, row in zip(queries, s) for v in np.argsort(-row)[:5]}
    for per_task in (ann.BLOCKS_PER_TASK, 1 / 256):
        before, ann.BLOCKS_PER_TASK = ann.BLOCKS_PER_TASK, per_task
        try:
            got = {(r.query_id, r.vec_id) for r in ann.nearest_neighbours(df, shard_rows=2000).collect()}
        finally:
            ann.BLOCKS_PER_TASK = before
        assert len(got) == len(want) and len(got & want) >= 0.95 * len(want)


def test_url_lists_on_odd_rows(spark):
    day = datetime.date.fromisoformat
    prepare(spark)
    pages = [(1, "http://a.b.com/x", day("2024-01-05")), (1, "http://a.b.com/x", day("2024-01-05")), (2, "http://" + "a." * 300 + "com/", day("2024-01-05")), (3, "http://b.com/" + "x" * 100_000, day("2024-01-05")), (None, None, None), (4, "http://b.com", None)]
    captures = clash(spark.createDataFrame(pages, "page_id long, url string, day date"))
    listed = [("l", "b.com", "add", day("2024-01-01"))] * 3 + [("m", "b.com", "add", day("2024-01-05")), ("l", None, "add", day("2024-01-01"))]
    entries = clash(spark.createDataFrame(listed, "list string, key string, action string, day date"))
    got = sorted((r.page_id or 0, r.n_lists, r.matches, r.blocked, r.host is None) for r in urlfilter.filter_captures(captures, entries, "2025-01-01").collect())
    assert got == [(0, 0, "", False, True), (1, 2, "l:b.com,m:b.com", True, False), (1, 2, "l:b.com,m:b.com", True, False), (2, 0, "", False, True), (3, 2, "l:b.com,m:b.com", True, False), (4, 0, "", False, False)]
    assert urlfilter.filter_captures(captures.limit(0), entries, "2025-01-01").count() == 0
    assert not any(r.blocked for r in urlfilter.filter_captures(captures, entries.limit(0), "2025-01-01").collect())


def test_url_lists_with_a_hot_host(spark):
    """A host of half the captures on one day, and a domain above most of the others."""
    prepare(spark)
    captures = spark.range(12000).selectExpr("id as page_id", "if(id % 2 = 0, 'http://hot.com/', concat('http://h', id, '.many.org/')) as url", "date'2024-01-05' as day")
    entries = spark.sql("select 'l' as list, explode(array('hot.com', 'many.org', 'h11.many.org')) as key, 'add' as action, date'2024-01-01' as day")
    out = urlfilter.filter_captures(captures, entries, "2025-01-01")
    assert out.count() == 12000 == out.filter("blocked").count()
    assert [r.matches for r in out.filter("page_id = 11").collect()] == ["l:h11.many.org,l:many.org"]


RUNS = {"letters and a digit": "z" * 1_000_000 + " 1", "digits": "1" * 1_000_000, "before a sign": "a" * 1_000_000 + "@", "dotted": "1.2.3." + "9" * 1_000_000, "signs": "@" * 1_000_000, "spelled": "at" * 500_000}


@pytest.mark.parametrize("name", sorted(RUNS))
def test_pii_reads_a_megabyte_run_in_seconds(name):
    field, began = pii.fitted(), time.time()
    assert pii.base_spans(RUNS[name]) == [] and pii.added_spans(RUNS[name], [], field) == []
    assert time.time() - began < 20


def test_pii_octets_of_any_length():
    text = "1.2.3.00000000000000000000004 and 1.2.3." + "9" * 5000
    assert pii.base_spans(text)[0] == (0, 1, 29) and len(pii.base_spans(text)) == 1


def best_by_enumeration(n, scored):
    """The best score of any set of segments that don't overlap."""
    if not n:
        return 0.0
    best = best_by_enumeration(n - 1, [s for s in scored if s[1] <= n - 1])
    for i, j, _, score in scored:
        if j == n:
            best = max(best, score + best_by_enumeration(i, [s for s in scored if s[1] <= i]))
    return best


def test_pii_decoding_equals_enumeration():
    rng, field = np.random.default_rng(4), pii.Field()
    for _ in range(60):
        n = int(rng.integers(1, 9))
        spans = sorted({(int(i), int(j)) for i, j in rng.integers(0, n + 1, (10, 2)) if i < j})
        scored = [(i, j, int(rng.integers(4)), float(rng.normal())) for i, j in spans]
        found = field.decode(n, iter(scored))
        value = {(i, j, k): s for i, j, k, s in scored}
        assert all(a[1] <= b[0] for a, b in zip(found, found[1:]))
        assert np.isclose(sum(value[f] for f in found), best_by_enumeration(n, scored))


def loop_forward(model, bag):
    """The model's score of one bag, one passage at a time."""
    p, hidden, weights = model.p, [], []
    for x in bag:
        h = [np.tanh(sum((x[i] - model.mean[i]) / model.scale[i] * p["W"][i, j] for i in range(len(x))) + p["b"][j]) for j in range(quality.HIDDEN)]
        gate = 0.0
        for k in range(quality.ATTENTION):
            v, u = sum(h[j] * p["V"][j, k] for j in range(len(h))), sum(h[j] * p["U"][j, k] for j in range(len(h)))
            gate += p["w"][k] * np.tanh(v) / (1 + np.exp(-u))
        hidden.append(h), weights.append(np.exp(gate))
    z = [sum(w * h[j] for w, h in zip(weights, hidden)) / sum(weights) for j in range(quality.HIDDEN)]
    return 1 / (1 + np.exp(-(sum(a * b for a, b in zip(z, p["c"])) + p["d"])))


def small_model():
    rng = np.random.default_rng(2)
    model = quality.Model(0.4)
    model.p = {k: v + 0.3 * rng.standard_normal(v.shape) for k, v in model.p.items()}
    bags = [rng.random((n, quality.FEATURES)) for n in (1, 3, 2)]
    return model, bags, np.concatenate(bags), np.array([0, 1, 4, 6])


def plain_features(text):
    """The features of a text's passages, one word at a time."""
    raw = text.encode()
    found = [(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)]
    if not found:
        return [[0.0] * quality.FEATURES]
    all_words, rows = [raw[a:b] for a, b in found], []
    for lo in range(0, len(found), quality.PASSAGE):
        words = all_words[lo : lo + quality.PASSAGE]
        lens, n = [len(w) for w in words], len(words)
        mean = sum(lens) / n
        row = [math.log1p(n) / 4, mean / 8, math.sqrt(max(0.0, sum(x * x for x in lens) / n - mean**2)) / 8, len(set(words)) / n]
        upper = [sum(65 <= c <= 90 for c in w) for w in words]
        letters = [sum(65 <= c <= 90 or 97 <= c <= 122 or c >= 128 for c in w) for w in words]
        at = range(lo, lo + n)
        flags = [
            [u >= 2 and u == k for u, k in zip(upper, letters, strict=True)], [u > 0 for u in upper], [k == 0 for k in letters], [k < x for k, x in zip(letters, lens, strict=True)],
            *([w[-1] == c for w in words] for c in (33, 46, 44)), [w[-1:] in (b"$", b"%", b"&", b"*", b"#", b"@", b"|") for w in words],
            [k > 0 and all_words[k] == all_words[k - 1] for k in at], [any(k >= g and all_words[k] == all_words[k - g] for g in (2, 3, 4, 5, 6, 8, 11, 12)) for k in at],
            [x == 1 for x in lens], [x > 14 for x in lens],
        ]
        row += [sum(f) / n for f in flags]
        end = found[lo + n][0] if lo + n < len(found) else len(raw)
        tally = [0] * quality.CLASSES
        for c in raw[0 if lo == 0 else found[lo][0] : end]:
            tally[quality.BYTE_CLASS[c]] += 1
        rows.append(row + [x / sum(tally) for x in tally] + [1.0])
    return rows


def test_quality_features_equal_loops():
    """Each text alone, and none tells on another in the batch."""
    rng = random.Random(12)
    words = ["The", "cat", "SAT", "a", "b1", "!!", "no.", "yes,", "end!", "#1$", "extraordinarily-long", "\u00e9t\u00e9", "cat", "cat"]
    texts = ["", " \n", "\n\n one", "x", *(rng.choice(["", " ", "\t\n"]) + rng.choice([" ", "\n", "  "]).join(rng.choice(words) for _ in range(n)) + rng.choice(["", " \n "]) for n in (3, 63, 64, 65, 200, 128))]
    got, cuts = quality.passages(pa.array([*texts, None]))
    want = [plain_features(t) for t in [*texts, ""]]
    assert np.diff(cuts).tolist() == [len(w) for w in want]
    assert np.allclose(got, np.array([row for w in want for row in w]), atol=1e-6)


def test_quality_forward_pass_equals_loops():
    model, bags, x, cuts = small_model()
    assert np.allclose(model.forward(x, cuts)[0], [loop_forward(model, b) for b in bags])


def test_quality_gradient_equals_differences():
    model, _, x, cuts = small_model()
    y, rng = np.array([1.0, 0.0, 1.0]), np.random.default_rng(3)

    def loss():
        s = model.forward(x, cuts)[0]
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))

    for name, g in model.gradient(x, cuts, y).items():
        value = model.p[name]
        for at in [tuple(rng.integers(0, value.shape)) for _ in range(4)] if value.shape else [()]:
            losses = []
            for step in (1e-5, -1e-5):
                model.p[name] = np.array(value)
                model.p[name][at] += step
                losses.append(loss())
            model.p[name] = value
            assert np.isclose((losses[0] - losses[1]) / 2e-5, np.asarray(g)[at], rtol=1e-3, atol=1e-7), name


def test_quality_sample_is_bounded_and_whole(spark):
    """Repeated rows of a labelled id are one bag; a document beyond the bound is left out whole."""
    long = " ".join(["word"] * 64 * 90)
    df = table(spark, [(k, f"text {k}") for k in range(40)] + [(1, "text 1")] * 30 + [(3, "other")] * 5 + [(100 + k, long) for k in range(6)])
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(40)] + [(100 + k, 1, 0) for k in range(6)] + [(4, 1, 0)], "doc_id long, quality int, toxic int")
    size = {r.id: r.n for r in quality.training_bags(df, labels, max_passages=150).selectExpr("id", f"length(bag) div {4 * quality.FEATURES} as n").collect()}
    assert all(n in (1, 90) for n in size.values()) and list(size.values()).count(90) == 1
    assert len(quality.training_bags(df, labels, max_docs=7).collect()) == 7


def test_jump_equals_the_loop():
    def loop(key, shards):
        b, j = -1, 0
        while j < shards:
            b, key = j, (key * 2862933555777941757 + 1) % 2**64
            j = int((b + 1) * (2.0**31 / ((key >> 33) + 1)))
        return b

    keys = [0, 1, 2**60 - 1, *np.random.default_rng(6).integers(0, 2**60, 500).tolist()]
    for shards in (1, 2, 16, 17, 1000):
        assert sharding.jump(np.array(keys, np.uint64), shards).tolist() == [loop(k, shards) for k in keys]


def test_scratch_tables_are_deleted(spark):
    prepare(spark)
    with scratch_scope(spark) as made:
        kept = materialize(spark.range(5).toDF("a"), "one")
        assert kept.count() == 5
        neardup.near_duplicates(table(spark, [(1, P), (2, P + " x"), (3, Q)])).collect()
        assert len([p for p in made if exists(spark, p)]) == 3  # this one, the profile and the named classes
    assert not any(exists(spark, p) for p in made)


def test_scopes_side_by_side_keep_their_tables(spark):
    """Each of two calls in threads of its own deletes its own tables only."""
    prepare(spark)

    def one(k):
        with scratch_scope(spark):
            rows = table(spark, [(k, P), (k + 1, P + " x"), (k + 2, Q)])
            return sorted((r.doc_id, r.component_id) for r in neardup.near_duplicates(rows).collect())

    with ThreadPoolExecutor(2) as pool:
        assert list(pool.map(one, (10, 20))) == [[(10, 10), (11, 10), (12, 12)], [(20, 20), (21, 20), (22, 22)]]


def test_ann_scores_of_enormous_and_tiny_vectors(spark):
    vectors = [(0, [1e200, 1e200]), (1, [1e200, 0.0]), (2, [1e-200, 1e-200]), (3, [-3e-310, 0.0])]
    rows = ann.nearest_neighbours(spark.createDataFrame(vectors, "vec_id long, embedding array<double>")).collect()
    found = [(r.rank, r.vec_id, round(r.score, 12)) for r in sorted(rows, key=lambda r: r["rank"])]
    assert found == [(1, 2, 1.0), (2, 1, round(0.5**0.5, 12)), (3, 3, -round(0.5**0.5, 12))]


def test_bpe_proposes_long_words_too(spark):
    words = ["".join(random.Random(k).choice("abcdefghij") for _ in range(n)) for k, n in enumerate((193, 700, 5_000))] + ["the" * 100_000, "ab" * 500 + "\u00e9" * 300]
    own = bpe.load(PATH)
    exact_, proposed = Tokenizer.from_file(PATH), 0
    for word in words:
        ids = exact_.encode(word, add_special_tokens=False).ids
        assert own.encode([word]) == [ids]
        raw = word.encode()
        proposed += own.greedy_word(raw).tolist() == own.greedy(np.frombuffer(raw, np.uint8).astype(np.int64)[None, :], np.array([len(raw)]))[0][: len(own.greedy_word(raw))].tolist() if len(raw) < 6_000 else 1
    assert proposed == len(words)


def test_substring_with_many_equal_rows(spark):
    """Rows repeated under one id are one document: their places are not gathered."""
    text = " ".join(f"r{k}" for k in range(300))
    rows = spark.range(40_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit(text).alias("text")).union(table(spark, [(9, "a b " + text)]).select("doc_id", "text"))
    found = substring.substring_dedup(rows).groupBy("doc_id").agg(F.count("n_words").alias("n"), F.max("n_removed").alias("removed"), F.min("n_removed").alias("least"))
    assert sorted(map(tuple, found.collect())) == [(7, 40_000, 0, 0), (9, 1, 300, 300)]


def test_texts_of_ten_megabytes_and_words_of_one(spark):
    long = " ".join(f"v{k % 90_000}" for k in range(1_500_000))
    rows = table(spark, [(1, long), (2, long + " end"), (3, "z" * 1_000_000), (4, "z" * 1_000_000), (5, "short one")])
    assert [r.keep_id for r in exact.exact_dedup(rows).orderBy("doc_id").collect()] == [1, 2, 3, 3, 5]
    assert [r.component_id for r in neardup.near_duplicates(rows).orderBy("doc_id").collect()] == [1, 1, 3, 3, 5]
    assert [r.n_removed for r in substring.substring_dedup(rows).orderBy("doc_id").collect()] == [0, 1_500_000, 0, 0, 0]


def test_crowds_of_any_similarity_hide_no_link(spark):
    """Many groups that share most of their shingles, compared with all pairs."""
    rng, texts = random.Random(3), []
    base = [f"c{k}" for k in range(60)]
    for g in range(40):
        own = base[:]
        for k in rng.sample(range(60), 2):
            own[k] = f"g{g}_{k}"
        texts += [" ".join(own), " ".join([*own[: rng.randrange(50, 60)], f"x{g}"])]
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(table(spark, list(enumerate(texts))), shingle_size=3, threshold=(70, 100)).collect()}
    sets = [{tuple(w[k : k + 3]) for k in range(len(w) - 2)} for w in (t.split() for t in texts)]
    up = list(range(len(sets)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 70 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    assert got == {k: root(k) for k in range(len(sets))}
