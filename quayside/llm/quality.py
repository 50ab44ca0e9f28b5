"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages. Each passage is encoded (features, then a hidden layer),
gated attention weighs the passages, and the weighted sum is scored. Only document labels
train it: nothing says which passage is bad.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.llm import words
from quayside.llm.common import materialize, ship

PASSAGE = 64  # words
HIDDEN, ATTENTION = 24, 12
#: Bounds of the sample of labelled documents that a fit gathers on the driver: documents,
#: and the passages of all of them together (of 132 bytes each). Each one's text is whole.
TRAIN_DOCS, TRAIN_PASSAGES = 6_000, 400_000
THRESHOLD = 0.3
CLASSES = 16
WORD_FEATURES = 12
FEATURES = 4 + WORD_FEATURES + CLASSES + 1


def _byte_classes() -> np.ndarray:
    table = np.full(256, 15, np.uint8)
    for k, group in enumerate((b" ", b"\n\r\t\x0b\x0c", b".", b",", b"!", b"?", b"|", b"$%&*#@", b"<>{}[]()/\\=_~^`", b"0123456789", b"\"'-:;", bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(0xC3, 0xC4)), bytes(range(0x80, 0xC0)))):
        table[list(group)] = k
    return table


BYTE_CLASS = _byte_classes()


def passages(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage of every text, and each text's first passage (n+1). A
    text without words is one passage of zeros."""
    data, offsets = words.text_bytes(column)
    starts, ends, first = words.split(data, offsets)
    counts = np.diff(first)
    bags = np.maximum(1, -(-counts // PASSAGE))
    cuts = np.concatenate([[0], np.cumsum(bags)])
    out = np.zeros((int(cuts[-1]), FEATURES), np.float32)
    if not len(starts):
        return out, cuts
    hashes = words.word_hashes(data, starts, ends)
    owner = np.repeat(np.arange(len(counts)), counts)
    passage = cuts[owner] + (np.arange(len(starts)) - first[owner]) // PASSAGE
    lens = ends - starts
    upper = np.concatenate([[0], np.cumsum((data >= 65) & (data <= 90))])
    letters = np.concatenate([[0], np.cumsum(((data | 32) >= 97) & ((data | 32) <= 122) | (data >= 128))])
    n_upper, n_letters = upper[ends] - upper[starts], letters[ends] - letters[starts]
    last = data[ends - 1]
    repeat = np.zeros(len(starts), bool)
    repeat[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    near = np.zeros(len(starts), bool)
    for gap in (2, 3, 4, 5, 6, 8, 11, 12):
        near[gap:] |= (hashes[gap:] == hashes[:-gap]) & (owner[gap:] == owner[:-gap])
    n = np.bincount(passage, minlength=len(out)).astype(np.float64)
    one = np.maximum(n, 1)

    def mean(x) -> np.ndarray:
        return np.bincount(passage, x, len(out)) / one

    shouting = (n_upper >= 2) & (n_upper == n_letters)
    cols = [np.log1p(n) / 4, mean(lens) / 8, np.sqrt(np.maximum(0, mean(lens.astype(float) ** 2) - mean(lens) ** 2)) / 8]
    order = np.lexsort((hashes, passage))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (passage[order][1:] != passage[order][:-1])
    cols.append(np.bincount(passage[order][new], minlength=len(out)) / one)
    symbol = np.isin(last, np.frombuffer(b"$%&*#@|", np.uint8))
    for x in (shouting, (n_upper > 0), n_letters == 0, n_letters < lens, last == 33, last == 46, last == 44, symbol, repeat, near, lens == 1, lens > 14):
        cols.append(mean(x))
    # byte classes from each passage's first word to the next passage; a text's first passage
    # begins with the text, so that no text tells on another
    heads = np.flatnonzero(np.diff(passage, prepend=-1))
    opens = np.zeros(len(out), np.int64)
    opens[passage[heads]] = starts[heads]
    opens[cuts[:-1]] = offsets[:-1]
    region = np.repeat(np.arange(len(out)), np.diff(np.append(opens, len(data))))
    tally = np.bincount(region * CLASSES + BYTE_CLASS[data], minlength=len(out) * CLASSES).reshape(-1, CLASSES).astype(np.float64)
    tally[n == 0] = 0
    tally /= np.maximum(tally.sum(1, keepdims=True), 1)
    out[:, :FEATURES - 1] = np.column_stack([*cols, tally])
    out[:, -1] = (n > 0)
    return out, cuts


class Model:
    """Parameters by name; forward and backward passes over passages and bag bounds."""

    def __init__(self, base: float = 0.5) -> None:
        rng = np.random.default_rng(8)
        init = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float64)
        self.base = float(np.clip(base, 0.01, 0.99))
        self.mean, self.scale = np.zeros(FEATURES), np.ones(FEATURES)
        self.p = {"W": init(FEATURES, HIDDEN), "b": np.zeros(HIDDEN), "V": init(HIDDEN, ATTENTION), "U": init(HIDDEN, ATTENTION), "w": init(ATTENTION), "c": np.zeros(HIDDEN), "d": np.array(np.log(self.base / (1 - self.base)))}

    def forward(self, x: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, dict]:
        p = self.p
        f = (x - self.mean) / self.scale
        h = np.tanh(f @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * g) @ p["w"]
        bag = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
        e = np.exp(e - np.maximum.reduceat(e, cuts[:-1])[bag])
        a = e / np.add.reduceat(e, cuts[:-1])[bag]
        z = np.add.reduceat(a[:, None] * h, cuts[:-1])
        score = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))
        return score, {"f": f, "h": h, "t": t, "g": g, "a": a, "z": z, "bag": bag}

    def gradient(self, x: np.ndarray, cuts: np.ndarray, y: np.ndarray) -> dict:
        score, k = self.forward(x, cuts)
        p, bag = self.p, k["bag"]
        out = (score - y) / len(y)
        dz = out[:, None] * p["c"]
        dh = k["a"][:, None] * dz[bag]
        da = (k["h"] * dz[bag]).sum(1)
        de = k["a"] * (da - np.add.reduceat(k["a"] * da, cuts[:-1])[bag])
        dt, dg = de[:, None] * p["w"] * k["g"] * (1 - k["t"] ** 2), de[:, None] * p["w"] * k["t"] * k["g"] * (1 - k["g"])
        dh = (dh + dt @ p["V"].T + dg @ p["U"].T) * (1 - k["h"] ** 2)
        return {"W": k["f"].T @ dh, "b": dh.sum(0), "V": k["h"].T @ dt, "U": k["h"].T @ dg, "w": (k["t"] * k["g"]).T @ de, "c": k["z"].T @ out, "d": out.sum()}

    def fit(self, bags: list[np.ndarray], y: np.ndarray, epochs: int = 14, batch: int = 64) -> Model:
        """Adam on the log loss; the same bags give the same model."""
        if len(bags) < 2 or len(set(y.tolist())) < 2:
            return self
        every = np.concatenate(bags)
        self.mean, self.scale = every.mean(0, dtype=np.float64), every.std(0, dtype=np.float64) + 1e-3
        rng, step = np.random.default_rng(80), 0
        m = {n: np.zeros_like(v) for n, v in self.p.items()}
        v = {n: np.zeros_like(x) for n, x in self.p.items()}
        for epoch in range(epochs):
            rate = 0.01 * (1 - epoch / epochs) + 0.0005
            order = rng.permutation(len(bags))
            for lo in range(0, len(order), batch):
                part = order[lo : lo + batch]
                cuts = np.concatenate([[0], np.cumsum([len(bags[k]) for k in part])])
                grad = self.gradient(np.concatenate([bags[k] for k in part]), cuts, y[part])
                step += 1
                for name, g in grad.items():
                    g = g + 1e-5 * self.p[name]
                    m[name] = 0.9 * m[name] + 0.1 * g
                    v[name] = 0.999 * v[name] + 0.001 * g * g
                    self.p[name] = self.p[name] - rate * (m[name] / (1 - 0.9**step)) / (np.sqrt(v[name] / (1 - 0.999**step)) + 1e-8)
        return self


def held_out(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def training_bags(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_docs: int = TRAIN_DOCS,
    max_passages: int = TRAIN_PASSAGES,
) -> DataFrame:
    """(id, label, bag) of a sample of labelled, not held-out documents in hashed order: as
    many of the first ``max_docs`` as have ``max_passages`` together; a document that
    would go beyond is passed over, never cut. An id with several labels has the smallest,
    one with several texts that of least hash."""
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
    known = known.groupBy("id").agg(F.min("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(max_docs)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text")).join(F.broadcast(known), "id")  # max_docs rows
    rows = rows.groupBy("id", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))

    def encode(batches):
        for batch in batches:
            x, cuts = passages(batch.column(2))
            bags = [x[cuts[k] : cuts[k + 1]].tobytes() for k in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.diff(cuts)), pa.array(bags, pa.binary())], names=["id", "label", "n", "bag"])

    bags = materialize(rows.mapInArrow(encode, "id long, label int, n long, bag binary"), "bags")
    order = Window.orderBy("h", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # of max_docs rows
    sizes = bags.select("id", "n", F.xxhash64("id").alias("h")).filter(F.col("n") <= max_passages)
    chosen = sizes.withColumn("sum", F.sum("n").over(order)).filter(F.col("sum") <= max_passages)
    return bags.join(F.broadcast(chosen.select("id")), "id").select("id", "label", "bag")


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """A model of P(label = 1 | text) from the ``training_bags``. Without labels of both
    kinds it scores every text by the share of ones (0.5 without any)."""
    got = training_bags(docs, labels, id_col, text_col, label_col).toArrow().sort_by([("id", "ascending")])
    y = got["label"].to_numpy().astype(float)
    bags = [np.frombuffer(b, np.float32).reshape(-1, FEATURES) for b in got["bag"].to_pylist()]
    return Model(y.mean() if len(y) else 0.5).fit(bags, y)


def quality_score(text: Column, model: Model) -> Column:
    """Score from 0 to 1 of a text column; a null text scores as an empty one."""

    ship(SparkSession.active())

    @F.arrow_udf("double")
    def run(column: pa.Array) -> pa.Array:
        if not len(column):
            return pa.array([], pa.float64())
        x, cuts = passages(column)
        return pa.array(model.forward(x, cuts)[0])

    return run(text)


def score_documents(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted (score >= THRESHOLD).

    Whole texts count; labels, ids and every other column are no inputs. Null and empty
    texts score as one empty passage; a null id counts as held out. Repeated rows score
    alike. An empty table gives no rows.
    """
    model = fit_quality(df, labels, id_col, text_col)
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), quality_score(F.col(text_col).cast("string"), model).alias("score"))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_low_quality(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` without the rows that the classifier rejects; all columns as they were."""
    model = fit_quality(df, labels, id_col, text_col)
    return df.filter(quality_score(F.col(text_col).cast("string"), model) >= THRESHOLD)
