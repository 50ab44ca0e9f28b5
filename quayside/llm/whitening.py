"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Vectors become whole numbers, and each distinct one is fitted once. A step multiplies the
centred rows by a right vector and the outcome by the rows' transpose, in one pass over the
table; both sides are orthogonalised against all earlier vectors. A left vector has a
value per row and is never stored: a task finds those of its rows from the right vectors and
the coefficients so far. The singular vectors of the small bidiagonal matrix give the
components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import drop_scratch, materialize

COMPONENTS, SCALE, OFFSET = 16, 64, 1_000_000
#: Entries beyond this have no exact place among whole numbers; such a vector takes no part.
LARGEST = float(1 << 53)
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
BLOCK = 4_096  # rows
#: A deviation below this share of the first is rounding, as are coefficients below ``CLOSED``.
NO_VARIANCE, CLOSED = 1e-10, 1e-13


def whole_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, x): ``floor(64 * c) + 1000000`` of each entry of each usable vector."""
    scaled = F.transform(F.col(vector_col), lambda c: F.floor(c.cast("double") * SCALE))
    usable = F.forall(F.col(vector_col), lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double") * SCALE) < LARGEST))
    rows = df.filter(F.col(vector_col).isNotNull()).filter((F.size(vector_col) > 0) & usable)
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(scaled, lambda c: c.cast("long") + OFFSET).alias("x"))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def summed(rows: DataFrame, add: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
    """The sum over all rows' blocks of ``add(block of x)``, a short vector: each task sums
    its own, the sums meet by place, and the driver gets one number a place. Whole numbers
    are summed as decimals, exactly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            x = matrix(batch.column(0))
            for lo in range(0, len(x), BLOCK):
                part = add(x[lo : lo + BLOCK])
                total = part if total is None else total + part
        if total is not None:
            values = pa.array(total) if kind == "double" else pa.array([Decimal(int(v)) for v in total], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), values], names=["place", "value"])

    got = rows.select("x").mapInArrow(run, f"place long, value {kind}").groupBy("place").agg(F.sum("value").alias("value")).toArrow().sort_by("place")
    return got["value"].to_numpy() if kind == "double" else np.array([int(v) for v in got["value"].to_pylist()], object)


def scattered(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n x - S, exact: Python's numbers where a long might not hold it."""
    top = max(int(np.abs(x).max()) if x.size else 0, 1)
    if n * top < 1 << 61:
        return n * x - sums.astype(np.int64)
    return n * x.astype(object) - sums


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S/n, rounded once."""
    return (scattered(x, n, sums) / n).astype(np.float64)


class Bidiagonal:
    """The state of the process: right vectors, the coefficients of ``X V = U R`` (R is upper
    bidiagonal but for corrections of rounding) and the products of the rows' transpose with
    the left vectors."""

    def __init__(self, n: int, sums: np.ndarray, steps: int) -> None:
        self.n, self.sums, self.steps = n, sums, steps
        self.v = np.zeros((len(sums), 0))
        self.r = np.zeros((0, 0))
        self.back = np.zeros((len(sums), 0))
        self.beta: list[float] = []

    def lefts(self, y: np.ndarray, upto: int) -> np.ndarray:
        """The first ``upto`` left vectors at the centred rows ``y``, by substitution."""
        p, u = y @ self.v[:, :upto], np.zeros((len(y), upto))
        for k in range(upto):
            if self.r[k, k]:
                u[:, k] = (p[:, k] - u[:, :k] @ self.r[:k, k]) / self.r[k, k]
        return u

    def fresh(self) -> np.ndarray | None:
        """A direction orthogonal to all right vectors, the same in every run."""
        for seed in range(8):
            v = self.orthogonal(np.random.default_rng(1000 * self.v.shape[1] + seed).standard_normal(len(self.sums)))
            if np.linalg.norm(v) > 1e-3:
                return v / np.linalg.norm(v)
        return None

    def orthogonal(self, v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - self.v @ (self.v.T @ v)
        return v

    def step(self, fit: DataFrame) -> bool:
        """One right and one left vector more; False if there is no direction left."""
        k, d = self.v.shape[1], len(self.sums)
        beta, v = 0.0, None
        if k:
            v = self.orthogonal(self.back[:, -1] - self.r[-1, -1] * self.v[:, -1])
            beta = float(np.linalg.norm(v))
        if v is None or beta <= CLOSED * self.size():
            beta, v = 0.0, self.fresh()  # the space so far is closed
        else:
            v = v / beta
        if v is None:
            return False
        self.v = np.column_stack([self.v, v])
        column = np.zeros(k + 1)
        if k:
            column[k - 1] = beta

        def products(x: np.ndarray) -> np.ndarray:
            y = centred(x, self.n, self.sums)
            u = self.lefts(y, k)
            new = y @ v - u @ column[:k]
            return np.concatenate([y.T @ new, u.T @ new, [new @ new]])

        got = summed(fit, products)
        back, over, square = got[:d], got[d : d + k], got[-1]
        column[:k] += over  # the new left vector without its part along the earlier ones
        alpha = float(np.sqrt(max(0.0, square - over @ over)))
        back = back - self.back @ over
        if alpha <= CLOSED * max(self.size(), float(np.sqrt(square)), beta):
            alpha, back = 0.0, np.zeros(d)
        column[k] = alpha
        grown = np.zeros((k + 1, k + 1))
        grown[:k, :k], grown[:, k] = self.r, column
        self.r, self.back = grown, np.column_stack([self.back, back / alpha if alpha else back])
        self.beta.append(beta)
        return True

    def size(self) -> float:
        return float(np.abs(self.r).max()) if self.r.size else 0.0

    def components(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """(d x c, c): components by falling variance, and their variances. One of no
        variance, next to the first, is left out."""
        small = np.diag(np.diag(self.r)) + np.diag(self.beta[1:], 1)
        _, sigma, right = np.linalg.svd(small)
        keep = sigma > NO_VARIANCE * max(sigma[0], 1e-300)
        out = self.v @ right.T[:, keep][:, :most]
        return out / np.linalg.norm(out, axis=0), sigma[keep][:most] ** 2 / self.n


def bidiagonalise(fit: DataFrame, n: int, sums: np.ndarray, steps: int | None = None) -> Bidiagonal:
    """As many steps as vectors have entries: every variance is found, equal ones too.
    ``steps`` bounds them for long vectors, whose leading components settle far earlier."""
    state = Bidiagonal(n, sums, min(steps or len(sums), len(sums)))
    while state.v.shape[1] < state.steps and state.step(fit):
        pass
    return state


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """Sum of (n x - S)^2, exact; null if beyond a long."""
    z = scattered(x, n, sums)
    top = int(np.abs(z).max()) if z.size else 0
    if top * top * max(1, z.shape[1]) < 1 << 63:
        z = z.astype(np.int64)
        return pa.array((z * z).sum(1))
    exact = [sum(int(v) ** 2 for v in row) for row in z]
    return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, steps: int | None = None) -> DataFrame:
    """One row per usable row and component: vec_id, component (from 1), n (distinct vectors),
    deviation (sum of squared n x - S), whitened (the centred vector's projection over the
    component's deviation), explained (its share of all variance) and identity_error (largest
    entry by which the whitened vectors' covariance differs from the identity).

    A vector that is null or empty or holds null, non-finite or enormous entries (2**53 when
    scaled) takes no part, nor does one whose length is not the commonest (of two, the
    longer). Repeated vectors count once in the fit and each get rows; a null id stays null.
    Components without variance are not returned, so a table of equal vectors, or an empty
    one, gives no rows. Deviations beyond a long are null. Other columns are ignored.
    """
    spark = df.sparkSession
    rows = whole_vectors(df, id_col, vector_col)
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if lengths is None:
        return spark.createDataFrame([], RESULT)
    rows = rows.filter(F.size("x") == lengths["d"])
    fit = materialize(rows.select("x").distinct(), "distinct")
    counts = summed(fit, lambda x: np.append(x.astype(object).sum(0), len(x)) if np.abs(x).max() > 1 << 50 else np.append(x.sum(0), len(x)), "decimal(38,0)")
    n, sums = int(counts[-1]), counts[:-1]
    basis, variance = bidiagonalise(fit, n, sums, steps).components(components)
    c = len(variance)
    if not c:
        drop_scratch(fit)
        return spark.createDataFrame([], RESULT)
    scale = np.sqrt(variance)

    def moments(x: np.ndarray) -> np.ndarray:
        y = centred(x, n, sums)
        w = y @ basis / scale
        return np.concatenate([(w.T @ w).ravel(), w.sum(0), [(y * y).sum()]])

    got = summed(fit, moments)
    mean, trace = got[c * c : c * c + c] / n, got[-1] / n
    error = float(np.abs(got[: c * c].reshape(c, c) / n - np.outer(mean, mean) - np.eye(c)).max())
    explained = variance / trace
    drop_scratch(fit)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(1))
            w, m = centred(x, n, sums) @ basis / scale, len(x)
            each = pa.array(np.repeat(np.arange(m), c))
            columns = [batch.column(0).take(each), np.tile(np.arange(1, c + 1, dtype=np.int32), m), np.full(m * c, n), deviations(x, n, sums).take(each), w.ravel(), np.tile(explained, m), np.full(m * c, error)]
            yield pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v) for v in columns], names=[f.split(" ")[0] for f in RESULT.split(", ")])

    return rows.mapInArrow(project, RESULT)
