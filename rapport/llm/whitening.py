"""Whitening of embeddings: leading components by Golub-Kahan-Lanczos bidiagonalisation.

The centred rows X, as integers less their mean, stay in the cluster. Each step multiplies X
with a vector v and X transposed with the resulting left vector u; both are kept orthogonal to
all earlier ones. A left vector has an entry per row and is never stored: as it lies in the
range of X, it is kept as the short vector p with u = Xp, and its entries are formed again in
the tasks that need them. So one pass over the rows gives both products of a step, and only
sums over rows come back, as many as the rows have dimensions.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rapport.sources.sinks import stored

# Entries become whole numbers: this many to one, less nothing below this.
SCALE, SHIFT = 1024, 100_000
# Scaled entries lie within plus and minus this.
LARGEST = 2**52
# Up to this width all steps are made; wider tables stop when the leading components stand still.
ALL_STEPS = 256
# A singular value below this share of the largest one is zero.
RANK = 1e-9
# A step that leaves less than this share of the largest singular value has left nothing.
NOTHING = 1e-12
SEED = 13


@dataclass(frozen=True)
class Centre:
    """Number of rows and sums per dimension, exact."""

    n: int
    sums: list[int]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """Rows less their mean: the whole part of the mean is taken off as whole numbers."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n / self.n for s in self.sums])
        return (x - whole) - rest

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sum over dimensions of (n x - S)^2 per row; null where a long cannot hold it.

        Sums of 64-bit numbers are right modulo 2^64, so they are exact where the rounded
        result shows that the exact one fits.
        """
        whole = [s // self.n for s in self.sums]
        rest = np.array([s % self.n for s in self.sums], np.int64)
        near = x - np.array(whole, np.int64)
        about = near.astype(np.float64) * self.n - rest
        with np.errstate(over="ignore"):
            exact = near * np.int64(self.n) - rest
            total = (exact * exact).sum(axis=1, dtype=np.int64)
        fits = (about * about).sum(axis=1) < 9.2e18
        return pa.array(total, mask=~fits)


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix."""
    if not len(column):
        return np.empty((0, 0), np.int64)
    return column.flatten().to_numpy().reshape(len(column), -1)


def whole_rows(vectors: DataFrame) -> DataFrame:
    """Vectors as whole numbers: (vec_id, x).

    Rows whose vector is null, empty or holds a null, infinite or undefined entry are left out,
    and so are vectors of another length than most (of equally frequent lengths the shorter).
    """
    fine = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where(fine & (F.size("embedding") > 0))
    widths = rows.groupBy(F.size("embedding").alias("width")).agg(F.count(F.lit(1)).alias("n"))
    most = widths.orderBy(F.desc("n"), "width").first()
    rows = rows.where(F.size("embedding") == (most.width if most else 0))

    def run(batches):
        for batch in batches:
            values = batch.column(1).flatten().to_numpy()
            scaled = np.clip(np.floor(SCALE * values), -LARGEST, LARGEST).astype(np.int64) + SHIFT
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1) * (most.width if most else 0), pa.int32()), pa.array(scaled))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["vec_id", "x"])

    return rows.mapInArrow(run, "vec_id long, x array<long>")


def centre_of(rows: DataFrame) -> Centre:
    """Exact sums: tasks add whole numbers of any size, and so does Spark, as decimals."""

    def run(batches):
        n, sums = 0, None
        for batch in batches:
            x = matrix(batch.column(0))
            if len(x):
                # High and low halves of the numbers cannot overflow in a batch.
                part = [int(h) * 2**26 + int(w) for h, w in zip((x >> 26).sum(axis=0), (x & (2**26 - 1)).sum(axis=0))]
                sums = part if sums is None else [a + b for a, b in zip(sums, part)]
                n += len(x)
        values = [n, *(sums or [])]
        if n:
            totals = pa.array([Decimal(v) for v in values], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(values) - 1), pa.int32()), totals], ["dimension", "total"])

    parts = rows.select("x").mapInArrow(run, "dimension int, total decimal(38,0)")
    found = {r.dimension: int(r.total) for r in parts.groupBy("dimension").agg(F.sum("total").alias("total")).collect()}
    return Centre(found.get(-1, 0), [found[k] for k in range(len(found) - 1)])


def summed(rows: DataFrame, centre: Centre, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all rows of a function from a block of centred rows to a short vector.

    Each task sends one vector, Spark adds them by place, and the driver gets one vector.
    """

    def run(batches):
        total = None
        for batch in batches:
            x = matrix(batch.column(0))
            if len(x):
                part = of(centre.centred(x))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["place", "value"])

    parts = rows.select("x").mapInArrow(run, "place int, value double")
    found = parts.groupBy("place").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(len(found))
    for r in found:
        out[r.place] = r.value
    return out


def products(p: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """Of a block X: X'(Xp), then the square of |Xp| and that of |X|."""

    def of(x: np.ndarray) -> np.ndarray:
        left = x @ p
        return np.concatenate((left @ x, [left @ left, np.einsum("ij,ij->", x, x)]))

    return of


def orthogonal(vector: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """``vector`` less its part along orthonormal ``others``, taken off twice for rounding."""
    if others:
        basis = np.array(others)
        for _ in range(2):
            vector = vector - basis.T @ (basis @ vector)
    return vector


@dataclass(frozen=True)
class Components:
    """Unit vectors in columns, the eigenvalues of the covariance, and its trace."""

    vectors: np.ndarray
    values: np.ndarray
    trace: float


def bidiagonalise(apply: Callable[[np.ndarray], np.ndarray], width: int, n: int, wanted: int) -> Components:
    """Leading components of n centred rows X of some width.

    ``apply`` is a pass over the rows: from p to X'Xp, |Xp|^2 and |X|^2. Up to a width of
    ``ALL_STEPS`` as many steps are made as there are dimensions; where a step leaves nothing, a
    new direction is drawn, so eigenvalues that repeat are found as often as they do. Wider
    tables stop once the wanted components have a residual of rounding size: there an eigenvalue
    that repeats exactly may be found once only.
    """
    rng = np.random.default_rng(SEED)
    right: list[np.ndarray] = []  # v
    left: list[np.ndarray] = []  # p, with u = Xp
    back: list[np.ndarray] = []  # X'u
    alphas: list[float] = []
    betas: list[float] = []
    v, trace, largest = rng.normal(size=width), 0.0, 0.0
    v /= np.linalg.norm(v)
    while True:
        # u = Xv less its part along the u before; their products with it follow from X'u.
        p = v.copy()
        for _ in range(2):
            along = [w @ p for w in back]
            p = p - sum((a * q for a, q in zip(along, left)), np.zeros(width))
        found = apply(p)
        trace = found[width + 1]
        alpha = float(np.sqrt(max(found[width], 0.0)))
        largest = max(largest, alpha)
        right.append(v)
        if alpha > NOTHING * max(largest, trace**0.5 * NOTHING):
            left.append(p / alpha)
            back.append(found[:width] / alpha)
            rest = orthogonal(back[-1], right)
        else:
            alpha = 0.0
            left.append(np.zeros(width))
            back.append(np.zeros(width))
            rest = np.zeros(width)
        alphas.append(alpha)
        beta = float(np.linalg.norm(rest))
        if len(right) == width:
            break
        if beta <= NOTHING * largest:
            beta = 0.0
            rest = orthogonal(rng.normal(size=width), right)
        betas.append(beta)
        v = orthogonal(rest / np.linalg.norm(rest), right)
        v /= np.linalg.norm(v)
        if width > ALL_STEPS and len(right) >= 2 * wanted:
            u, s, _ = np.linalg.svd(np.diag(alphas) + np.diag(betas[:-1], 1))
            if (beta * np.abs(u[-1, :wanted]) <= 1e-14 * s[0]).all():
                break
    k = len(right)
    _, s, turned = np.linalg.svd(np.diag(alphas) + np.diag(betas[: k - 1], 1))
    keep = [i for i in range(min(wanted, k)) if s[i] > RANK * s[0]]
    vectors = np.array(right).T @ turned[keep].T
    vectors /= np.linalg.norm(vectors, axis=0)
    return Components(vectors, s[keep] ** 2 / n, trace / n)


def whiten(vectors: DataFrame, wanted: int = 8) -> DataFrame:
    """Whitened coordinates of every vector: a row per vector and component.

    Entries c become x = floor(1024 c) + 100000, at most 2^52 in size before the shift. Returns
    (vec_id, component, n, deviation, whitened, explained, identity_error): ``n`` vectors were
    fitted, all that remain; ``deviation`` is the sum over dimensions of (n x - S)^2, null where
    a long cannot hold it; ``whitened`` is the centred vector's product with the component over
    the root of its eigenvalue; ``explained`` the eigenvalue's share of the trace;
    ``identity_error`` the largest entry of the whitened coordinates' covariance less the
    identity. Components go by falling eigenvalue, from 1 to ``wanted`` or the rank if that is
    less: vectors that are all equal have none, and so no rows come back.

    Left out is what ``whole_rows`` leaves out. Rows that repeat count as often; a null id stays
    null; other columns are not read.
    """
    rows = stored(whole_rows(vectors), "whole-vectors")
    centre = centre_of(rows)
    width = len(centre.sums)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not centre.n:
        return rows.sparkSession.createDataFrame([], schema)
    found = bidiagonalise(lambda p: summed(rows, centre, products(p)), width, centre.n, wanted)
    scaled = found.vectors / np.sqrt(found.values)
    many = len(found.values)
    if not many:
        return rows.sparkSession.createDataFrame([], schema)
    mean = summed(rows, centre, lambda x: (x @ scaled).sum(axis=0)) / centre.n

    def spread(x: np.ndarray) -> np.ndarray:
        y = x @ scaled - mean
        return (y.T @ y).ravel()

    covariance = summed(rows, centre, spread).reshape(many, many) / centre.n
    error = float(np.abs(covariance - np.eye(many)).max())
    explained = found.values / found.trace

    def run(batches):
        for batch in batches:
            x = matrix(batch.column(1))
            if not len(x):
                continue
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(len(x)), many)))
            size = len(x) * many
            deviation = centre.deviations(x).take(pa.array(np.repeat(np.arange(len(x)), many)))
            columns = [ids, np.tile(np.arange(1, many + 1, dtype=np.int32), len(x)), np.full(size, centre.n), deviation,
                       (centre.centred(x) @ scaled).ravel(), np.tile(explained, len(x)), np.full(size, error)]
            names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)

    return rows.mapInArrow(run, schema)
