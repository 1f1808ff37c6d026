"""Whitening against the eigenvectors of the whole covariance, and edge rows."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from rapport.llm import queries, whitening

SF = "/root/testdata/sf0.001"
KIND = "vec_id long, embedding array<float>, label int"


def plain(x, wanted=8):
    """Exact sums and deviations, and components by the whole covariance, of whole numbers."""
    n, sums = len(x), x.sum(axis=0)
    deviation = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums)) for row in x]
    centred = np.array([[float(Fraction(int(v)) - Fraction(int(s), n)) for v, s in zip(row, sums)] for row in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:wanted], vectors[:, ::-1][:, :wanted]
    return deviation, centred @ vectors / np.sqrt(values), values / (centred**2).sum() * n


def compared(found, ids, x, wanted=8):
    found = found.sort_values(["vec_id", "component"])
    deviation, whitened, explained = plain(x, wanted)
    got = found.whitened.to_numpy().reshape(len(ids), -1)
    assert found.vec_id.to_numpy().reshape(got.shape)[:, 0].tolist() == ids and (found.n == len(ids)).all()
    assert found.deviation.to_numpy().reshape(got.shape)[:, 0].tolist() == deviation
    signs = np.sign((got * whitened).sum(axis=0))
    assert np.allclose(got, whitened * signs, atol=1e-8)
    assert np.allclose(found.explained.to_numpy().reshape(got.shape)[0], explained, rtol=1e-10)
    assert found.identity_error.nunique() == 1 and found.identity_error.iloc[0] < 1e-9


def test_op13_query_equals_the_whole_covariance(spark):
    data = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas().sort_values("vec_id")
    x = np.floor(1024 * np.stack(data.embedding.to_numpy()).astype(float)).astype(np.int64) + 100_000
    compared(queries.op13_whitening(spark, SF).toPandas(), data.vec_id.tolist(), x)


def made(spark, x, **more):
    rows = [(i, v, None) for i, v in enumerate(x.tolist())]
    return spark.createDataFrame(rows, KIND.replace("float", more.get("kind", "double")))


def test_few_dimensions_and_steep_spectra(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 5)) * [100, 10, 1, 0.1, 0.05] + 7
    found = whitening.whiten(made(spark, x), 3).toPandas()
    compared(found, list(range(300)), np.floor(1024 * x).astype(np.int64) + 100_000, 3)



@pytest.mark.parametrize("shape", ["plain", "repeated", "flat", "low rank", "one row", "wide", "zero"])
def test_bidiagonalisation(shape):
    rng = np.random.default_rng(5)
    base = np.linalg.qr(rng.normal(size=(400, 20)))[0]
    spread = {"repeated": [9.0] * 4 + [3.0] * 3 + [1.0] * 13, "flat": [2.0] * 20, "low rank": [5.0, 4, 3] + [0] * 17}
    x = base * spread.get(shape, np.linspace(10, 1, 20)) @ np.linalg.qr(rng.normal(size=(20, 20)))[0]
    if shape == "one row":
        x = x[:1]
    if shape == "zero":
        x = np.zeros((10, 20))
    if shape == "wide":
        x = rng.normal(size=(500, 300)) * np.linspace(10, 1, 300) ** 2
    found = whitening.bidiagonalise(lambda p: whitening.products(p)(x), x.shape[1], len(x), 8)
    values, vectors = np.linalg.eigh(x.T @ x / len(x))
    rank = min(8, np.linalg.matrix_rank(x) if x.any() else 0)
    assert len(found.values) == rank and np.allclose(found.values, values[::-1][:rank], rtol=1e-10)
    assert np.allclose(found.vectors.T @ found.vectors, np.eye(rank), atol=1e-10)
    assert np.allclose(x.T @ x / len(x) @ found.vectors, found.vectors * found.values, atol=1e-9 * max(1, values[-1]))
    assert math.isclose(found.trace, values.sum(), rel_tol=1e-10, abs_tol=1e-12)


def test_deviations_that_no_long_holds_are_null():
    x = np.array([[1, 2], [3 * 10**15, 5], [4, 4]], np.int64)
    centre = whitening.Centre(3, [int(v) for v in x.sum(axis=0)])
    exact = [sum((3 * int(v) - s) ** 2 for v, s in zip(row, centre.sums)) for row in x]
    assert centre.deviations(x).to_pylist() == [None, None, None] and min(exact) > 2**63
    x = np.array([[1, 2], [3 * 10**8, 5], [4, 4]], np.int64)
    centre = whitening.Centre(3, [int(v) for v in x.sum(axis=0)])
    assert centre.deviations(x).to_pylist() == [sum((3 * int(v) - s) ** 2 for v, s in zip(row, centre.sums)) for row in x]


def test_odd_vectors(spark):
    rows = [
        (1, [0.5, 1.0, 2.0], 1),
        (1, [0.5, 1.0, 2.0], 1),
        (2, [1.5, -1.0, 0.25], None),
        (None, [0.125, 3.0, -2.0], 2),
        (3, None, 1),
        (4, [], 1),
        (5, [1.0, None, 2.0], 1),
        (6, [1.0, float("nan"), 2.0], 1),
        (7, [1.0, float("inf"), 2.0], 1),
        (8, [1.0, 2.0], 1),
        (9, [0.0, 0.0, 0.0], 1),
    ]
    df = spark.createDataFrame(rows, KIND)
    odd = df.select("*", *[F.lit(f"{c}!").alias(c) for c in ["x", "n", "component", "dimension", "total", "place", "value", "width", "a.b"]])
    found = whitening.whiten(odd).toPandas()
    kept = np.array([r[1] for k, r in enumerate(rows) if k in (0, 1, 2, 3, 10)])
    deviation, _, explained = plain(np.floor(1024 * kept).astype(np.int64) + 100_000, 3)
    assert len(found) == 15 and sorted(found.component.unique()) == [1, 2, 3] and found.vec_id.isna().sum() == 3
    assert sorted(found[found.component == 1].deviation) == sorted(deviation)
    assert np.allclose(found.groupby("component").explained.first(), explained)
    assert whitening.whiten(df.limit(0)).collect() == []
    assert whitening.whiten(df.where("vec_id = 1")).collect() == []
    assert whitening.whiten(df.where("vec_id in (3, 4, 5, 6, 7)")).collect() == []
    huge = spark.createDataFrame([(1, [1e300, 1.0], 1), (2, [-1e300, 2.0], 1), (3, [0.0, 5.0], 1)], KIND.replace("float", "double"))
    assert whitening.whiten(huge).where("component = 1 AND deviation IS NULL").count() == 2
