"""Whitened components against a plain eigendecomposition."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import whitening


def plain(vectors, components=16):
    x = np.floor(64 * np.asarray(vectors, dtype=np.float64)).astype(np.int64) + 1_000_000
    distinct = np.unique(x, axis=0)
    n, s = len(distinct), distinct.sum(axis=0)
    centred = distinct - s / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1][:components], v[:, ::-1][:, :components]
    return n, ((n * x - s) ** 2).sum(axis=1), (x - s / n) @ v / np.sqrt(e), e / (e.sum() if len(e) == x.shape[1] else np.trace(centred.T @ centred / n))


def run(spark, rows, **more):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, row string, x string, component int")
    return whitening.whiten(table.repartition(3), **more).select("row.vec_id", "row.x", *[
        F.col(c) for c in ("component", "n", "deviation", "whitened", "explained", "identity_error")]).toPandas()


@pytest.mark.parametrize("size", [3, 20, 40])
def test_equals_eigh(spark, size):
    rng = np.random.default_rng(size)
    vectors = (rng.standard_normal((600, size)) * np.linspace(0.2, 3, size)).astype(np.float32)
    vectors[100:220] = vectors[7]  # a hot vector is one of the fit list
    out = run(spark, [(i, v.tolist(), "r", f"x{i}", 0) for i, v in enumerate(vectors)])
    n, deviation, white, explained = plain(vectors)
    some = min(16, size)
    out = out.sort_values(["vec_id", "component"])
    assert len(out) == 600 * some and set(out["n"]) == {n} and (out["x"] == "x" + out["vec_id"].astype(str)).all()
    assert out["deviation"].tolist() == np.repeat(deviation, some).tolist()
    got = out["whitened"].to_numpy().reshape(600, some)
    signs = np.sign((got * white[:, :some]).sum(axis=0))
    assert np.abs(got * signs - white[:, :some]).max() < 1e-9
    assert np.allclose(out["explained"].to_numpy().reshape(600, some), explained[:some], rtol=1e-9)
    assert out["identity_error"].nunique() == 1 and out["identity_error"].iloc[0] < 1e-9


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i % 5), float(i * i % 7), 1.0], "", "", 0) for i in range(30)]
    bad = [(90, None), (91, [1.0, nan, 0.0]), (92, [inf, 0.0, 0.0]), (93, [1.0, None, 2.0]), (94, [1.0]), (95, []), (96, [1e30, 0.0, 0.0])]
    out = run(spark, good + [(None, [0.0, 0.0, 1.0], "", "", 0)] + [(i, v, "", "", 0) for i, v in bad])
    assert set(out["vec_id"].dropna()) == set(range(30)) and out["vec_id"].isna().sum() == 2
    assert set(out["component"]) == {1, 2}  # the last entry never varies


def test_no_variance_gives_no_rows(spark):
    assert run(spark, []).empty
    assert run(spark, [(1, [1.0, 2.0], "", "", 0)]).empty
    assert run(spark, [(i, [1.0, 2.0], "", "", 0) for i in range(4)]).empty
    assert run(spark, [(1, None, "", "", 0)]).empty


@pytest.mark.parametrize("values", [[3, 3, 1, 1, 1], [5, 4, 3, 2, 1], [1e8, 1, 1e-8], [2, 0, 0, 0], [1] * 6, np.linspace(1, 9, 30)])
def test_eigen_of_close_and_equal_values(values):
    values = np.asarray(values, dtype=float)
    q = np.linalg.qr(np.random.default_rng(3).standard_normal((len(values),) * 2))[0]
    a = q * values @ q.T
    a = (a + a.T) / 2
    e, v = whitening.eigen(a)
    assert np.allclose(e, np.sort(values)[::-1], atol=1e-14 * values.max())
    assert np.abs(v.T @ v - np.eye(len(e))).max() < 1e-12
    assert np.abs(a @ v - v * e).max() < 1e-14 * values.max() * len(e)


def test_polar_factor_is_the_sign():
    rng = np.random.default_rng(4)
    a = rng.standard_normal((25, 25))
    a = a + a.T
    e, v = np.linalg.eigh(a)
    assert np.abs(whitening.polar(a) - v * np.sign(e) @ v.T).max() < 1e-11


def test_sums_stay_exact_beyond_doubles():
    y = np.array([[1 << 40, 3], [-(1 << 40), 5], [7, 1 << 30]], dtype=np.int64)
    assert whitening._products(y).tolist() == [[int(sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j]))) for j in range(2)] for i in range(2)]
    of = whitening.Whitening(2, 10**9, [10**15, 0], np.eye(2), np.ones(2), np.ones(2), 0.0)
    assert whitening.deviations(of, np.array([[10**6, 0], [10**6 + 9, 1]])) == [0, None]
    assert whitening.deviations(of, np.array([[10**6, 1], [10**6 + 1, 0]])) == [10**18, 10**18]
