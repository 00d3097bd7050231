"""Embedding whitening: principal components by spectral divide and conquer.

Entries become whole numbers first, so that sums and sums of products are exact and do not depend on partitions. The
covariance of the distinct vectors, a matrix of the vectors' length, is all that reaches the driver. Its components come
from polar decompositions: the polar factor of a shifted covariance, by QR- and Cholesky-based dynamically weighted Halley
steps, is its matrix sign; the spectral projector made of it splits the space into the invariant subspaces above and below
the shift, and each is split again until they are single components. All rows are then projected with the components.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import saved

SCALE = 64
OFFSET = 1_000_000
LARGEST = float(1 << 46)  # entries beyond have no whole number that sums hold
COMPONENTS = 16
EPS = np.finfo(np.float64).eps


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix that isn't singular."""
    n = len(a)
    x = a / np.linalg.norm(a)
    r = np.linalg.qr(x, mode="r")
    low = EPS
    if np.abs(np.diag(r)).min() > EPS:
        low = min(1.0, max(EPS, 1 / np.linalg.norm(np.linalg.inv(r))))
    for _ in range(60):
        square = low * low
        d = np.cbrt(4 * max(0.0, 1 - square) / square ** 2)
        root = np.sqrt(1 + d)
        p = root + np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - square) / (square * root))) / 2
        q = (p - 1) ** 2 / 4
        s = p + q - 1
        if s > 100:
            both = np.linalg.qr(np.vstack([np.sqrt(s) * x, np.eye(n)]))[0]
            new = q / s * x + (p - q / s) / np.sqrt(s) * both[:n] @ both[n:].T
        else:
            new = q / s * x + (p - q / s) * np.linalg.solve(np.eye(n) + s * x.T @ x, x.T).T
        new = (new + new.T) / 2
        moved, x = np.linalg.norm(new - x), new
        low = min(1.0, low * (p + q * square) / (1 + s * square))
        if abs(1 - low) < 10 * EPS and moved < np.cbrt(EPS):
            break
    return x


def _split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of two invariant subspaces of a symmetric matrix, of its larger and smaller eigenvalues; none if they're equal."""
    n, size = len(a), np.linalg.norm(a)
    off = np.linalg.norm(a - np.eye(n) * np.trace(a) / n)
    if off <= EPS * size * n:
        return None
    mean = np.trace(a) / n
    tries = [np.median(np.diag(a)), mean, *(mean + off / n * t for t in (0.1, -0.1, 0.03, -0.03, 0.3, -0.3))]
    for shift in tries:
        above = (polar(a - shift * np.eye(n)) + np.eye(n)) / 2
        k = int(round(np.trace(above)))
        if not 0 < k < n or np.linalg.norm(above @ above - above) > 1e-8:
            continue  # all on one side, or an eigenvalue at the shift
        basis = above @ np.random.default_rng(n).standard_normal((n, k))
        for _ in range(3):
            full = np.linalg.qr(basis, mode="complete")[0]
            one, two = full[:, :k], full[:, k:]
            if np.linalg.norm(two.T @ a @ one) <= 10 * n * EPS * size:
                break
            basis = above @ one
        return one, two
    return None


def _refined(a: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and vectors, corrected twice in extended precision against what rounding left."""
    wide = a.astype(np.longdouble)
    x = v.astype(np.longdouble)
    for _ in range(2):
        miss = np.eye(len(x), dtype=np.longdouble) - x.T @ x
        s = x.T @ (wide @ x)
        e = np.diag(s) / (1 - np.diag(miss))
        gap = e[None, :] - e[:, None]
        noise = 2 * (np.sqrt(((s - np.diag(e)) ** 2).sum()) + np.abs(e).max() * np.sqrt((miss ** 2).sum()))
        apart = np.abs(gap) > max(noise, len(x) * EPS * np.abs(e).max())
        x = x + x @ np.where(apart, (s + e[None, :] * miss) / np.where(apart, gap, 1), miss / 2)
    return e.astype(np.float64), x.astype(np.float64)


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns; their largest entries are positive."""
    parts, done = [(np.asarray(a, dtype=np.float64), np.eye(len(a)))], []
    while parts:
        block, basis = parts.pop()
        halves = _split(block) if len(block) > 1 else None
        if halves is None:
            done.append(basis)
        else:
            parts += [((q.T @ block @ q + (q.T @ block @ q).T) / 2, basis @ q) for q in halves]
    e, v = _refined(a, np.hstack(done))
    order = np.argsort(-e, kind="stable")
    e, v = e[order], v[:, order]
    top = v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])]
    return e, v * np.where(top < 0, -1, 1)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _summed(parts: DataFrame, size: int) -> list:
    """Sums of ``(k, v)`` rows by ``k`` below ``size``: as many values, whatever the number of rows."""
    found = {r["k"]: r["v"] for r in parts.groupBy("k").agg(F.sum("v").alias("v")).collect()}
    return [found.get(k, 0) for k in range(size)]


def _products(y: np.ndarray) -> np.ndarray:
    """The whole-number products ``y.T @ y``, exact, as Python integers."""
    most = max(1, int(np.abs(y).max(initial=0)))
    if most >= 1 << 26:
        wide = y.astype(object)
        return wide.T @ wide
    total, step = 0, max(1, (1 << 53) // (most * most))  # within a step, doubles hold every sum exactly
    for lo in range(0, max(1, len(y)), step):
        some = y[lo:lo + step].astype(np.float64)
        total = total + (some.T @ some).astype(np.int64).astype(object)
    return total


class Whitening(NamedTuple):
    """What projects vectors: length, number and sums of the fit list, components, eigenvalues, their shares, the check."""

    dim: int
    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float


def fit(rows: DataFrame, dim: int, components: int = COMPONENTS) -> Whitening | None:
    """The components of the distinct vectors ``x``; none if there is no vector, or all are equal."""
    distinct = saved(rows.select("x").distinct(), "whitening-fit")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dim + 1, dtype=object)
        for batch in batches:
            x = _matrix(batch.column(0), dim)
            total[:dim] += x.sum(axis=0, dtype=np.int64)
            total[dim] += len(x)
        yield _pairs(total)

    def _pairs(total) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()),
                                           pa.array([Decimal(int(v)) for v in total], pa.decimal128(38, 0))], ["k", "v"])

    sums = [int(v) for v in _summed(distinct.mapInArrow(add, "k int, v decimal(38,0)"), dim + 1)]
    n = sums.pop()
    if not n or not dim:
        return None
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], dtype=np.int64)  # the nearest whole numbers
    upper = np.triu_indices(dim)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(upper[0]), dtype=object)
        for batch in batches:
            total += _products(_matrix(batch.column(0), dim) - centre)[upper]
        yield _pairs(total)

    products = [int(v) for v in _summed(distinct.mapInArrow(multiply, "k int, v decimal(38,0)"), len(upper[0]))]
    rest = [s - n * int(c) for s, c in zip(sums, centre)]  # sums of the centred vectors
    cov = np.zeros((dim, dim))
    for i, j, p in zip(*upper, products):
        cov[i, j] = cov[j, i] = float(Fraction(n * p - rest[i] * rest[j], n * n))
    trace = float(Fraction(sum(n * p - rest[i] * rest[j] for i, j, p in zip(*upper, products) if i == j), n * n))
    if trace <= 0:
        return None
    e, v = eigen(cov)
    some = min(components, int((e > 16 * dim * EPS * e[0]).sum()))
    out = Whitening(dim, n, sums, v[:, :some], e[:some], e[:some] / trace, 0.0)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((some + 1, some + 1))
        for batch in batches:
            w = whitened(out, _matrix(batch.column(0), dim))
            w = np.hstack([w, np.ones((len(w), 1))])
            total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.reshape(-1))], ["k", "v"])

    total = np.array(_summed(distinct.mapInArrow(again, "k int, v double"), (some + 1) ** 2)).reshape(some + 1, -1) / n
    mean = total[:some, some]  # next to nothing, as vectors are centred already
    return out._replace(identity_error=float(np.abs(total[:some, :some] - np.outer(mean, mean) - np.eye(some)).max()))


def _centred(of: Whitening, x: np.ndarray) -> np.ndarray:
    """``x - S/n``: the whole parts are taken off exactly."""
    whole_part = np.array([s // of.n for s in of.sums], dtype=np.int64)
    return (x - whole_part).astype(np.float64) - np.array([s % of.n / of.n for s in of.sums])


def whitened(of: Whitening, x: np.ndarray) -> np.ndarray:
    return _centred(of, x) @ of.vectors / np.sqrt(of.values)


def deviations(of: Whitening, x: np.ndarray) -> list[int | None]:
    """The sums of ``(n*x - S)^2``, exact; none where 64 bits can't hold one."""
    most = max((abs(of.n * int(v) - s) for column, s in zip(x.T, of.sums) for v in (column.min(), column.max())), default=0)
    kind = np.int64 if of.dim * most * most < 1 << 63 else object
    away = x.astype(kind) * of.n - np.array(of.sums, dtype=kind)
    return [v if v < 1 << 63 else None for v in map(int, (away * away).sum(axis=1))]


def whiten(table: DataFrame, *, vector: str = "embedding", components: int = COMPONENTS, columns: list[str] | None = None) -> DataFrame:
    """``row, component, n, deviation, whitened, explained, identity_error`` for each row that remains and each component.

    Rows whose vector is null or holds null or non-finite entries take no part; nor do vectors of another length than
    most, and entries of 2^46 or more. Components of no variance are left out: equal vectors only, or one, give no rows.
    Repeated rows are rows of their own but one vector of the fit list. ``row`` has the columns named, or all.
    """
    vec = table[f"`{vector}`"].cast("array<double>")
    fits = F.forall(vec, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    fields = F.struct(*[table[f"`{c}`"] for c in (columns or table.columns)]).alias("row")
    rows = table.where(F.coalesce(fits, F.lit(False))).select(
        fields, F.transform(vec, lambda c: F.floor(c * SCALE).cast("long") + OFFSET).alias("x"))
    rows = saved(rows, "whitening-rows")
    common = rows.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    dim = common["dim"] if common else 0
    rows = rows.where(F.size("x") == dim)
    of = fit(rows, dim, components)
    schema = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    if of is None:
        return rows.where(F.lit(False)).select("row", *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in schema.split(", ")])
    some = len(of.values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                x = _matrix(part.column("x"), dim)
                yield pa.RecordBatch.from_arrays([
                    part.column("row").take(pa.array(np.repeat(np.arange(len(x)), some))),
                    pa.array(np.tile(np.arange(1, some + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(x) * some, of.n)),
                    pa.array([d for d in deviations(of, x) for _ in range(some)], pa.int64()),
                    pa.array(whitened(of, x).reshape(-1)), pa.array(np.tile(of.explained, len(x))),
                    pa.array(np.full(len(x) * some, of.identity_error))],
                    ["row", *(c.split()[0] for c in schema.split(", "))])

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(project, f"row {kind}, {schema}")
