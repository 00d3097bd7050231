"""Nearest neighbours by randomly rotated one-bit codes.

A vector's direction from the centre is rotated at random and only the signs are kept, packed into bytes, with two
scalars: its distance from the centre, and how well the signs fit the direction. Out of these the inner product
with a query is estimated without bias, with an error bound; only candidates whose best possible distance is not
beyond the distance that is already reached get their distance from the original vectors.

All rows are coded and searched. Queries and candidates meet in blocks of bounded size; a block keeps the nearest
few of each query, and those of all blocks are merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import saved

ROWS = 4096  # candidates in a block
QUERIES = 512  # queries in a block


def _rotation(dim: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)


def usable(vector: Column) -> Column:
    """Not null, not zero, and without null or non-finite components."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                      & F.exists(vector, lambda x: x != 0), F.lit(False))


class Index(NamedTuple):
    """``rows``: ``rid, vec_id, vec, code, radius, fit`` for each vector that takes part."""

    rows: DataFrame
    dim: int
    centre: np.ndarray
    seed: int


def index(table: DataFrame, *, vector: str = "embedding", seed: int = 1) -> Index:
    """Codes of all vectors, written once.

    Rows without an id, unusable vectors and vectors of another length than most take no part.
    """
    vec = table[f"`{vector}`"].cast("array<double>")
    rows = table.select(table["vec_id"].cast("long").alias("vec_id"), vec.alias("vec")).where(
        F.col("vec_id").isNotNull() & usable(F.col("vec")))
    rows = saved(rows.select(F.monotonically_increasing_id().alias("rid"), "vec_id", "vec", F.size("vec").alias("dim")),
                 "vectors")
    common = rows.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    schema = "rid long, vec_id long, vec array<double>, code binary, radius double, fit double"
    if common is None:
        return Index(table.sparkSession.createDataFrame([], schema), 0, np.empty(0), seed)
    dim = common["dim"]
    rows = rows.where(F.col("dim") == dim).drop("dim")
    centre = np.array(rows.agg(*[F.avg(F.col("vec")[i]) for i in range(dim)]).first(), dtype=np.float64)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = _rotation(dim, seed)
        for batch in batches:
            vecs = _matrix(pa.chunked_array([batch.column("vec")]), dim) - centre
            radius = np.linalg.norm(vecs, axis=1)
            turned = (vecs / np.where(radius > 0, radius, 1)[:, None]) @ turn.T
            bits = np.packbits(turned > 0, axis=1)
            fit = np.abs(turned).sum(axis=1) / np.sqrt(dim)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([b.tobytes() for b in bits], pa.binary()), pa.array(radius), pa.array(fit)],
                [*batch.schema.names, "code", "radius", "fit"])

    return Index(saved(rows.mapInArrow(code, schema), "vector-codes"), dim, centre, seed)


def nearest(of: Index, queries: Column, *, k: int = 10, epsilon: float = 3.0) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of least Euclidean distance to each row that is a query.

    A row is no neighbour of itself; equal distances go to the smaller id. ``epsilon`` is the width of the error
    bound in standard deviations of the estimate. Repeated rows are rows of their own.
    """
    schema = "query_id long, query_rid long, vec_id long, rid long, score double"
    coded, dim, centre, seed = of
    asked = coded.where(queries)
    n, m = coded.count(), asked.count()
    if not n or not m:
        return coded.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    chunks, blocks = -(-n // ROWS), -(-m // QUERIES)

    def spread(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    def dealt(count: int) -> Column:
        return F.pmod(F.xxhash64("rid"), F.lit(count)).cast("int")

    left = coded.select("*", dealt(chunks).alias("chunk"), spread(blocks).alias("block"))
    right = asked.select("rid", "vec_id", "vec", dealt(blocks).alias("block"), spread(chunks).alias("chunk"))

    def search(rows: pa.Table, ask: pa.Table) -> pa.Table:
        names = ["query_id", "query_rid", "vec_id", "rid", "score"]
        if not rows.num_rows or not ask.num_rows:
            return pa.table({n: pa.array([], pa.float64() if n == "score" else pa.int64()) for n in names})
        vecs, wanted = _matrix(rows["vec"], dim), _matrix(ask["vec"], dim)
        rid, vec_id = rows["rid"].to_numpy(), rows["vec_id"].to_numpy()
        radius, fit = rows["radius"].to_numpy(), rows["fit"].to_numpy()
        packed = np.frombuffer(b"".join(rows["code"].to_pylist()), dtype=np.uint8).reshape(len(rid), -1)
        signs = np.unpackbits(packed, axis=1)[:, :dim].astype(np.float64) * 2 - 1
        fit = np.where(fit > 0, fit, 1.0)
        error = np.sqrt(np.maximum(0, 1 - fit * fit)) / fit * epsilon / np.sqrt(max(1, dim - 1))
        turn, parts = _rotation(dim, seed), []
        for j, (q, own) in enumerate(zip(wanted, ask["rid"].to_numpy())):
            at = q - centre
            size = np.linalg.norm(at)
            dot = signs @ (turn @ at) / np.sqrt(dim) / fit  # size times the estimate
            far = radius * radius + size * size - 2 * radius * dot
            far[rid == own] = np.inf
            low = far - 2 * radius * size * error

            def exact(some: np.ndarray) -> np.ndarray:
                total = np.zeros(len(some))
                for away in (vecs[some] - q).T:  # one component after the other, so that sums never differ in a digit
                    total += away * away
                return np.sqrt(total)

            few = min(len(far), 4 * k)
            first = np.argpartition(far, few - 1)[:few]
            first = first[rid[first] != own]
            reached = np.sort(exact(first))[min(k, len(first)) - 1] if len(first) >= k else np.inf
            some = np.flatnonzero((low <= reached * reached * (1 + 1e-9)) & (rid != own))
            score = exact(some)
            best = np.lexsort((rid[some], vec_id[some], score))[:k]
            parts.append((np.full(len(best), j), some[best], score[best]))
        j, some, score = (np.concatenate(x) for x in zip(*parts))
        return pa.table({"query_id": ask["vec_id"].to_numpy()[j], "query_rid": ask["rid"].to_numpy()[j],
                         "vec_id": vec_id[some], "rid": rid[some], "score": score})

    found = left.groupBy("chunk", "block").cogroup(right.groupBy("chunk", "block")).applyInArrow(search, schema)
    order = Window.partitionBy("query_id", "query_rid").orderBy("score", "vec_id", "rid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
