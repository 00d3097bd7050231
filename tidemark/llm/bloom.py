"""Bloom filters of bounded size: what they hold back need not be moved to be looked up exactly."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

BLOCK = 64  # bits that are tested together
BITS = 16  # per value
CHUNK = 4096  # blocks that are filled together
MOST_BYTES = 64 << 20


def bits(hashes: np.ndarray) -> np.ndarray:
    """The bits of each hash inside its block."""
    mask = np.zeros(hashes.shape, dtype=np.uint64)
    for shift in (0, 6, 12, 18):
        mask |= np.uint64(1) << (hashes >> np.uint64(shift) & np.uint64(63))
    return mask


def filled(marks: DataFrame, blocks: int) -> np.ndarray:
    """The filter made of ``chunk, block, mask`` rows, chunk by chunk in Spark. The driver gets ``blocks * 8`` bytes."""
    def fill(rows: pa.Table) -> pa.Table:
        part = np.zeros(CHUNK, dtype=np.uint64)
        np.bitwise_or.at(part, rows["block"].to_numpy(), rows["mask"].to_numpy().view(np.uint64))
        return pa.table({"chunk": rows["chunk"][:1], "filled": pa.array([part.tobytes()], pa.binary())})

    out = np.zeros((-(-blocks // CHUNK), CHUNK), dtype=np.uint64)
    for row in marks.groupBy("chunk").applyInArrow(fill, "chunk long, filled binary").collect():
        out[row["chunk"]] = np.frombuffer(row["filled"], dtype=np.uint64)
    return out.reshape(-1)


def among(values: DataFrame, key: str, most_bytes: int = MOST_BYTES):
    """A test for columns: false only for keys that are not in ``values``; true for all that are, and few others.

    A filter never exceeds ``most_bytes``; beyond its capacity it lets more through, but still all that are in.
    """
    spark, n = values.sparkSession, values.count()
    blocks = min(max(1, -(-n * BITS // BLOCK)), most_bytes // 8)

    def place(batches):
        for batch in batches:
            h = batch.column(0).to_numpy().view(np.uint64)
            at = ((h >> np.uint64(24)) % np.uint64(blocks)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at // CHUNK), pa.array((at % CHUNK).astype(np.int32)), pa.array(bits(h).view(np.int64))], ["chunk", "block", "mask"])

    hashes = values.select(F.xxhash64(key).alias("h"))
    table = spark.sparkContext.broadcast(filled(hashes.mapInArrow(place, "chunk long, block int, mask long"), blocks))

    @pandas_udf("boolean")
    def met(h: pd.Series) -> pd.Series:
        h = h.to_numpy().view(np.uint64)
        mask = bits(h)
        return pd.Series((table.value[((h >> np.uint64(24)) % np.uint64(blocks)).astype(np.int64)] & mask) == mask)

    def test(column: str) -> Column:
        return met(F.xxhash64(column))

    return test
