"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint of 64 bits is cut into four blocks. Two fingerprints that differ in at most two bits agree in at
least two blocks, so every pair of blocks is a join key of 32 bits; candidates of a small bucket are compared.
A bucket of more fingerprints than ``PAIRS_UP_TO`` makes no pairs: its members meet at common neighbours
instead. Two fingerprints differ in at most two bits just if some value is within one bit of both, so each
member names the 65 values within one bit of it, and members that name the same value are linked. That is
exact too, and grows with the members, not with their pairs.

Copies share a fingerprint and count once.
"""

from __future__ import annotations

from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tidemark.llm.common import packed, saved, shared, whole
from tidemark.llm.components import components

BLOCKS = 4
PAIRS_UP_TO = 40
SHINGLE = 3
SEED = 42


def fingerprint_of(text: str, shingle: int = SHINGLE) -> int:
    """The signed 64-bit fingerprint of a text: a bit is set if it is in over half of the shingles' hashes."""
    import numpy as np
    import xxhash

    words = text.encode().lower().split()  # bytes: only A-Z change, and words end at \x20 and \x09-\x0D
    if not words:
        return 0
    joined, ends, at = b" ".join(words), [], -1
    starts = []
    for word in words:
        starts.append(at + 1)
        at += 1 + len(word)
        ends.append(at)
    first = ends[shingle - 1:] or ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, first)], dtype=">u8")
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 16):  # a long text in pieces
        ones += np.unpackbits(hashes[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes)).view(">i8")[0])


def fingerprints(docs: DataFrame, columns: list[str] | None = None, shingle: int = SHINGLE) -> DataFrame:
    """``rid, row (columns or all), doc_id, fp`` for each document, written once. A null text is an empty one."""
    @pandas_udf("long")
    def fingerprint(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t, shingle) for t in texts], dtype="int64")

    rows = packed(docs, docs["doc_id"].cast("long").alias("doc_id"), fingerprint(whole(docs["text"])).alias("fp"))
    return saved(rows.select(F.monotonically_increasing_id().alias("rid"), F.struct(
        *[F.col("row").getField(c).alias(c) for c in columns or docs.columns]).alias("row"), "doc_id", "fp"), "simhash")


def links(fps: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` that connect just those of the distinct ``fp`` that differ in at most two bits."""
    width = 64 // BLOCKS
    masks = []
    for kept in combinations(range(BLOCKS), BLOCKS - 2):
        mask = sum(((1 << width) - 1) << (width * i) for i in kept)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    keys = F.array(*[F.struct(F.lit(i).alias("block"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                     for i, m in enumerate(masks)])
    blocked = fps.select("fp", F.explode(keys).alias("k")).select("fp", "k.block", "k.key")
    crowded = saved(shared(blocked, "block", "key"), "simhash-buckets")
    few = crowded.where(F.col("count") <= PAIRS_UP_TO).groupBy("block", "key").agg(F.sort_array(F.collect_list("fp")).alias("f"))
    pairs = few.select(F.explode(F.flatten(F.transform("f", lambda a: F.transform(
        F.filter("f", lambda b: (b > a) & (F.bit_count(a.bitwiseXOR(b)) <= 2)),
        lambda b: F.struct(a.alias("a"), b.alias("b")))))).alias("p")).select("p.a", "p.b").distinct()
    many = crowded.where(F.col("count") > PAIRS_UP_TO).select("fp").distinct()
    flips = F.array_append(F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("fp").bitwiseXOR(
        F.call_function("shiftleft", F.lit(1).cast("long"), i))), F.col("fp"))
    near = many.select("fp", F.explode(flips).alias("value"))
    least = near.groupBy("value").agg(F.min("fp").alias("low"), F.count(F.lit(1)).alias("n")).where("n > 1")
    stars = near.join(least.hint("merge"), "value").where("fp <> low").select(F.col("fp").alias("a"), F.col("low").alias("b"))
    return pairs.unionByName(stars.distinct())


def fingerprint_roots(fps: DataFrame) -> DataFrame:
    """``fp, root`` of the distinct ``fp`` that links of at most two bits connect with others."""
    return components(links(fps)).withColumnRenamed("node", "fp")


def near_duplicates(docs: DataFrame, columns: list[str] | None = None, shingle: int = SHINGLE) -> DataFrame:
    """``rid, row, doc_id, fp, component_id, keep`` for each document.

    ``component_id`` is the least id that can be reached over links of at most two bits, its own included
    (null if all of them are null). ``keep`` marks one row of each component: of its least id, then first read.
    Texts without words have fingerprint zero and are linked like others.
    """
    rows = fingerprints(docs, columns, shingle)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("rid")))
    fps = saved(rows.groupBy("fp").agg(first.alias("first")), "simhash-distinct")
    rooted = fps.join(fingerprint_roots(fps), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    heads = rooted.groupBy("root").agg(F.min("first").alias("head"))
    labels = saved(rooted.join(heads, "root").select("fp", "head"), "simhash-labels")
    return rows.join(labels, "fp").select(
        "rid", "row", "doc_id", "fp", F.col("head.doc_id").alias("component_id"), (F.col("rid") == F.col("head.rid")).alias("keep"))
