"""Spelling variants: words of a corpus that differ by one character, and the form each belongs to.

Words are counted over all texts. Every word then generates its edits: each deletion, and each replacement by a later
letter, so that every pair of words at one insertion, deletion or replacement comes up once, from its longer or its
smaller word. Edits are hashed without being written out and probed against Bloom filters, one per word length, made of
64-bit blocks. Only edits that pass become rows; an exact join with the vocabulary removes false positives.

A broadcast filter never exceeds ``FILTER_BYTES``. A vocabulary that needs more is probed in rounds, each with the words
of one residue of the hash: no word is left out.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bloom import BITS, BLOCK, CHUNK, bits, filled
from tidemark.llm.common import saved, whole

LEAST_LENGTH = 6
LEAST_COUNT = 5
FACTOR = 5  # a form is this many times as frequent
DELETED = 199  # one word of a document in so many loses a character
FILTER_BYTES = 64 << 20
LONGEST = 64  # longer words share a filter
HELD = 200_000  # words a task counts before it passes them on
CELLS = 1 << 20  # edits hashed at once

RUN = re.compile(rb"(?:[a-z]+|\xc3[\x80-\xbf])+")  # [a-zÀ-ÿ]+ in UTF-8, after lower()


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n``: the words of at least ``LEAST_LENGTH`` code points, with their occurrences in all texts.

    A null text has no words, a null id is written as nothing.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([w.decode() for w in found], pa.string()), pa.array(found.values(), pa.int64())], ["word", "n"])

        found: dict[bytes, int] = {}
        crc = zlib.crc32
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                start = crc(f"{key.as_py()}:".encode())
                for word, n in Counter(w for w in RUN.findall(text.as_buffer().to_pybytes().lower()) if len(w) >= LEAST_LENGTH).items():
                    h = crc(word, start)
                    if h % DELETED == 0:
                        letters = word.decode()
                        at = h % len(letters)
                        word = (letters[:at] + letters[at + 1:]).encode()
                    found[word] = found.get(word, 0) + n
                if len(found) >= HELD:
                    yield out()
                    found.clear()
        yield out()

    texts = docs.select(F.coalesce(docs["doc_id"].cast("string"), F.lit("")).alias("key"), whole(docs["text"]).alias("text"))
    counts = texts.mapInArrow(count, "word string, n long")
    return counts.where(F.char_length("word") >= LEAST_LENGTH).groupBy("word").agg(F.sum("n").alias("n"))


def _mix(x: np.ndarray) -> np.ndarray:
    """A well mixed 64-bit value for each whole number."""
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xD1B54A32D192ED03)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _values(letters: np.ndarray, first: int = 0) -> np.ndarray:
    """The value of each letter (row: word, column: place) at its place, counted from ``first``."""
    places = np.arange(first, first + letters.shape[1], dtype=np.int64) * 256
    return _mix(letters.astype(np.int64) + places)


def word_hashes(letters: np.ndarray) -> np.ndarray:
    """The hash of words of one length: the sum of their letters' values."""
    return _values(letters).sum(axis=1, dtype=np.uint64)


class Filters:
    """Where a hash stands: round, block and bits, for each length of word."""

    def __init__(self, counts: dict[int, int], most: int = FILTER_BYTES):
        need = sum(counts.values()) * BITS // 8
        self.rounds = max(1, -(-need // most))
        self.first, self.blocks, at = {}, {}, 0
        for length, n in sorted(counts.items()):
            self.first[length], self.blocks[length] = at, -(-n * BITS // (BLOCK * self.rounds))
            at += self.blocks[length]
        self.size = at

    def has(self, length: int) -> bool:
        return min(length, LONGEST) in self.blocks

    def round_of(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes * np.uint64(0xA24BAED4963EE407) >> np.uint64(33)) % np.uint64(self.rounds)

    def block(self, hashes: np.ndarray, length: int) -> np.ndarray:
        length = min(length, LONGEST)
        return (((hashes >> np.uint64(32)) * np.uint64(self.blocks[length]) >> np.uint64(32)) + np.uint64(self.first[length])).astype(np.int64)


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of words of one length, in blocks of bounded size, and their letters (Latin-1 codes) as a matrix."""
    order: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        order.setdefault(len(word), []).append(i)
    for length, places in order.items():
        step = max(1, (1 << 18) // length)
        for lo in range(0, len(places), step):
            some = places[lo:lo + step]
            joined = "".join([words[i] for i in some]).encode("latin-1")
            yield np.array(some), np.frombuffer(joined, dtype=np.uint8).reshape(len(some), length)


def _filter_chunks(vocabulary: DataFrame, at: Filters, turn: int) -> np.ndarray:
    """The filter of one round, filled chunk by chunk in Spark."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, letters in by_length(batch.column(0).to_pylist()):
                h = word_hashes(letters)
                h = h[at.round_of(h) == turn]
                block = at.block(h, letters.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block // CHUNK), pa.array((block % CHUNK).astype(np.int32)), pa.array(bits(h).view(np.int64))],
                    ["chunk", "block", "mask"])

    marks = vocabulary.select("word").mapInArrow(place, "chunk long, block int, mask long")
    return filled(marks, at.size)


def passing(words: list[str], letters: np.ndarray, at: Filters, table: np.ndarray, turn: int) -> Iterator[tuple[int, str]]:
    """``(place in words, edit)`` of all edits that the filter of this round lets through."""
    def met(hashes: np.ndarray, length: int, valid: np.ndarray) -> np.ndarray:
        mask = bits(hashes)
        hit = valid & ((table[at.block(hashes, length)] & mask) == mask)
        return hit if at.rounds == 1 else hit & (at.round_of(hashes) == turn)

    for places, rows in by_length(words):
        length, values = rows.shape[1], _values(rows)
        if length > LEAST_LENGTH and at.has(length - 1):
            moved = _values(rows[:, 1:])  # each letter but the first, one place further left
            before = np.cumsum(values, axis=1, dtype=np.uint64) - values
            after = np.zeros_like(values)
            after[:, :-1] = np.cumsum(moved[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1]
            first = np.ones(rows.shape, dtype=bool)  # of equal letters in a row, only the first is deleted
            first[:, 1:] = rows[:, 1:] != rows[:, :-1]
            for i, j in zip(*np.nonzero(met(before + after, length - 1, first))):
                word = words[places[i]]
                yield places[i], word[:j] + word[j + 1:]
        total = values.sum(axis=1, dtype=np.uint64)[:, None, None]
        step = max(1, CELLS // (len(rows) * len(letters)))
        for lo in range(0, length, step):
            part = slice(lo, min(length, lo + step))
            new = _values(np.broadcast_to(letters[:, None], (len(letters), part.stop - lo)), lo).T
            edits = total - values[:, part, None] + new
            for i, j, k in zip(*np.nonzero(met(edits, length, letters > rows[:, part, None]))):
                word = words[places[i]]
                yield places[i], word[:lo + j] + chr(letters[k]) + word[lo + j + 1:]


def near_words(vocabulary: DataFrame, most: int = FILTER_BYTES) -> DataFrame:
    """``word, n, other, other_n`` for each ordered pair of vocabulary words that differ by one character."""
    shard = F.least(F.char_length("word"), F.lit(LONGEST)).alias("shard")
    counts = {r["shard"]: r["count"] for r in vocabulary.groupBy(shard).count().collect()}  # at most LONGEST rows
    empty = vocabulary.select("word", "n", F.col("word").alias("edit")).where(F.lit(False))
    if not counts:
        found = empty
    else:
        spark, at = vocabulary.sparkSession, Filters(counts, most)
        used = vocabulary.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).distinct()
        letters = np.array(sorted(ord(r["c"]) for r in used.where("c <> ''").collect()), dtype=np.uint8)  # at most 90
        found = empty
        for turn in range(at.rounds):
            table = spark.sparkContext.broadcast(_filter_chunks(vocabulary, at, turn))

            def probe(batches: Iterator[pa.RecordBatch], table=table, turn=turn) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    words, n = batch.column(0).to_pylist(), batch.column(1).to_numpy()
                    hits = list(passing(words, letters, at, table.value, turn))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([words[i] for i, _ in hits], pa.string()), pa.array([n[i] for i, _ in hits], pa.int64()),
                         pa.array([edit for _, edit in hits], pa.string())], ["word", "n", "edit"])

            found = found.unionByName(saved(vocabulary.select("word", "n").mapInArrow(probe, empty.schema), "spelling-edits"))
    exact = found.join(vocabulary.select(F.col("word").alias("edit"), F.col("n").alias("edit_n")), "edit")
    sides = F.array(F.struct("word", "n", F.col("edit").alias("other"), F.col("edit_n").alias("other_n")),
                    F.struct(F.col("edit").alias("word"), F.col("edit_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    return exact.select(F.inline(sides))


def spelling_variants(docs: DataFrame, most: int = FILTER_BYTES) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each word of the vocabulary.

    ``form`` is the near word of largest count (ties: the smallest) if it is at least ``FACTOR`` times as frequent,
    ``root`` the last of the forms that follow from a word. Null and empty texts add nothing, repeated rows count
    again; without words there are no rows.
    """
    counts = word_counts(docs).where(F.col("n") >= LEAST_COUNT)
    vocabulary = saved(counts, "spelling-words")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other"))).alias("best")
    near = near_words(vocabulary, most).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    better = -F.col("best.less") >= FACTOR * F.col("n")
    words = saved(vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(better, F.col("best.other")).alias("form"),
        F.when(better, -F.col("best.less")).alias("form_n")), "spelling-forms")
    # Counts grow along the forms, so they end; each round doubles the steps that are known.
    roots, moved = words.where("form IS NOT NULL").select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), True
    while moved:
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = saved(roots.join(on, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        moved = not roots.where("moved").isEmpty()
    return words.join(roots.select("word", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
