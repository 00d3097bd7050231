"""Removal of long repeated byte strings, by suffix arrays of shards.

Two equal strings of ``length`` bytes must meet in one shard. So each window of that length is given an anchor that
its own bytes choose: the place of the least hash of the 64-byte grams in it. Equal windows have equal anchors, and
neighbouring windows mostly share one, so that a text has few anchors (about one in 70 bytes).

1. Batches of whole texts ask for the number of their anchors' hashes; windows whose anchor is found once are done.
2. The windows of the other anchors, as runs of bytes, go to shards by the anchors' hashes, each different run once.
   Runs are trimmed to what they share with others of their anchor; what came twice as a whole is repeated. A shard
   sorts all suffixes of the different parts left by induction and computes the permuted common prefixes: a window is
   repeated if its suffix shares ``length`` bytes with a neighbour in the order.
3. The answers go back to the batches, which remove the covered bytes.

An anchor with more than ``CROWDED`` runs would make a shard too large. Its windows are counted one by one, by
digests of 128 bits, as tables are; that grows with the different windows of a batch only.
"""

from __future__ import annotations

import collections
import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import saved, whole
from tidemark.llm.packing import loosen, loosen_sorted, squeeze, squeeze_sorted
from tidemark.llm.suffix_arrays import common_prefixes, suffix_array

GRAM = 64
BATCH = 2 << 20  # bytes of text
PART = 8 << 20  # bytes of text for each part of the tables
SHARD = 1 << 19  # bytes of runs in one suffix array
CROWDED = 4096
STRIDE = 1 << 20  # window starts hashed at once

ANSWER = "t long, p int, kind int, data binary"
ANSWER_SCHEMA = pa.schema([("t", pa.int64()), ("p", pa.int32()), ("kind", pa.int32()), ("data", pa.binary())])
RUNS, DIGESTS, TALLY = 0, 1, 2


def text_batches(docs: DataFrame) -> DataFrame:
    """Batches of whole texts: ``t``, ``size``, and by text ``doc_id`` and ``n`` (bytes); the bytes, compressed."""
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId() << 32, 0
        ids, parts, size = [], [], 0

        def batch() -> pa.RecordBatch:
            data = b"".join(parts)
            row = {"t": task + made, "size": size, "doc_id": ids, "n": list(map(len, parts)),
                   "data": pa.compress(data, codec="zstd", asbytes=True)}
            return pa.RecordBatch.from_pylist([row], pa.schema([
                ("t", pa.int64()), ("size", pa.int64()), ("doc_id", pa.list_(pa.int64())),
                ("n", pa.list_(pa.int64())), ("data", pa.binary())]))

        for rows in batches:
            for doc_id, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                ids.append(doc_id)
                parts.append(text)
                size += len(text)
                if size >= BATCH or len(ids) >= BATCH // 64:
                    yield batch()
                    ids, parts, size, made = [], [], 0, made + 1
        if ids:
            yield batch()

    rows = docs.select(docs["doc_id"].cast("long"), whole(docs["text"]).cast("binary"))
    return saved(rows.mapInArrow(gather, "t long, size long, doc_id array<long>, n array<long>, data binary"), "texts")


class Batch:
    """A batch's bytes, and its runs of windows: ``key`` (the anchor's hash), first and last window start, anchor."""

    def __init__(self, row: dict, length: int):
        self.sizes = np.array(row["n"], dtype=np.int64)
        data = pa.decompress(row["data"], decompressed_size=row["size"], codec="zstd", asbytes=True) if row["size"] else b""
        self.data = data
        self.bytes = np.frombuffer(data, np.uint8)
        self.length = length
        ends = np.cumsum(self.sizes)
        found = [self._runs(at, min(at + STRIDE, len(data)), ends) for at in range(0, len(data), STRIDE)]
        found.append((np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 3))
        self.key, self.first, self.last, self.anchor = (np.concatenate(x) for x in zip(*found))

    def _runs(self, low: int, high: int, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """Runs of the windows that begin from ``low`` to ``high``."""
        data = self.bytes[low:high + self.length - 1]
        starts = len(data) - self.length + 1
        if starts < 1:
            return np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 3
        starts = min(starts, high - low)
        grams = _grams(data)
        # The upper bits of a hash, then its place backwards: of equal hashes the rightmost is the least.
        bits = int(len(grams)).bit_length()
        place = np.arange(len(grams), dtype=np.uint64)
        packed = ((grams >> np.uint64(bits)) << np.uint64(bits)) | (np.uint64((1 << bits) - 1) - place)
        least = _sliding_least(packed, self.length - GRAM + 1)[:starts]
        new = np.ones(starts, dtype=bool)
        np.not_equal(least[1:], least[:-1], out=new[1:])
        new[ends[(ends > low) & (ends < low + starts)] - low] = True  # another text begins
        head = np.flatnonzero(new)
        at = (np.uint64((1 << bits) - 1) - (least[head] & np.uint64((1 << bits) - 1))).astype(np.int64)
        last = low + np.append(head[1:], starts) - 1
        head += low
        last = np.minimum(last, ends[np.searchsorted(ends, head, side="right")] - self.length)  # windows inside one text
        some = last >= head
        key = grams[at[some]]  # least ones, so all are small; spread over all values again, one to one
        key = (key ^ (key >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
        return key, head[some], last[some], low + at[some]

    def run(self, i: int) -> bytes:
        return self.data[self.first[i]:self.last[i] + self.length]


def _grams(data: np.ndarray) -> np.ndarray:
    """A hash of each ``GRAM`` bytes, by doubling."""
    out = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64)[data]
    size, factor = 1, 0x9E3779B97F4A7C15
    while size < GRAM:
        out = out[:-size] * np.uint64(factor) + out[size:]
        out ^= out >> np.uint64(31)
        size, factor = 2 * size, factor * 0xBF58476D1CE4E5B9 % (1 << 64) | 1
    return out * np.uint64(0x94D049BB133111EB)


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def _ranges(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where sorted keys are cut, by equal ranges of the hash."""
    width = -(-(1 << 64) // parts)
    return np.searchsorted(keys, np.array([i * width for i in range(1, parts)], dtype=np.uint64))


def _tallies(batches: DataFrame, length: int, parts: int) -> DataFrame:
    """For each batch and part the numbers of its distinct anchors, in their order."""
    def ask(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in rows for r in b.to_pylist()):
            keys, counts = np.unique(Batch(row, length).key, return_counts=True)
            cuts = _ranges(keys, parts)
            asked = [(p, row["t"], squeeze_sorted(k), squeeze(c.astype(np.uint32))) for p, (k, c) in
                     enumerate(zip(np.split(keys, cuts), np.split(counts, cuts))) if len(k)]
            if asked:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    zip(*asked), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))], ["p", "t", "keys", "counts"])

    def answer(asked: pa.Table) -> pa.Table:
        blocks = [loosen_sorted(k) for k in asked["keys"].to_pylist()]
        _, at = np.unique(np.concatenate(blocks), return_inverse=True)
        total = np.bincount(at, weights=np.concatenate([loosen(c, "u4") for c in asked["counts"].to_pylist()]))
        cuts = np.cumsum([len(b) for b in blocks])[:-1]
        said = [squeeze(np.minimum(x, CROWDED + 1).astype(np.uint16)) for x in np.split(total[at], cuts)]
        n = len(said)
        return pa.table([asked["t"].combine_chunks(), asked["p"].combine_chunks(), pa.array([TALLY] * n, pa.int32()),
                         pa.array(said, pa.binary())], schema=ANSWER_SCHEMA)

    asked = batches.select("t", "size", "n", "data").mapInArrow(ask, "p int, t long, keys binary, counts binary")
    return saved(asked.groupBy("p").applyInArrow(answer, ANSWER), "anchors")


class Wanted:
    """What a batch asks the shards: its different runs of anchors found elsewhere too, and digests of windows."""

    def __init__(self, batch: Batch, said: pa.Table):
        keys, at = np.unique(batch.key, return_inverse=True)
        said = said.sort_by("p")
        total = np.concatenate([np.empty(0, np.uint16), *(loosen(x, "u2") for x in said["data"].to_pylist())])
        number = total[at] if len(at) else np.empty(0, np.uint16)
        self.batch = batch
        chosen = np.flatnonzero((number > 1) & (number <= CROWDED))
        chosen = chosen[np.argsort(batch.key[chosen], kind="stable")]
        known: dict[tuple[int, bytes], int] = {}  # hot passages repeat inside a batch
        self.runs, self.which, self.times = [], [], []
        for i in chosen.tolist():
            run = batch.run(i)
            j = known.setdefault((int(batch.key[i]), run), len(self.runs))
            if j == len(self.runs):
                self.runs.append(i)
                self.times.append(0)
            self.times[j] += 1
            self.which.append(j)
        self.chosen = chosen
        crowded = np.flatnonzero(number > CROWDED)
        starts = np.concatenate([np.empty(0, np.int64), *(np.arange(batch.first[i], batch.last[i] + 1) for i in crowded)])
        digests: dict[bytes, int] = {}
        seen: dict[bytes, np.ndarray] = {}
        numbers = []
        for i in crowded.tolist():
            run = batch.run(i)
            if run not in seen:
                seen[run] = np.array([digests.setdefault(hashlib.blake2b(run[j:j + batch.length], digest_size=16).digest(), len(digests))
                                      for j in range(len(run) - batch.length + 1)], dtype=np.int64)
            numbers.append(seen[run])
        which = np.concatenate(numbers) if numbers else np.empty(0, np.int64)
        both = np.frombuffer(b"".join(digests), dtype=np.uint64).reshape(-1, 2)
        order = np.lexsort((both[:, 1], both[:, 0]))
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        self.starts, self.digest_of = starts, rank[which]
        self.high, self.low = both[order, 0], both[order, 1]
        self.digest_times = np.bincount(self.digest_of, minlength=len(order))


def _repeated(wanted: DataFrame, length: int) -> DataFrame:
    """For each batch and part, a flag for each window of its runs, or for each of its digests."""
    def runs(asked: pa.Table) -> pa.Table:
        blocks = asked.to_pylist()
        keys = np.concatenate([loosen_sorted(b["keys"]) for b in blocks])
        anchors = np.concatenate([loosen(b["anchors"], "u4") for b in blocks])
        sizes = np.concatenate([loosen(b["sizes"], "u4") for b in blocks]).astype(np.int64)
        times = np.concatenate([loosen(b["times"], "u4") for b in blocks]).astype(np.int64)
        data = b"".join(pa.decompress(b["data"], decompressed_size=b["size"], codec="zstd", asbytes=True) for b in blocks)
        begin = np.cumsum(sizes) - sizes
        number: dict[tuple[int, bytes], int] = {}
        which = np.array([number.setdefault((int(k), data[a:a + n]), len(number)) for k, a, n in zip(keys, begin, sizes)])
        often = np.bincount(which, weights=times, minlength=len(number)).astype(np.int64)
        anchor = np.empty(len(number), dtype=np.int64)
        anchor[which] = anchors
        by_key: dict[int, list[tuple[int, bytes]]] = collections.defaultdict(list)
        for (key, run), j in number.items():
            by_key[key].append((j, run))
        flags = [np.zeros(len(run) - length + 1, dtype=bool) for _, run in number]
        shard, size = [], 0
        for group in by_key.values():  # all runs of an anchor are in one shard
            parts = _trimmed(group, anchor, often, flags, length)
            if len(parts) > 1:
                shard += parts
                size += sum(len(part.text) for part in parts)
            if size >= SHARD:
                _flag(shard, length)
                shard, size = [], 0
        _flag(shard, length)
        out, at = [], 0
        for b in blocks:
            n = len(loosen(b["sizes"], "u4"))
            out.append(squeeze(np.packbits(np.concatenate([flags[j] for j in which[at:at + n]]))))
            at += n
        return pa.table([asked["t"].combine_chunks(), asked["p"].combine_chunks(), asked["kind"].combine_chunks(),
                         pa.array(out, pa.binary())], schema=ANSWER_SCHEMA)

    def digests(asked: pa.Table) -> pa.Table:
        blocks = asked.to_pylist()
        high = [loosen_sorted(b["keys"]) for b in blocks]
        both = np.stack([np.concatenate(high), np.concatenate([loosen(b["data"], "u8") for b in blocks])], axis=1)
        times = np.concatenate([loosen(b["times"], "u4") for b in blocks])
        order = np.lexsort((both[:, 1], both[:, 0]))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (both[order][1:] != both[order][:-1]).any(axis=1)
        which = np.empty(len(order), dtype=np.int64)
        which[order] = np.cumsum(new) - 1
        often = np.bincount(which, weights=times) > 1
        out = [squeeze(np.packbits(x)) for x in np.split(often[which], np.cumsum(list(map(len, high)))[:-1])]
        return pa.table([asked["t"].combine_chunks(), asked["p"].combine_chunks(), asked["kind"].combine_chunks(),
                         pa.array(out, pa.binary())], schema=ANSWER_SCHEMA)

    def answer(asked: pa.Table) -> pa.Table:
        return (runs if asked["kind"][0].as_py() == RUNS else digests)(asked)

    return saved(wanted.groupBy("p", "kind").applyInArrow(answer, ANSWER), "repeats")


class Part(NamedTuple):
    """What a run shares with others of its anchor, and the flags of its windows in each run that has it."""

    text: bytes
    flags: list[np.ndarray]


def _shared(a: bytes, b: bytes) -> int:
    """The length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def _longest_shared(texts: list[bytes]) -> list[int]:
    """For each text the longest prefix it shares with another one: with a neighbour in their order."""
    order = sorted(range(len(texts)), key=texts.__getitem__)
    out = [0] * len(texts)
    for a, b in zip(order, order[1:]):
        n = _shared(texts[a], texts[b])
        out[a], out[b] = max(out[a], n), max(out[b], n)
    return out


def _trimmed(group: list[tuple[int, bytes]], anchor: np.ndarray, times: np.ndarray, flags: list[np.ndarray],
             length: int) -> list[Part]:
    """The different parts of an anchor's runs that may hold repeated windows; flags what is repeated for certain.

    A repeated window holds the anchor in the same place as its equal, so it lies in what its run shares with other
    runs to the left and to the right of the anchor. A run, or such a part of several, that came twice is repeated as
    a whole; two windows of one run differ, as they hold the anchor in different places.
    """
    for j, _ in group:
        if times[j] > 1:
            flags[j][:] = True
    if len(group) == 1:
        return []
    at = [int(anchor[j]) for j, _ in group]
    left = _longest_shared([run[a - 1::-1] if a else b"" for a, (_, run) in zip(at, group)])
    right = _longest_shared([run[a:] for a, (_, run) in zip(at, group)])
    parts: dict[tuple[int, bytes], list[np.ndarray]] = collections.defaultdict(list)
    for a, b, c, (j, run) in zip(at, left, right, group):
        if b + c >= length:
            parts[b, run[a - b:a + c]].append(flags[j][a - b:a + c - length + 1])
    for own in parts.values():
        if len(own) > 1:
            for some in own:
                some[:] = True
    return [Part(text, own) for (_, text), own in parts.items()]


def _flag(shard: list[Part], length: int) -> None:
    """Flag the windows of a shard's parts that are found at another place of the shard."""
    if not shard:
        return
    text = np.frombuffer(b"\x00".join(part.text for part in shard) + b"\x00", np.uint8).astype(np.int32) + 2
    at = 0
    for part in shard:
        text[at + len(part.text)] = 1  # no window reaches over the end of its part
        at += len(part.text) + 1
    text = np.append(text, np.int32(0))
    order = suffix_array(text, 258)
    shared = common_prefixes(text, order)
    hit = shared >= length
    hit[order[:-1]] |= shared[order[1:]] >= length
    at = 0
    for part in shard:
        for own in part.flags:
            own |= hit[at:at + len(own)]
        at += len(part.text) + 1


def remove_repeats(docs: DataFrame, length: int = 200) -> DataFrame:
    """``doc_id, n_bytes, n_removed, spans, kept`` for each document.

    Each byte that a string of ``length`` bytes covers, which also begins anywhere else in any text (overlaps and the
    text itself included), is removed; strings are judged on the input. ``spans`` are the maximal removed runs as
    ``(start, end)`` in bytes, ``kept`` the bytes that remain. Null texts are empty. Rows may repeat (then all of a
    text of ``length`` bytes goes, in each of them) and ids may be null.
    """
    if length < GRAM:
        raise ValueError(f"strings of fewer than {GRAM} bytes have no anchor")
    batches = text_batches(docs)
    total = batches.agg(F.sum("size")).first()[0] or 0
    parts = max(1, -(-total // PART))
    tallies = _tallies(batches, length, parts)
    by_batch = batches.groupBy("t")
    kinds = pa.schema([("p", pa.int32()), ("kind", pa.int32()), ("t", pa.int64()), ("keys", pa.binary()),
                       ("sizes", pa.binary()), ("anchors", pa.binary()), ("times", pa.binary()), ("data", pa.binary()),
                       ("size", pa.int64())])

    def want(batch: pa.Table, said: pa.Table) -> pa.Table:
        rows = []
        for row in batch.to_pylist():
            own = Wanted(Batch(row, length), said)
            keys = own.batch.key[own.runs] if own.runs else np.empty(0, np.uint64)
            offsets = (own.batch.anchor - own.batch.first)[own.runs] if own.runs else np.empty(0, np.int64)
            for p, part in enumerate(np.split(np.arange(len(keys)), _ranges(keys, parts))):
                if len(part):
                    runs = [own.batch.run(own.runs[i]) for i in part]
                    data = b"".join(runs)
                    rows.append((p, RUNS, row["t"], squeeze_sorted(keys[part]), squeeze(np.array(list(map(len, runs)), np.uint32)),
                                 squeeze(offsets[part].astype(np.uint32)),
                                 squeeze(np.array(own.times, np.uint32)[part]), pa.compress(data, codec="zstd", asbytes=True), len(data)))
            for p, part in enumerate(np.split(np.arange(len(own.high)), _ranges(own.high, parts))):
                if len(part):
                    rows.append((p, DIGESTS, row["t"], squeeze_sorted(own.high[part]), None, None,
                                 squeeze(own.digest_times[part].astype(np.uint32)), squeeze(own.low[part]), 0))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), kinds)] if rows else [pa.array([], f.type) for f in kinds],
                        schema=kinds)

    wanted = by_batch.cogroup(tallies.groupBy("t")).applyInArrow(
        want, "p int, kind int, t long, keys binary, sizes binary, anchors binary, times binary, data binary, size long")
    said = tallies.unionByName(_repeated(wanted, length))
    result = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())])

    def remove(batch: pa.Table, said: pa.Table) -> pa.Table:
        rows = []
        kind = said["kind"].to_numpy()
        for row in batch.to_pylist():
            own = Wanted(Batch(row, length), said.filter(pa.array(kind == TALLY)))
            runs = said.filter(pa.array(kind == RUNS)).sort_by("p")["data"].to_pylist()
            sizes = own.batch.last - own.batch.first + 1
            window = np.zeros(len(own.batch.bytes) + 1, dtype=bool)
            if own.runs:
                n = sizes[own.runs]
                keys = own.batch.key[own.runs]
                per_part = [int(n[part].sum()) for part in np.split(np.arange(len(keys)), _ranges(keys, parts)) if len(part)]
                flags = np.concatenate([np.unpackbits(loosen(x, "u1"))[:m] for x, m in zip(runs, per_part)])
                begin = np.cumsum(n) - n
                for i, j in zip(own.chosen.tolist(), own.which):
                    window[own.batch.first[i]:own.batch.last[i] + 1] = flags[begin[j]:begin[j] + n[j]]
            if len(own.high):
                answers = said.filter(pa.array(kind == DIGESTS)).sort_by("p")["data"].to_pylist()
                per_part = [len(x) for x in np.split(own.high, _ranges(own.high, parts)) if len(x)]
                flags = np.concatenate([np.unpackbits(loosen(x, "u1"))[:m] for x, m in zip(answers, per_part)])
                window[own.starts] = flags[own.digest_of]
            hits = np.flatnonzero(window)
            edge = np.zeros(len(own.batch.bytes) + 1, dtype=np.int64)
            np.add.at(edge, hits, 1)
            np.add.at(edge, hits + length, -1)
            gone = np.cumsum(edge[:-1]) > 0
            at = 0
            for doc_id, size in zip(row["doc_id"], row["n"]):
                mask = gone[at:at + size]
                turns = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
                rows.append((doc_id, size, int(mask.sum()), [{"start": a, "end": b} for a, b in turns.tolist()],
                             own.batch.bytes[at:at + size][~mask].tobytes()))
                at += size
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), result)] if rows else [pa.array([], f.type) for f in result],
                        schema=result)

    return by_batch.cogroup(said.groupBy("t")).applyInArrow(
        remove, "doc_id long, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept binary")
