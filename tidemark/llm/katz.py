"""Language-model scores by Katz backoff.

N-grams are counted over the training texts, discounted by Good-Turing estimates, and backed off with weights that
make every context's probabilities sum to one, unknown words included as one word.

Tokens make up nearly all the data, so they stay where they are, in batches of whole texts, and only packed
tables move:

1. Each batch sends its distinct n-grams, sorted and cut by ranges of their hashes, to the tables of counts; a part
   of a table adds the batches up and answers in the order it was asked: the count, and whether this batch is the
   one that accounts for the n-gram.
2. With the answers a batch knows all probabilities of n-grams that were seen. It scores its texts as far as that
   goes, sums what each context has given away for the n-grams it accounts for, and names the contexts whose
   backoff weight a text needs.
3. Weights are computed per context and added to the texts that need them.

An n-gram in a third of the texts reaches its table once per batch. Higher orders cost one more table each.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import saved, whole
from tidemark.llm.packing import loosen, loosen_sorted, squeeze, squeeze_sorted

BATCH = 500_000  # tokens
KEYS = 500_000  # n-grams in a part of a table
BEGIN = np.uint64(0x9E3779B97F4A7C15)  # stands before each text; a context only
TURING = 5  # counts up to this are discounted by Turing's estimate, others by a fitted line
SEEN = 12  # numbers of n-grams of one count kept: for counts below this


def _mixed(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """One hash out of two."""
    x = context * np.uint64(0xD6E8FEB86659FD93) + word
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def held_out(doc_id: Column) -> Column:
    """Texts that nothing is learnt from; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def token_batches(docs: DataFrame, held: Column) -> DataFrame:
    """Texts as batches: ``t``, and by text ``doc_id``, ``held``, ``n`` (tokens); words by number, and their hashes.

    Word 0 is the end, which each text has once. A null text is an empty one.
    """
    schema = "t long, tokens long, doc_id array<long>, held array<boolean>, n array<int>, words binary, hashes binary"

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        task, made = TaskContext.get().partitionId() << 32, 0
        number: defaultdict[bytes, int] = defaultdict()
        number.default_factory = number.__len__
        number[b""]
        ids, out, lengths, words, size = [], [], [], [], 0

        def batch() -> pa.RecordBatch:
            hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in number), dtype=np.uint64, count=len(number))
            row = {"t": task + made, "tokens": size, "doc_id": ids, "held": out, "n": lengths,
                   "words": squeeze(np.concatenate(words)), "hashes": squeeze(hashes)}
            return pa.RecordBatch.from_pylist([row], pa.schema([
                ("t", pa.int64()), ("tokens", pa.int64()), ("doc_id", pa.list_(pa.int64())),
                ("held", pa.list_(pa.bool_())), ("n", pa.list_(pa.int32())), ("words", pa.binary()), ("hashes", pa.binary())]))

        for rows in batches:
            for doc_id, is_held, text in zip(*(c.to_pylist() for c in rows.columns)):
                found = text.encode().lower().split()  # bytes: only A-Z change; words end at \x20 and \x09-\x0D
                found.append(b"")
                words.append(np.fromiter(map(number.__getitem__, found), dtype=np.uint32, count=len(found)))
                ids.append(doc_id)
                out.append(is_held)
                lengths.append(len(found))
                size += len(found)
                if size >= BATCH:
                    yield batch()
                    made, size = made + 1, 0
                    ids, out, lengths, words = [], [], [], []
                    number.clear()
                    number[b""]
        if size:
            yield batch()

    rows = docs.select(docs["doc_id"].cast("long"), held, whole(docs["text"]))
    return saved(rows.mapInArrow(tokenise, schema), "katz-batches")


class Grams:
    """The n-grams of a batch: of each order, the sorted distinct hashes, and for each token which of them ends there."""

    def __init__(self, row: dict, order: int):
        n = np.array(row["n"], dtype=np.int64)
        words = loosen(row["words"], "u4")
        self.word = loosen(row["hashes"], "u8")[words]
        self.text = np.repeat(np.arange(len(n)), n)
        ends = np.cumsum(n)
        self.place = np.arange(len(words)) - np.repeat(ends - n, n)  # in the text
        self.train = ~np.array(row["held"], dtype=bool)[self.text]
        self.keys, self.at, self.has, self.counts = [], [], [], []
        gram = self.word
        for m in range(1, order + 1):
            if m > 1:  # the n-gram of one less that ends a token before; the first token's context is the beginning
                before = np.empty_like(gram)
                before[1:] = gram[:-1]
                before[self.place == 0] = BEGIN
                gram = _mixed(before, self.word)
            has = self.place >= m - 2  # longer ones would begin before the beginning
            keys, at = np.unique(gram[has], return_inverse=True)
            counts = np.bincount(at, weights=self.train[has], minlength=len(keys)).astype(np.uint32)
            full = np.full(len(gram), -1, dtype=np.int64)
            full[has] = at
            self.keys.append(keys)
            self.at.append(full)
            self.has.append(has)
            self.counts.append(counts)


def count_tables(batches: DataFrame, order: int, parts: int) -> DataFrame:
    """Answers ``m, p, t, counts, owned`` to the batches; rows with ``t = -1`` hold each part's ``stats`` instead.

    ``stats``: the number of n-grams with counts 0 (not used), 1, 2, ... below ``SEEN``, then all, then their sum.
    """
    width = -(-(1 << 64) // parts)

    def ask(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in rows for r in b.to_pylist()):
            grams = Grams(row, order)
            for m, (keys, counts) in enumerate(zip(grams.keys, grams.counts)):
                cuts = np.searchsorted(keys, np.array([i * width for i in range(1, parts)], dtype=np.uint64))
                asked = [(m, p, row["t"], squeeze_sorted(k), squeeze(c)) for p, (k, c) in
                         enumerate(zip(np.split(keys, cuts), np.split(counts, cuts))) if len(k)]
                if not asked:  # texts too short for this order
                    continue
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    zip(*asked), (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))], ["m", "p", "t", "keys", "counts"])

    def answer(asked: pa.Table) -> pa.Table:
        asked = asked.sort_by("t")
        blocks = [loosen_sorted(k) for k in asked["keys"].to_pylist()]
        counts = np.concatenate([loosen(c, "u4") for c in asked["counts"].to_pylist()]).astype(np.int64)
        keys, at = np.unique(np.concatenate(blocks), return_inverse=True)
        total = np.bincount(at, weights=counts, minlength=len(keys)).astype(np.int64)
        owner = np.zeros(len(at), dtype=np.uint8)  # the first batch that learns the n-gram accounts for it
        learnt = np.flatnonzero(counts)
        owner[learnt[np.unique(at[learnt], return_index=True)[1]]] = 1
        seen = np.bincount(np.minimum(total, SEEN), minlength=SEEN + 1)[:SEEN]
        cuts = np.cumsum([len(b) for b in blocks])[:-1]
        rows = [(t, squeeze(c), squeeze(o), None) for t, c, o in
                zip(asked["t"].to_pylist(), np.split(total[at], cuts), np.split(owner, cuts))]
        rows.append((-1, None, None, [*seen.tolist(), int((total > 0).sum()), int(total.sum())]))
        t, c, o, s = zip(*rows)
        return pa.table({"m": [asked["m"][0].as_py()] * len(rows), "p": [asked["p"][0].as_py()] * len(rows), "t": pa.array(t, pa.int64()),
                         "counts": pa.array(c, pa.binary()), "owned": pa.array(o, pa.binary()),
                         "stats": pa.array(s, pa.list_(pa.int64()))}).cast(pa.schema([
                             ("m", pa.int32()), ("p", pa.int32()), ("t", pa.int64()), ("counts", pa.binary()),
                             ("owned", pa.binary()), ("stats", pa.list_(pa.int64()))]))

    asked = batches.mapInArrow(ask, "m int, p int, t long, keys binary, counts binary")
    return saved(asked.groupBy("m", "p").applyInArrow(
        answer, "m int, p int, t long, counts binary, owned binary, stats array<long>"), "katz-counts")


def discounts(seen: list[int]) -> tuple[list[float], float]:
    """Factors for the counts 0 to ``TURING``, and the power ``b`` of ``(1 + 1 / r) ** b`` for larger counts ``r``.

    The line is fitted to the logarithms of the numbers of n-grams of one count. Turing's estimate counts where it
    lies between 0 and 1; elsewhere the line's does. All factors are below 1, so every context keeps some for others.
    """
    points = [(np.log(r), np.log(n)) for r, n in enumerate(seen) if r and n]
    slope = np.polyfit(*zip(*points), 1)[0] if len(points) > 1 else -2.0
    power = float(min(slope + 1, -0.05))
    factors = [0.0]
    for r in range(1, TURING + 1):
        turing = (r + 1) * seen[r + 1] / (r * seen[r]) if seen[r] else 0.0
        factors.append(float(turing) if 0 < turing < 1 else (1 + 1 / r) ** power)
    return factors, power


def discounted(counts: np.ndarray, discount: tuple[list[float], float]) -> np.ndarray:
    factors, power = discount
    low = np.array(factors)[np.minimum(counts, TURING)]
    r = np.maximum(counts, 1).astype(np.float64)
    return counts * np.where(counts > TURING, (1 + 1 / r) ** power, low)


def katz_scores(docs: DataFrame, *, order: int = 2, held: Column | None = None) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for each document.

    Tokens are words in lower case (A-Z) and one end. ``base_score`` adds one to the words' counts; ``score`` is the
    model's log10 probability. Unknown words share what the discounts of single words leave. Texts are independent
    of each other: repeated rows are counted and scored each. Without training texts all scores are null, but the
    base, which has no known words then.
    """
    spark = docs.sparkSession
    batches = token_batches(docs, held if held is not None else held_out(docs["doc_id"]))
    tokens = batches.agg(F.sum("tokens")).first()[0] or 0
    parts = max(1, -(-tokens // KEYS))
    answers = count_tables(batches, order, parts)
    sums = answers.where("t = -1").groupBy("m").agg(*[F.sum(F.col("stats")[i]).alias(f"s{i}") for i in range(SEEN + 2)])
    stats = {r[0]: list(r[1:]) for r in sums.collect()}  # one row for each order
    empty = [0] * (SEEN + 2)
    known, total = stats.get(0, empty)[SEEN], stats.get(0, empty)[SEEN + 1]
    texts = batches.agg(F.sum(F.size(F.filter("held", lambda h: ~h)))).first()[0] or 0
    steps = [discounts(stats.get(m, empty)[:SEEN]) for m in range(order)]
    factors, power = steps[0]
    single = answers.where("m = 0 AND t >= 0")
    given = _given(single, steps[0]) if total else 0.0
    unknown = max(1 - given / max(total, 1), 1e-12)

    def score(key: tuple, batch: pa.Table, said: pa.Table) -> pa.Table:
        if not batch.num_rows:
            return pa.table({n: pa.array([], t) for n, t in names.items()})
        row = batch.to_pylist()[0]
        grams = Grams(row, order)
        said = said.sort_by([("m", "ascending"), ("p", "ascending")])
        orders = said["m"].to_numpy()
        counts, owned = [], []
        for m in range(order):
            mine = said.filter(pa.array(orders == m))
            counts.append(np.concatenate([np.empty(0, np.int64), *(loosen(x, "i8") for x in mine["counts"].to_pylist())]))
            owned.append(np.concatenate([np.empty(0, np.uint8), *(loosen(x, "u1") for x in mine["owned"].to_pylist())]) > 0)
        n_texts = len(row["n"])
        at = grams.at[0]
        count = counts[0][at]
        base = np.bincount(grams.text, np.log10((count + 1) / (total + known + 1)), n_texts)
        n_known = np.bincount(grams.text, count > 0, n_texts).astype(np.int64)
        # Probabilities of each token by order, where its n-gram was seen.
        prob = np.where(count > 0, discounted(count, steps[0]) / max(total, 1), unknown)
        log, waits = np.log10(prob), []
        given_key, given_sum, given_low, given_count = [], [], [], []
        for m in range(1, order):
            if not len(grams.keys[m]):
                break
            lower = np.empty(len(at), dtype=np.int64)  # counts of the contexts: n-grams of order m
            key = np.empty(len(at), dtype=np.uint64)
            ending = counts[m - 1][np.maximum(grams.at[m - 1], 0)]
            lower[1:], key[1:] = ending[:-1], grams.keys[m - 1][np.maximum(grams.at[m - 1], 0)][:-1]
            first = grams.place == 0
            lower[first], key[first] = (texts, BEGIN) if m == 1 else (0, 0)
            has = grams.has[m]
            count = np.where(has, counts[m][np.maximum(grams.at[m], 0)], 0)
            seen = count > 0
            own = discounted(count, steps[m])
            new = np.where(seen, own / np.maximum(lower, 1), 0.0)
            # What each context gives away, summed by the batch that accounts for the n-gram.
            places = np.full(len(grams.keys[m]), -1, dtype=np.int64)
            places[grams.at[m][has]] = np.flatnonzero(has)
            places = places[owned[m]]
            ctx, back = np.unique(key[places], return_inverse=True)
            first_of = np.zeros(len(ctx), dtype=np.int64)
            first_of[back] = places
            given_key.append(ctx)
            given_sum.append(np.bincount(back, own[places], len(ctx)))
            given_low.append(np.bincount(back, prob[places], len(ctx)))
            given_count.append(lower[first_of])
            # A context that was never seen passes the token on as it is.
            wait = has & ~seen & (lower > 0)
            waits = [(w[0] & ~seen, w[1]) for w in waits] + [(wait, key)]
            log = np.where(seen, np.log10(np.where(seen, new, 1.0)), log)
            prob = np.where(seen, new, prob)
        done = np.bincount(grams.text, log, n_texts)
        need_text, need_key = [], []
        for wait, key in waits:
            need_text.append(grams.text[wait])
            need_key.append(key[wait])
        pairs = np.stack([np.concatenate(need_text).astype(np.uint64), np.concatenate(need_key)], axis=1) if waits else \
            np.empty((0, 2), np.uint64)
        pairs = pairs[np.lexsort((pairs[:, 0], pairs[:, 1]))]
        new = np.ones(len(pairs), dtype=bool)
        new[1:] = (pairs[1:] != pairs[:-1]).any(axis=1)
        starts = np.flatnonzero(new)
        times = np.diff(np.append(starts, len(pairs)))
        doc = row["t"] * 1  # texts are named by batch and place
        n_given, n_need = sum(map(len, given_key)), len(starts)

        def column(kind: str, texts_: object, given_: object, needs_: object) -> pa.Array:
            def part(values: object, n: int) -> pa.Array:
                return pa.nulls(n, names[kind]) if values is None else pa.array(values, names[kind])
            return pa.concat_arrays([part(texts_, n_texts), part(given_, n_given), part(needs_, n_need)])

        def flat(parts_: list[np.ndarray]) -> np.ndarray:
            return np.concatenate(parts_) if parts_ else np.empty(0)

        place = np.arange(n_texts, dtype=np.int64)
        wanted = pairs[starts]
        return pa.table({
            "t": column("t", np.full(n_texts, doc), None, np.full(n_need, doc)),
            "place": column("place", place, None, wanted[:, 0].astype(np.int64)),
            "key": column("key", None, flat(given_key).astype(np.uint64).view(np.int64), wanted[:, 1].copy().view(np.int64)),
            "doc_id": column("doc_id", row["doc_id"], None, None), "held_out": column("held_out", row["held"], None, None),
            "n_tokens": column("n_tokens", np.array(row["n"], dtype=np.int64), flat(given_count).astype(np.int64), times.astype(np.int64)),
            "n_known": column("n_known", n_known, None, None),
            "base": column("base", base, flat(given_sum), None), "log": column("log", done, flat(given_low), None)})

    names = {"t": pa.int64(), "place": pa.int64(), "key": pa.int64(), "doc_id": pa.int64(), "held_out": pa.bool_(),
             "n_tokens": pa.int64(), "n_known": pa.int64(), "base": pa.float64(), "log": pa.float64()}
    schema = "t long, place long, key long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, log double"
    out = saved(batches.groupBy("t").cogroup(answers.where("t >= 0").groupBy("t")).applyInArrow(score, schema), "katz-scored")
    text = out.where("place IS NOT NULL AND key IS NULL")
    # Contexts: what is left of 1 in their own n-grams, over what is left of 1 in the shorter ones.
    left = out.where("place IS NULL").groupBy("key").agg(
        (1 - F.sum("base") / F.max("n_tokens")).alias("left"), (1 - F.sum("log")).alias("lower"))
    weights = left.select("key", F.log10(F.greatest("left", F.lit(1e-300)) / F.greatest("lower", F.lit(1e-300))).alias("weight"))
    backed = out.where("place IS NOT NULL AND key IS NOT NULL").select("t", "place", "key", "n_tokens").join(
        weights, "key").groupBy("t", "place").agg(F.sum(F.col("weight") * F.col("n_tokens")).alias("backed"))
    total_score = F.when(F.lit(total > 0), F.col("log") + F.coalesce("backed", F.lit(0.0)))
    return text.join(backed, ["t", "place"], "left").select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"), total_score.alias("score"))


def _given(answers: DataFrame, discount: tuple[list[float], float]) -> float:
    """What the known words have of the probability of single words, times the number of training tokens."""
    def add(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for batch in rows:
            for counts, owned in zip(batch.column("counts").to_pylist(), batch.column("owned").to_pylist()):
                total += float(discounted(loosen(counts, "i8")[loosen(owned, "u1").astype(bool)], discount).sum())
        yield pa.RecordBatch.from_arrays([pa.array([total])], ["given"])

    return answers.select("counts", "owned").mapInArrow(add, "given double").agg(F.sum("given")).first()[0] or 0.0
