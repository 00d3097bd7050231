"""Encoding to the ids of a public piece vocabulary, and decoding, by streaming Viterbi.

A vocabulary gives pieces with scores; the best split of a text is the one of the greatest total score. The
search reads the text once. It keeps scores for as many boundaries as the longest piece has characters, and
backpointers from the last boundary that all surviving paths share; whenever they meet at a later one, the ids
up to there are committed. Where no piece reaches over a place (before a space that follows a word, around
characters of no longer piece) the paths have met, so texts are cut there and frequent cuts are remembered.

The model's file holds ranks of merges, not probabilities. A piece's score is minus the logarithm of its place
in the vocabulary, which is the rule for frequencies by rank; nothing is trained. A space stands for the
model's mark of a word's start, so that the mark itself in a text, like every other character without a
piece, becomes bytes, and decoding gives back each text exactly.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import packed, whole

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Vocabularies are sent to every task; larger ones are refused.
MAX_PIECES = 1_000_000
REMEMBERED = 400_000
#: Characters of a cut that may be remembered, and of the texts whose new cuts are taken in order.
SHORT = 64
TOGETHER = 1 << 20
#: Scores are whole multiples of 1 / UNIT, so that equal sums are equal in any order.
UNIT = 1 << 20


class Vocabulary:
    """Pieces with ids and scores, one id for each byte, and the text or bytes of each id."""

    def __init__(self, pieces: dict[str, tuple[int, int]], byte_ids: list[int]):
        if len(pieces) > MAX_PIECES:
            raise ValueError("too many pieces to send to every task")
        self.pieces, self.byte_ids = pieces, byte_ids
        self.longest = max(map(len, pieces), default=1)
        self.bytes_of = {i: p.encode() for p, (i, _) in pieces.items()} | {i: bytes([b]) for b, i in enumerate(byte_ids)}
        self.byte_score = min((s for _, s in pieces.values()), default=0) - 10 * UNIT
        inside = {c for p in pieces if len(p) > 1 for c in p}
        spaced = any(re.search("[^ ] ", p) for p in pieces)
        lone = "" if "\n" in inside else "\n"
        #: Cuts that no piece crosses; None if spaces are found inside pieces.
        self.cut = None if spaced else re.compile(f" *[^ {lone}]+| +" + (f"|{lone}" if lone else ""))

    @classmethod
    def load(cls, path: str = MODEL) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, byte_ids = {}, [0] * 256
        for i in range(model.get_piece_size()):
            if model.is_byte(i):
                byte_ids[int(model.id_to_piece(i)[3:-1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                pieces[model.id_to_piece(i).replace(MARK, " ")] = (i, -round(UNIT * math.log(i + 1)))
        return cls(pieces, byte_ids)


def stream(vocabulary: Vocabulary, chars: Iterable[str]) -> Iterator[int]:
    """The ids of the best split of a stream of characters; of equal splits the one whose last pieces are longest."""
    get, longest, byte_ids, byte_score = vocabulary.pieces.get, vocabulary.longest, vocabulary.byte_ids, vocabulary.byte_score
    window = ""  # the last characters, as many as the longest piece has
    base, end = 0, 0  # the committed boundary, the last one
    score: list[float] = [0]  # of boundaries end - len(window) to end
    back: dict[int, tuple[int, tuple[int, ...]]] = {}
    for c in chars:
        window = (window + c)[-longest:]
        end += 1
        n, best, at, ids = len(window), -math.inf, 0, ()
        for size in range(n, 0, -1):
            piece = get(window[n - size:])
            if piece is not None and (value := score[-size] + piece[1]) > best:
                best, at, ids = value, end - size, (piece[0],)
        if get(c) is None:
            data = c.encode()
            if (value := score[-1] + byte_score * len(data)) > best:
                best, at, ids = value, end - 1, tuple(byte_ids[b] for b in data)
        back[end] = (at, ids)
        score = [*score, best][-longest:] if longest > 1 else [best]
        if end - base >= 2 * longest and end % longest == 0:
            met, paths = _meeting(back, [b for b in range(max(base, end - longest + 1), end + 1)], base)
            if met > base:
                yield from paths
                for b in range(base + 1, met + 1):
                    back.pop(b, None)
                base = met
    yield from _path(back, end, base)


def _path(back: dict[int, tuple[int, tuple[int, ...]]], end: int, base: int) -> list[int]:
    out = []
    while end > base:
        end, ids = back[end]
        out.append(ids)
    return [i for ids in reversed(out) for i in ids]


def _meeting(back: dict, live: list[int], base: int) -> tuple[int, list[int]]:
    """The last boundary on the paths of all live boundaries, and the ids from ``base`` to it."""
    points = set(live)
    while len(points) > 1:  # the rightmost can only be shared if it is the only one
        right = max(points)
        points.remove(right)
        points.add(back[right][0])
    met = points.pop()
    return met, _path(back, met, base) if met > base else []


def encoder(vocabulary: Vocabulary) -> Callable[[str], list[int]]:
    """A function from a text to its ids. It remembers short cuts, a bounded number of them."""
    encode = batch_encoder(vocabulary)
    return lambda text: next(encode([text]))


def batch_encoder(vocabulary: Vocabulary) -> Callable[[Iterable[str]], Iterator[list[int]]]:
    """A function from texts to the ids of each. It remembers short cuts, a bounded number of them.

    The best split up to a boundary depends on what stands before it only, so new cuts are taken in order, and each goes on
    from the characters that it shares with the one before.
    """
    known: dict[str, tuple[int, ...]] = {}
    get, byte_ids, byte_score = vocabulary.pieces.get, vocabulary.byte_ids, vocabulary.byte_score

    root: dict[str, list] = {}  # by character, backwards: what may stand before, and the id and score of the piece that begins here
    for piece, (i, value) in vocabulary.pieces.items():
        below = root
        for c in piece[:0:-1]:
            below = below.setdefault(c, [{}, -1, 0])[0]
        below.setdefault(piece[0], [{}, -1, 0])[1:] = i, value

    def learn(cuts: list[str]) -> None:
        """As ``stream`` does it, for cuts of up to ``SHORT`` characters, in order."""
        score, at, ids = [0] * (SHORT + 1), [0] * (SHORT + 1), [-1] * (SHORT + 1)
        before = ""
        for cut in cuts:
            n, shared = len(cut), 0
            for c, d in zip(cut, before):
                if c != d:
                    break
                shared += 1
            for end in range(shared + 1, n + 1):
                best, start, last = -math.inf, 0, -1
                if get(c := cut[end - 1]) is None:
                    best, start = score[end - 1] + byte_score * len(c.encode()), end - 1
                below = root
                for i in range(end - 1, -1, -1):
                    node = below.get(cut[i])
                    if node is None:
                        break
                    below, piece, value = node
                    if piece >= 0 and (value := value + score[i]) >= best:  # of equal ones the longest
                        best, start, last = value, i, piece
                score[end], at[end], ids[end] = best, start, last
            before = cut
            out: list[int] = []
            while n:  # backwards
                if ids[n] >= 0:
                    out.append(ids[n])
                else:
                    out.extend(byte_ids[b] for b in reversed(cut[n - 1].encode()))
                n = at[n]
            known[cut] = tuple(reversed(out))

    def parts(texts: Iterable[str]) -> Iterator[list[str]]:
        """Some texts at a time: as many as have ``TOGETHER`` characters, or a single one."""
        some, size = [], 0
        for text in texts:
            if some and size + len(text) > TOGETHER:
                yield some
                some, size = [], 0
            some.append(" " + text)
            size += len(text)
        if some:
            yield some

    def learn_new(cuts: list[str]) -> None:
        if len(known) >= REMEMBERED:
            known.clear()
        learn(sorted(cut for cut in set(cuts).difference(known) if len(cut) <= SHORT))

    def joined(cuts: list[str]) -> list[int]:
        if max(map(len, cuts), default=0) > SHORT:
            return [i for cut in cuts for i in (known[cut] if len(cut) <= SHORT else stream(vocabulary, cut))]
        return [*itertools.chain.from_iterable(map(known.__getitem__, cuts))]

    def streamed(text: str) -> Iterator[list[int]]:
        """The ids of a text of any length, whose cuts are not all held at once."""
        found = vocabulary.cut.finditer(text)
        while cuts := [m[0] for m in itertools.islice(found, TOGETHER >> 3)]:
            learn_new(cuts)
            yield joined(cuts)

    def encode(texts: Iterable[str]) -> Iterator[list[int]]:
        if vocabulary.cut is None:
            yield from (list(stream(vocabulary, " " + text)) for text in texts)
            return
        for some in parts(texts):
            if len(some[0]) > TOGETHER:
                yield [*itertools.chain.from_iterable(streamed(some[0]))]
                continue
            cuts = [vocabulary.cut.findall(text) for text in some]
            learn_new([*itertools.chain.from_iterable(cuts)])
            yield from map(joined, cuts)

    return encode


def decode(vocabulary: Vocabulary, ids: Iterable[int]) -> str:
    return b"".join(map(vocabulary.bytes_of.__getitem__, ids)).decode()[1:]


def encode_documents(docs: DataFrame, *, model: str = MODEL, columns: list[str] | None = None) -> DataFrame:
    """``row`` (``columns`` or all), ``ids``, ``n_ids``, ``n_bytes`` (ids that are bytes) and ``exact``.

    ``exact``: decoding the ids gave the text again. A null text is an empty one, whose ids are the word start.
    No row depends on another, so nothing is shuffled.
    """
    vocabulary = Vocabulary.load(model)
    pieces, byte_ids = vocabulary.pieces, vocabulary.byte_ids
    made: list = []

    @F.arrow_udf("struct<ids: array<int>, n_bytes: int, exact: boolean>")
    def encoded(texts: pa.Array) -> pa.Array:
        import numpy as np

        if not made:
            own = Vocabulary(pieces, byte_ids)
            made.extend([own, batch_encoder(own), np.isin(np.arange(max(own.bytes_of) + 1), byte_ids)])
        own, encode, is_byte = made
        ids, ends, n_bytes, exact = [], [0], [], []
        for text, found in zip(texts, encode(text.as_py() for text in texts)):
            array = np.array(found, dtype=np.int32)
            ids.append(array)
            ends.append(ends[-1] + len(array))
            n_bytes.append(int(is_byte[array].sum()))
            exact.append(decode(own, found) == text.as_py())
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(
            np.concatenate(ids) if ids else np.empty(0, np.int32)))
        return pa.StructArray.from_arrays([lists, pa.array(n_bytes, pa.int32()), pa.array(exact)], ["ids", "n_bytes", "exact"])

    rows = packed(docs, encoded(whole(docs["text"])).alias("e"))
    return rows.select(F.struct(*[F.col("row").getField(c).alias(c) for c in columns or docs.columns]).alias("row"),
                       "e.ids", F.size("e.ids").alias("n_ids"), "e.n_bytes", "e.exact")
