"""Spelling variants against a plain count and a plain comparison of all words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import spelling
from tidemark.llm.bloom import among
from tidemark.llm.bloom import bits as bits_of

SCHEMA = "doc_id long, text string, word string, n long, form string"


def plain(docs):
    counts = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    letters = sorted({c for w in words for c in w})
    out = {}
    for w in words:
        near = {w[:i] + w[i + 1:] for i in range(len(w))}
        near |= {w[:i] + c + w[i + d:] for d in (0, 1) for c in letters for i in range(len(w) + 1 - d)}
        near = sorted((near - {w}) & words.keys(), key=lambda o: (-words[o], o))
        out[w] = (near[0] if near and words[near[0]] >= 5 * words[w] else None, len(near))
    rows = set()
    for w, (form, n_near) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.add((w, form, root, words[w], n_near, words[form] if form else None))
    return rows


def corpus(seed=3):
    rng, docs = random.Random(seed), []
    stems = ["".join(rng.choice("abcdeéßü") for _ in range(rng.randint(6, 9))) for _ in range(25)] + ["aaaaaa", "aaaaaaa", "aaabaaa"]
    pool = []
    for stem in stems:
        pool += [stem] * rng.choice((5, 30, 200))
        for _ in range(4):
            i, c = rng.randrange(len(stem)), rng.choice("abcdeéßü")
            pool += [rng.choice((stem[:i] + stem[i + 1:], stem[:i] + c + stem[i:], stem[:i] + c + stem[i + 1:]))] * rng.choice((2, 5, 6, 26))
    rng.shuffle(pool)
    for i in range(0, len(pool), 20):
        docs.append((i, rng.choice((" ", ". ", "\n", "1")).join(w.title() if rng.random() < 0.2 else w for w in pool[i:i + 20])))
    long = "x" * 3000
    return docs + [(None, " ".join(pool[:40])), (7, None), (8, ""), (9, "1234 ..."), (10, f"{long} {long} {long}y {long}y {long}z " * 5),
                   (11, "Ünder Ünderx Ünderx " * 9 + "ab÷cd×ef " * 6)] + docs[:2]


def test_equals_plain(spark):
    docs = corpus()
    table = spark.createDataFrame([(*d, "w", 1, "f") for d in docs], SCHEMA).repartition(4)
    expected = plain(docs)
    assert {tuple(r) for r in spelling.spelling_variants(table).collect()} == expected
    assert sum(1 for r in expected if r[1]) > 10 and any(r[2] != r[1] for r in expected if r[1])
    assert any(len(r[0]) > 2000 and r[4] for r in expected)
    # A filter too small for the vocabulary takes several rounds and loses nothing.
    assert {tuple(r) for r in spelling.spelling_variants(table, most=120).collect()} == expected


def test_no_rows(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], SCHEMA)).collect() == []
    assert spelling.spelling_variants(spark.createDataFrame([(1, "few words only", "", 1, "")], SCHEMA)).collect() == []


def test_filters_hold_every_word_and_little_else():
    rng = np.random.default_rng(1)
    words = list({"".join(map(chr, rng.integers(97, 123, rng.integers(6, 12)))) for _ in range(5000)})
    at = spelling.Filters(Counter(map(len, words)))
    filled = np.zeros(at.size, dtype=np.uint64)

    def block_and_bits(some):
        for places, letters in spelling.by_length(some):
            h = spelling.word_hashes(letters)
            yield at.block(h, letters.shape[1]), bits_of(h)

    for block, bits in block_and_bits(words):
        np.bitwise_or.at(filled, block, bits)
    assert all(((filled[block] & bits) == bits).all() for block, bits in block_and_bits(words))
    others = ["".join(map(chr, rng.integers(65, 91, 8))) for _ in range(20000)]
    passed = sum(((filled[block] & bits) == bits).sum() for block, bits in block_and_bits(others))
    assert passed < 0.01 * len(others)


def test_what_is_among_others(spark):
    some = spark.range(0, 3000, 3).withColumnRenamed("id", "rid")
    held = [r[0] for r in spark.range(9000).where(among(some, "rid")("id")).collect()]
    assert set(range(0, 3000, 3)) <= set(held) and len(held) < 1000 + 160
    crowded = among(some, "rid", most_bytes=64)  # far too small: all that are in still pass
    assert spark.range(3000).where(crowded("id") & (F.col("id") % 3 == 0)).count() == 1000
    assert spark.range(50).where(among(some.limit(0), "rid")("id")).count() == 0


def test_every_edit_is_made_once():
    words = ["aabbcc", "aabbccd", "abcdef"]
    letters = np.array(sorted({ord(c) for w in words for c in w}), dtype=np.uint8)
    every = spelling.Filters({n: 1 for n in range(1, 12)})
    made = list(spelling.passing(words, letters, every, np.full(every.size, (1 << 64) - 1, dtype=np.uint64), 0))
    expected = [(1, e) for e in {"abbccd", "aabccd", "aabbcd", "aabbcc"}]
    expected += [(i, w[:j] + c + w[j + 1:]) for i, w in enumerate(words) for j in range(len(w)) for c in "abcdef" if c > w[j]]
    assert sorted((int(i), e) for i, e in made) == sorted(expected)
