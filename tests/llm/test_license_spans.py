"""Licence spans with passages put in, left out, repeated, replaced and moved, against a plain alignment."""

import random
import re

import pytest

from tidemark.llm.license_texts import TEMPLATES
from tidemark.llm.licenses import license_labels, scan

LABEL, TEXT = TEMPLATES[0]
WORDS = TEXT.split()
N = len(WORDS)


def noise(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(n)]


def aligned(words: list[str]) -> float:
    """Share of the template's words in the longest common subsequence with a text."""
    row = [0] * (N + 1)
    for word in words:
        above, row = row, [0]
        for j, other in enumerate(WORDS):
            row.append(above[j] + 1 if word == other else max(above[j + 1], row[j]))
    return row[-1] / N


HALF, THIRD = N // 2, N // 3
CHANGED = {
    "whole": WORDS,
    "one word put in": WORDS[:HALF] + ["zuzuzu"] + WORDS[HALF:],
    "word put in, own words repeated": WORDS[:HALF] + ["zuzuzu"] + WORDS[HALF - 20:HALF - 15] + WORDS[HALF:],
    "own words repeated, word put in": WORDS[:HALF] + WORDS[HALF - 20:HALF - 15] + ["zuzuzu"] + WORDS[HALF:],
    "own words from the end put in": WORDS[:HALF] + WORDS[-15:] + WORDS[HALF:],
    "passage put in": WORDS[:HALF] + noise(1, 25) + WORDS[HALF:],
    "passage left out": WORDS[:HALF] + WORDS[HALF + 15:],
    "passage replaced": WORDS[:HALF] + noise(2, 15) + WORDS[HALF + 15:],
    "passage moved": WORDS[:THIRD] + WORDS[THIRD + 12:] + WORDS[THIRD:THIRD + 12],
    "words put in all over": [w for i, word in enumerate(WORDS) for w in ([word, "zuzuzu"] if i % 15 == 7 else [word])],
    "between other words": noise(3, 200) + WORDS[:HALF] + ["zuzuzu"] + WORDS[:6] + WORDS[HALF:] + noise(4, 300),
}
OTHER = {
    "shuffled": random.Random(5).sample(WORDS, N),
    "first half": WORDS[:HALF],
    "halves far apart": WORDS[:HALF] + noise(6, 3 * N) + WORDS[HALF:],
    "five words again and again": WORDS[10:15] * 40,
    "none": noise(7, 100),
}


@pytest.fixture(scope="module")
def found(spark):
    rows = [(name, " ".join(words)) for name, words in (CHANGED | OTHER).items()]
    out = license_labels(spark.createDataFrame(rows, "doc_id string, text string"))
    return {r["row"]["doc_id"]: (r["labels"], r["score"]) for r in out.collect()}


@pytest.mark.parametrize("name", CHANGED)
def test_changed_licence_is_found(found, name):
    assert aligned(CHANGED[name]) >= 0.7
    labels, score = found[name]
    assert labels == LABEL and score >= 0.7


@pytest.mark.parametrize("name", OTHER)
def test_other_text_is_left_alone(found, name):
    assert found[name] == ("", 0.0)
    assert aligned(OTHER[name]) < 0.7 or name == "halves far apart"


def test_copies_are_spans_of_their_own(spark):
    stray = WORDS[30:36]
    words = [*noise(8, 10), *WORDS, *stray, *WORDS, *stray, *noise(9, 5), *WORDS]
    _, spans = scan(spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string"), ["doc_id"])
    got = sorted((r["start"], r["end"]) for r in spans.where("NOT phrase").collect())
    assert len(got) == 3
    assert all(end <= start for (_, end), (start, _) in zip(got, got[1:]))
    assert got[0][0] == 10 and got[-1][1] == len(re.findall("[A-Za-z0-9]+", " ".join(words)))
