"""Texts encoded together: as one by one, whatever they share and however much is remembered."""

import random

from tidemark.llm import pieces


def test_texts_together_as_one_by_one(monkeypatch):
    vocabulary = pieces.Vocabulary.load()
    rng = random.Random(8)
    texts = ["", " ", "\n", "a\n\nb   c ", "▁ é😀" + "x" * 70 + " y", " " * 300, "ab" * 50, "the then them they thematic"]
    texts += ["".join(rng.choice("abé▁😀\n中 the") for _ in range(rng.randint(0, 400))) for _ in range(60)]
    plain = [list(pieces.stream(vocabulary, " " + t)) for t in texts]
    calls = []

    def walked(cut, before, zip=zip):
        calls.append(cut)
        return zip(cut, before)

    for together, remembered in ((1 << 20, 400_000), (50, 20)):  # also: long texts in parts, and forgetting all the time
        monkeypatch.setattr(pieces, "TOGETHER", together)
        monkeypatch.setattr(pieces, "REMEMBERED", remembered)
        monkeypatch.setattr(pieces, "zip", walked, raising=False)
        encode = pieces.batch_encoder(vocabulary)
        assert list(encode(texts)) == plain and list(encode(reversed(texts))) == plain[::-1]
        if remembered == 400_000:  # new cuts are taken in order, so that what they share is done once
            assert calls == sorted(set(calls)) and len(calls) > 100
    assert [pieces.encoder(vocabulary)(t) for t in texts] == plain
