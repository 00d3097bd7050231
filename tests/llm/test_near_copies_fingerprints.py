"""The near copies of the pipeline: links by SimHash, crowded buckets, scratch files."""

import random

import corpus_pipeline
from test_near_copies import SCHEMA, edited, plain_least, words

from tidemark.llm import mixing, near_copies, simhash


def rows(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items()], SCHEMA).repartition(3)


def test_links_by_fingerprint_count(spark):
    """Texts alike but for words among many repeats: the sets of five-word shingles differ, the fingerprints hardly."""
    rng = random.Random(3)
    phrase = words(rng, 9)
    texts = {i: " ".join(phrase * 400 + words(rng, 12)) for i in range(3)}
    texts |= {10 + i: " ".join(words(rng, 60)) for i in range(3)}
    fps = [simhash.fingerprint_of(texts[i]) for i in range(3)]
    assert all((a ^ b).bit_count() <= 2 for a in fps for b in fps) and plain_least(texts) == {i: i for i in texts}
    docs = rows(spark, texts)
    assert {r["doc_id"] for r in corpus_pipeline.near_copies(spark, docs, "").collect()} == {0, 10, 11, 12}
    # Both kinds of links together: 20 is a near copy of 1 only, 1 is linked with 0 by its fingerprint.
    texts[20] = " ".join(texts[1].split()[:-1])
    out = near_copies.near_copies(rows(spark, texts), fingerprints=True).select("doc_id", "component_id", "keep").toPandas()
    assert dict(zip(out["doc_id"], out["component_id"])) == {i: 0 if i in (0, 1, 2, 20) else i for i in texts}
    assert sorted(out[out["keep"]]["doc_id"]) == [0, 10, 11, 12]


def test_changed_copies_of_one_text_make_few_pairs(spark, monkeypatch):
    """Copies with changes of their own are near copies of the text, not of each other."""
    rng = random.Random(4)
    base = words(rng, 200)
    copies = [" ".join(edited(rng, base, 3)[rng.randint(0, 3):]) for _ in range(150)]
    short = " ".join(base[20:] + words(rng, 5))  # a smaller set than the text's, and far from most copies
    texts = dict(enumerate([" ".join(base + words(rng, 3)), short, *copies]))
    seen = []

    def counted(df, name, saved=near_copies.saved):
        out = saved(df, name)
        if name == "near-pairs":
            seen.append(out.count())
        return out

    monkeypatch.setattr(near_copies, "saved", counted)
    out = near_copies.near_copies(rows(spark, texts)).select("doc_id", "component_id").toPandas()
    assert dict(zip(out["doc_id"], out["component_id"])) == plain_least(texts)
    assert seen[-1] < len(texts)


def test_the_mixture_does_not_store_texts_again(spark, monkeypatch):
    stored = []

    def noted(df, name, saved=mixing.saved):
        stored.append(df.schema.simpleString())
        return saved(df, name)

    monkeypatch.setattr(mixing, "saved", noted)
    rng = random.Random(6)
    docs = rows(spark, {i: " ".join(words(rng, 5 + i)) for i in range(40)})
    assert set(corpus_pipeline.mixture(spark, docs, "").columns) == set(docs.columns)
    assert stored and not any("text" in s for s in stored)
