"""Near copies of the pipeline against all pairs."""

import random


import corpus_pipeline
from tidemark.llm import near_copies

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n):
    return [f"w{rng.randrange(100_000)}" for _ in range(n)]


def edited(rng, base, n):
    out = list(base)
    for i in rng.sample(range(len(out)), n):
        out[i] = f"e{rng.randrange(1_000_000)}"
    return out


def shingles(text):
    w = text.lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def plain_least(texts):
    """The least id of each document's component over all pairs of similarity 0.8 or more."""
    sets, root = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in texts:
        for b in texts:
            if a < b and (len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9 or sets[a] == sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in texts}


def test_planted_near_copies_leave_the_pipeline(spark):
    rng = random.Random(5)
    bases = [words(rng, 200) for _ in range(12)]
    texts = {i: " ".join(b) for i, b in enumerate(bases)}
    texts |= {100 + i: " ".join(b[:100] + [f"new{i}"] + b[101:160] + [f"other{i}"] + b[161:]) for i, b in enumerate(bases)}
    texts |= {200 + i: " ".join(b[:60] + words(rng, 140)) for i, b in enumerate(bases)}  # less alike
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items()], SCHEMA).repartition(3)
    left = {r["doc_id"] for r in corpus_pipeline.near_copies(spark, docs, "").collect()}
    assert left == {i for i in texts if i < 100 or i >= 200}


def test_components_equal_all_pairs(spark):
    rng = random.Random(9)
    texts = {}
    for size, most in ((150, 4), (60, 9), (25, 2)):  # a crowded group, and groups at the threshold
        base = words(rng, 120)
        for _ in range(size):
            texts[len(texts)] = " ".join(edited(rng, base, rng.randint(0, most)))
    texts |= {len(texts) + i: " ".join(words(rng, rng.randint(1, 30))) for i in range(40)}
    texts |= {1000: "", 1001: " \n", 1002: "one two", 1003: "ONE\ttwo", 1004: "one two three"}
    rows = [(i, t, "en", "s", len(t)) for i, t in texts.items()]
    rows += [(None, "one two", "en", "s", 7), (2000, None, None, None, None), (3, texts[3], "en", "s", 1)]
    out = near_copies.near_copies(spark.createDataFrame(rows, SCHEMA).repartition(4))
    found = out.select("doc_id", "component_id", "keep").toPandas()
    plain = plain_least(texts | {2000: ""})
    assert dict(zip(found["doc_id"].dropna(), found["component_id"][found["doc_id"].notna()])) == plain
    assert found[found["doc_id"].isna()]["component_id"].tolist() == [1002.0]
    assert sorted(found[found["keep"]]["doc_id"]) == sorted(set(plain.values()))
    assert len(found) == len(rows)


def test_ids_that_are_null(spark):
    out = near_copies.near_copies(spark.createDataFrame([(None, "a b"), (None, "a b"), (None, "c")], "doc_id long, text string"))
    assert sorted(map(tuple, out.select("component_id", "keep").collect()), key=repr) == [(None, False), (None, True), (None, True)]


def test_a_crowded_bucket_of_sets_that_are_apart(spark):
    rng = random.Random(11)
    passage = words(rng, 80)
    texts = {}
    for own in (2, 5, 8, 9, 12, 15, 16, 17, 18, 19, 20, 21, 24, 30, 60):  # around what links sets that share the passage
        for _ in range(9):
            texts[len(texts)] = " ".join(passage + words(rng, own))
    parts = [words(rng, 20) for _ in range(7)]  # texts made of passages all of which are common
    for i in range(60):
        texts[len(texts)] = " ".join(sum(rng.sample(parts, 5), words(rng, i % 5)))
    smallest = {i: t for i, t in texts.items() if len(t.split()) > 88}  # also without the sets that link everybody
    for some in (texts, smallest):
        docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in some.items()], SCHEMA).repartition(4)
        found = near_copies.near_copies(docs).select("doc_id", "component_id").toPandas()
        assert dict(zip(found["doc_id"], found["component_id"])) == plain_least(some)


def test_prefixes_keep_every_pair_within_reach(spark):
    rng = random.Random(12)
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(edited(rng, base, rng.randint(0, 4))[rng.randint(0, 6):]) for _ in range(60)]
    sets = spark.createDataFrame([(i, near_copies.shingle_hashes(t).view("int64").tolist()) for i, t in enumerate(texts)],
                                 "node long, hashes array<bigint>")
    rows = near_copies._prefixes(sets, 0.8).toPandas()
    met = set()
    for _, group in rows.groupby("token"):
        for a in group.itertuples():
            met |= {(a.node, b.node) for b in group.itertuples() if a.node < b.node and a.n <= b.reach and b.n <= a.reach}
    hashes = {r["node"]: set(r["hashes"]) for r in sets.collect()}
    wanted = {(a, b) for a in hashes for b in hashes if a < b and len(hashes[a] & hashes[b]) >= 0.8 * len(hashes[a] | hashes[b])}
    assert wanted and wanted <= met
