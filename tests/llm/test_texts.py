"""Quality, licences, mixing, near copies, personal data, pieces and the pipeline on hard rows."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pandas as pd
import pytest
import xxhash
from hard_rows import prose
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import pieces, pii, simhash
from tidemark.llm.components import components
from tidemark.llm.mixing import mix
from tidemark.llm.queries import ORACLES, QUERIES
from tidemark.llm.quality import quality_rules


def rows(df) -> list[tuple]:
    columns = sorted(df.columns)
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", sorted(set(ORACLES) - {"op4_neighbours"}))  # that table has a test of its own
def test_equals_sql(spark, tables, name):
    db = duckdb.connect()
    for table in ("documents", "pages"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tables}/{table}.parquet'")
    cursor = db.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    theirs = sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=repr)
    assert rows(QUERIES[name](spark, tables)) == theirs


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op4_neighbours"}))
def test_empty(spark, nothing, name):
    assert QUERIES[name](spark, nothing).collect() == []


def test_pipeline_on_empty_table(spark, nothing):
    assert corpus_pipeline.run(spark, nothing).collect() == []


def test_outliers_are_rejected_and_others_stay(spark):
    made = [(i, prose(i, 80 + i % 200), "en", "s") for i in range(300)]
    odd = [(1000 + i, " ".join(w + "%%%" for w in prose(i, 100).split()), "en", "s") for i in range(60)]
    out = quality_rules(spark.createDataFrame(made + odd, "doc_id long, text string, lang string, source string"))
    kept = {r["row"]["doc_id"]: r["kept"] for r in out.collect()}
    assert not any(kept[i] for i, *_ in odd)
    assert sum(kept[i] for i, *_ in made) >= 297


def test_marginals_meet_targets(spark):
    made = [(i, prose(i, 100), ("en", "de")[i % 4 == 0], ("a", "b", "c")[i % 3]) for i in range(240)]
    out = mix(spark.createDataFrame(made, "doc_id long, text string, lang string, source string"), budget=0.2,
              targets={"lang": {"en": 0.5, "de": 0.5}, "source": {"a": 0.6}}, topic=F.lit("one"))
    got = out.withColumn("t", F.col("probability") * F.col("n_tokens")).toPandas()
    assert got.groupby("lang")["t"].sum().div(got["t"].sum())["de"] == pytest.approx(0.5, abs=1e-3)
    assert got.groupby("source")["t"].sum().div(got["t"].sum())["a"] == pytest.approx(0.6, abs=1e-3)
    assert got["t"].sum() / got["n_tokens"].sum() == pytest.approx(0.2, abs=1e-6)
    assert 0.12 < got["sampled"].mean() < 0.28


def plain_fingerprint(text) -> int:
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, linked) -> dict:
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {n: find(n) for n in nodes}


def test_simhash_equals_plain(spark, tables, frame):
    fps = [plain_fingerprint(t if isinstance(t, str) else None) for t in frame["text"]]
    root = plain_components(set(fps), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for i, f in zip(frame["doc_id"], fps):
        if not pd.isna(i):
            least[root[f]] = min(least.get(root[f], i), i)
    expected = sorted(((None if pd.isna(i) else int(i)), f"{f:016x}", least.get(root[f])) for i, f in zip(frame["doc_id"], fps)
                      if not pd.isna(i))
    got = sorted(tuple(r) for r in QUERIES["op8_simhash"](spark, tables).where("doc_id IS NOT NULL").collect())
    assert got == [(i, f, c) for i, f, c in expected]
    assert QUERIES["op8_simhash"](spark, tables).count() == len(frame)


def test_crowded_buckets_lose_no_link(spark):
    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(3)]
    fps = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for c in centres for _ in range(150)}
    fps |= {rng.getrandbits(64) for _ in range(50)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"))
    assert all(((r["a"] ^ r["b"]) & (1 << 64) - 1).bit_count() <= 2 for r in edges.collect())
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    plain = plain_components(signed, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 2)
    assert {n: got.get(n, n) for n in signed} == plain


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}


def plain_spans(text) -> list:
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c in "0123456789"]
        doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
        if 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_personal_data_equals_plain(spark, tables, frame):
    expected = []
    for i, text in zip(frame["doc_id"], frame["text"]):
        spans = plain_spans(text) if isinstance(text, str) else []
        written = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        expected.append((None if pd.isna(i) else int(i), *(sum(s[0] == k for s in spans) for k in pii.BASE_KINDS),
                         hashlib.sha256(written.encode()).hexdigest()))
    out = QUERIES["op9_personal_data"](spark, tables).collect()
    assert sorted((tuple(r)[:6] for r in out), key=repr) == sorted(expected, key=repr)


def test_spans_of_random_strings():
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice("a1@.+- 29(") for _ in range(rng.randint(0, 40)))
        assert [(pii.KINDS[k], a, b) for k, a, b in pii.base_spans(text)] == plain_spans(text), text


def test_contexts_find_unseen_identifiers(spark):
    def luhn(body: int) -> str:
        return next(f"{body}{d}" for d in range(10) if pii.luhn(f"{body}{d}"))

    made = [(i, f"{prose(i, 9)} my card number: {luhn(453914880343600 + 7 * i)} and {prose(i, 5)}") for i in range(30)]
    made += [(100, f"We saw card number: 4539148803436461 and {prose(3, 9)}"), (101, "The year 2024-2025-x and nothing")]
    docs = spark.createDataFrame(made, "doc_id long, text string")
    out = {r["row"]["doc_id"]: r for r in pii.personal_data(docs).collect()}
    found = [(pii.KINDS[s["kind"]], made[30][1][s["start"]:s["end"]]) for s in out[100]["spans"]]
    assert found == [("context_card", "4539148803436461")]
    assert out[101]["spans"] == [] and len(out[3]["spans"]) == 1


def test_redaction_joins_overlaps():
    assert pii.redact("a 12 34 b", [(2, 2, 7), (3, 5, 7)]) == "a <CARD> b"
    assert pii.redact("x@y.z", [(4, 0, 5)]) == "<EMAIL>"


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary.load()


def best_total(vocabulary, text: str) -> int:
    """The greatest total score, by all splits of the whole text."""
    text = " " + text
    score = [0] + [None] * len(text)
    for j in range(1, len(text) + 1):
        options = [score[i] + vocabulary.pieces[text[i:j]][1] for i in range(max(0, j - vocabulary.longest), j) if text[i:j] in vocabulary.pieces]
        if text[j - 1] not in vocabulary.pieces:
            options.append(score[j - 1] + vocabulary.byte_score * len(text[j - 1].encode()))
        score[j] = max(options)
    return score[-1]


def total(vocabulary, ids) -> int:
    scores = {i: s for i, s in vocabulary.pieces.values()}
    return sum(scores.get(i, vocabulary.byte_score) for i in ids)


def test_pieces_are_best_and_exact(vocabulary, frame):
    encode = pieces.encoder(vocabulary)
    samples = [t for t in frame["text"] if isinstance(t, str) and len(t) < 7000] + ["  a  b\n\n c▁d é😀   ", "x" * 500, "ab" * 300 + " " * 50]
    for text in samples:
        ids = encode(text)
        assert ids == list(pieces.stream(vocabulary, " " + text))
        assert pieces.decode(vocabulary, ids) == text
        assert total(vocabulary, ids) == best_total(vocabulary, text)


def test_stream_commits_early(vocabulary):
    seen = []

    def chars():
        for i, c in enumerate(prose(2, 3000)):
            seen.append(i)
            yield c

    ids = pieces.stream(vocabulary, chars())
    next(ids)
    assert len(seen) < 10 * vocabulary.longest


def test_own_vocabulary_with_spaces_inside():
    own = pieces.Vocabulary({"a": (0, -1), " ": (1, -1), "a a": (2, -1), "aa": (3, -1)}, list(range(10, 266)))
    assert own.cut is None
    ids = pieces.encoder(own)("a aa")
    assert pieces.decode(own, ids) == "a aa" and total(own, ids) == best_total(own, "a aa")


def test_piece_query_is_exact(spark, tables, frame):
    out = QUERIES["op10_pieces"](spark, tables).toPandas()
    assert out["exact"].all() and len(out) == len(frame)


def test_pipeline_stages(spark, tables, frame):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns, sizes = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.saved(stage(spark, docs, tables), name)
        sizes.append(docs.count())
        if name != "pieces":
            assert docs.columns == columns
        if name == "quality":
            ids = {r["doc_id"] for r in docs.collect()}
            assert 159 not in ids and 156 not in ids and 45 in ids
        if name == "near_copies":
            left = [r["doc_id"] for r in docs.collect()]
            assert 110 in left and not {111, 112, 113} & set(left) and left.count(155) <= 1
            fps = [plain_fingerprint(r["text"]) for r in docs.collect()]
            assert all((a ^ b).bit_count() > 2 for i, a in enumerate(fps) for b in fps[:i])
        if name == "private":
            text = next((r["text"] for r in docs.collect() if r["doc_id"] == 162), None)
            assert text is not None and "Mail <EMAIL> or <EMAIL>, from <IP> or 999.1.1.1; card <CARD>, call <PHONE>." in text
            assert docs.count() == before.count()
            assert docs.where("n_chars <> length(text)").count() == 0
        if name == "mixture":
            assert docs.join(before, "doc_id", "left_anti").where("doc_id IS NOT NULL").count() == 0
    assert sizes[0] >= sizes[1] == sizes[2] >= sizes[3] == sizes[4] > 0
    assert np.all([r["exact"] for r in docs.collect()])
