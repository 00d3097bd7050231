"""Vectors, archives, repeats and language-model scores against plain versions."""

import base64
import collections
import hashlib
import math
import zlib
from urllib.parse import urlparse

import numpy as np
import pandas as pd
import pytest
from hard_rows import prose
from pyspark.sql import functions as F

from tidemark.llm import katz, packing, suffixes, warc
from tidemark.llm.suffix_arrays import common_prefixes, suffix_array
from tidemark.llm.vectors import index, nearest


def search(spark, rows, kind="array<float>"):
    table = spark.createDataFrame(rows, f"vec_id long, embedding {kind}, rid string, code string")
    return [tuple(r) for r in nearest(index(table), F.col("vec_id") % 100 == 0).collect()]


def test_neighbours_equal_brute_force(spark):
    rng = np.random.default_rng(0)
    centres = rng.standard_normal((8, 24))
    vecs = (centres[rng.integers(0, 8, 900)] + 0.4 * rng.standard_normal((900, 24))).astype(np.float32)
    vecs[300:340] = vecs[200]  # equal ones
    made = [(i, v.tolist(), "x", "y") for i, v in enumerate(vecs)]
    nan, inf = float("nan"), float("inf")
    bad = [(None, [1.0] * 24), (1000, None), (1100, [0.0] * 24), (1200, [nan] + [1.0] * 23), (1300, [inf] + [1.0] * 23),
           (1400, [None] + [1.0] * 23), (1500, [1.0] * 3), (1600, [])]
    got = search(spark, made + [(i, v, "x", "y") for i, v in bad])
    wide = vecs.astype(np.float64)
    expected = []
    for q in range(0, 900, 100):
        far = np.sqrt(((wide - wide[q]) ** 2).sum(axis=1))
        far[q] = np.inf
        best = np.lexsort((np.arange(900), far))[:10]
        expected += [(q, r + 1, int(i), far[i]) for r, i in enumerate(best)]
    hits = {x[:3] for x in got} & {x[:3] for x in expected}
    assert len(hits) >= 0.9 * len(expected) and len(got) == len(expected)
    scores = {x[:3]: x[3] for x in expected}
    assert all(x[3] == pytest.approx(scores[x[:3]], rel=1e-14) for x in got if x[:3] in scores)


def test_few_vectors_and_none(spark):
    got = search(spark, [(0, [1.0, 0.0], "", ""), (1, [0.0, 1.0], "", ""), (2, [1.0, 0.0], "", "")])
    assert got == [(0, 1, 2, 0.0), (0, 2, 1, math.sqrt(2))]
    assert search(spark, [(0, [1.0, 2.0], "", "")]) == []
    assert search(spark, [(0, None, "", "")]) == []
    assert sorted(search(spark, [(0, [1.0], "", ""), (0, [1.0], "", "")])) == [(0, 1, 0, 0.0)] * 2  # a repeated row


def local(path: str) -> str:
    return urlparse(path).path


def pages_frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload string")


def test_archives_hold_one_member_for_each_record(spark, tmp_path):
    pages = pages_frame(spark, [(3, "http://a", "same", ""), (1, "http://b", "same", ""), (2, None, None, ""), (4, "u\r\nv", "é" * 3000, "")])
    manifest = warc.write_archives(warc.records(pages.coalesce(1)), f"file://{tmp_path}/whole")
    found = warc.normalise(manifest, f"file://{tmp_path}/members").collect()
    assert len(found) == 4 and {r["record_type"] for r in found} == {"response", "revisit"}
    for path in {r["path"] for r in found}:
        data = open(local(path), "rb").read()
        mine = sorted((r["offset"], r["length"]) for r in found if r["path"] == path)
        assert [o for o, _ in mine] == [sum(n for _, n in mine[:i]) for i in range(len(mine))]
        assert sum(n for _, n in mine) == len(data)
        for offset, length in mine:
            gz = zlib.decompressobj(31)
            record = gz.decompress(data[offset:offset + length])
            assert gz.eof and not gz.unused_data and record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        assert len(open(local(path) + ".idx").read().splitlines()) == len(mine)


def test_small_payloads_are_never_revisits(spark):
    rows = [(r["refers_to"]) for r in warc.records(pages_frame(spark, [(1, "", "ab", ""), (2, "", "ab", "")]), min_bytes=3).collect()]
    assert rows == [None, None]


def test_normaliser_reads_members_and_names_damage(spark, tmp_path):
    one = warc.record_bytes(1, "http://a", b"x" * 5000, None, "2024-01-01T00:00:00Z")
    two = warc.record_bytes(2, "http://b", b"", 1, "2024-01-01T00:00:00Z")
    gz = [zlib.compressobj(6, wbits=31) for _ in range(3)]
    parts = [gz[0].compress(one) + gz[0].flush(), gz[1].compress(two) + gz[1].flush(), gz[2].compress(one * 2) + gz[2].flush()]
    (tmp_path / "members.warc.gz").write_bytes(parts[0] + parts[1])
    (tmp_path / "cut.warc.gz").write_bytes(parts[1] + parts[2][:-20])
    (tmp_path / "other.warc.gz").write_bytes(b"no gzip")
    (tmp_path / "nothing.warc.gz").write_bytes(b"")
    manifest = spark.createDataFrame([(f"file://{p}",) for p in tmp_path.iterdir()], "path string")
    found = warc.normalise(manifest, f"file://{tmp_path}/out").collect()
    whole = [r for r in found if r["problem"] is None]
    assert sorted(r["record_id"] for r in whole)[:2] == ["<urn:page:1>", "<urn:page:1>"]
    assert sum(r["record_id"] == "<urn:page:2>" for r in whole) == 2
    assert sorted(r["problem"].split("/")[-1].split(":")[0] for r in found if r["problem"]) >= ["cut.warc.gz", "nothing.warc.gz", "other.warc.gz"]
    read = warc.read_records(spark.createDataFrame(found, warc.INDEX)).collect()
    assert {(r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in read} == {
        (1, 5000, "response", None), (2, 0, "revisit", 1)}
    assert {r["payload_digest"] for r in read} == {base64.b32encode(hashlib.sha1(x).digest()).decode() for x in (b"x" * 5000, b"")}


def test_suffix_arrays_equal_sorting():
    rng = np.random.default_rng(4)
    for trial in range(200):
        body = rng.integers(1, int(rng.choice([2, 3, 6])), rng.integers(0, 40))
        s = np.append(np.tile(body, 1 + trial % 3), 0)
        plain = sorted(range(len(s)), key=lambda i: s[i:].tolist())
        for sigma in (8, 600):  # the way of small alphabets and that of large ones
            assert suffix_array(s, sigma).tolist() == plain
        shared = common_prefixes(s, np.array(plain))
        for a, b in zip(plain[1:], plain):
            n = 0
            while max(a, b) + n < len(s) and s[a + n] == s[b + n]:
                n += 1
            assert shared[a] == n


def plain_removal(texts, length):
    found = collections.Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if found[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(t), sum(gone), spans, bytes(c for c, g in zip(t, gone) if not g)))
    return out


@pytest.mark.parametrize("limits", [{}, {"CROWDED": 2, "STRIDE": 900, "BATCH": 20_000, "PART": 15_000, "SHARD": 3000}])
def test_repeats_equal_plain(spark, frame, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(suffixes, name, value)
    docs = frame[frame["text"].str.len().fillna(0) < 20_000]
    made = [(None if pd.isna(i) else int(i), t if isinstance(t, str) else None, "x", "y") for i, t in zip(docs["doc_id"], docs["text"])]
    made += [(500, "ab" * 60 + prose(9, 60), "x", "y"), (501, prose(9, 60)[:199], "x", "y"), (502, prose(9, 60)[:200], "x", "y")]
    out = suffixes.remove_repeats(spark.createDataFrame(made, "doc_id long, text string, data string, t string").repartition(3))
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in out.collect()]
    plain = plain_removal([(t or "").encode() for _, t, *_ in made], 200)
    assert sorted(got, key=repr) == sorted(((i, *p) for (i, *_), p in zip(made, plain)), key=repr)
    assert 0 < sum(p[1] for p in plain) < sum(p[0] for p in plain)


def test_short_strings_are_refused(spark):
    with pytest.raises(ValueError):
        suffixes.remove_repeats(spark.createDataFrame([], "doc_id long, text string"), length=63)


class Plain:
    """Katz backoff by dictionaries."""

    def __init__(self, rows, order):
        self.order = order
        self.held = [zlib.crc32(str(i).encode() if i is not None else b"") % 7 == 2 for i, _ in rows]
        self.tokens = [[*(t or "").encode().lower().split(), b""] for _, t in rows]
        self.counts = [collections.Counter() for _ in range(order)]
        for held, words in zip(self.held, self.tokens):
            line = ["begin", *words]
            for p in range(1, 0 if held else len(line)):
                for m in range(1, min(order, p + 1) + 1):
                    self.counts[m - 1][tuple(line[p - m + 1:p + 1])] += 1
        self.texts = self.held.count(False)
        self.n, self.v = sum(self.counts[0].values()), len(self.counts[0])
        self.steps = [katz.discounts([sum(c == r for c in k.values()) for r in range(katz.SEEN)]) for k in self.counts]
        self.after = collections.defaultdict(list)
        for k in self.counts[1:]:
            for gram in k:
                self.after[gram[:-1]].append(gram[-1])
        self.unknown = 1 - sum(self.less(0, c) for c in self.counts[0].values()) / self.n

    def less(self, m, count):
        return float(katz.discounted(np.array([count]), self.steps[m])[0])

    def of(self, context):
        return self.texts if context == ("begin",) else self.counts[len(context) - 1][context]

    def p(self, word, context):
        count = self.counts[len(context)][(*context, word)]
        if not context:
            return self.less(0, count) / self.n if count else self.unknown
        if count:
            return self.less(len(context), count) / self.of(context)
        return self.weight(context) * self.p(word, context[1:])

    def weight(self, context):
        if not self.of(context):
            return 1.0
        left = 1 - sum(self.less(len(context), self.counts[len(context)][(*context, w)]) for w in self.after[context]) / self.of(context)
        return left / (1 - sum(self.p(w, context[1:]) for w in self.after[context]))

    def scores(self):
        for held, words in zip(self.held, self.tokens):
            line = ["begin", *words]
            yield (held, len(words), sum(self.counts[0][(w,)] > 0 for w in words), self.n,
                   sum(math.log10((self.counts[0][(w,)] + 1) / (self.n + self.v + 1)) for w in words),
                   sum(math.log10(self.p(line[p], tuple(line[max(0, p - self.order + 1):p]))) for p in range(1, len(line))))


@pytest.mark.parametrize("order", [1, 2, 3])
def test_katz_equals_plain(spark, frame, monkeypatch, order):
    monkeypatch.setattr(katz, "BATCH", 3000)
    monkeypatch.setattr(katz, "KEYS", 2500)
    docs = frame[frame["text"].str.len().fillna(0) < 6000]
    made = [(None if pd.isna(i) else int(i), t if isinstance(t, str) else None) for i, t in zip(docs["doc_id"], docs["text"])]
    table = spark.createDataFrame([(*r, 1) for r in made], "doc_id long, text string, t int").repartition(3)
    got = sorted((tuple(r) for r in katz.katz_scores(table, order=order).collect()), key=repr)
    model = Plain(made, order)
    plain = sorted(((i, *s) for (i, _), s in zip(made, model.scores())), key=repr)
    assert [g[:5] for g in got] == [p[:5] for p in plain]
    for g, p in zip(got, plain):
        assert g[5:] == pytest.approx(p[5:], rel=1e-9)
    for context in [("begin",), (b"the",), (b"of",)][:3 if order > 1 else 0]:
        assert sum(model.p(w, context) for (w,) in model.counts[0]) + model.p("unknown", context) == pytest.approx(1)


def test_nothing_to_learn_from(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    row = katz.katz_scores(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert (row["held_out"], row["n_tokens"], row["n_known"], row["train_tokens"], row["score"]) == (True, 3, 0, 0, None)


def test_packing_round_trips():
    keys = np.sort(np.random.default_rng(0).integers(0, 1 << 63, 1000).astype(np.uint64))
    assert (packing.loosen_sorted(packing.squeeze_sorted(keys)) == keys).all()
    assert len(packing.loosen(packing.squeeze(np.empty(0, np.uint32)), "u4")) == 0
