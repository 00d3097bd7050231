"""Near copies: documents whose sets of word shingles have a Jaccard similarity of at least a threshold.

Documents of equal sets count once. Signatures of minimum hashes choose candidates: sets that agree in all rows of
a band share a bucket, and two sets of similarity s share none with probability ``(1 - s ** ROWS) ** BANDS``, at
0.8 that is 3 in a million. Every link is then checked on the sets themselves.

Buckets make no pairs of their members. In each, the smallest set is the head, and the others are compared with it: a set
that others share a passage with can only be their near copy if its own part is small, so who links to anybody in the bucket
mostly links to the head. Sets that are still apart from others of a bucket after that are joined exactly: shingles are put
in order, the rarest first; near copies share one of the first ``n - ceil(0.8 n) + 1``, so only these meet. Where a shingle
stands, and the sets' sizes, bound what two sets can share from there on. A set that cannot reach 0.8 with the smallest set
of a shingle's bucket leaves it; the rest goes through heads again, and only pairs within the bounds are compared.

Unique shingles make a set a bad head: copies of one text, each with changes of its own, are further from each other than from
the text. So each such bucket has a second head, the set with the fewest shingles that no other has.

With ``fingerprints`` the links of ``simhash.py`` (two bits, three words, repeats counted) are links too, as they are.

Candidates are first compared by sketches of one byte per minimum hash, of which near copies share 76.8 of 96 on average and
fewer than 55 once in ten million; only what passes is checked on the sets.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import BooleanType, LongType

from tidemark.llm.bloom import among
from tidemark.llm.common import bucketed, packed, saved, shared, whole
from tidemark.llm.components import components
from tidemark.llm.simhash import fingerprint_of, fingerprint_roots

BANDS = 24
ROWS = 4
WORDS = 5
SIMILARITY = 0.8
SEED = 42
PIECE = 1 << 8
SKETCH = 55  # equal bytes of sketches that are worth a check


def shingle_hashes(text: str, words: int = WORDS):
    """The distinct 64-bit hashes of a text's shingles, in order; of all its words if they are too few for one."""
    import numpy as np
    import xxhash

    split = text.encode().lower().split()  # bytes: only A-Z change, and words end at \x20 and \x09-\x0D
    joined, starts, ends, at = b" ".join(split), [], [], -1
    for word in split:
        starts.append(at + 1)
        at += 1 + len(word)
        ends.append(at)
    last = ends[words - 1:] or ends[-1:]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[a:b], SEED) for a, b in zip(starts, last)], dtype=np.uint64))


def signatures(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``rid, row, doc_id, set, n, bands, sketch, fp`` for each document, written once.

    ``set`` is a digest, ``n`` the set's size, ``fp`` the fingerprint that ``simhash.py`` gives the text.
    """
    @pandas_udf("struct<set: binary, n: long, bands: array<bigint>, sketch: binary, fp: long>")
    def signed(texts: pd.Series) -> pd.DataFrame:
        import numpy as np
        import xxhash

        rng = np.random.default_rng(SEED)
        masks, factors = (rng.integers(0, 1 << 64, BANDS * ROWS, dtype=np.uint64) for _ in range(2))
        factors |= np.uint64(1)
        out = []
        for text in texts:
            hashes = shingle_hashes(text, words)
            least = np.full(BANDS * ROWS, (1 << 64) - 1, dtype=np.uint64)
            for i in range(0, len(hashes), PIECE):
                least = np.minimum(least, ((hashes[i:i + PIECE, None] ^ masks) * factors).min(axis=0))
            bands = [xxhash.xxh64_intdigest(b.tobytes()) for b in least.reshape(BANDS, ROWS)]
            out.append((xxhash.xxh128_digest(hashes.tobytes()), len(hashes), np.array(bands, dtype=np.uint64).view(np.int64),
                        (least >> np.uint64(56)).astype(np.uint8).tobytes(), fingerprint_of(text)))
        return pd.DataFrame(out, columns=["set", "n", "bands", "sketch", "fp"])

    rows = packed(docs, docs["doc_id"].cast("long").alias("doc_id"), signed(whole(docs["text"])).alias("s"))
    return saved(rows.select(F.monotonically_increasing_id().alias("rid"), "row", "doc_id", "s.*"), "near-signatures")


def _roots(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``node, root`` of all nodes: those without an edge are their own roots."""
    found = components(edges).withColumnRenamed("node", "linked")
    return saved(nodes.join(found, F.col("node") == F.col("linked"), "left").select(
        "node", F.coalesce("root", "node").alias("root")), "near-roots")


@pandas_udf(BooleanType())
def _alike(one: pd.Series, two: pd.Series) -> pd.Series:
    """Whether two sketches agree in enough bytes."""
    import numpy as np

    return pd.Series([(np.frombuffer(a, np.uint8) == np.frombuffer(b, np.uint8)).sum() >= SKETCH for a, b in zip(one, two)], dtype=bool)


@pandas_udf(LongType())
def _shared(one: pd.Series, two: pd.Series) -> pd.Series:
    """The number of values that two arrays of different values have in common."""
    import numpy as np

    return pd.Series([len(np.intersect1d(a, b, assume_unique=True)) for a, b in zip(one, two)], dtype="int64")


def _prefixes(sets: DataFrame, similarity: float) -> DataFrame:
    """``token, node, n, own, reach``: for each set its first shingles, rarest first. ``own``: how many no other set has.

    ``reach`` is the size of the largest set that may be a near copy, if the shingle is the first the two have in common.
    """
    tokens = sets.select("node", F.size("hashes").alias("n"), F.explode("hashes").alias("token"))
    # Shingles of one set only come first in it; they meet nobody, so their number is all that is needed.
    met = shared(tokens, "token").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("count", "token"))).alias("met"))
    first = met.select("node", "n", (F.col("n") - F.size("met")).alias("own"), F.posexplode("met").alias("at", "t"))
    place = F.col("own") + F.col("at")
    reach = (1 + similarity) / similarity * (F.col("n") - place) - F.col("n") + 1e-6
    return first.where(place <= F.col("n") * (1 - similarity) + 1e-9).select(
        F.col("t.token").alias("token"), "node", "n", "own", reach.alias("reach"))


def links(members: DataFrame, sets: DataFrame, sketches: DataFrame, similarity: float = SIMILARITY,
          known: DataFrame | None = None) -> DataFrame:
    """``node, root`` of the nodes in ``members`` (``band, key, node, n``: those of buckets with others) and ``known``.

    ``sets`` are ``node, hashes``, ``sketches`` are ``node, sketch`` of these nodes. Roots are equal just where links of
    at least the similarity connect, or the links ``(a, b)`` that are known already.
    """
    nodes = members.select("node")
    if known is not None:
        nodes = nodes.unionByName(known.select(F.explode(F.array("a", "b")).alias("node")))
    nodes = nodes.distinct()

    def checked(pairs: DataFrame) -> DataFrame:
        """Those of the pairs ``(a, b)`` that are near copies."""
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        for of, columns, test in ((sketches, "sketch", _alike("a_sketch", "b_sketch")), (sets, "hashes", None)):
            one = of.select(F.col("node").alias("a"), F.col(columns).alias(f"a_{columns}"))
            two = of.select(F.col("node").alias("b"), F.col(columns).alias(f"b_{columns}"))
            met = pairs.join(one, "a").join(two, "b")
            if test is not None:
                pairs = saved(met.where(test).select("a", "b"), "near-pairs")
        sizes = F.size("a_hashes") + F.size("b_hashes")
        met = met.withColumn("shared", _shared("a_hashes", "b_hashes"))
        return met.where(F.col("shared") >= similarity * (sizes - F.col("shared")) - 1e-9).select("a", "b")

    def linked(roots: DataFrame) -> DataFrame:
        """One link of each node to its root, in place of all that led there."""
        return roots.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))

    def apart(rows: DataFrame, roots: DataFrame, *bucket: str) -> DataFrame:
        """The rows of buckets that hold several roots."""
        rooted = rows.drop("root").join(roots, "node")
        split = rooted.groupBy(*bucket).agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y")
        return saved(rooted.join(split.select(*bucket), list(bucket)), "near-apart")

    def stars(rows: DataFrame, *bucket: str, by: tuple[str, ...] = ("n",)) -> DataFrame:
        """Pairs of each bucket's first set, the smallest or as ordered, with the others within its reach and theirs."""
        heads = rows.groupBy(*bucket).agg(F.min(F.struct(*by, "node", "root", "reach")).alias("h"))
        return rows.join(heads, list(bucket)).where((F.col("root") != F.col("h.root")) & (F.col("h.n") <= F.col("reach")) & (
            F.col("n") <= F.col("h.reach"))).select(F.col("node").alias("a"), F.col("h.node").alias("b"))

    edges = saved(checked(stars(members.withColumns({"root": F.col("node"), "reach": F.col("n") / similarity + 1e-6}), "band", "key")),
                  "near-edges")
    roots = _roots(nodes, edges if known is None else edges.unionByName(known))
    rest = apart(members, roots, "band", "key").select("node").distinct()
    rows = saved(_prefixes(sets.join(rest, "node", "left_semi"), similarity), "near-prefixes")
    while True:
        rows = apart(rows, roots, "token")
        least = rows.groupBy("token").agg(F.min("n").alias("least"))
        rows = apart(rows.join(least, "token").where("least <= reach").drop("least"), roots, "token")
        new = saved(checked(stars(rows, "token").unionByName(stars(rows, "token", by=("own", "n")))), "near-edges")
        if new.isEmpty():
            break
        roots = _roots(nodes, linked(roots).unionByName(new))
    one, two = (rows.select("token", F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("root").alias(f"root_{x}"),
                            F.col("reach").alias(f"reach_{x}")) for x in ("a", "b"))
    within = (F.col("a") < F.col("b")) & (F.col("root_a") != F.col("root_b")) & (F.col("n_a") <= F.col("reach_b")) & (
        F.col("n_b") <= F.col("reach_a"))
    new = saved(checked(one.join(two, (one["token"] == two["token"]) & within)), "near-edges")
    return _roots(nodes, linked(roots).unionByName(new))


def _by_fingerprint(rows: DataFrame, of_set: DataFrame) -> DataFrame:
    """Links ``(a, b)`` that connect just the sets of texts whose fingerprints' links connect them."""
    fps = saved(rows.select("set", "fp").distinct(), "near-fingerprints")
    roots = saved(fingerprint_roots(fps.select("fp").distinct()), "near-fingerprint-roots")
    rooted = fps.join(roots, "fp", "left").select("set", F.coalesce("root", "fp").alias("root"))
    heads = rooted.groupBy("root").agg(F.min("set").alias("head"), F.max("set").alias("last")).where("head <> last")
    pairs = saved(rooted.join(heads, "root").where("set <> head").select("set", "head").distinct(), "near-fingerprint-pairs")
    one, two = (of_set.select(F.col("set").alias(s), F.col("node").alias(x)) for s, x in (("set", "a"), ("head", "b")))
    return saved(pairs.join(one, "set").join(two, "head").select("a", "b"), "near-fingerprint-edges")


def near_copies(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, fingerprints: bool = False) -> DataFrame:
    """``rid, row, doc_id, component_id, keep`` for each document.

    ``component_id`` is the least id that can be reached over links of at least the similarity, its own included
    (null if all of them are null), and with ``fingerprints`` over those of ``simhash.near_duplicates`` as well. ``keep`` marks one row of each component: of its least id, then first read.
    Texts without words have equal, empty sets; they are near copies of each other only.
    """
    rows = signatures(docs, words)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("rid")))
    of_set = saved(rows.groupBy("set").agg(first.alias("first"), F.count(F.lit(1)).alias("copies"), F.min("rid").alias("node"),
                                           F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "near-sets")
    keyed = of_set.select("node", "n", F.posexplode("bands").alias("band", "key"))
    members = saved(shared(keyed, "band", "key").drop("count"), "near-members")

    @pandas_udf("array<bigint>")
    def hashed(texts: pd.Series) -> pd.Series:
        return pd.Series([shingle_hashes(t, words).view("int64") for t in texts], dtype=object)

    wanted = members.select(F.col("node").alias("rid")).distinct()
    # A filter first, so that only the texts of these sets, and few others, move to be looked up.
    texts = rows.where(among(wanted, "rid")("rid")).select("rid", whole(F.col("row.text")).alias("text"))
    sets = bucketed(texts.join(wanted, "rid", "left_semi").select(F.col("rid").alias("node"), hashed("text").alias("hashes")),
                    "near-hashes", "node")
    roots = links(members, sets, of_set.select("node", "sketch").join(wanted.withColumnRenamed("rid", "node"), "node", "left_semi"),
                  similarity, _by_fingerprint(rows, of_set) if fingerprints else None)
    rooted = of_set.join(roots, "node", "left").select("set", "first", "copies", F.coalesce("root", "node").alias("root"))
    heads = rooted.groupBy("root").agg(F.min("first").alias("head"), F.sum("copies").alias("size")).where("size > 1")
    # Only sets of several documents; texts that a filter shows to be no such set's do not move.
    labels = saved(rooted.join(heads, "root").select("set", "head"), "near-labels")
    rows, test = rows.drop("n", "bands", "sketch", "fp").withColumn("head", F.lit(None).cast(labels.schema["head"].dataType)), among(labels, "set")
    found = rows.where(test("set")).drop("head").join(labels, "set", "left")
    alone = F.col("head").isNull()
    return rows.where(~test("set")).unionByName(found).select(
        "rid", "row", "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("component_id"),
        (alone | (F.col("rid") == F.col("head.rid"))).alias("keep"))
