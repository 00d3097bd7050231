"""Licence scans by diagonal voting.

Every word k-gram of every text is joined by its hash with the positions of the same gram in the licence
templates. Matches of one document and template that share ``document position - template position`` lie on
one diagonal; votes are summed per diagonal, diagonals next to each other (words put in or left out) merge
into one span, and a span counts once enough of the template's words are found in it. Diagonals are next to each
other in two ways: one follows the other in the text, or both lie in one band of offsets, whatever stray ones stand
between them. So a passage of up to a third of the template may be put in, left out, replaced or repeated.

Grams of two words come first and are few, so only they meet all texts; longer grams, for the longer
templates, are looked up for the places that remain. The templates are constants and are broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import let, lower_ascii, saved, whole
from tidemark.llm.license_texts import PHRASES, TEMPLATES

#: Templates are broadcast; more characters than this are refused.
MAX_TEMPLATE_CHARS = 1_000_000


def license_words(text: Column) -> Column:
    """Lower-case words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text that isn't null."""
    return F.array_remove(F.split(lower_ascii(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _grams(words: Column) -> Column:
    """(word, hash of two words, hash of four) for each word that one follows; no hash of four for the last two."""
    def next_to(values: Column, step: int, least: int) -> Column:
        return F.transform(F.arrays_zip(values.alias("a"), F.slice(values, step + 1, F.size(values)).alias("b")),
                           lambda x: F.when(x["b"].isNotNull(), F.xxhash64(x["a"], x["b"])))

    two = let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: next_to(h, 1, 2))
    four = let(two, lambda h: next_to(h, 2, 4))
    return F.arrays_zip(words.alias("word"), two.alias("h2"), four.alias("h4"))


def template_grams(spark: SparkSession, phrases: dict[str, str] = PHRASES,
                   templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """One row for each gram of a template: of two words in phrases and short templates, else of four."""
    rows = [(i, label, text, True) for i, (text, label) in enumerate(phrases.items())]
    rows += [(len(rows) + i, label, text, False) for i, (label, text) in enumerate(templates)]
    if sum(len(r[2]) for r in rows) > MAX_TEMPLATE_CHARS:
        raise ValueError("the templates are too long to be broadcast")
    values = F.array(*[F.struct(F.lit(i).alias("template"), F.lit(label).alias("label"), F.lit(text).alias("text"),
                                F.lit(phrase).alias("phrase")) for i, label, text, phrase in rows])
    texts = spark.range(1).select(F.inline(values)).withColumn("words", license_words(F.col("text")))
    texts = texts.withColumn("k", F.when(F.col("phrase") | (F.size("words") < 5), 2).otherwise(4))
    grams = texts.select("template", "label", "phrase", "k", (F.size("words") - F.col("k") + 1).alias("n_grams"),
                         F.posexplode(_grams(F.col("words"))).alias("t_pos", "g"))
    grams = grams.withColumn("hash", F.when(F.col("k") == 2, F.col("g.h2")).otherwise(F.col("g.h4")))
    return grams.where("hash IS NOT NULL").select(
        "template", "label", "phrase", "k", "n_grams", "t_pos", "hash", F.col("g.word").alias("t_word"),
        F.col("g.h2").alias("h2"))


def scan(docs: DataFrame, columns: list[str], **templates: object) -> tuple[DataFrame, DataFrame]:
    """``(documents, spans)``: documents are ``rid, row (columns), n_words``; spans are
    ``rid, template, label, phrase, start, end, coverage``, with word positions from 0, end exclusive.

    Null texts are empty ones. Rows are told apart by ``rid``, so ids may be null or repeated.
    """
    grams = template_grams(docs.sparkSession, **templates)
    texts = docs.select(F.struct(*[docs[f"`{c}`"].alias(c) for c in columns]).alias("row"),
                        license_words(whole(docs["text"])).alias("words"))
    texts = texts.select(F.monotonically_increasing_id().alias("rid"), "row",
                         F.size("words").cast("long").alias("n_words"), _grams(F.col("words")).alias("grams"))
    places = texts.select("rid", "row", "n_words", F.posexplode_outer("grams").alias("pos", "g")).select(
        "rid", "row", "n_words", "pos", "g.word", "g.h2", "g.h4")
    # A gram of four words begins with one of two, so one lookup leaves the few places that matter.
    known = grams.select("h2").distinct().withColumn("known", F.lit(True))
    first = F.coalesce(F.col("pos"), F.lit(0)) == 0  # one row for each document stays
    places = saved(places.join(F.broadcast(known), "h2", "left").where(first | F.col("known")), "license-places")
    documents = places.where(first).select("rid", "row", "n_words")
    votes = None
    for k in (2, 4):
        found = places.select("rid", "pos", "word", F.col(f"h{k}").alias("hash")).join(
            F.broadcast(grams.where(F.col("k") == k)), "hash").where(F.col("word") == F.col("t_word"))
        votes = found if votes is None else votes.unionByName(found)
    kept = ["rid", "template", "label", "phrase", "k", "n_grams"]
    diagonals = votes.groupBy(*kept, (F.col("pos") - F.col("t_pos")).alias("offset")).agg(
        F.min("pos").alias("first"), F.max("pos").alias("last"), F.collect_set("t_pos").alias("found"))
    return documents, _spans(diagonals, kept)


def _spans(diagonals: DataFrame, kept: list[str], gap: int = 8, drift: int = 8, least: float = 0.7) -> DataFrame:
    """Verified spans. Phrases need all their words on one diagonal."""
    covered = F.size("found") / F.col("n_grams")
    phrases = diagonals.where(F.col("phrase") & (covered == 1)).select(
        "rid", "template", "label", "phrase", F.col("offset").alias("start"),
        (F.col("offset") + F.col("n_grams") - 1 + F.col("k")).alias("end"), F.lit(1.0).alias("coverage"))
    found = [F.min("first").alias("start"), (F.max("last") + F.col("k")).alias("end"),
             F.array_distinct(F.flatten(F.collect_list("found"))).alias("found")]
    long = diagonals.where(~F.col("phrase"))
    order = Window.partitionBy("rid", "template").orderBy("first", "offset")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    apart = (F.col("first") > F.max("last").over(before) + F.col("k") + gap) | (
        F.abs(F.col("offset") - F.lag("offset").over(order)) > drift)
    runs = long.withColumn("new", F.coalesce(apart, F.lit(True)).cast("int"))
    spans = runs.withColumn("run", F.sum("new").over(order)).groupBy(*kept, "run").agg(*found).drop("run")
    # Bands are two cells of offsets wide and begin at each cell, so offsets less than a cell apart share one.
    cell = F.floor(F.col("offset") / F.greatest(F.lit(drift), F.floor(F.col("n_grams") / 3)))
    bands = long.withColumn("band", F.explode(F.array(cell, cell - 1))).groupBy(*kept, "band").agg(*found).drop("band")
    spans = spans.unionByName(bands).withColumn("coverage", F.size("found") / F.col("n_grams"))
    dense = (F.col("end") - F.col("start")) <= 2 * (F.col("n_grams") + F.col("k") - 1)
    return phrases.unionByName(_joined(spans.where(dense & (F.col("coverage") >= least)).select(*phrases.columns)))


def _joined(spans: DataFrame) -> DataFrame:
    """One span for those of a template that overlap, with the greatest coverage."""
    order = Window.partitionBy("rid", "template").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    numbered = spans.withColumn("new", F.coalesce(F.col("start") >= before, F.lit(True)).cast("int"))
    joined = numbered.withColumn("span", F.sum("new").over(order)).groupBy("rid", "template", "label", "phrase", "span")
    return joined.agg(F.min("start").alias("start"), F.max("end").alias("end"), F.max("coverage").alias("coverage")).drop("span")


def license_labels(docs: DataFrame, columns: list[str] | None = None, **templates: object) -> DataFrame:
    """One row for each document: ``row, n_words, n_base, first_word, last_word, base_labels, labels, score``."""
    documents, spans = scan(docs, columns or docs.columns, **templates)
    base = F.col("phrase")

    def joined(labels: Column) -> Column:
        return F.coalesce(F.concat_ws(",", F.sort_array(labels)), F.lit(""))

    found = spans.groupBy("rid").agg(
        F.count(F.when(base, 1)).alias("n_base"), F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        F.collect_set(F.when(base, F.col("label"))).alias("base_labels"), F.collect_set("label").alias("labels"),
        F.max("coverage").alias("score"))
    return documents.join(found, "rid", "left").select(
        "row", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        joined(F.col("base_labels")).alias("base_labels"), joined(F.col("labels")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
