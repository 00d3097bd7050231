"""The registered queries of the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.katz import katz_scores
from tidemark.llm.licenses import license_labels
from tidemark.llm.mixing import DIMENSIONS, mix
from tidemark.llm.oracles import ORACLES  # noqa: F401
from tidemark.llm.page_text import page_texts
from tidemark.llm.pii import BASE_KINDS, personal_data, written
from tidemark.llm.pieces import encode_documents
from tidemark.llm.quality import quality_rules
from tidemark.llm.simhash import near_duplicates
from tidemark.llm.spelling import spelling_variants
from tidemark.llm.suffixes import remove_repeats
from tidemark.llm.vectors import index, nearest
from tidemark.llm.warc import archive_pages
from tidemark.llm.whitening import whiten


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(_table(spark, sf_dir, "documents"), columns=["doc_id"])
    return out.select("row.doc_id", *[F.round(c, 6).alias(c) if c == "distance" else c for c in out.columns if c != "row"])


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = license_labels(_table(spark, sf_dir, "documents"), columns=["doc_id"])
    return out.select("row.doc_id", *[c for c in out.columns if c != "row"])


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(_table(spark, sf_dir, "documents"), columns=["doc_id"])
    return out.select("row.doc_id", *DIMENSIONS, "n_tokens", F.round("weight", 9).alias("weight"),
                      F.round("probability", 9).alias("probability"), "sampled")


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(index(_table(spark, sf_dir, "embeddings")), F.col("vec_id") % 100 == 0)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = archive_pages(_table(spark, sf_dir, "pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op7_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = katz_scores(_table(spark, sf_dir, "documents"))
    return out.withColumns({c: F.round(c, 6) for c in ("base_score", "score")})


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(_table(spark, sf_dir, "documents"), columns=["doc_id"])
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = personal_data(_table(spark, sf_dir, "documents"), columns=["doc_id"])
    base = F.filter("spans", lambda s: s["kind"] < len(BASE_KINDS))

    def count(i: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == i)).cast("long")

    counts = [count(i).alias(f"n_{kind}") for i, kind in enumerate(BASE_KINDS)]
    return out.select("row.doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode_documents(_table(spark, sf_dir, "documents"), columns=["doc_id"])
    return out.select("row.doc_id", "ids", "n_ids", "n_bytes", "exact")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whiten(_table(spark, sf_dir, "embeddings"), columns=["vec_id"])
    return out.select("row.vec_id", *[c for c in out.columns if c != "row"])


def op12_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = page_texts(_table(spark, sf_dir, "pages"), columns=["page_id", "url"])
    return out.select("row.page_id", "row.url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_licenses": op2_licenses,
    "op3_mixing": op3_mixing,
    "op4_neighbours": op4_neighbours,
    "op5_warc": op5_warc,
    "op6_repeats": op6_repeats,
    "op7_katz": op7_katz,
    "op8_simhash": op8_simhash,
    "op9_personal_data": op9_personal_data,
    "op10_pieces": op10_pieces,
    "op11_whitening": op11_whitening,
    "op12_page_text": op12_page_text,
    "op13_spelling": op13_spelling,
}
