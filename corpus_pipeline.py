"""The text pipeline: quality, near copies, personal data, mixing, pieces; each stage is written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import near_copies as near
from tidemark.llm.common import saved
from tidemark.llm.mixing import mix
from tidemark.llm.pieces import encode_documents
from tidemark.llm.pii import personal_data, redacted
from tidemark.llm.quality import quality_rules


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the outlier test reject. Null and empty texts fail the base rules; equal
    rows are judged alike; null languages and sources are values like others."""
    return quality_rules(docs).where("kept").select("row.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (SimHash within two bits, as ``op8_simhash``, or five words at similarity
    0.8): of the least id, then first read. Texts without words, null ones too, are copies of each other; a null id is
    beyond all others."""
    return near.near_copies(docs, fingerprints=True).where("keep").select("row.*")


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their personal data replaced by its kind; ``n_chars`` follows the text. A null text becomes an empty
    one; all rows stay."""
    out = personal_data(docs).select("row", redacted("row.text", "spans").alias("redacted"))
    new = {"text": F.col("redacted"), "n_chars": F.length("redacted").cast("long")}
    return out.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that sources, languages and topics have their target weights, as many as these allow. A null
    source or language is a value of its own; documents without words are never drawn; rows of one id share a draw."""
    return mix(docs, budget=None).where("sampled").select("row.*")


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the documents' pieces; none for a null or empty text. Every row has its own."""
    out = encode_documents(docs, columns=["doc_id"])
    return out.select("row.doc_id", "ids", "n_ids", "exact")


STAGES = [("quality", quality), ("near_copies", near_copies), ("private", private), ("mixture", mixture),
          ("pieces", pieces)]

#: The last stage has no SQL equivalent; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
