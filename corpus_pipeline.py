"""A training-data pipeline of five corpus operators; counted as part of endmark.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read back as the next
one's docs. All but the last return the columns of docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from endmark.llm import bpe, mixing, quality, resemblance, secret_scan
from endmark.llm.common import table, written
from endmark.llm.queries import tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; cutoffs come from the labels beside the input. Null and empty texts fail, repeated rows alike; a null language is a stratum."""
    judged = quality.quality_rules(docs, table(spark, sf_dir, "labels"))
    return judged.filter("kept").select(*docs.columns)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: shingles of five words, Jaccard similarity 0.8 or more. Pairs come from SimHash fingerprints by operator 5's vantage-point trees, and those
    whose fingerprints lie further apart from MinHash bands; exact similarity decides. The one that stays has the smallest id, null last; of several rows of that
    id in a group the least by digest stays, and different documents that share an id stay both. Null and empty texts are copies of each other."""
    return resemblance.keep_one(docs).select(*docs.columns)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each secret in the text replaced. Null texts stay null; every row stays, repeated ones too."""
    out = secret_scan.redact(secret_scan.secret_scan(docs))
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy of a document that the mix takes, whole. Null sources are a source; documents without words are taken by no copy; repeated rows alike."""
    return mixing.draw(mixing.mix(docs)).select(*docs.columns)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_tokens, ids, decoded): the token ids of each row and the text they decode to; none and the empty text for a null or empty one."""
    path = tokenizer_path()
    coded = bpe.round_trip(docs.select("doc_id", "source", "text"), path)
    return coded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality rules", quality_stage),
    ("SimHash near-dedup", dedup_stage),
    ("secret scans", secret_stage),
    ("mixing sources to target weights", mixing_stage),
    ("BPE encoding and decoding", bpe_stage),
]

#: SQL can't express the fingerprints' components or the token ids; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn on the documents."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs)
    return docs
