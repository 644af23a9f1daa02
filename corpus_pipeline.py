"""A training-data pipeline over ``documents``: quality, near-duplicates, secrets, packing.

Every stage is a function (spark, docs, sf_dir) -> DataFrame over all that its predecessor
kept; its result is written as Parquet and read again as the next stage's docs.  All stages
but the last return the columns of docs.

Defined cases are those of the operators; in addition a null doc_id passes every filter (it
cannot be named as a duplicate), and rows that repeat a doc_id are one document after the
near-duplicate stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylabel.llm import neardup, packing, quality, secretscan
from paylabel.llm.common import table, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def neardup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    found = neardup.near_duplicates(docs)
    dropped = written(found.where(~F.col("kept")).select("doc_id"), "pipeline_dropped")
    kept = docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
    repeated = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    repeated = written(repeated, "pipeline_repeated")
    if repeated.isEmpty():
        return kept
    once = kept.join(repeated, "doc_id", "left_anti").select(*docs.columns)
    row = F.struct(*docs.columns)
    merged = kept.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.max_by(row, F.coalesce("text", F.lit(""))).alias("row"))
    return once.union(merged.select("row.*"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with every secret replaced by a mark."""
    return secretscan.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training sequences that the documents' pieces fill."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_stage),
    ("MinHash near-dedup", neardup_stage),
    ("secret scans", secrets_stage),
    ("best-fit packing", packing_stage),
]

#: SQL cannot express the trained classifier and the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline_" + name.replace(" ", "_"))
    return docs
