"""The corpus pipeline: documents to encoded training text, one stored table per stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.bpe import encode
from tidelog.llm.common import stored, table
from tidelog.llm.exact_dedup import exact_dedup
from tidelog.llm.mixing import mix
from tidelog.llm.queries import WORD_BPE, judged
from tidelog.llm.simhash import simhash_dedup


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return judged(docs, table(spark, sf_dir, "labels"), whole_rows=True).where("good").select("row.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays."""
    return exact_dedup(docs, whole_rows=True).where("kept").select("row.*")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash_dedup(docs, whole_rows=True).where("kept").select("row.*")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source comes near its target words; documents may be left out or come repeatedly."""
    return mix(docs, whole_rows=True).mixed().select("row.*")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document the mix has taken, repeats included."""
    return encode(docs, WORD_BPE).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality", quality), ("exact dedup", exact), ("near dedup", near), ("mixing", mixed), ("encode", encoded)]

# Classifier, fingerprints, mixing and encoding are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
