"""From raw documents to packed sequences, stage by stage.

Each stage gets the documents that its predecessor kept and its result is written as
Parquet before the next one reads it. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickloom.llm import langid, packing, simhash, toxicity
from clickloom.llm.queries import tokenizer
from clickloom.llm.store import saved


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or between two languages, go. Learns from the languages
    that the documents state."""
    return langid.accepted(docs, langid.fit(docs))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score a half or more for toxicity go. Learns from all labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.accepted(docs, toxicity.fit(docs, labels))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.one_of_each(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents in their windows."""
    return packing.pack(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("language ID", language),
    ("toxicity", clean),
    ("SimHash near-dedup", near_dedup),
    ("packing", pack),
]

#: Fingerprints, trained models and tokens are beyond SQL; tests compare run() with a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
