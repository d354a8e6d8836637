"""From raw documents to packed training sequences, in five stages.

Each stage takes what the one before has kept and returns documents, the last one the
pieces of the packed sequences. A stage is called with (spark, docs, sf_dir).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from smelter.llm.common import Scratch, durable
from smelter.llm.exact_dedup import drop_duplicates
from smelter.llm.mixing import mixed_documents
from smelter.llm.ngram_join import drop_similar
from smelter.llm.packing import pack
from smelter.llm.quality import keep_good


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the isolation forest accept."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest doc_id."""
    return drop_duplicates(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links connect, the one with the smallest doc_id: five words, similarity 0.8 or more."""
    return drop_similar(docs, k=5, num=80, den=100)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, once or twice; where it ends, a text is cut."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, and their place in the sequences."""
    return pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("ngram_join", ngram_join),
    ("source_mix", source_mix),
    ("packing", packing),
]

#: The forest of the first stage and the tokenizer of the last are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table `documents`; what one stage returns is stored before the next begins."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with Scratch(spark) as scratch:
        for name, stage in STAGES[:-1]:
            docs = scratch.write(stage(spark, docs, sf_dir), name)
        return durable(STAGES[-1][1](spark, docs, sf_dir))
