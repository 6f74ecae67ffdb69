"""Training corpus: quality rules, exact and near duplicates, mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again as the next
stage's ``docs``. The first four return the columns of ``documents``; the last one returns batches. Mixing keeps every
row and decides their order: packing fills its batches in the order of the files it reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lumbung.llm.common import table
from lumbung.llm.exact_dedup import DigestIndex, without_copies
from lumbung.llm.fertility import accepted
from lumbung.llm.jaccard_join import one_of_each
from lumbung.llm.mixing import interleaved
from lumbung.llm.packing import packed
from lumbung.session import shared_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return accepted(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_copies(docs, DigestIndex(spark, shared_folder(spark, "digests")), "documents")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return interleaved(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: Byte-pair encoding can't be stated in SQL; tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
