"""Exact duplicates against a persistent digest index.

The index is a Parquet table bucketed and sorted by the SHA-256 digest of the normalised text. A
batch is reduced to one row per digest, anti-joined with the index by sort-merge (the index is not
shuffled) and what is new is appended.

Normalised text: every run of ``[\\x20\\x09-\\x0D]`` becomes one space. NULL counts as empty, so
documents without text are copies of each other. Of equal rows of a batch the one with the smallest
doc_id stays (NULL ids last; of repeated rows with the same id exactly one). Texts that an earlier
batch brought are dropped in favour of that batch's row. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.llm.common import Scratch, checked, hot_join, result, table
from lumbung.session import shared_folder
from lumbung.sources.versions import plain_or_none


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "), 256))


class DigestIndex:
    """Table (digest, keep_id, batch) in ``path``, opened again by any later session.

    ``buckets`` is fixed when the index is made: about index bytes / 256 MB, e.g. 4096 for 10 billion texts. The number is
    kept in ``path`` beside the data, and whoever opens the index later works with that one, whatever they ask for.
    The table's name comes from the whole path, so that indexes in folders of one name stay apart.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 32):
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        whole = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()
        self.spark, self.buckets = spark, self._kept(spark, whole, buckets)
        self.name = f"digest_index_{hashlib.sha256(whole.encode()).hexdigest()[:32]}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, keep_id BIGINT, batch STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{whole}'"
        )

    @staticmethod
    def _kept(spark: SparkSession, path: str, buckets: int) -> int:
        """The index's number of buckets; the one asked for becomes it when the index is new."""
        note = f"{path}/_buckets"  # a name that readers of the data pass over
        found = plain_or_none(spark, note)
        if found is None:
            spark.range(1).select(F.lit(buckets).alias("buckets")).coalesce(1).write.parquet(note)
            return buckets
        return found.first()["buckets"]

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, rows: DataFrame) -> None:
        (
            rows.select("digest", "keep_id", "batch").repartition(self.buckets, "digest")
            .write.mode("append").format("parquet").bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.name)
        )


def deduplicate(docs: DataFrame, index: DigestIndex, batch: str, scratch: Scratch) -> DataFrame:
    """Append the new texts of ``docs`` (doc_id, text) to the index.

    Returns (doc_id, digest, keep_id, group_size, kept) for every row; group_size counts rows of this
    batch. Running a batch again under its name, e.g. after a failure, gives the same result.
    """
    prints = scratch.keep(
        docs.select(F.col("doc_id"), digest(F.col("text")).alias("digest"), F.monotonically_increasing_id().alias("row")), "prints"
    )
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    firsts = scratch.keep(
        prints.groupBy("digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("group_size")), "firsts"
    )
    new = firsts.select("digest", F.col("first.doc_id").alias("keep_id"), F.lit(batch).alias("batch"))
    index.append(new.join(index.read().select("digest").hint("merge"), "digest", "left_anti"))
    held = index.read().select("digest", "keep_id", "batch")
    groups = firsts.join(held.hint("merge"), "digest").select(
        "digest", "keep_id", "group_size", F.when(F.col("batch") == batch, F.col("first.row")).alias("first_row")
    )
    groups = scratch.keep(groups, "groups")
    return hot_join(prints, groups, "digest", "group_size", prints.count()).select(
        "doc_id", "digest", "keep_id", "group_size", F.coalesce(F.col("row") == F.col("first_row"), F.lit(False)).alias("kept")
    )


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row that stays for it, through a new index."""
    docs = table(spark, sf_dir, "documents")
    with Scratch(spark, "dedup") as scratch:
        index = DigestIndex(spark, shared_folder(spark, "digests"))
        rows = deduplicate(docs, index, "documents", scratch)
        return result(rows.select(
            "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
        ), "op6")


def without_copies(docs: DataFrame, index: DigestIndex, batch: str) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    with Scratch(docs.sparkSession, "dedup") as scratch:
        stays = deduplicate(docs.select("doc_id", "text"), index, batch, scratch).groupBy("doc_id", "digest").agg(
            F.max("kept").alias("kept"), F.count(F.lit(1)).alias("times")
        ).filter("kept")
        stays = result(stays.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), "times"), "stays")
    marked = docs.withColumn("_text_digest", digest(F.col("text")))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_digest") == F.col("_digest"))

    def those(which: str) -> DataFrame:
        return marked.join(checked(stays.filter(which)), same, "left_semi")

    rows = those("times = 1")
    if not stays.filter("times > 1").isEmpty():  # rows that repeat id and text
        rows = rows.unionByName(those("times > 1").dropDuplicates(["doc_id", "_text_digest"]))
    return rows.select(*docs.columns)


ORACLE_OP6 = r"""
with t as (
  select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256 from documents
), g as (select *, min(doc_id) over (partition by text_sha256) as keep_id,
         count(*) over (partition by text_sha256) as group_size from t)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from g
"""
