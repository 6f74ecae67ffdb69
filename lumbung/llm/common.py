"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.session import remove, shared_folder

#: A key with more than this share of the rows is hot; fewer than HOT_SHARE keys can be.
HOT_SHARE = 1000
FEW_ROWS = 100_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut small, so that what a task derives from one stays small."""
    for b in batches:
        for s in range(0, b.num_rows, rows):
            yield b.slice(s, rows)


class Scratch:
    """Folder below ``spark.checkpoint.dir`` for intermediate tables, removed when the block ends.

    Tables are cut points: later stages reread them when executors are lost, and values that
    depend on the partitioning (ids, partition numbers) stay as they were written. ``codec`` is that of the files.
    """

    def __init__(self, spark: SparkSession, purpose: str, codec: str = "snappy"):
        self.spark, self.folder, self.codec = spark, shared_folder(spark, purpose), codec

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        remove(self.spark, self.folder)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write a frame as Parquet and read it back with the same schema."""
        df.write.option("compression", self.codec).parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def drop(self, *names: str) -> None:
        """Remove tables, where they exist, that nothing reads any more."""
        for name in names:
            remove(self.spark, f"{self.folder}/{name}")


def result(df: DataFrame, purpose: str) -> DataFrame:
    """Write an operator's result to its own folder and read it back."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hot_join(left: DataFrame, right: DataFrame, key: str, rows: str, total: int, how: str = "inner") -> DataFrame:
    """Equi-join of rows to a table that is unique per ``key``, safe for keys with a large share of the rows.

    ``rows`` is a column of ``right``: how many rows of ``left`` have the key; ``total`` their sum. Keys
    with more than total / HOT_SHARE rows are fewer than HOT_SHARE, whatever the data, so that part of
    ``right`` is broadcast. The other keys are joined by a shuffle. Up to FEW_ROWS rows in all, ``right`` has no more
    either and is broadcast whole.
    """
    if total <= FEW_ROWS:
        return left.join(F.broadcast(right), key, how)
    limit = max(total // HOT_SHARE, 1)
    hot = right.filter(F.col(rows) > limit)
    marked = left.join(F.broadcast(hot.select(key, F.lit(True).alias("_hot"))), key, "left")
    many = marked.filter("_hot").drop("_hot").join(F.broadcast(hot), key, "inner")
    few = marked.filter("_hot is null").drop("_hot").join(right.filter(F.col(rows) <= limit), key, how)
    return few.unionByName(many)


def connected(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Connected components of edges (u, v): one row (node, root) per node, root being its smallest node.

    Alternating star contraction: every round hangs larger neighbours, then smaller neighbours, onto the
    smallest one, and writes the edges that are left. It ends when a round changes nothing. Work is
    spread by nodes; a node with very many edges is joined as a hot key.
    """
    spark = edges.sparkSession
    now = scratch.keep(
        edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{name}_0"
    )

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before, step = mark(now), 0
    while before[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Larger neighbours of u go to the smallest of u and its neighbours.
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("n"))
        large = (
            hot_join(both, least, "u", "n", 2 * before[0]).filter("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        )
        large = scratch.keep(large, f"{name}_{step}_large")
        # u and its smaller neighbours go to the smallest of these.
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        hung = hot_join(large, least, "u", "n", large.count())
        small = (
            hung.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                          F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").filter("u <> v").distinct()
        )
        step += 1
        now = scratch.keep(small, f"{name}_{step}")
        after = mark(now)
        if after == before:
            break
        before = after
    roots = now.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def checked(small: DataFrame, rows: int = 500_000) -> DataFrame:
    """Narrow rows of a written table, marked for broadcast if a count shows that there are few; else joined by a shuffle."""
    return F.broadcast(small) if small.count() <= rows else small


def same_text() -> Column:
    """Join condition for finding rows (doc_id, text) again by (_id, _hash): id and text hash, NULLs included."""
    return F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
