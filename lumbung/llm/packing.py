"""Packing into optimal length buckets under a token budget.

Texts are counted in tokens of a public vocabulary plus an end token; longer ones than ``longest`` are cut into
pieces of that many. The histogram of piece lengths over all documents (at most ``longest`` bars) goes through a
dynamic program that chooses at most ``buckets`` boundaries with the least padding of all choices. Inside a bucket,
pieces in the order of arrival fill batches of floor(budget / boundary) rows, so a batch never exceeds the budget (a
boundary above the budget gives batches of one).

Positions within a bucket come from chunks of the order and the sums of earlier chunks, never from one sort of
a bucket. Texts that are NULL or empty are one end token. Equal rows get a place each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumbung.llm.common import Scratch, result, slices, table
from lumbung.llm.pieces import byte_bpe_ranks, text_slots


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Boundaries of at most ``buckets`` buckets with the least padding, for ascending distinct lengths."""
    m = len(lengths)
    if not m:
        return [1]
    up_to = np.concatenate([[0], np.cumsum(counts.astype(np.float64))])
    # cost[j]: padded tokens of the j shortest lengths; a bucket (i, j] pads to lengths[j - 1].
    cost = np.concatenate([[0.0], lengths * up_to[1:]])
    choice = [np.zeros(m + 1, np.int64)]
    for _ in range(min(buckets, m) - 1):
        better, from_ = cost.copy(), choice[-1] * 0 - 1
        for j in range(1, m + 1):
            tried = cost[:j] + lengths[j - 1] * (up_to[j] - up_to[:j])
            i = int(np.argmin(tried))
            if tried[i] < better[j]:
                better[j], from_[j] = tried[i], i
        cost = better
        choice.append(from_)
    out, j = [], m
    for from_ in reversed(choice):
        if j and from_[j] >= 0:  # -1: one bucket less does as well
            out.append(int(lengths[j - 1]))
            j = int(from_[j])
    return out[::-1]


def _count(path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = byte_bpe_ranks(path, cap=200_000)
        for b in slices(batches):
            pieces.start()
            slots = [text_slots(t or "", pieces) for t in b.column("text").to_pylist()]
            sizes = pieces.counts(np.concatenate([*slots, np.empty(0, np.int64)]))
            doc = np.repeat(np.arange(len(slots)), [len(s) for s in slots])
            tokens = np.bincount(doc, weights=sizes, minlength=len(slots)).astype(np.int64)
            rest = [n for n in b.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*map(b.column, rest), pa.array(tokens + 1)], [*rest, "tokens"])
    return run


def _arrival(docs: DataFrame, chunk_rows: int) -> DataFrame:
    """(doc_id, text, chunk, place): the order of rows in their files, else of md5(doc_id)."""
    try:
        return docs.select("doc_id", "text", F.col("_metadata.file_name").alias("chunk"),
                           F.lpad(F.col("_metadata.row_index").cast("string"), 19, "0").alias("place"))
    except AnalysisException:  # not read from files
        return by_mark(docs, chunk_rows)


def by_mark(docs: DataFrame, chunk_rows: int = 20_000) -> DataFrame:
    digits = max(1, math.ceil(math.log(max(docs.select("doc_id").count() / chunk_rows, 1), 16)) + 1)
    mark = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return docs.select("doc_id", "text", F.substring(mark, 1, digits).alias("chunk"),
                       F.concat(mark, F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))).alias("place"))


def pack(ordered: DataFrame, scratch: Scratch, longest: int = 4096, buckets: int = 8, budget: int = 65_536,
         vocabulary: str | None = None) -> DataFrame:
    """Batches of pieces from (doc_id, text, chunk, place), in the order of (chunk, place).

    Returns (doc_id, piece, start, n_tokens, bucket, padded, batch, row): piece ``piece`` of the document holds its tokens
    from ``start`` on, and is row ``row`` of batch ``batch`` of bucket ``bucket``, padded to ``padded`` tokens.
    """
    counted = ordered.mapInArrow(_count(vocabulary), ordered.drop("text").schema.add("tokens", "long"))
    counted = scratch.keep(counted, "counted")
    pieces = counted.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(tokens - 1) div {longest}"))).alias("piece"))
    pieces = pieces.withColumns({"start": F.col("piece") * longest, "n_tokens": F.expr(f"least({longest}, tokens - piece * {longest})")})
    bars = sorted(tuple(r) for r in pieces.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect())  # at most ``longest``
    ends = boundaries(np.array([b[0] for b in bars], np.int64), np.array([b[1] for b in bars], np.int64), buckets)
    steps = F.array(*map(F.lit, ends))
    pieces = pieces.withColumn("bucket", F.size(F.filter(steps, lambda e: e < F.col("n_tokens")))).withColumn(
        "padded", F.element_at(steps, F.col("bucket") + 1).cast("long"))
    line = Window.partitionBy("bucket", "chunk").orderBy("place", "doc_id", "piece")
    pieces = pieces.withColumn("inside", F.row_number().over(line).cast("long") - 1)
    earlier = Window.partitionBy("bucket").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = pieces.groupBy("bucket", "chunk").agg(F.count(F.lit(1)).alias("n")).select(
        "bucket", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    rows = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.col("padded"))).cast("long")
    placed = pieces.join(chunks, ["bucket", "chunk"]).withColumns({"rank": F.col("inside") + F.col("before"), "rows": rows})
    return placed.select("doc_id", "piece", "start", "n_tokens", "bucket", "padded",
                         F.expr("rank div rows").alias("batch"), (F.col("rank") % F.col("rows")).alias("row"))


def op2_bucket_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of all documents in a shuffled order that only depends on their ids."""
    with Scratch(spark, "packing") as scratch:
        return result(pack(by_mark(table(spark, sf_dir, "documents")), scratch), "op2")


def packed(docs: DataFrame) -> DataFrame:
    """Batches of ``docs`` in their order of arrival."""
    with Scratch(docs.sparkSession, "packing") as scratch:
        return result(pack(_arrival(docs, 20_000), scratch), "packed")
