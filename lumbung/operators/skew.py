"""Finding and splitting keys that hold too many rows for one task.

Small inputs cannot contain such a key, so their plans stay as plain as possible; the
decision uses Catalyst's size estimate of the input. For large inputs one aggregation
(combined on the map side, reading the key columns only) lists the heavy keys. That list
has at most one entry per ``group_rows`` rows of the input. Splitting
changes where rows are processed, never which rows are processed.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbung.session import shared_folder


@dataclass(frozen=True)
class SkewSettings:
    """When and how far to split.

    check_bytes: inputs whose files are smaller are not examined: 4 million rows of one key need more, at four
        bytes a row.
    group_rows: rows of one key a single task may receive.
    unseen_bytes: size of the tables below a lookup up to which it is broadcast unseen.
    broadcast_bytes: the same, up to which it is broadcast if its rows, counted by a job, fit into ``broadcast_memory``.
    broadcast_memory: bytes that a broadcast may take in the driver and in each executor. Files tell little about it: five
        million sorted ids are 16 MB of Parquet and half a gigabyte as a hash table.
    broadcast_rows: row count, verified by a job, up to which any other lookup is broadcast.
    """

    check_bytes: int = 16 << 20
    group_rows: int = 4_000_000
    broadcast_bytes: int = 16 << 20
    broadcast_rows: int = 100_000
    unseen_bytes: int = 1 << 20
    broadcast_memory: int = 64 << 20


DEFAULT = SkewSettings()

#: Heavy keys up to this many are broadcast; longer lists are joined by a shuffle.
LISTED = 100_000


def estimated_bytes(df: DataFrame) -> int:
    """Size of the tables a frame reads, from Catalyst's statistics; unknown counts as unbounded.

    The estimate of the frame itself would multiply the sides of every join.
    """
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))
    except AttributeError:  # no JVM handle (remote session)
        return 1 << 62


def has_at_most(df: DataFrame, rows: int) -> bool:
    """Whether a frame has no more than ``rows`` rows; counts no further than that plus one."""
    return df.select(F.lit(1)).limit(rows + 1).count() <= rows


def row_bytes(df: DataFrame) -> int:
    """About what a row takes in a hash table: pointers and places beside its columns."""
    return 32 + sum(8 if isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DatetimeType)) else 32 for f in df.schema.fields)


def hot_keys(df: DataFrame, keys: Sequence[str], settings: SkewSettings = DEFAULT) -> list[Row]:
    """Heavy keys with their row counts: all of them, fewer than rows / group_rows."""
    if estimated_bytes(df) < settings.check_bytes:
        return []
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.filter(F.col("_rows") > settings.group_rows).collect()


def _hot_frame(df: DataFrame, keys: Sequence[str], hot: list[Row], prefix: str) -> DataFrame:
    spark = df.sparkSession
    schema = df.select(*keys, F.lit(0).cast("long").alias("_rows")).schema
    frame = spark.createDataFrame(hot, schema=schema)
    marks = frame.select(*[F.col(k).alias(f"{prefix}{k}") for k in keys], "_rows")
    return F.broadcast(marks) if len(hot) <= LISTED else marks


def _same(df: DataFrame, keys: Sequence[str], prefix: str) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & df[k].eqNullSafe(F.col(f"{prefix}{k}"))
    return cond


def split_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    settings: SkewSettings = DEFAULT,
    measure: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Separate ordinary rows from rows of heavy keys, counted on ``measure`` if given.

    The second frame is None when no key is heavy. Otherwise it carries ``_chunk``: the
    rows are range-partitioned by key and order columns, so that chunks of one key are
    consecutive pieces of its order, and written to the shared folder. Reading them back
    keeps every chunk number stable when executors are lost and stages run again. ``_tie``
    tells rows apart that agree in all order columns, so that these can be cut as well; it
    is fixed by a first write for the same reason. Only heavy rows are written.
    """
    hot = hot_keys(measure if measure is not None else df, keys, settings)
    if not hot:
        return df, None
    marks = _hot_frame(df, keys, hot, "_hot_")
    same = _same(df, keys, "_hot_")
    cold = df.join(marks, same, "left_anti")
    pieces = max(2, math.ceil(sum(r["_rows"] for r in hot) / settings.group_rows))
    spark = df.sparkSession
    tied, chunked = shared_folder(spark, "heavy"), shared_folder(spark, "chunks")
    df.join(marks, same, "left_semi").withColumn("_tie", F.monotonically_increasing_id()).write.parquet(tied)
    (
        spark.read.parquet(tied)
        .repartitionByRange(pieces, *[F.col(c).asc() for c in (*keys, *order, "_tie")])
        .withColumn("_chunk", F.spark_partition_id())
        .write.parquet(chunked)
    )
    return cold, spark.read.parquet(chunked)


def skew_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    settings: SkewSettings = DEFAULT,
    measure: DataFrame | None = None,
) -> DataFrame:
    """Equi-join (inner or left) whose left side may hold very many rows of one key.

    Rows of a heavy key are dealt over several salts by a hash of the whole row (rows carry an
    id, so they differ), and the few matching right rows are repeated once per salt. ``measure`` names a cheaper frame with
    the same keys to count on, e.g. the bare scan below ``left``.
    """
    hot = hot_keys(measure if measure is not None else left, keys, settings)
    if not hot:
        return left.join(right, list(keys), how)

    salts = (F.ceil(F.col("_rows") / F.lit(settings.group_rows))).cast("int")

    def mark(df: DataFrame) -> DataFrame:
        marks = _hot_frame(df, keys, hot, "_hot_")
        marked = df.join(marks, _same(df, keys, "_hot_"), "left")
        return marked.withColumn("_salts", F.coalesce(salts, F.lit(1))).drop(
            "_rows", *[f"_hot_{k}" for k in keys]
        )

    spread = [c for c in left.columns if c not in keys] or list(keys)
    salted_left = mark(left).withColumn(
        "_salt", F.pmod(F.xxhash64(*[F.col(c) for c in spread]), F.col("_salts")).cast("int")
    ).drop("_salts")
    salted_right = mark(right).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))
    ).drop("_salts")
    return salted_left.join(salted_right, [*keys, "_salt"], how).drop("_salt")


def _may_broadcast(lookup: DataFrame, settings: SkewSettings) -> bool:
    size = estimated_bytes(lookup)
    if size <= min(settings.unseen_bytes, settings.broadcast_bytes):
        return True
    fitting = settings.broadcast_memory // row_bytes(lookup) if size <= settings.broadcast_bytes else 0
    return has_at_most(lookup, max(settings.broadcast_rows, fitting))


def lookup_join(
    left: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    settings: SkewSettings = DEFAULT,
    measure: DataFrame | None = None,
    unique: bool = False,
) -> DataFrame:
    """Join to a dimension: broadcast when its checked size allows, else a skew-aware shuffle.

    ``unique`` declares that ``left`` holds few rows per key, e.g. of its primary key: no key is looked for then.
    """
    if _may_broadcast(lookup, settings):
        return left.join(F.broadcast(lookup), list(keys), how)
    if estimated_bytes(lookup) <= settings.broadcast_bytes:
        lookup = lookup.hint("merge")  # else Spark broadcasts small files by itself
    if unique:
        return left.join(lookup, list(keys), how)
    return skew_join(left, lookup, keys, how, settings, measure)
