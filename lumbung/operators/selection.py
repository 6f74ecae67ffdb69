"""Exact percentiles by selection: histograms narrow the range of values in which each rank lies.

Ordering all distinct values of a group means a shuffle as large as these values and a group that may fill a task. Here a
pass counts the rows of each group in a fixed number of bins between two bounds and keeps, for each wanted rank, the bin it falls into,
with the smallest and the largest value seen in it as the next bounds. A shuffle carries bins only: their number per group is fixed,
and they are summed before they leave a task. A rank is known when its bin holds one value. What few rows are
left between bounds after some passes are counted per value and walked in order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbung.session import WorkFolder, shared_folder

from .ordered import OrderedSpec, ordered
from .skew import DEFAULT, SkewSettings, lookup_join


def _bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Number of the bin, never falling as the value rises. Infinite values and NaN, the largest, have bins of their own."""
    v, a, b = (c.cast("double") for c in (value, low, high))
    inside = F.floor((v / bins - a / bins) / (b / bins - a / bins) * bins)
    return (
        F.when(F.isnan(v), bins + 2).when(v == float("inf"), bins + 1).when(v == float("-inf"), -1)
        .when(b > a, F.least(F.greatest(inside, F.lit(0)), F.lit(bins))).otherwise(0).cast("int")
    )


def _finite(value: Column) -> Column:
    v = value.cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) != float("inf")), value)


def selected_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, shares: Mapping[str, float], settings: SkewSettings = DEFAULT,
    bins: int = 1024, passes: int = 4, rest_rows: int = 100_000,
) -> DataFrame:
    """(keys, value_count, one column per share): the smallest value that covers the share of a group's non-NULL values.

    Values are numbers; a NULL key is a group like any other. ``df`` is computed once. Passes end when every rank is known, at most
    ``rest_rows`` rows lie between bounds, or after ``passes``: the ordered walk over the rest is exact whatever its size, and
    splits groups that are too large for one task.
    """
    if not isinstance(df.schema[value].dataType, T.NumericType):
        raise TypeError(f"{value} is not a number")
    spark, names = df.sparkSession, [f"_k{i}" for i in range(max(1, len(keys)))]
    # A struct per key column joins NULL with NULL; without keys all rows are one group.
    grouped = [F.struct(F.col(k).alias("v")) for k in keys] or [F.struct(F.lit(0).alias("v"))]
    with WorkFolder(spark, "selection") as work:
        rows = work.keep(df.filter(F.col(value).isNotNull()).select(
            *[g.alias(n) for g, n in zip(grouped, names, strict=True)], F.col(value).alias("_v")), "values")
        groups = rows.groupBy(*names).agg(
            F.count(F.lit(1)).alias("_total"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
        ranks = F.explode(F.array(*[
            F.struct(F.lit(n).alias("_share"), F.greatest(F.ceil(F.col("_total") * F.lit(s)), F.lit(1)).alias("_rank"))
            for n, s in shares.items()]))
        wanted = groups.select("*", ranks.alias("_r")).select(
            *names, "_r.*", "_total", F.lit(0).cast("long").alias("_below"), F.col("_total").alias("_inside"), "_low", "_high")
        bounds, number = work.keep(wanted, "bounds-0"), 0
        known, settled = [], F.expr("_low = _high")  # NaN equals NaN in Spark

        def between() -> DataFrame:
            """Rows within the bounds of an open rank, once for each such rank."""
            return lookup_join(rows, bounds, names, "inner", settings).filter("_v >= _low and _v <= _high")

        while True:
            known.append(bounds.filter(settled).select(*names, "_share", "_total", F.col("_low").alias("_value")))
            bounds = bounds.filter(~settled)
            left, inside = bounds.agg(F.count(F.lit(1)), F.coalesce(F.sum("_inside"), F.lit(0))).first()
            if not left or inside <= rest_rows or number == passes:
                break
            number += 1
            ends = bounds
            if isinstance(df.schema[value].dataType, (T.DoubleType, T.FloatType)):
                # Bins lie between finite bounds; where a group's extremes are not, its finite ones are looked up.
                finite = between().groupBy(*names, "_share").agg(F.min(_finite(F.col("_v"))).alias("_a"), F.max(_finite(F.col("_v"))).alias("_b"))
                ends = work.keep(bounds.join(finite, [*names, "_share"]), f"ends-{number}")
                bounds, low, high = ends, F.col("_a"), F.col("_b")
            else:
                low, high = F.col("_low"), F.col("_high")
            low, high = F.coalesce(low, F.col("_low")), F.coalesce(high, F.col("_high"))
            counted = between().withColumn("_bin", _bin(F.col("_v"), low, high, bins)).groupBy(*names, "_share", "_bin").agg(
                F.first("_rank").alias("_rank"), F.first("_total").alias("_total"), F.first("_below").alias("_below"),
                F.count(F.lit(1)).alias("_inside"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
            # At most ``bins`` and three rows in a window.
            line = Window.partitionBy(*names, "_share").orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
            upto = counted.withColumn("_upto", F.col("_below") + F.sum("_inside").over(line))
            hit = upto.filter("_upto >= _rank and _upto - _inside < _rank").withColumn("_below", F.expr("_upto - _inside"))
            bounds = work.keep(hit.select(*wanted.columns), f"bounds-{number}")
        if left:
            counts = between().groupBy(*names, "_share", "_total", "_rank", "_below", "_v").agg(F.count(F.lit(1)).alias("_n"))
            walked = ordered(work.keep(counts, "rest"), [*names, "_share"], ["_v"], OrderedSpec(sums={"_upto": "_n"}), settings)
            known.append(walked.filter("_below + _upto >= _rank").groupBy(*names, "_share", "_total").agg(F.min("_v").alias("_value")))
        found = known[0]
        for more in known[1:]:
            found = found.unionByName(more)
        picks = [F.max(F.when(F.col("_share") == n, F.col("_value"))).alias(n) for n in shares]
        done = found.groupBy(*names).agg(F.first("_total").alias("value_count"), *picks).select(
            *[F.col(f"{n}.v").alias(k) for k, n in zip(keys, names, strict=False)], "value_count", *shares)
        path = shared_folder(spark, "percentiles")
        done.write.parquet(path)
        return spark.read.schema(done.schema).parquet(path)
