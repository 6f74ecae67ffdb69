"""Exact percentiles without holding a group in memory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import OrderedSpec, ordered
from .skew import DEFAULT, SkewSettings


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    shares: dict[str, float],
    settings: SkewSettings = DEFAULT,
) -> DataFrame:
    """Smallest value of each group that covers the given share of its non-NULL values.

    Rows are first counted per distinct value, which combines on the map side; one pass then walks the
    distinct values in order with the running count and the total.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    walked = ordered(counts, keys, [value], OrderedSpec(sums={"_upto": "_n"}, totals={"_total": "_n"}), settings)
    picks = [
        F.min(F.when(F.col("_upto") >= F.ceil(F.col("_total") * F.lit(share)), F.col(value))).alias(name)
        for name, share in shares.items()
    ]
    return walked.groupBy(*keys).agg(F.first("_total").alias("value_count"), *picks)
