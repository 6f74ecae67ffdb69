"""Generated calendar and minute series."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def date_spine(spark: SparkSession, first: date, last: date) -> DataFrame:
    """One row per day, both ends included."""
    days = F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day"))
    return spark.range(1, numPartitions=1).select(F.explode(days).alias("date_day"))


def spanning_date_spine(df: DataFrame, ts: str) -> DataFrame:
    """One row per day between the earliest and the latest timestamp of a table."""
    span = df.agg(F.min(ts).cast("date").alias("lo"), F.max(ts).cast("date").alias("hi"))
    return span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date_day"))


def minute_spine(spark: SparkSession) -> DataFrame:
    """Minutes 0..1439 of a day."""
    return spark.range(0, 1440, 1, 1).select(F.col("id").cast("int").alias("minute_of_day"))
