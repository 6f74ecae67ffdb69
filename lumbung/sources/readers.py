"""Reading raw tables and dimension files with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbung.schemas import PRIMARY_KEYS, RAW_SCHEMAS


def raw_table(spark: SparkSession, base: str, table: str) -> DataFrame:
    """Scan of one raw table stored as Parquet below ``base``."""
    return spark.read.schema(RAW_SCHEMAS[table]).parquet(f"{base.rstrip('/')}/{table}")


def raw_tables(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """All raw tables below ``base``, by name."""
    return {t: raw_table(spark, base, t) for t in RAW_SCHEMAS}


def dimension_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """CSV copy of a dimension table: header row, declared types, load time added."""
    fields = [f for f in RAW_SCHEMAS[table].fields if f.name != "loaded_at"]
    read = spark.read.schema(T.StructType(fields)).option("header", True)
    return read.option("timestampNTZFormat", "yyyy-MM-dd[ HH:mm:ss][.SSSSSS]").csv(path).withColumn(
        "loaded_at", F.current_timestamp().cast("timestamp_ntz")
    )


def latest_profiles(profile_events: DataFrame) -> DataFrame:
    """Newest profile event of each customer; the event id decides between equal times.

    An aggregate, not a window: partial results are combined before the shuffle, so a
    customer with very many events costs one small state per task.
    """
    whole = F.struct(*[F.col(c) for c in profile_events.columns])
    newest = F.max_by(whole, F.struct("effective_at", "customer_profile_event_id"))
    return profile_events.groupBy("customer_id").agg(newest.alias("_row")).select("_row.*")


def max_key(df: DataFrame, key: str) -> DataFrame:
    """Largest key of a table as one row, 0 for an empty table."""
    return df.agg(F.coalesce(F.max(key), F.lit(0)).cast("long").alias("max_key"))


def max_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """Largest key of every transaction table: (table_name, max_key)."""
    names = [
        "orders", "order_items", "payments", "shipments", "order_status_events", "customer_profile_events",
    ]
    result = None
    for name in names:
        row = max_key(tables[name], PRIMARY_KEYS[name]).select(F.lit(name).alias("table_name"), "max_key")
        result = row if result is None else result.unionByName(row)
    return result


def new_data_start(orders: DataFrame) -> DataFrame:
    """Lower bound for new orders: the latest order time, else one day ago."""
    fallback = F.expr("cast(current_timestamp() as timestamp_ntz) - interval 1 day")
    return orders.agg(F.coalesce(F.max("order_ts"), fallback).alias("latest_order_ts"))
