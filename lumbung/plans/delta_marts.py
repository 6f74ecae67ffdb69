"""Marts kept up to date by the differences between two versions of their source.

Between the marts and the fact (or the order roll-up) stands a *state* per mart: sums and counts by key, in which every
source row counts +1. A new version of the source differs from the version a state was made of by whole
partitions. Rows of partitions that went count -1, rows of partitions that came +1; what a rewritten partition
holds before and after cancels. So an update reads only partitions that changed, whatever the size of the source.

* Sums keep the number of values that are not NULL beside them, so a sum can become NULL again.
* Distinct counts are rows of a state by (group, customer); a row goes when nothing counts in it any more.
* Shortest and longest times and last days are keys of a state, so they can fall back when their last order goes.

Every version of a state notes the version of the source it stands for. An update that is repeated, or that comes after
one that stopped half way, starts from there and counts nothing twice. If that version is gone, the state is
built anew from the whole source.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.functions import surrogate_key
from lumbung.operators.skew import DEFAULT, SkewSettings, estimated_bytes
from lumbung.session import COMPRESSION, WorkFolder, parts_of, side_by_side
from lumbung.sources import versions

from . import marts

#: Fractional measures are kept as decimals with six digits, so that differences cancel exactly; all others are whole numbers.
FRACTIONAL = {"minutes_sum": "decimal(38,6)"}
BUCKET = "bucket"
BUCKETS_AT_ONCE = 4  # of a state, that one query makes: its shuffle files can go before the next one starts
SOURCE_VERSION = "source_version"


def _orders(rollup: DataFrame) -> DataFrame:
    return marts.counted(rollup).withColumn("order_day", F.expr("cast(order_ts as date)"))


def _minutes(rollup: DataFrame) -> DataFrame:
    """The shortest and the longest delivery of each order."""
    each = F.explode(F.array("minutes_min", "minutes_max")).alias("minutes")
    return marts.counted(rollup).select("shipping_key", "order_count", each).filter("minutes is not null")


@dataclass(frozen=True)
class State:
    """Sums of ``measures`` by ``keys`` over ``rows`` of a stored table.

    ``bucket``: key by whose hash the state is spread over files, so that an update writes only some of them.
    """

    source: str
    keys: tuple[str, ...]
    measures: tuple[str, ...]
    bucket: str | None = None
    rows: Callable[[DataFrame], DataFrame] = _orders


# Product sums count an order once per product and customer, so items are first summed per order.
STATES: Mapping[str, State] = {
    "city_customer": State("order_rollup", ("customer_city_key", "customer_nk"), (
        "order_count", "total_payment", "profit", "minutes_sum", "minutes_count", "cancelled_items", "item_count"), "customer_nk"),
    "customer_day": State("order_rollup", ("customer_nk", "order_day"), ("order_count", "total_payment", "profit"), "customer_nk"),
    "minute": State("order_rollup", ("order_time_key",), ("order_count", "total_payment")),
    "day": State("order_rollup", ("order_date_key",), (
        "order_count", "item_count", "quantity", "subtotal", "discount_amount", "shipping_subsidy", "voucher_amount",
        "total_payment", "estimated_cost", "profit")),
    "payment_method": State("order_rollup", ("payment_method_key",), (
        "order_count", "total_payment", "paid_item_count", "voucher_amount", "promo_loss")),
    "shipping": State("order_rollup", ("shipping_key",), (
        "order_count", "cancelled_items", "cancelled_orders", "minutes_sum", "minutes_count", "delayed_items", "item_count")),
    "shipping_minutes": State("order_rollup", ("shipping_key", "minutes"), ("order_count",), rows=_minutes),
    "product_customer": State("fct_order_item", ("product_nk", "category_key", "customer_nk"), (
        "order_count", "item_count", "quantity", "revenue", "profit", "returned_quantity", "returned_items",
        "cancelled_items"), "customer_nk", marts.product_orders),
}


def _values(state: State) -> list[str]:
    return [c for m in state.measures for c in (m, f"{m}_known")] + ["row_count"]


def _summed(state: State) -> list[Column]:
    return [F.sum(c).cast(FRACTIONAL.get(c, "bigint")).alias(c) for c in _values(state)]


def signed(state: State, went: DataFrame, came: DataFrame) -> DataFrame:
    """Differences by key; keys without any are left out."""
    def part(df: DataFrame, sign: int) -> DataFrame:
        counted = [F.expr(f"cast({sign} * coalesce(cast({m} as {FRACTIONAL.get(m, 'bigint')}), 0) as {FRACTIONAL.get(m, 'bigint')})").alias(m) for m in state.measures]
        known = [F.expr(f"{sign}L * int({m} is not null)").alias(f"{m}_known") for m in state.measures]
        return state.rows(df).select(*state.keys, *counted, *known, F.lit(sign).cast("long").alias("row_count"))

    both = part(went, -1).unionByName(part(came, 1))
    changed = " or ".join(f"{c} <> 0" for c in _values(state))
    return both.groupBy(*state.keys).agg(*_summed(state)).filter(changed)


def update(spark: SparkSession, state: State, path: str, source: str, rebuild: bool = False, buckets: int = 16, whole: int = 0) -> None:
    """Bring the state stored at ``path`` up to the newest version of the table ``source``.

    A query makes ``BUCKETS_AT_ONCE`` buckets, or more while the differences have at most ``whole`` bytes for each query.
    """
    newest = versions.version(spark, source)
    old = None if rebuild else versions.version(spark, path)
    since = old.notes[SOURCE_VERSION] if old else 0
    if old and since == newest.number:
        return
    diff = versions.changes(spark, source, since)
    if diff is None:  # the source's older version is gone
        old, diff = None, versions.changes(spark, source, 0)
    notes = {SOURCE_VERSION: newest.number}
    size = sum(map(estimated_bytes, diff)) if whole else 0
    at_once = -(-buckets // parts_of(size, whole, -(-buckets // BUCKETS_AT_ONCE)))
    with WorkFolder(spark, "state") as work:
        delta = signed(state, *diff)
        if state.bucket:
            delta = delta.withColumn(BUCKET, F.expr(f"cast(pmod(xxhash64({state.bucket}), {buckets}) as int)"))
        columns = [*state.keys, *([BUCKET] if state.bucket else [])]

        def write(df: DataFrame, folder: str) -> None:
            for some in _in_parts(df, buckets, at_once):
                some.write.mode("append").option("compression", COMPRESSION).partitionBy(BUCKET).parquet(folder)

        if not old:  # the differences are the state
            first = delta.filter("row_count <> 0").select(*columns, *_values(state))
            if state.bucket:
                versions.replace(first, path, [BUCKET], notes=notes, write=write)
            else:
                versions.replace(first.coalesce(1), path, notes=notes)
            return
        delta = work.keep_parts(_in_parts(delta, buckets, at_once) if state.bucket else [delta], "delta")

        def merged(now: DataFrame) -> DataFrame:
            return now.unionByName(delta).groupBy(*columns).agg(*_summed(state)).filter("row_count <> 0")

        if not state.bucket:
            versions.replace(merged(versions.table(spark, path)).coalesce(1), path, notes=notes)
            return
        touched = [r[0] for r in delta.select(BUCKET).distinct().collect()]  # at most ``buckets``
        now = versions.table(spark, path).filter(F.col(BUCKET).isin(touched))
        versions.replace_partitions(merged(now), path, BUCKET, touched, notes=notes, write=write)


def _in_parts(df: DataFrame, buckets: int, at_once: int) -> Iterator[DataFrame]:
    """The rows of some buckets at a time. The key a bucket is made of is a key of every aggregation, so sources are filtered."""
    for i in range(0, buckets, at_once):
        yield df.filter((F.col(BUCKET) >= i) & (F.col(BUCKET) < i + at_once))


def sums(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A stored state as plain sums by key; those without any value are NULL."""
    state = STATES[name]
    values = [F.expr(f"if({m}_known > 0, cast({m} as {'double' if m in FRACTIONAL else 'bigint'}), null)").alias(m) for m in state.measures]
    return versions.table(spark, path).select(*state.keys, *values)


def marts_of(states: Callable[[str], DataFrame], dims: Mapping[str, DataFrame], settings: SkewSettings = DEFAULT) -> dict[str, DataFrame]:
    """All marts but the voucher recommendations, which follow from the customer segments."""
    minutes = states("shipping_minutes").groupBy("shipping_key").agg(F.min("minutes").alias("minutes_min"), F.max("minutes").alias("minutes_max"))
    products = states("product_customer").groupBy("product_nk", "category_key").agg(
        F.count("customer_nk").alias("buying_customers"), *[F.sum(m).alias(m) for m in STATES["product_customer"].measures]
    ).withColumn("product_key", F.expr(surrogate_key("product_nk")))
    return {
        "mart_city_performance": marts.city_performance(states("city_customer"), dims["dim_city"], settings),
        "mart_customer_segments": marts.customer_segments(
            states("customer_day").withColumnRenamed("order_day", "order_ts"), dims["dim_customer"], dims["dim_city"], settings),
        "mart_hourly_orders": marts.hourly_orders(states("minute"), dims["dim_time"]),
        "mart_monthly_revenue": marts.monthly_revenue(states("day"), dims["dim_date"], settings),
        "mart_payment_method_performance": marts.payment_method_performance(
            states("payment_method"), dims["dim_payment_method"], settings),
        "mart_product_performance": marts.named_products(products, dims["dim_product"], dims["dim_category"], settings),
        "mart_shipping_performance": marts.shipping_performance(
            states("shipping").join(minutes, "shipping_key", "left"), dims["dim_shipping"], settings),
    }


def refresh(
    spark: SparkSession, folder: Callable[[str], str], rebuild: bool = False, names: Sequence[str] = tuple(STATES), whole: int = 0
) -> None:
    """Bring all states up to date, those of the fact first; ``folder`` names where a table is stored. No state reads another one."""
    longest = sorted(names, key=lambda n: STATES[n].source != "fct_order_item")
    side_by_side([
        lambda n=name: update(spark, STATES[n], folder(f"state_{n}"), folder(STATES[n].source), rebuild, whole=whole) for name in longest])
