"""Items that don't reach the fact, with every reason why.

The fact keeps items whose lookups all find a row. Here the same lookups mark instead of drop: each sets a bit of a mask, at
order grain where the order decides, so that items join once by product and once by order, as in the fact. Items with an
empty mask are those of the fact; every other one names all lookups that failed.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung.operators.asof import asof_join
from lumbung.operators.skew import DEFAULT, SkewSettings, lookup_join, skew_join

from .dimensions import FLAGS
from .fact import Dimensions

#: Reason -> its bit. An item without its order has no reasons of the order.
REASONS = {name: 1 << i for i, name in enumerate(
    ["order", "customer_version", "payment_method", "shipping", "voucher", "order_status", "product", "order_flags"])}


def judged_items(stg: Mapping[str, DataFrame], dims: Dimensions, settings: SkewSettings = DEFAULT) -> DataFrame:
    """Every item (order_item_id, order_id, product_id, loaded_at) with ``reject_mask``: 0 for rows of the fact."""
    orders = stg["orders"].select(
        "order_id", "customer_id", "order_ts", "payment_method_id", "shipping_service_id", "voucher_id", "order_status")
    marked = asof_join(
        orders, dims.customer, "customer_id", "order_ts", "customer_nk", ["customer_key"], settings=settings, unmatched=True)
    failed = _bit("customer_version", F.col("customer_key").isNull())
    lookups = {"payment_method": (dims.payment_method, "payment_method_nk", "payment_method_id"),
               "shipping": (dims.shipping, "shipping_service_nk", "shipping_service_id"),
               "voucher": (dims.voucher, "voucher_nk", "voucher_id")}
    if dims.order_status is not None:
        lookups["order_status"] = (dims.order_status, "order_status", "order_status")
    else:
        failed = failed.bitwiseOR(_bit("order_status", F.col("order_status").isNull()))
    for reason, (dim, key, column) in lookups.items():
        marked = _looked_up(marked, dim.select(F.col(key).alias(column)), column, reason, settings)
        failed = failed.bitwiseOR(_bit(reason, F.col(f"_has_{reason}").isNull()))
    by_order = marked.select("order_id", failed.alias("_of_order"))

    items = stg["order_items"]
    flags = [text for name, text in FLAGS.items() if name not in ("is_delayed", "cancellation_stage")]  # these two always have a value
    unknown = F.expr(" or ".join(f"({text}) is null" for text in flags))
    narrow = items.select("order_item_id", "order_id", "product_id", "loaded_at", _bit("order_flags", unknown).alias("_of_item"))
    products = lookup_join(dims.product, dims.category.select("category_key"), ["category_key"], "inner", settings)
    known = _looked_up(
        narrow, products.select(F.col("product_nk").alias("product_id")), "product_id", "product", settings, items.select("product_id"))
    joined = skew_join(known, by_order, ["order_id"], "left", settings, measure=items.select("order_id"))
    mask = F.coalesce("_of_order", F.lit(REASONS["order"])).bitwiseOR(F.col("_of_item")).bitwiseOR(
        _bit("product", F.col("_has_product").isNull()))
    return joined.select("order_item_id", "order_id", "product_id", "loaded_at", mask.alias("reject_mask"))


def rejected_items(judged: DataFrame) -> DataFrame:
    """The items that are not in the fact, with their reasons as a comma-separated text."""
    names = [F.when(F.col("reject_mask").bitwiseAND(F.lit(bit)) != 0, F.lit(name)) for name, bit in REASONS.items()]
    return judged.filter("reject_mask <> 0").select("order_item_id", "order_id", F.concat_ws(",", *names).alias("reasons"))


def reject_counts(judged: DataFrame) -> DataFrame:
    """Items per reason, reasons without items included; an item with two reasons counts for both."""
    counts = [F.sum(F.when(F.col("reject_mask").bitwiseAND(F.lit(bit)) != 0, 1).otherwise(0)).alias(name) for name, bit in REASONS.items()]
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("reason"), F.coalesce(n, F.lit(0)).cast("long").alias("items")) for n in REASONS]))
    return judged.agg(*counts).select(rows.alias("r")).select("r.*")


def _bit(reason: str, failed: Column) -> Column:
    return F.when(failed, F.lit(REASONS[reason])).otherwise(F.lit(0))


def _looked_up(
    rows: DataFrame, keys: DataFrame, column: str, reason: str, settings: SkewSettings, measure: DataFrame | None = None
) -> DataFrame:
    lookup = keys.distinct().withColumn(f"_has_{reason}", F.lit(True))
    return lookup_join(rows, lookup, [column], "left", settings, measure)
