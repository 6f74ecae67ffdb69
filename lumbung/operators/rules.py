"""Order-processing rules as operators on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumbung.functions import date_key, money, whole_days_between, zero_padded
from lumbung.session import shared_folder

from .ordered import OrderedSpec, ordered
from .skew import DEFAULT, SkewSettings, lookup_join, skew_join

# Voucher codes, their conditions and amounts.
NO_VOUCHER = "NO_DISCOUNT"
CASHBACK = "CASHBACK_10_MIN_200K"
FREE_SHIPPING = "FREE_SHIPPING_MIN_50K"
ELECTRONICS_OFF = "ELECTRONICS_100K"
CASHBACK_MINIMUM, FREE_SHIPPING_MINIMUM = 200_000, 50_000
CASHBACK_RATE, ELECTRONICS_LIMIT = 0.10, 100_000
ELECTRONICS = "Electronics"

# Status changes an order may make.
LEGAL_STEPS = {
    "placed": ["paid", "cancelled"],
    "paid": ["packed", "cancelled"],
    "packed": ["shipped", "cancelled"],
    "shipped": ["delivered", "cancelled"],
    "delivered": ["returned"],
    "cancelled": [],
    "returned": [],
}


def with_category(
    items: DataFrame, products: DataFrame, categories: DataFrame, settings: SkewSettings = DEFAULT
) -> DataFrame:
    """Items with the name of their product's category."""
    named = lookup_join(
        products.select("product_id", "category_id"), categories.select("category_id", "category_name"),
        ["category_id"], "inner", settings,
    ).select("product_id", "category_name")
    return lookup_join(items, named, ["product_id"], "inner", settings, measure=items.select("product_id"))


def order_subtotals(items: DataFrame) -> DataFrame:
    """Subtotal and Electronics subtotal per order, from items with ``category_name``."""
    return items.groupBy("order_id").agg(
        F.sum("subtotal").alias("order_subtotal"),
        F.expr(f"sum(if(category_name = '{ELECTRONICS}', subtotal, 0)) as electronics_subtotal"),
    )


def eligible_vouchers(items: DataFrame) -> DataFrame:
    """Voucher codes each order qualifies for: (order_id, voucher_code)."""
    return order_subtotals(items).selectExpr("order_id", f"""explode(array_compact(array('{NO_VOUCHER}',
        if(order_subtotal >= {CASHBACK_MINIMUM}, '{CASHBACK}', null),
        if(order_subtotal >= {FREE_SHIPPING_MINIMUM}, '{FREE_SHIPPING}', null),
        if(electronics_subtotal > 0, '{ELECTRONICS_OFF}', null)))) as voucher_code""")


def promotion_pools(
    orders: DataFrame, vouchers: DataFrame, shipments: DataFrame, items: DataFrame, settings: SkewSettings = DEFAULT
) -> DataFrame:
    """Cashback, electronics and shipping amounts each order may hand to its items."""
    coded = lookup_join(
        orders.select("order_id", "voucher_id"), vouchers.select("voucher_id", "voucher_code"), ["voucher_id"], "inner",
        settings,
    )
    fees = shipments.select("order_id", "shipping_fee")
    cashback = money(f"order_subtotal * {CASHBACK_RATE}d")
    return coded.join(order_subtotals(items), "order_id", "inner").join(fees, "order_id", "left").selectExpr(
        "order_id", "voucher_code", "order_subtotal", "electronics_subtotal",
        f"if(voucher_code = '{CASHBACK}', {cashback}, 0L) as cashback_pool",
        f"if(voucher_code = '{ELECTRONICS_OFF}', least({ELECTRONICS_LIMIT}L, electronics_subtotal), 0L)"
        " as electronics_pool",
        f"if(voucher_code = '{FREE_SHIPPING}', coalesce(shipping_fee, 0L), 0L) as shipping_pool",
    )


def allocated_items(items: DataFrame, pools: DataFrame, settings: SkewSettings = DEFAULT) -> DataFrame:
    """Share each order's pools over its items by subtotal and derive the item amounts.

    Every amount is rounded on its own, so the items of an order need not add up to the pool.
    """
    general = "if(order_subtotal <> 0, subtotal / order_subtotal, 0d)"
    electronic = (
        f"if(category_name = '{ELECTRONICS}' and electronics_subtotal <> 0, subtotal / electronics_subtotal, 0d)"
    )
    joined = skew_join(items, pools, ["order_id"], "inner", settings, measure=items.select("order_id"))
    given = joined.selectExpr(
        "order_item_id", "order_id", "product_id", "quantity", "subtotal", "discount_amount", "estimated_cost",
        f"{money(f'cashback_pool * {general} + electronics_pool * {electronic}')} as voucher_amount",
        f"{money(f'shipping_pool * {general}')} as shipping_subsidy",
    )
    return with_item_amounts(given)


def allocated_whole(items: DataFrame, pools: DataFrame, settings: SkewSettings = DEFAULT) -> DataFrame:
    """Like ``allocated_items``, but the items of an order add up to its pools exactly.

    Largest remainders: every item gets the whole part of its share; what is left goes, one each, to the items with the
    largest remainders, of equal ones to the smallest id. Items without any weight in their order share alike.
    """
    joined = skew_join(items, pools, ["order_id"], "inner", settings, measure=items.select("order_id"))
    worth = "greatest(subtotal, 0L)"
    weighed = joined.selectExpr(
        "order_item_id", "order_id", "product_id", "quantity", "subtotal", "discount_amount", "estimated_cost",
        "cashback_pool + electronics_pool as _voucher_pool", "shipping_pool as _shipping_pool", f"{worth} as _shipping_weight",
        f"if(electronics_pool > 0 and not (category_name <=> '{ELECTRONICS}'), 0L, {worth}) as _voucher_weight",
    )
    # Totals beside the rows: a sum joined back would compute the items, their categories and pools once more.
    shared = ordered(
        weighed.withColumn("_one", F.lit(1).cast("long")), ["order_id"], ["order_item_id"],
        OrderedSpec(totals={"_voucher_total": "_voucher_weight", "_shipping_total": "_shipping_weight", "_n": "_one"}), settings,
        measure=items.select("order_id")).drop("_one")
    for name, amount in (("voucher", "voucher_amount"), ("shipping", "shipping_subsidy")):
        before = shared.columns
        total = f"if(_{name}_total = 0, _n, _{name}_total)"
        part = f"cast(_{name}_pool as decimal(19, 0)) * cast(if(_{name}_total = 0, 1L, _{name}_weight) as decimal(19, 0))"
        parts = shared.selectExpr("*", f"cast(({part}) div {total} as bigint) as _whole", f"cast(-(({part}) % {total}) as bigint) as _rest")
        ranked = ordered(
            parts, ["order_id"], ["_rest", "order_item_id"], OrderedSpec(sequence="_nth", totals={"_given": "_whole"}), settings,
            measure=items.select("order_id"))
        shared = ranked.selectExpr(*before, f"_whole + if(_nth <= _{name}_pool - _given, 1L, 0L) as {amount}")
    return with_item_amounts(shared.select(*[c for c in shared.columns if not c.startswith("_")]))


def with_item_amounts(items: DataFrame) -> DataFrame:
    """Customer payment and profit of an item from its parts."""
    paid = items.selectExpr("*", "subtotal - discount_amount - voucher_amount as total_payment")
    return paid.selectExpr("*", "total_payment - estimated_cost - shipping_subsidy as profit")


def payment_amounts(items: DataFrame) -> DataFrame:
    """Amount to pay per order."""
    return items.groupBy("order_id").agg(F.sum("total_payment").alias("payment_amount"))


def stage_times(status_events: DataFrame) -> DataFrame:
    """First shipped and delivered time per order."""
    return status_events.groupBy("order_id").agg(
        F.expr("min(status_ts) filter (where status = 'shipped') as shipped_ts"),
        F.expr("min(status_ts) filter (where status = 'delivered') as delivered_ts"),
    )


def late_deliveries(
    shipments: DataFrame, shipping_services: DataFrame, settings: SkewSettings = DEFAULT
) -> DataFrame:
    """Shipments that took more whole days than their service promises."""
    promise = shipping_services.select("shipping_service_id", "max_delivery_days")
    joined = lookup_join(shipments, promise, ["shipping_service_id"], "inner", settings)
    return joined.selectExpr(
        "shipment_id", "order_id", "shipping_service_id",
        f"{whole_days_between('shipped_ts', 'delivered_ts')} as delivery_days", "max_delivery_days",
    ).filter("delivery_days > max_delivery_days")


#: Payment status that follows from order status and cancellation stage.
PAYMENT_STATUS = """case when order_status = 'cancelled' and cancellation_stage = 'placed' then 'cancelled'
    when order_status = 'returned' then 'refunded' else 'paid' end"""

#: Shipping status that follows from order status and delivery time.
SHIPPING_STATUS = """case when order_status = 'cancelled' then 'cancelled'
    when delivered_ts is not null then 'delivered' else 'in_progress' end"""


def order_number(ts: str, order_id: str) -> str:
    """``ORD-YYYYMMDD-`` and the order id with at least eight digits."""
    return f"concat('ORD-', {date_key(ts)}, '-', {zero_padded(order_id, 8)})"


def sku(category_name: str, product_id: str) -> str:
    """``SKU-XXX-`` and the product id with at least five digits."""
    return f"concat('SKU-', upper(substring({category_name}, 1, 3)), '-', {zero_padded(product_id, 5)})"


def continued_keys(
    batch: DataFrame, order: list[str], key: str, last_key: int, settings: SkewSettings = DEFAULT
) -> DataFrame:
    """Number a batch from ``last_key + 1`` in the given order.

    A batch of more than ``group_rows`` rows is cut into ranges of all order columns, so that rows of one instant are cut as
    well, and written with the number of its range to the shared folder, which keeps the numbers when executors are
    lost. Each range is numbered by itself and starts after the rows of the earlier ones.
    """
    pieces = batch.count() // settings.group_rows + 1
    if pieces == 1:
        cut = batch.withColumn("_piece", F.lit(0))
    else:
        ranges = batch.repartitionByRange(pieces, *order).withColumn("_piece", F.spark_partition_id())
        folder = shared_folder(batch.sparkSession, "pieces")
        ranges.write.parquet(folder)
        cut = batch.sparkSession.read.schema(ranges.schema).parquet(folder)
    line = Window.partitionBy("_piece").orderBy(*order)
    numbered = cut.withColumn("_nth", F.row_number().over(line).cast("long"))
    earlier = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)  # over one row per piece
    starts = cut.groupBy("_piece").agg(F.count(F.lit(1)).alias("_n")).select(
        "_piece", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    return numbered.join(starts, "_piece").withColumn(key, F.col("_nth") + F.col("_start") + F.lit(last_key)).select(*batch.columns, key)


def illegal_steps(status_events: DataFrame, settings: SkewSettings = DEFAULT) -> DataFrame:
    """Consecutive statuses of an order that are not an allowed change."""
    followed = ordered(
        status_events.select("order_id", "status_event_id", "status", "status_ts"),
        ["order_id"], ["status_ts", "status_event_id"], OrderedSpec(nexts={"next_status": "status"}), settings,
    )
    allowed = [f"('{a}', '{b}')" for a, following in LEGAL_STEPS.items() for b in following]
    return followed.filter(
        f"next_status is not null and struct(status, next_status) not in ({', '.join(allowed)})"
    ).select("order_id", "status_event_id", "status", "next_status", "status_ts")
