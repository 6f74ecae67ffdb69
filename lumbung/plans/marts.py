"""Business marts on the fact.

Distinct orders are counted by first rolling the fact up to one row per order; a plain
count then replaces ``count(distinct order_id)``, and one roll-up serves six marts. An order
belongs to one customer version, city, date, minute, payment method and shipping service.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumbung.functions import ratio, surrogate_key
from lumbung.operators.skew import DEFAULT, SkewSettings, lookup_join

ORDER_KEYS = [
    "customer_nk", "customer_key", "customer_city_key", "order_date_key", "order_time_key",
    "payment_method_key", "shipping_key", "cancellation_stage", "is_new_customer_order",
]

# Segment thresholds in currency units and orders.
VIP_REVENUE, HIGH_REVENUE, LOW_REVENUE, FREQUENT_ORDERS = 5_000_000, 3_000_000, 1_000_000, 5

#: Parts by customer that the rows of one product are dealt over.
PRODUCT_SLICES = 8


def _exprs(*texts: str) -> list[Column]:
    return [F.expr(t) for t in texts]


def _sums(*columns: str) -> list[str]:
    """``sum(c) as c``, or ``sum(c) as name`` for entries written "c name"."""
    return [f"sum({c.split()[0]}) as {c.split()[-1]}" for c in columns]


def _share(part: str, whole: str = "item_count") -> str:
    return ratio(f"sum({part})", f"sum({whole})")


def order_rollup(fact: DataFrame, keys: Sequence[str] = tuple(ORDER_KEYS)) -> DataFrame:
    """One row per order: summed measures, flag counts, delivery time range.

    Partial sums are combined before the shuffle, so an order with very many items is no
    hot spot. Measures a mart does not use are pruned by the optimizer. All items of an order agree in its keys, as
    orders are computed whole, so these are grouping columns and the sums are hash aggregations; the check of the stored
    roll-up (one row per order) fails if they ever don't.
    """
    minutes = "delivery_duration_minutes"
    return fact.groupBy("order_id", *keys).agg(*_exprs(
        "count(*) as item_count",
        *_sums("quantity", "subtotal", "discount_amount", "shipping_subsidy", "voucher_amount", "total_payment",
               "estimated_cost", "profit"),
        "count(total_payment) as paid_item_count",
        "sum(discount_amount + voucher_amount + shipping_subsidy) as promo_loss", "max(order_ts) as order_ts",
        f"sum({minutes}) as minutes_sum", f"count({minutes}) as minutes_count",
        f"min({minutes}) as minutes_min", f"max({minutes}) as minutes_max",
        "count_if(is_cancelled) as cancelled_items", "count_if(is_returned) as returned_items",
        "count_if(is_delayed) as delayed_items",
    ))


def counted(orders: DataFrame) -> DataFrame:
    """Rows of the roll-up as sums over one order; rows that are sums over several orders already stay as they are."""
    if "order_count" in orders.columns:
        return orders
    have = set(orders.columns)
    orders = orders.withColumn("order_count", F.lit(1).cast("long"))
    return orders.withColumn("cancelled_orders", F.expr("cast(cancelled_items > 0 as bigint)")) if "cancelled_items" in have else orders


def city_performance(orders: DataFrame, dim_city: DataFrame, settings: SkewSettings = DEFAULT) -> DataFrame:
    """Orders, customers, revenue, profit, delivery time and cancellations per city."""
    place = ["city_name", "province", "region"]
    city = dim_city.selectExpr("city_key as customer_city_key", *place)
    located = lookup_join(counted(orders), city, ["customer_city_key"], "inner", settings)
    # One row per customer and city first: a second distinct count becomes a plain count too.
    customers = located.groupBy(*place, "customer_nk").agg(*_exprs(
        *_sums("order_count", "total_payment", "profit", "minutes_sum", "minutes_count", "cancelled_items", "item_count"),
    ))
    return customers.groupBy(*place).agg(*_exprs(
        "sum(order_count) as transaction_count", "count(customer_nk) as customer_count",
        *_sums("total_payment revenue", "profit"),
        f"{_share('minutes_sum', 'minutes_count')} as avg_delivery_duration_minutes",
        f"{_share('cancelled_items')} as cancellation_rate",
    ))


def customer_segments(
    orders: DataFrame, dim_customer: DataFrame, dim_city: DataFrame, settings: SkewSettings = DEFAULT
) -> DataFrame:
    """Customer totals beside the current profile, with group and voucher strategy."""
    metrics = counted(orders).groupBy("customer_nk").agg(*_exprs(
        *_sums("order_count transaction_count", "total_payment revenue", "profit"),
        "cast(max(order_ts) as date) as last_order_date",
    ))
    current = dim_customer.filter("is_current").selectExpr(
        "customer_nk", "customer_key as current_customer_key", "full_name", "loyalty_tier", "city_key"
    )
    joined = lookup_join(
        metrics.join(current, "customer_nk", "inner"), dim_city.select("city_key", "city_name"), ["city_key"],
        "inner", settings,
    )
    often, seldom = f"transaction_count >= {FREQUENT_ORDERS}", f"transaction_count < {FREQUENT_ORDERS}"
    rules = [
        (f"revenue >= {VIP_REVENUE} and {often}", "VIP", "Exclusive loyalty voucher"),
        (f"revenue >= {HIGH_REVENUE} and {seldom}", "High Revenue Low Frequency", "Retention voucher"),
        (f"revenue < {LOW_REVENUE} and {often}", "Frequent Low Basket", "Basket-size upsell voucher"),
        ("transaction_count = 1", "New/One-time", "Second purchase voucher"),
    ]
    groups = " ".join(f"when {condition} then '{name}'" for condition, name, _ in rules)
    advice = " ".join(f"when {condition} then '{strategy}'" for condition, _, strategy in rules)
    return joined.selectExpr(
        "customer_nk", "current_customer_key", "full_name", "loyalty_tier", "city_name", "transaction_count",
        "revenue", "profit", "last_order_date", f"case {groups} else 'Regular' end as customer_group",
        f"case {advice} else 'Standard campaign voucher' end as recommended_voucher_strategy",
    )


def hourly_orders(orders: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Orders and revenue per hour of the day."""
    times = dim_time.selectExpr("time_key as order_time_key", "hour_of_day", "daypart")
    # 1,440 rows by construction.
    return counted(orders).join(F.broadcast(times), "order_time_key").groupBy("hour_of_day", "daypart").agg(
        *_exprs(*_sums("order_count", "total_payment revenue"))
    )


def monthly_revenue(orders: DataFrame, dim_date: DataFrame, settings: SkewSettings = DEFAULT) -> DataFrame:
    """Monthly orders, amounts, cost, profit and margin."""
    days = dim_date.selectExpr(
        "date_key as order_date_key", "year", "month", "trunc(date_day, 'month') as month_start_date"
    )
    dated = lookup_join(counted(orders), days, ["order_date_key"], "inner", settings)
    return dated.groupBy("year", "month", "month_start_date").agg(*_exprs(
        *_sums(
            "order_count", "item_count order_item_count", "quantity quantity_sold", "subtotal gross_revenue", "discount_amount",
            "shipping_subsidy", "voucher_amount", "total_payment net_revenue", "estimated_cost", "profit"),
        f"{_share('profit', 'total_payment')} as profit_margin",
    ))


def payment_method_performance(
    orders: DataFrame, dim_payment_method: DataFrame, settings: SkewSettings = DEFAULT
) -> DataFrame:
    """Orders, value and promotion loss per payment method."""
    names = ["payment_method_name", "payment_group"]
    methods = dim_payment_method.select("payment_method_key", *names)
    return lookup_join(counted(orders), methods, ["payment_method_key"], "inner", settings).groupBy(*names).agg(*_exprs(
        *_sums("order_count transaction_count", "total_payment transaction_value"),
        f"{_share('total_payment', 'paid_item_count')} as avg_item_value",
        *_sums("voucher_amount", "promo_loss total_promo_loss"),
    ))


def shipping_performance(orders: DataFrame, dim_shipping: DataFrame, settings: SkewSettings = DEFAULT) -> DataFrame:
    """Orders, cancellations, delivery times and delays per shipping service."""
    names = ["shipping_provider", "shipping_service", "service_level"]
    services = dim_shipping.select("shipping_key", *names)
    return lookup_join(counted(orders), services, ["shipping_key"], "inner", settings).groupBy(*names).agg(*_exprs(
        *_sums("order_count", "cancelled_items cancelled_order_item_count", "cancelled_orders cancelled_order_count"),
        f"{_share('minutes_sum', 'minutes_count')} as avg_delivery_duration_minutes",
        "min(minutes_min) as fastest_delivery_minutes", "max(minutes_max) as slowest_delivery_minutes",
        f"{_share('delayed_items')} as delay_rate",
    ))


def product_orders(fact: DataFrame) -> DataFrame:
    """Sums of the items of one product in one order, all of one product and customer in one place.

    Sums per product and customer then need no further shuffle.
    """
    used = fact.select(
        "product_nk", "category_key", "customer_nk", "order_id", "quantity", "total_payment", "profit", "is_returned", "is_cancelled")
    placed = used.repartition("product_nk", "customer_nk")
    return placed.groupBy("product_nk", "category_key", "customer_nk", "order_id").agg(*_exprs(
        "1L as order_count", "count(*) as item_count", *_sums("quantity", "total_payment revenue", "profit"),
        "sum(if(is_returned, quantity, 0)) as returned_quantity", "count_if(is_returned) as returned_items",
        "count_if(is_cancelled) as cancelled_items",
    ))


def product_performance(
    fact: DataFrame, dim_product: DataFrame, dim_category: DataFrame, settings: SkewSettings = DEFAULT
) -> DataFrame:
    """Sales, returns, cancellations and repurchase proxy per product.

    Summed per product and customer, then per product, before the dimensions are joined. An order counts in the first of
    its rows of a product, found where the fact has all rows of an order together, so neither distinct count repeats
    rows. Rows travel once, under the product's own id (its key is the hash of it); the slices by customer spread a product that
    holds a large share of all items, and leave at most so many sums per product for the last shuffle.
    """
    product = ["product_nk", "category_key"]
    line = Window.partitionBy("order_id", *product).orderBy("customer_nk")
    opening = F.when(F.col("order_id").isNotNull(), F.row_number().over(line) == 1).otherwise(F.lit(False))
    measures = ["quantity", "revenue", "profit", "returned_quantity"]
    counts = ["order_count", "item_count", "returned_items", "cancelled_items"]
    sliced = fact.withColumn("_opening", opening).selectExpr(
        *product, "customer_nk", f"pmod(xxhash64(customer_nk), {PRODUCT_SLICES}) as _slice", "_opening", "quantity", "total_payment",
        "profit", "is_returned", "is_cancelled",
    ).repartition(*product, "_slice")
    buyers = sliced.groupBy(*product, "_slice", "customer_nk").agg(*_exprs(
        "count_if(_opening) as order_count", "count(*) as item_count", *_sums("quantity", "total_payment revenue", "profit"),
        "sum(if(is_returned, quantity, 0)) as returned_quantity", "count_if(is_returned) as returned_items",
        "count_if(is_cancelled) as cancelled_items",
    ))
    per_product = buyers.groupBy(*product).agg(*_exprs("count(customer_nk) as buying_customers", *_sums(*counts, *measures)))
    keyed = per_product.selectExpr("*", f"{surrogate_key('product_nk')} as product_key")
    return named_products(keyed, dim_product, dim_category, settings)


def named_products(
    per_product: DataFrame, dim_product: DataFrame, dim_category: DataFrame, settings: SkewSettings = DEFAULT
) -> DataFrame:
    """Sums per product with names and rates."""
    product = dim_product.select("product_key", "product_name", "sku")
    category = dim_category.select("category_key", "category_name", "subcategory_name")
    # A row per product and category: looking for heavy keys would compute the sums twice.
    named = lookup_join(
        lookup_join(per_product, product, ["product_key"], "inner", settings, unique=True), category, ["category_key"],
        "inner", settings, unique=True,
    )
    return named.selectExpr(
        "product_key", "product_name", "sku", "category_name", "subcategory_name", "order_count",
        "item_count as order_item_count", "quantity as quantity_sold", "revenue", "profit", "returned_quantity",
        f"{ratio('returned_items', 'item_count')} as return_rate",
        f"{ratio('cancelled_items', 'item_count')} as cancellation_rate", "buying_customers",
        f"{ratio('order_count', 'buying_customers')} as repurchase_proxy_rate",
    )


def voucher_recommendations(segments: DataFrame) -> DataFrame:
    """Customers, average revenue and average orders per group and strategy."""
    return segments.groupBy("customer_group", "recommended_voucher_strategy").agg(*_exprs(
        "count(*) as customer_count", f"{ratio('sum(revenue)', 'count(revenue)')} as avg_revenue",
        f"{ratio('sum(transaction_count)', 'count(transaction_count)')} as avg_transaction_count",
    ))
