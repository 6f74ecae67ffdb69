"""Analytical questions on marts, roll-up and dimensions.

NULLs sort last ascending and first descending; reports with a limit end their sort with a
key so that ties have one outcome.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung.functions import ratio
from lumbung.operators.skew import DEFAULT, SkewSettings, lookup_join


def _up(c: str) -> Column:
    return F.col(c).asc_nulls_last()


def _down(c: str) -> Column:
    return F.col(c).desc_nulls_first()


def monthly_trend(monthly: DataFrame) -> DataFrame:
    return monthly.select("month_start_date", "net_revenue", "profit", "profit_margin").orderBy(_up("month_start_date"))


def city_ranking(cities: DataFrame) -> DataFrame:
    return cities.select("city_name", "province", "transaction_count", "revenue", "profit").orderBy(_down("revenue"))


def top_products_by_revenue(products: DataFrame, n: int = 10) -> DataFrame:
    best = products.orderBy(_down("revenue"), _down("quantity_sold"), _up("product_key")).limit(n)
    return best.select("product_name", "category_name", "quantity_sold", "revenue")


def top_products_by_quantity(products: DataFrame, n: int = 10) -> DataFrame:
    best = products.orderBy(_down("quantity_sold"), _up("product_key")).limit(n)
    return best.select("product_name", "category_name", "quantity_sold", "revenue")


def payment_frequency(payments: DataFrame) -> DataFrame:
    return payments.select("payment_method_name", "transaction_count", "transaction_value").orderBy(
        _down("transaction_count")
    )


def payment_value(payments: DataFrame) -> DataFrame:
    return payments.select("payment_method_name", "transaction_value", "transaction_count", "avg_item_value").orderBy(
        _down("transaction_value")
    )


def voucher_rules(dim_voucher: DataFrame) -> DataFrame:
    return dim_voucher.orderBy(_up("voucher_nk")).select(
        "voucher_code", "voucher_name", "voucher_type", "rule_description", "min_order_amount", "discount_amount"
    )


def shipping_usage(shipping: DataFrame) -> DataFrame:
    return shipping.select("shipping_provider", "shipping_service", "order_count").orderBy(_down("order_count"))


def shipping_cancellations(shipping: DataFrame) -> DataFrame:
    return shipping.select("shipping_provider", "shipping_service", "cancelled_order_count").orderBy(
        _down("cancelled_order_count")
    )


def highest_return_rates(products: DataFrame, min_orders: int = 10, n: int = 20) -> DataFrame:
    worst = products.filter(F.col("order_count") >= min_orders).orderBy(
        _down("return_rate"), _down("returned_quantity"), _up("product_key")
    )
    return worst.limit(n).select("product_name", "category_name", "order_count", "returned_quantity", "return_rate")


def highest_cancellation_rates(products: DataFrame, min_orders: int = 10, n: int = 20) -> DataFrame:
    worst = products.filter(F.col("order_count") >= min_orders).orderBy(_down("cancellation_rate"), _up("product_key"))
    return worst.limit(n).select("product_name", "order_count", "cancellation_rate")


def promo_loss(monthly: DataFrame) -> DataFrame:
    return monthly.selectExpr(
        "month_start_date", "discount_amount", "shipping_subsidy", "voucher_amount",
        "discount_amount + shipping_subsidy + voucher_amount as total_promo_loss",
        "net_revenue", "profit", "profit_margin",
    ).orderBy(_up("month_start_date"))


def peak_hours(hourly: DataFrame) -> DataFrame:
    return hourly.select("hour_of_day", "daypart", "order_count", "revenue").orderBy(_down("order_count"))


def cancellation_by_stage(orders: DataFrame) -> DataFrame:
    """Cancelled and all orders per cancellation stage; NULL is a stage of its own."""
    return orders.groupBy("cancellation_stage").agg(
        F.expr("count_if(cancelled_items > 0) as cancelled_orders"), F.expr("count(*) as total_orders"),
        F.expr(f"{ratio('count_if(cancelled_items > 0)', 'count(*)')} as cancellation_rate"),
    ).orderBy(_down("cancelled_orders"))


def orders_per_provider_quarter(
    orders: DataFrame, dim_date: DataFrame, dim_shipping: DataFrame, settings: SkewSettings = DEFAULT
) -> DataFrame:
    quarters = dim_date.selectExpr("date_key as order_date_key", "trunc(date_day, 'quarter') as quarter_start")
    providers = dim_shipping.select("shipping_key", "shipping_provider")
    joined = lookup_join(
        lookup_join(orders, quarters, ["order_date_key"], "inner", settings), providers, ["shipping_key"], "inner", settings
    )
    return joined.groupBy("quarter_start", "shipping_provider").agg(
        F.count(F.lit(1)).alias("total_orders")
    ).orderBy(_up("quarter_start"), _up("shipping_provider"))


def loyalty_tier_value(orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Orders and value per loyalty tier held at order time.

    Totals per version are formed before the customer dimension is joined. Two versions can
    share a key when a customer changed twice at one instant; the middle step counts an
    order once per tier even then.
    """
    per_version = orders.groupBy("customer_key").agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("total_payment").alias("total_payment")
    )
    tiers = dim_customer.select("customer_key", "loyalty_tier")
    per_key = per_version.join(tiers, "customer_key").groupBy("customer_key", "loyalty_tier").agg(
        F.max("order_count").alias("order_count"), F.sum("total_payment").alias("total_payment")
    )
    return per_key.groupBy("loyalty_tier").agg(
        F.sum("order_count").alias("total_orders"), F.sum("total_payment").alias("total_value")
    ).orderBy(_down("total_orders"))


def category_margin(products: DataFrame) -> DataFrame:
    """Revenue, profit and margin in percent per category."""
    return products.groupBy("category_name").agg(
        F.sum("revenue").alias("total_revenue"), F.sum("profit").alias("total_profit"),
        F.expr(f"round({ratio('sum(profit)', 'sum(revenue)')} * 100, 2) as margin_percent"),
    ).orderBy(_down("margin_percent"))
