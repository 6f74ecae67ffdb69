"""Dashboard figures that no mart holds as a column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.functions import ratio
from lumbung.operators.selection import selected_percentiles
from lumbung.operators.skew import DEFAULT, SkewSettings, lookup_join
from lumbung.session import shared_folder


def promo_loss_total(monthly: DataFrame) -> DataFrame:
    return monthly.agg(F.expr("sum(discount_amount + shipping_subsidy + voucher_amount) as total_promo_loss"))


def customers_in_group(segments: DataFrame, group: str = "High Revenue Low Frequency") -> DataFrame:
    return segments.filter(F.col("customer_group") == group)


def new_vs_returning(orders: DataFrame) -> DataFrame:
    return orders.groupBy("is_new_customer_order").agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("total_payment").alias("revenue")
    )


def high_profit_low_sales(
    products: DataFrame, profit_share: float = 0.75, sales_share: float = 0.5, settings: SkewSettings = DEFAULT
) -> DataFrame:
    """Products at or above one profit percentile and at or below one quantity percentile.

    The products are written once: percentiles and filter read them, so that what they are summed from is computed once.
    """
    path = shared_folder(products.sparkSession, "products")
    products.select("product_key", "product_name", "category_name", "quantity_sold", "profit").write.parquet(path)
    products = products.sparkSession.read.parquet(path)
    # Both measures go through one percentile pass, one group each.
    values = products.selectExpr("stack(2, 'profit', profit, 'sales', quantity_sold) as (measure, value)")
    found = selected_percentiles(values, ["measure"], "value", {"high": profit_share, "low": sales_share}, settings)
    limits = found.agg(
        F.expr("max(high) filter (where measure = 'profit') as profit_limit"),
        F.expr("max(low) filter (where measure = 'sales') as sales_limit"),
    )
    return products.filter(
        (F.col("profit") >= limits.select("profit_limit").scalar())
        & (F.col("quantity_sold") <= limits.select("sales_limit").scalar())
    ).select("product_key", "product_name", "category_name", "quantity_sold", "profit")


def fastest_and_slowest_service(shipping: DataFrame) -> DataFrame:
    """Names of the services with the shortest and the longest single delivery."""
    service = "concat_ws(' ', shipping_provider, shipping_service)"
    fastest, slowest = "fastest_delivery_minutes", "slowest_delivery_minutes"
    # The name takes part in the comparison, so equal times have one outcome.
    return shipping.filter(f"{fastest} is not null").agg(
        F.expr(f"min_by({service}, struct({fastest}, {service})) as fastest"),
        F.expr(f"min({fastest}) as fastest_minutes"),
        F.expr(f"max_by({service}, struct({slowest}, {service})) as slowest"),
        F.expr(f"max({slowest}) as slowest_minutes"),
    )


def overall_rates(orders: DataFrame) -> DataFrame:
    return orders.agg(
        F.expr(f"{ratio('sum(returned_items)', 'sum(item_count)')} as return_rate"),
        F.expr(f"{ratio('sum(cancelled_items)', 'sum(item_count)')} as cancellation_rate"),
    )


def average_order_value(orders: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return orders.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.expr(f"{ratio('sum(total_payment)', 'count(*)')} as average_order_value"),
    )


def delivery_percentiles(fact: DataFrame, dim_shipping: DataFrame, settings: SkewSettings = DEFAULT) -> DataFrame:
    """Median and 90th percentile of delivery minutes per shipping service, over items."""
    shares = {"median_minutes": 0.5, "p90_minutes": 0.9}
    found = selected_percentiles(fact, ["shipping_key"], "delivery_duration_minutes", shares, settings)
    services = dim_shipping.select("shipping_key", "shipping_provider", "shipping_service")
    return lookup_join(found, services, ["shipping_key"], "inner", settings).select(
        "shipping_provider", "shipping_service", "value_count", "median_minutes", "p90_minutes"
    )
