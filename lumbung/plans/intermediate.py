"""Intermediate models between staging and the star."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from lumbung.functions import minutes_between, surrogate_key
from lumbung.operators.ordered import OrderedSpec, ordered
from lumbung.operators.skew import DEFAULT, SkewSettings, lookup_join, skew_join

#: End of validity of the version in force.
OPEN_END = "timestamp_ntz'9999-12-31 00:00:00'"


def customer_scd2(profile_events: DataFrame, settings: SkewSettings = DEFAULT) -> DataFrame:
    """Type-2 history: every profile event opens a version that ends at the next event."""
    followed = ordered(
        profile_events, ["customer_id"], ["effective_at", "customer_profile_event_id"],
        OrderedSpec(nexts={"_next": "effective_at"}), settings,
    )
    return versions_of(followed)


def versions_of(followed: DataFrame) -> DataFrame:
    """Versions from profile events that know when the next one starts (``_next``)."""
    return followed.selectExpr(
        f"{surrogate_key('customer_id', 'effective_at')} as customer_key", "customer_id as customer_nk",
        "full_name", "email", "gender", "birth_date", "city_id", "loyalty_tier", "marketing_opt_in",
        "effective_at as valid_from", f"coalesce(_next, {OPEN_END}) as valid_to", "_next is null as is_current",
    )


def order_fulfillment(orders: DataFrame, shipments: DataFrame) -> DataFrame:
    """Orders with their shipment and the minutes to hand-over and to delivery."""
    shipment = shipments.selectExpr(
        "order_id", "checkout_ts", "shipped_ts", "delivered_ts", "shipping_service_id", "shipping_fee",
        "shipping_subsidy as shipment_shipping_subsidy", "is_delayed", "shipping_status",
    )
    return orders.select("order_id", "order_ts").join(shipment, "order_id", "left").selectExpr(
        "order_id", "order_ts", "checkout_ts", "shipped_ts", "delivered_ts", "shipping_service_id",
        "shipping_fee", "shipment_shipping_subsidy", "is_delayed", "shipping_status",
        f"{minutes_between('checkout_ts', 'delivered_ts')} as delivery_duration_minutes",
        f"{minutes_between('checkout_ts', 'shipped_ts')} as checkout_to_ship_minutes",
    )


def order_context(orders: DataFrame, payments: DataFrame, shipments: DataFrame) -> DataFrame:
    """Order headers with payment and delivery columns, at order grain.

    Built before items are touched, so that the three order-level tables meet on one
    partitioning and the much larger item table is shuffled once.
    """
    paid = payments.select("order_id", "payment_status", "payment_ts")
    delivered = shipments.selectExpr(
        "order_id", "is_delayed", f"{minutes_between('checkout_ts', 'delivered_ts')} as delivery_duration_minutes"
    )
    return orders.drop("loaded_at").join(paid, "order_id", "left").join(delivered, "order_id", "left")


def order_item_enriched(stg: Mapping[str, DataFrame], settings: SkewSettings = DEFAULT) -> DataFrame:
    """Items with order, product, payment and delivery columns."""
    items = stg["order_items"]
    context = order_context(stg["orders"], stg["payments"], stg["shipments"])
    products = stg["products"].select("product_id", "category_id")
    with_product = lookup_join(items, products, ["product_id"], "inner", settings, measure=items.select("product_id"))
    joined = skew_join(with_product, context, ["order_id"], "inner", settings, measure=items.select("order_id"))
    return joined.selectExpr(
        "order_item_id", "order_id", "order_number", "customer_id", "order_ts", "order_status",
        "cancellation_stage", "payment_method_id", "shipping_service_id", "voucher_id", "sales_channel",
        "currency", "product_id", "category_id", "item_number", "quantity", "unit_price", "subtotal",
        "discount_amount", "shipping_subsidy", "voucher_amount", "total_payment", "estimated_cost", "profit",
        "delivery_duration_minutes", "is_returned", "is_cancelled", "is_delayed", "payment_status",
        "payment_ts", "loaded_at",
    )


def order_status_lifecycle(status_events: DataFrame, settings: SkewSettings = DEFAULT) -> DataFrame:
    """Status events with position, following time, and the order's cancel and return times."""
    marked = status_events.selectExpr(
        "order_id", "status_event_id", "status", "status_ts",
        "case when status = 'cancelled' then status_ts end as _cancelled",
        "case when status = 'returned' then status_ts end as _returned",
    )
    spec = OrderedSpec(
        sequence="status_sequence", nexts={"next_status_ts": "status_ts"},
        maximums={"cancelled_ts": "_cancelled", "returned_ts": "_returned"},
    )
    placed = ordered(marked, ["order_id"], ["status_ts", "status_event_id"], spec, settings)
    return placed.selectExpr(
        "order_id", "status_event_id", "status", "status_ts", "cast(status_sequence as int) as status_sequence",
        "next_status_ts", "cancelled_ts", "returned_ts",
    )


def customer_order_sequence(orders: DataFrame, settings: SkewSettings = DEFAULT) -> DataFrame:
    """Orders numbered per customer, with the time of the customer's first order."""
    spec = OrderedSpec(sequence="customer_order_number", minimums={"first_order_ts": "order_ts"})
    numbered = ordered(
        orders.select("order_id", "customer_id", "order_ts"), ["customer_id"], ["order_ts", "order_id"], spec, settings
    )
    return numbered.selectExpr(
        "order_id", "customer_id", "order_ts", "cast(customer_order_number as int) as customer_order_number",
        "first_order_ts",
    )
