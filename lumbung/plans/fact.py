"""The order-item fact."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.functions import date_key, minute_key, surrogate_key
from lumbung.operators.asof import asof_join
from lumbung.operators.skew import DEFAULT, SkewSettings, lookup_join, skew_join
from lumbung.session import WorkFolder
from lumbung.sources.writers import latest_rows

from .dimensions import FLAGS
from .intermediate import order_context

FACT_COLUMNS = [
    "order_item_key", "order_item_id", "order_id", "order_number", "item_number",
    "order_date_key", "order_time_key", "payment_date_key",
    "customer_key", "customer_city_key", "product_key", "category_key", "payment_method_key", "shipping_key",
    "order_status_key", "voucher_key", "order_flags_key",
    "customer_nk", "product_nk", "order_ts", "sales_channel", "currency", "payment_status", "cancellation_stage",
    "quantity", "unit_price", "subtotal", "discount_amount", "shipping_subsidy", "voucher_amount",
    "total_payment", "estimated_cost", "profit", "delivery_duration_minutes",
    "is_returned", "is_cancelled", "is_delayed", "customer_order_number", "is_new_customer_order", "loaded_at",
]


#: Columns of the fact that are hashes of others; stored runs make them behind the shuffles of a write.
LATE_KEYS = {"order_item_key": surrogate_key("order_item_id"), "product_key": surrogate_key("product_nk")}

#: What ``fct_of_orders`` keeps in its work folder; of no use once its rows are written.
SLICE_INPUTS = ("resolved", "items")


@dataclass(frozen=True)
class Dimensions:
    """Dimensions the fact looks up.

    ``order_status`` and ``order_flags`` may be left out when they would be derived from the
    same rows: every non-NULL value then has its row, whose key is the hash of the value, so
    the lookup reduces to a NULL filter. Pass stored ones to drop rows they do not list.
    """

    customer: DataFrame
    product: DataFrame
    category: DataFrame
    payment_method: DataFrame
    shipping: DataFrame
    voucher: DataFrame
    order_status: DataFrame | None = None
    order_flags: DataFrame | None = None


def fct_order_item(
    stg: Mapping[str, DataFrame], dims: Dimensions, settings: SkewSettings = DEFAULT, work: WorkFolder | None = None
) -> DataFrame:
    """Build the fact: one row per order item whose dimension rows all exist.

    Everything that depends on the order alone (customer version at order time, position in
    the customer's history, payment, delivery, small lookups) is resolved at order grain;
    items then join once by order and once by product. ``work`` keeps the resolved orders, for rows that are made in parts.
    """
    orders = resolved_orders(stg, dims, settings)
    return _items_with_orders(stg["order_items"], work.keep(orders, "resolved") if work else orders, dims, settings)


def fct_order_item_since(
    stg: Mapping[str, DataFrame],
    dims: Dimensions,
    since: datetime | None,
    settings: SkewSettings = DEFAULT,
    refresh_customers: bool = False,
) -> DataFrame:
    """Fact rows of items with ``loaded_at`` later than ``since`` (None: all items)."""
    if since is None:
        return fct_order_item(stg, dims, settings)
    fresh = stg["order_items"].filter(F.col("loaded_at") > F.lit(since))
    return fct_of_items(stg, dims, fresh, settings, refresh_customers)


def fct_of_items(
    stg: Mapping[str, DataFrame],
    dims: Dimensions,
    fresh: DataFrame,
    settings: SkewSettings = DEFAULT,
    refresh_customers: bool = False,
) -> DataFrame:
    """Fact rows of the given items.

    Only the orders of those items and the order history of their customers enter the
    joins. ``refresh_customers`` returns the rows of every item of those customers, because
    a late older order renumbers the orders after it.
    """
    narrowed = _history_of(stg, fresh.select("order_id").distinct(), settings)
    items = fresh
    if refresh_customers:
        theirs = narrowed["orders"].select("order_id").distinct()
        items = lookup_join(stg["order_items"], theirs, ["order_id"], "left_semi", settings)
    return _items_with_orders(items, resolved_orders(narrowed, dims, settings), dims, settings)


def fct_of_orders(
    stg: Mapping[str, DataFrame],
    dims: Dimensions,
    touched: DataFrame,
    work: WorkFolder,
    settings: SkewSettings = DEFAULT,
    refresh_customers: bool = False,
) -> DataFrame:
    """Fact rows of all items of the touched orders (order_id, distinct), each item in its latest version.

    All rows of an order are computed together, so they agree in everything that belongs to the order.
    ``refresh_customers`` takes in all orders of the customers, whose positions a late order may shift.
    """
    narrowed = _history_of(stg, touched, settings)
    narrowed["orders"] = work.keep(narrowed["orders"], "orders")
    if refresh_customers:
        touched = narrowed["orders"].select("order_id").distinct()
    items = lookup_join(stg["order_items"], touched, ["order_id"], "left_semi", settings)
    items = work.keep(latest_rows(items, "order_item_id"), "items")
    orders = work.keep(resolved_orders(narrowed, dims, settings), "resolved")
    work.drop("orders")
    return _items_with_orders(items, orders, dims, settings)


def _history_of(stg: Mapping[str, DataFrame], touched: DataFrame, settings: SkewSettings) -> dict[str, DataFrame]:
    """The staged tables with the orders of only those customers that placed a touched order."""
    orders = stg["orders"]
    theirs = lookup_join(orders.select("order_id", "customer_id"), touched, ["order_id"], "left_semi", settings, unique=True)
    customers = theirs.select("customer_id").distinct()
    return {**stg, "orders": lookup_join(orders, customers, ["customer_id"], "left_semi", settings)}


def resolved_orders(
    stg: Mapping[str, DataFrame], dims: Dimensions, settings: SkewSettings = DEFAULT
) -> DataFrame:
    """Orders with all keys and columns the fact takes from the order."""
    placed = asof_join(
        stg["orders"], dims.customer, "customer_id", "order_ts", "customer_nk", ["customer_key", "city_key"],
        position="customer_order_number", position_order=["order_id"], settings=settings,
    )
    method = dims.payment_method.selectExpr("payment_method_nk as payment_method_id", "payment_method_key")
    service = dims.shipping.selectExpr("shipping_service_nk as shipping_service_id", "shipping_key")
    voucher = dims.voucher.selectExpr("voucher_nk as voucher_id", "voucher_key")
    keyed = lookup_join(placed, method, ["payment_method_id"], "inner", settings)
    keyed = lookup_join(keyed, service, ["shipping_service_id"], "inner", settings)
    keyed = lookup_join(keyed, voucher, ["voucher_id"], "inner", settings)
    if dims.order_status is None:
        keyed = keyed.filter("order_status is not null").selectExpr(
            "*", f"{surrogate_key('order_status')} as order_status_key"
        )
    else:
        status = dims.order_status.select("order_status", "order_status_key")
        keyed = lookup_join(keyed, status, ["order_status"], "inner", settings)
    return order_context(keyed, stg["payments"], stg["shipments"])


def _items_with_orders(
    items: DataFrame, orders: DataFrame, dims: Dimensions, settings: SkewSettings
) -> DataFrame:
    # The category's id travels with the items, not its key: a hash is several times as wide.
    category = dims.category.select("category_key", "category_nk")
    product = lookup_join(dims.product, category, ["category_key"], "inner", settings).selectExpr(
        "product_nk as product_id", "category_nk"
    )
    with_product = lookup_join(items, product, ["product_id"], "inner", settings, measure=items.select("product_id"))
    joined = skew_join(with_product, orders, ["order_id"], "inner", settings, measure=items.select("order_id"))
    return _with_flags(joined, dims.order_flags, settings).selectExpr(
        f"{surrogate_key('order_item_id')} as order_item_key",
        "order_item_id", "order_id", "order_number", "item_number",
        f"{date_key('order_ts')} as order_date_key", f"{minute_key('order_ts')} as order_time_key",
        f"{date_key('payment_ts')} as payment_date_key",
        "customer_key", "city_key as customer_city_key", f"{surrogate_key('product_id')} as product_key",
        f"{surrogate_key('category_nk')} as category_key",
        "payment_method_key", "shipping_key", "order_status_key", "voucher_key", "order_flags_key",
        "customer_id as customer_nk", "product_id as product_nk",
        "order_ts", "sales_channel", "currency", "payment_status", "cancellation_stage",
        "quantity", "unit_price", "subtotal", "discount_amount", "shipping_subsidy", "voucher_amount",
        "total_payment", "estimated_cost", "profit", "delivery_duration_minutes",
        "is_returned", "is_cancelled", "coalesce(is_delayed, false) as is_delayed",
        "customer_order_number", "customer_order_number = 1 as is_new_customer_order",
        "loaded_at",
    )


def _with_flags(rows: DataFrame, order_flags: DataFrame | None, settings: SkewSettings) -> DataFrame:
    """Add ``order_flags_key``, by hash or by lookup on the six derived conditions."""
    marks = [f"_flag_{name}" for name in FLAGS]
    flagged = rows.selectExpr("*", *[f"{text} as _flag_{name}" for name, text in FLAGS.items()])
    if order_flags is not None:
        lookup = order_flags.selectExpr("order_flags_key", *[f"{n} as _flag_{n}" for n in FLAGS])
        return lookup_join(flagged, lookup, marks, "inner", settings)
    known = " and ".join(f"{m} is not null" for m in marks)
    return flagged.filter(known).selectExpr("*", f"{surrogate_key(*marks)} as order_flags_key")
