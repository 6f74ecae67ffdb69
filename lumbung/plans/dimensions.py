"""Dimension models."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lumbung.functions import completed_years, date_key, padded_name, surrogate_key
from lumbung.operators.skew import DEFAULT, SkewSettings, lookup_join

# Order life cycle.
STATUS_ORDER = ["placed", "paid", "packed", "shipped", "delivered", "cancelled", "returned"]
STATUS_GROUPS = {
    "Open": ["placed", "paid", "packed", "shipped"],
    "Completed": ["delivered"],
    "Exception": ["cancelled", "returned"],
}
#: Daypart -> last hour it covers, in order of the day.
DAYPARTS = {"Late Night": 5, "Morning": 10, "Lunch": 14, "Afternoon": 17, "Evening": 21, "Night": 23}

#: Junk-dimension attribute -> its value for an item row.
FLAGS = {
    "is_cancelled": "is_cancelled",
    "is_returned": "is_returned",
    "has_voucher": "voucher_amount > 0",
    "has_shipping_subsidy": "shipping_subsidy > 0",
    "is_delayed": "coalesce(is_delayed, false)",
    "cancellation_stage": "coalesce(cancellation_stage, 'not_cancelled')",
}


def _case(arms: list[tuple[str, str]], default: str) -> str:
    """First matching arm of (condition, value)."""
    return "case " + " ".join(f"when {condition} then {value}" for condition, value in arms) + f" else {default} end"


def dim_category(categories: DataFrame) -> DataFrame:
    return categories.selectExpr(
        f"{surrogate_key('category_id')} as category_key", "category_id as category_nk", "category_name",
        "subcategory_name", "department",
    )


def dim_city(cities: DataFrame) -> DataFrame:
    return cities.selectExpr(
        f"{surrogate_key('city_id')} as city_key", "city_id as city_nk", "city_name", "province", "region", "country"
    )


def dim_customer(
    scd2: DataFrame, cities: DataFrame, as_of: str = "current_date()", settings: SkewSettings = DEFAULT
) -> DataFrame:
    """Customer versions with their city key and age on the day ``as_of``, an SQL date."""
    city = cities.selectExpr("city_nk as city_id", "city_key")
    return lookup_join(scd2, city, ["city_id"], "inner", settings).selectExpr(
        "customer_key", "customer_nk", "city_key", "full_name", "email", "gender", "birth_date",
        f"{completed_years('birth_date', as_of)} as age_years", "loyalty_tier", "marketing_opt_in",
        "valid_from", "valid_to", "is_current",
    )


def dim_date(spine: DataFrame) -> DataFrame:
    """Calendar attributes of a spine with one ``date_day`` per row."""
    return spine.selectExpr(
        f"{date_key('date_day')} as date_key", "date_day", "year(date_day) as year", "quarter(date_day) as quarter",
        "month(date_day) as month", f"{padded_name('date_day', 'MMMM')} as month_name",
        "dayofmonth(date_day) as day_of_month", "weekday(date_day) + 1 as day_of_week",
        f"{padded_name('date_day', 'EEEE')} as day_name", "weekofyear(date_day) as week_of_year",
        "weekday(date_day) + 1 in (6, 7) as is_weekend",
    )


def dim_time(spine: DataFrame) -> DataFrame:
    """Minute attributes of a spine with one ``minute_of_day`` per row."""
    hour, minute = "cast(minute_of_day div 60 as int)", "cast(minute_of_day % 60 as int)"
    *first, last = DAYPARTS
    daypart = _case([(f"{hour} <= {DAYPARTS[name]}", f"'{name}'") for name in first], f"'{last}'")
    return spine.selectExpr(
        "minute_of_day as time_key", f"format_string('%02d:%02d:00', {hour}, {minute}) as time_value",
        f"{hour} as hour_of_day", f"{minute} as minute_of_hour", f"{daypart} as daypart",
    )


def dim_order_flags(enriched: DataFrame) -> DataFrame:
    """Junk dimension: the flag combinations that occur, keyed by their hash."""
    seen = enriched.selectExpr(*[f"{text} as {name}" for name, text in FLAGS.items()]).distinct()
    return seen.selectExpr(f"{surrogate_key(*FLAGS)} as order_flags_key", *FLAGS)


def dim_order_status(orders: DataFrame, status_events: DataFrame) -> DataFrame:
    """Statuses seen on orders or in events, with group and sort position."""
    # Each side is reduced to its few values before the union.
    seen = orders.select("order_status").distinct().union(status_events.select("status").distinct()).distinct()
    groups = [(f"order_status in ({str(members)[1:-1]})", f"'{name}'") for name, members in STATUS_GROUPS.items()]
    places = [(f"order_status = '{name}'", str(i)) for i, name in enumerate(STATUS_ORDER, start=1)]
    return seen.selectExpr(
        f"{surrogate_key('order_status')} as order_status_key", "order_status",
        _case(groups, "'Unknown'") + " as status_group", _case(places, "99") + " as status_sort_order",
    )


def dim_payment_method(payment_methods: DataFrame) -> DataFrame:
    return payment_methods.selectExpr(
        f"{surrogate_key('payment_method_id')} as payment_method_key", "payment_method_id as payment_method_nk",
        "payment_method_name", "payment_group",
        "case when payment_method_name = 'COD' then false else true end as supports_instant_voucher",
    )


def dim_product(products: DataFrame, categories: DataFrame, settings: SkewSettings = DEFAULT) -> DataFrame:
    """Products of known categories; ``categories`` is the category dimension."""
    category = categories.selectExpr("category_nk as category_id", "category_key")
    return lookup_join(products, category, ["category_id"], "inner", settings).selectExpr(
        f"{surrogate_key('product_id')} as product_key", "product_id as product_nk", "category_key", "sku",
        "product_name", "standard_price", "estimated_unit_cost", "is_active", "created_at",
    )


def dim_shipping(shipping_services: DataFrame) -> DataFrame:
    return shipping_services.selectExpr(
        f"{surrogate_key('shipping_service_id')} as shipping_key", "shipping_service_id as shipping_service_nk",
        "shipping_provider", "shipping_service", "service_level", "min_delivery_days", "max_delivery_days",
    )


def dim_voucher(vouchers: DataFrame) -> DataFrame:
    return vouchers.selectExpr(
        f"{surrogate_key('voucher_id')} as voucher_key", "voucher_id as voucher_nk", "voucher_code", "voucher_name",
        "voucher_type", "rule_description", "min_order_amount", "discount_amount", "cashback_rate",
        "voucher_code <> 'NO_DISCOUNT' as is_voucher",
    )
