"""Explicit schemas of the raw operational tables and of the control table.

Spark does not enforce primary keys; ``PRIMARY_KEYS`` feeds the uniqueness checks
and the keyed writers instead.
"""

from __future__ import annotations

import re

from pyspark.sql import types as T

_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal(8,4)": T.DecimalType(8, 4),
}

# Column layout of the source system.
_COLUMNS = {
    "cities": """
        city_id bigint not null, city_name string not null, province string not null, region string not null,
        country string not null
    """,
    "categories": """
        category_id bigint not null, category_name string not null, subcategory_name string not null,
        department string not null
    """,
    "products": """
        product_id bigint not null, sku string not null, product_name string not null, category_id bigint not null,
        standard_price bigint not null, estimated_unit_cost bigint not null, is_active boolean not null,
        created_at timestamp_ntz not null
    """,
    "payment_methods": """
        payment_method_id bigint not null, payment_method_name string not null, payment_group string not null
    """,
    "shipping_services": """
        shipping_service_id bigint not null, shipping_provider string not null, shipping_service string not null,
        service_level string not null, min_delivery_days int not null, max_delivery_days int not null
    """,
    "vouchers": """
        voucher_id bigint not null, voucher_code string not null, voucher_name string not null,
        voucher_type string not null,
        rule_description string not null, min_order_amount bigint not null, discount_amount bigint not null,
        cashback_rate decimal(8,4) not null
    """,
    "customer_profile_events": """
        customer_profile_event_id bigint not null, customer_id bigint not null, full_name string not null,
        email string not null,
        gender string not null, birth_date date not null, city_id bigint not null, loyalty_tier string not null,
        marketing_opt_in boolean not null, effective_at timestamp_ntz not null, operation string not null
    """,
    "orders": """
        order_id bigint not null, order_number string not null, customer_id bigint not null,
        order_ts timestamp_ntz not null,
        order_status string not null, cancellation_stage string, payment_method_id bigint not null,
        shipping_service_id bigint not null, voucher_id bigint not null, sales_channel string not null,
        currency string not null
    """,
    "order_items": """
        order_item_id bigint not null, order_id bigint not null, product_id bigint not null,
        item_number int not null, quantity int not null,
        unit_price bigint not null, subtotal bigint not null, discount_amount bigint not null,
        shipping_subsidy bigint not null,
        voucher_amount bigint not null, total_payment bigint not null, estimated_cost bigint not null,
        profit bigint not null,
        is_returned boolean not null, is_cancelled boolean not null
    """,
    "payments": """
        payment_id bigint not null, order_id bigint not null, payment_ts timestamp_ntz not null,
        payment_method_id bigint not null,
        payment_status string not null, payment_amount bigint not null, transaction_reference string not null
    """,
    "shipments": """
        shipment_id bigint not null, order_id bigint not null, shipping_service_id bigint not null,
        checkout_ts timestamp_ntz not null,
        shipped_ts timestamp_ntz, delivered_ts timestamp_ntz, shipping_fee bigint not null,
        shipping_subsidy bigint not null,
        is_delayed boolean not null, shipping_status string not null, tracking_number string
    """,
    "order_status_events": """
        status_event_id bigint not null, order_id bigint not null, status string not null,
        status_ts timestamp_ntz not null
    """,
}

PRIMARY_KEYS = {
    "cities": "city_id",
    "categories": "category_id",
    "products": "product_id",
    "payment_methods": "payment_method_id",
    "shipping_services": "shipping_service_id",
    "vouchers": "voucher_id",
    "customer_profile_events": "customer_profile_event_id",
    "orders": "order_id",
    "order_items": "order_item_id",
    "payments": "payment_id",
    "shipments": "shipment_id",
    "order_status_events": "status_event_id",
}

#: Tables loaded with "keep the row that is there"; all others are append-only.
DIMENSION_TABLES = (
    "cities", "categories", "products", "payment_methods", "shipping_services", "vouchers",
)


def _schema(columns: str, *extra: T.StructField) -> T.StructType:
    fields = []
    for column in re.split(r",\s+", columns):
        name, kind, *required = column.split()
        fields.append(T.StructField(name, _TYPES[kind], not required))
    return T.StructType([*fields, *extra])


RAW_SCHEMAS: dict[str, T.StructType] = {
    name: _schema(columns, T.StructField("loaded_at", T.TimestampNTZType())) for name, columns in _COLUMNS.items()
}

WATERMARK_SCHEMA = _schema("table_name string not null, last_loaded_at timestamp_ntz not null")
