"""Staging models: one raw row in, one cleaned row out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from lumbung.schemas import RAW_SCHEMAS

_LONGS = {
    "order_items": ["unit_price", "subtotal", "discount_amount", "shipping_subsidy", "voucher_amount",
                    "total_payment", "estimated_cost", "profit"],
    "payments": ["payment_amount"],
    "products": ["standard_price", "estimated_unit_cost"],
    "shipments": ["shipping_fee", "shipping_subsidy"],
    "vouchers": ["min_order_amount", "discount_amount"],
}


def staged(table: str, raw: DataFrame) -> DataFrame:
    """Named columns of a raw table, money as whole units, e-mail in lower case."""
    columns = []
    for name in RAW_SCHEMAS[table].names:
        if name in _LONGS.get(table, ()):
            columns.append(f"cast({name} as bigint) as {name}")
        elif (table, name) == ("vouchers", "cashback_rate"):
            columns.append("cast(cashback_rate as decimal(8,4)) as cashback_rate")
        elif (table, name) == ("customer_profile_events", "email"):
            columns.append("lower(email) as email")
        else:
            columns.append(name)
    return raw.selectExpr(*columns)


class Staging(Mapping):
    """Lazy staging frames over raw tables, by raw table name."""

    def __init__(self, raw: Mapping[str, DataFrame]) -> None:
        self._raw = raw
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._made:
            self._made[table] = staged(table, self._raw[table])
        return self._made[table]

    def __iter__(self):
        return iter(RAW_SCHEMAS)

    def __len__(self) -> int:
        return len(RAW_SCHEMAS)
