"""All models over one set of raw tables, built lazily on first use."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from lumbung.operators.skew import DEFAULT, SkewSettings
from lumbung.operators.spine import date_spine, minute_spine
from lumbung.schemas import RAW_SCHEMAS

from . import dimensions as dim
from . import intermediate as mid
from . import marts
from .fact import Dimensions, fct_order_item
from .staging import Staging

# Bounds of the calendar.
CALENDAR_START, CALENDAR_END = date(2022, 1, 1), date(2040, 12, 31)


class Models(Mapping[str, DataFrame]):
    """``models[name]`` for raw.*, stg.*, int_*, dim_*, fct_order_item and mart_*.

    ``stored`` holds models that already exist as tables; they are used in place of the
    definition, which is how a run reads the layers it has written.
    """

    def __init__(
        self,
        spark: SparkSession,
        raw: Mapping[str, DataFrame],
        calendar: tuple[date, date] = (CALENDAR_START, CALENDAR_END),
        as_of: str = "current_date()",
        settings: SkewSettings = DEFAULT,
        stored: Mapping[str, DataFrame] | None = None,
    ) -> None:
        self.spark, self.raw, self.calendar, self.as_of, self.settings = spark, raw, calendar, as_of, settings
        self.stg = Staging(raw)
        self._made: dict[str, DataFrame] = dict(stored or {})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            layer, _, table = name.partition(".")
            if layer == "raw":
                self._made[name] = self.raw[table]
            elif layer == "stg":
                self._made[name] = self.stg[table]
            else:
                try:
                    build = getattr(self, f"_{name}")
                except AttributeError:
                    raise KeyError(name) from None
                self._made[name] = build()
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        yield from (f"{layer}.{t}" for layer in ("raw", "stg") for t in RAW_SCHEMAS)
        yield from ALL_MODELS

    def __len__(self) -> int:
        return 2 * len(RAW_SCHEMAS) + len(ALL_MODELS)

    # intermediate

    def _int_customer_scd2(self) -> DataFrame:
        return mid.customer_scd2(self.stg["customer_profile_events"], self.settings)

    def _int_order_fulfillment(self) -> DataFrame:
        return mid.order_fulfillment(self.stg["orders"], self.stg["shipments"])

    def _int_order_item_enriched(self) -> DataFrame:
        return mid.order_item_enriched(self.stg, self.settings)

    def _int_order_status_lifecycle(self) -> DataFrame:
        return mid.order_status_lifecycle(self.stg["order_status_events"], self.settings)

    def _int_customer_order_sequence(self) -> DataFrame:
        return mid.customer_order_sequence(self.stg["orders"], self.settings)

    # dimensions

    def _dim_category(self) -> DataFrame:
        return dim.dim_category(self.stg["categories"])

    def _dim_city(self) -> DataFrame:
        return dim.dim_city(self.stg["cities"])

    def _dim_customer(self) -> DataFrame:
        return dim.dim_customer(self["int_customer_scd2"], self["dim_city"], self.as_of, self.settings)

    def _dim_date(self) -> DataFrame:
        return dim.dim_date(date_spine(self.spark, *self.calendar))

    def _dim_time(self) -> DataFrame:
        return dim.dim_time(minute_spine(self.spark))

    def _dim_order_flags(self) -> DataFrame:
        return dim.dim_order_flags(self["int_order_item_enriched"])

    def _dim_order_status(self) -> DataFrame:
        return dim.dim_order_status(self.stg["orders"], self.stg["order_status_events"])

    def _dim_payment_method(self) -> DataFrame:
        return dim.dim_payment_method(self.stg["payment_methods"])

    def _dim_product(self) -> DataFrame:
        return dim.dim_product(self.stg["products"], self["dim_category"], self.settings)

    def _dim_shipping(self) -> DataFrame:
        return dim.dim_shipping(self.stg["shipping_services"])

    def _dim_voucher(self) -> DataFrame:
        return dim.dim_voucher(self.stg["vouchers"])

    def dimensions(self, stored_status_and_flags: bool = False) -> Dimensions:
        """Lookup dimensions of the fact; optionally with the status and flag tables."""
        return Dimensions(
            customer=self["dim_customer"], product=self["dim_product"], category=self["dim_category"],
            payment_method=self["dim_payment_method"], shipping=self["dim_shipping"], voucher=self["dim_voucher"],
            order_status=self["dim_order_status"] if stored_status_and_flags else None,
            order_flags=self["dim_order_flags"] if stored_status_and_flags else None,
        )

    # fact and marts

    def _fct_order_item(self) -> DataFrame:
        return fct_order_item(self.stg, self.dimensions(), self.settings)

    def orders_by(self, keys: Sequence[str]) -> DataFrame:
        """The order-level roll-up: the stored one, or one with just the keys asked for."""
        if "order_rollup" in self._made:
            return self._made["order_rollup"]
        return marts.order_rollup(self["fct_order_item"], keys)

    def _mart_city_performance(self) -> DataFrame:
        orders = self.orders_by(["customer_city_key", "customer_nk"])
        return marts.city_performance(orders, self["dim_city"], self.settings)

    def _mart_customer_segments(self) -> DataFrame:
        return marts.customer_segments(
            self.orders_by(["customer_nk"]), self["dim_customer"], self["dim_city"], self.settings
        )

    def _mart_hourly_orders(self) -> DataFrame:
        return marts.hourly_orders(self.orders_by(["order_time_key"]), self["dim_time"])

    def _mart_monthly_revenue(self) -> DataFrame:
        return marts.monthly_revenue(self.orders_by(["order_date_key"]), self["dim_date"], self.settings)

    def _mart_payment_method_performance(self) -> DataFrame:
        orders = self.orders_by(["payment_method_key"])
        return marts.payment_method_performance(orders, self["dim_payment_method"], self.settings)

    def _mart_product_performance(self) -> DataFrame:
        return marts.product_performance(
            self["fct_order_item"], self["dim_product"], self["dim_category"], self.settings
        )

    def _mart_shipping_performance(self) -> DataFrame:
        return marts.shipping_performance(self.orders_by(["shipping_key"]), self["dim_shipping"], self.settings)

    def _mart_voucher_recommendations(self) -> DataFrame:
        return marts.voucher_recommendations(self["mart_customer_segments"])


INTERMEDIATE = [
    "int_customer_scd2", "int_order_fulfillment", "int_order_item_enriched", "int_order_status_lifecycle",
    "int_customer_order_sequence",
]
DIMENSIONS = [
    "dim_category", "dim_city", "dim_customer", "dim_date", "dim_time", "dim_order_flags", "dim_order_status",
    "dim_payment_method", "dim_product", "dim_shipping", "dim_voucher",
]
MARTS = [
    "mart_city_performance", "mart_customer_segments", "mart_hourly_orders", "mart_monthly_revenue",
    "mart_payment_method_performance", "mart_product_performance", "mart_shipping_performance",
    "mart_voucher_recommendations",
]
ALL_MODELS = [*INTERMEDIATE, *DIMENSIONS, "fct_order_item", *MARTS]
