"""The declared checks of every model and the runner that turns them into one report."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import Row

from lumbung.operators import quality
from lumbung.operators.asof import overlapping_versions
from lumbung.session import SIDE_BY_SIDE, side_by_side

from .dimensions import STATUS_ORDER


@dataclass(frozen=True)
class Check:
    """One check on one model. ``kind`` and ``arg``:

    unique, not_null (no argument), accepted_values (list), is_true (condition text put
    after the column name), relationships ((model, column)).
    """

    model: str
    column: str
    kind: str
    arg: object = None


def _declare() -> list[Check]:
    # The columns and values that are checked.
    unique = [
        ("raw.cities", "city_id"),
        ("raw.categories", "category_id"),
        ("raw.products", "product_id"),
        ("raw.payment_methods", "payment_method_id"),
        ("raw.shipping_services", "shipping_service_id"),
        ("raw.vouchers", "voucher_id"),
        ("raw.customer_profile_events", "customer_profile_event_id"),
        ("raw.orders", "order_id"),
        ("raw.order_items", "order_item_id"),
        ("raw.payments", "payment_id"),
        ("raw.shipments", "shipment_id"),
        ("raw.order_status_events", "status_event_id"),
        ("stg.order_items", "order_item_id"),
        ("stg.orders", "order_id"),
        ("stg.customer_profile_events", "customer_profile_event_id"),
        ("int_customer_scd2", "customer_key"),
        ("int_order_item_enriched", "order_item_id"),
        ("dim_customer", "customer_key"),
        ("dim_product", "product_key"),
        ("dim_product", "product_nk"),
        ("dim_category", "category_key"),
        ("dim_category", "category_nk"),
        ("dim_payment_method", "payment_method_key"),
        ("dim_payment_method", "payment_method_name"),
        ("dim_shipping", "shipping_key"),
        ("dim_shipping", "shipping_service_nk"),
        ("dim_order_status", "order_status_key"),
        ("dim_order_status", "order_status"),
        ("dim_voucher", "voucher_key"),
        ("dim_voucher", "voucher_code"),
        ("dim_city", "city_key"),
        ("dim_city", "city_nk"),
        ("dim_date", "date_key"),
        ("dim_time", "time_key"),
        ("dim_order_flags", "order_flags_key"),
        ("fct_order_item", "order_item_key"),
        ("fct_order_item", "order_item_id"),
    ]
    not_null = [
        ("raw.cities", "city_id"),
        ("raw.categories", "category_id"),
        ("raw.products", "product_id"),
        ("raw.products", "category_id"),
        ("raw.payment_methods", "payment_method_id"),
        ("raw.shipping_services", "shipping_service_id"),
        ("raw.vouchers", "voucher_id"),
        ("raw.customer_profile_events", "customer_profile_event_id"),
        ("raw.customer_profile_events", "customer_id"),
        ("raw.customer_profile_events", "city_id"),
        ("raw.orders", "order_id"),
        ("raw.order_items", "order_item_id"),
        ("raw.order_items", "order_id"),
        ("raw.payments", "payment_id"),
        ("raw.shipments", "shipment_id"),
        ("raw.order_status_events", "status_event_id"),
        ("stg.order_items", "order_item_id"),
        ("stg.order_items", "quantity"),
        ("stg.order_items", "total_payment"),
        ("stg.orders", "order_id"),
        ("stg.orders", "order_ts"),
        ("stg.customer_profile_events", "customer_profile_event_id"),
        ("stg.customer_profile_events", "effective_at"),
        ("int_customer_scd2", "customer_key"),
        ("int_customer_scd2", "customer_nk"),
        ("int_customer_scd2", "valid_from"),
        ("int_customer_scd2", "valid_to"),
        ("int_order_item_enriched", "order_item_id"),
        ("int_order_item_enriched", "total_payment"),
        ("dim_customer", "customer_key"),
        ("dim_customer", "customer_nk"),
        ("dim_customer", "city_key"),
        ("dim_customer", "valid_from"),
        ("dim_customer", "valid_to"),
        ("dim_customer", "is_current"),
        ("dim_product", "product_key"),
        ("dim_product", "product_nk"),
        ("dim_product", "category_key"),
        ("dim_category", "category_key"),
        ("dim_category", "category_nk"),
        ("dim_payment_method", "payment_method_key"),
        ("dim_payment_method", "payment_method_name"),
        ("dim_shipping", "shipping_key"),
        ("dim_shipping", "shipping_service_nk"),
        ("dim_order_status", "order_status_key"),
        ("dim_order_status", "order_status"),
        ("dim_voucher", "voucher_key"),
        ("dim_voucher", "voucher_code"),
        ("dim_city", "city_key"),
        ("dim_city", "city_nk"),
        ("dim_date", "date_key"),
        ("dim_time", "time_key"),
        ("dim_order_flags", "order_flags_key"),
        ("fct_order_item", "order_item_key"),
        ("fct_order_item", "order_item_id"),
        ("fct_order_item", "customer_key"),
        ("fct_order_item", "product_key"),
        ("fct_order_item", "category_key"),
        ("fct_order_item", "payment_method_key"),
        ("fct_order_item", "shipping_key"),
        ("fct_order_item", "voucher_key"),
        ("fct_order_item", "order_date_key"),
        ("fct_order_item", "order_time_key"),
        ("fct_order_item", "quantity"),
        ("fct_order_item", "unit_price"),
        ("fct_order_item", "subtotal"),
        ("fct_order_item", "total_payment"),
        ("fct_order_item", "estimated_cost"),
    ]
    checks = [Check(model, column, "unique") for model, column in unique]
    checks += [Check(model, column, "not_null") for model, column in not_null]
    links = [
        ("raw.products", "category_id", "raw.categories", "category_id"),
        ("raw.customer_profile_events", "city_id", "raw.cities", "city_id"),
        ("raw.order_items", "order_id", "raw.orders", "order_id"),
        ("dim_customer", "city_key", "dim_city", "city_key"),
        ("dim_product", "category_key", "dim_category", "category_key"),
        ("fct_order_item", "customer_key", "dim_customer", "customer_key"),
        ("fct_order_item", "product_key", "dim_product", "product_key"),
        ("fct_order_item", "category_key", "dim_category", "category_key"),
        ("fct_order_item", "payment_method_key", "dim_payment_method", "payment_method_key"),
        ("fct_order_item", "shipping_key", "dim_shipping", "shipping_key"),
        ("fct_order_item", "voucher_key", "dim_voucher", "voucher_key"),
        ("fct_order_item", "order_date_key", "dim_date", "date_key"),
        ("fct_order_item", "order_time_key", "dim_time", "time_key"),
    ]
    checks += [Check(m, c, "relationships", (pm, pc)) for m, c, pm, pc in links]
    checks += [
        Check("raw.customer_profile_events", "operation", "accepted_values", ["insert", "update"]),
        Check("raw.orders", "order_status", "accepted_values", STATUS_ORDER),
        Check("dim_payment_method", "payment_method_name", "accepted_values", ["E-wallet", "QRIS", "COD", "Paylater"]),
        Check("stg.order_items", "quantity", "is_true", "> 0"),
        Check("stg.order_items", "total_payment", "is_true", ">= 0"),
        Check("int_order_item_enriched", "total_payment", "is_true", ">= 0"),
        Check("fct_order_item", "quantity", "is_true", "> 0"),
        Check("fct_order_item", "subtotal", "is_true", ">= 0"),
        Check("fct_order_item", "total_payment", "is_true", ">= 0"),
        Check("fct_order_item", "estimated_cost", "is_true", ">= 0"),
    ]
    return checks


DECLARED = _declare()


def singular_checks(
    models: Mapping[str, DataFrame], city_rows: int = 34, minimum_items: int = 10_000
) -> list[tuple[str, str, DataFrame]]:
    """Checks written for one model each: (check, model, violating rows)."""
    fact, customer = models["fct_order_item"], models["dim_customer"]
    return [
        ("city_rows", "dim_city", quality.row_count_is(models["dim_city"], city_rows)),
        ("grain", "fct_order_item", quality.unique(fact, "order_id", "item_number")),
        ("minimum_rows", "fct_order_item", quality.row_count_at_least(fact, minimum_items)),
        ("one_current_version", "dim_customer", quality.one_current_version(customer)),
        ("amount_formula", "fct_order_item", quality.amount_formula(fact)),
        ("profit_formula", "fct_order_item", quality.profit_formula(fact)),
        ("versions_overlap", "dim_customer", overlapping_versions(customer, "customer_nk", "customer_key")),
    ]


def row_violations(c: Check) -> Column:
    """Whether a row breaks a row-wise check."""
    if c.kind == "not_null":
        return F.col(c.column).isNull()
    if c.kind == "accepted_values":
        return ~F.col(c.column).isin(*c.arg)
    return ~F.expr(f"{c.column} {c.arg}")


def _row_checks(df: DataFrame, model: str, checks: list[Check]) -> DataFrame:
    """All row-wise checks of a model as conditional counts in one scan."""
    conditions = [F.count(F.when(row_violations(c), 1)) for c in checks]
    entries = [
        F.struct(F.lit(c.kind).alias("check"), F.lit(model).alias("model"), F.lit(c.column).alias("column"),
                 n.alias("n_bad"))
        for c, n in zip(checks, conditions)
    ]
    return df.agg(F.array(*entries).alias("_r")).select(F.explode("_r").alias("_e")).select("_e.*")


def _count(check: str, model: str, column: str, bad: DataFrame) -> DataFrame:
    return bad.agg(F.count(F.lit(1)).alias("n_bad")).select(
        F.lit(check).alias("check"), F.lit(model).alias("model"), F.lit(column).alias("column"), "n_bad"
    )


def run_checks(
    models: Mapping[str, DataFrame],
    checks: Iterable[Check] = tuple(DECLARED),
    singular: Iterable[tuple[str, str, DataFrame]] = (),
    select: Callable[[str], bool] = lambda model: True,
) -> DataFrame:
    """Report of (check, model, column, n_bad) over the selected models.

    Row-wise checks share one scan per model; uniqueness and key checks aggregate by key.
    """
    reports = []
    by_model: dict[str, list[Check]] = defaultdict(list)
    for c in checks:
        if not select(c.model):
            continue
        if c.kind == "unique":
            reports.append(_count(c.kind, c.model, c.column, quality.unique(models[c.model], c.column)))
        elif c.kind == "relationships":
            parent, key = c.arg
            bad = quality.relationships(models[c.model], c.column, models[parent], key)
            reports.append(_count(c.kind, c.model, c.column, bad))
        else:
            by_model[c.model].append(c)
    reports += [_row_checks(models[m], m, found) for m, found in by_model.items()]
    reports += [_count(name, model, "", bad) for name, model, bad in singular if select(model)]
    return reduce(DataFrame.unionByName, reports)


def checked_by_model(
    models: Mapping[str, DataFrame],
    checks: Iterable[Check] = tuple(DECLARED),
    singular: Iterable[tuple[str, str, DataFrame]] = (),
    select: Callable[[str], bool] = lambda model: True,
    at_once: int = SIDE_BY_SIDE,
    run: Callable[..., DataFrame] = run_checks,
) -> list[Row]:
    """The rows of ``run`` (``run_checks``), with a query per model, so that the shuffle files of one can go before others start.

    Checks of the fact have nothing to share but its scan, so there each key that shuffles all its rows has a query.
    """
    checks, singular = list(checks), list(singular)
    queries = []
    for model in sorted({c.model for c in checks} | {m for _, m, _ in singular}):
        if select(model):
            own = [c for c in checks if c.model == model]
            alone = [c for c in own if c.kind == "unique"] if model == "fct_order_item" else []
            rest = [c for c in own if c not in alone]
            queries += [(model, [c], []) for c in alone]
            if rest or any(m == model for _, m, _ in singular):
                queries.append((model, rest, singular))
    found = side_by_side([
        lambda m=model, cs=own, ss=single: run(models, cs, ss, lambda name: name == m).collect() for model, own, single in queries], at_once)
    return [r for part in found for r in part]


class ChecksFailed(RuntimeError):
    """Raised when a report holds violations; ``failures`` lists them."""

    def __init__(self, failures: list) -> None:
        self.failures = failures
        super().__init__("; ".join(f"{f['check']}({f['model']}.{f['column']}): {f['n_bad']}" for f in failures))


def require_passed(report: DataFrame) -> None:
    """Stop the run when any check found violations; the report has one row per check."""
    failures = report.filter("n_bad > 0").collect()
    if failures:
        raise ChecksFailed(failures)
