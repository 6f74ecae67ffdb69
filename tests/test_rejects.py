"""Items outside the fact, with every reason."""

from __future__ import annotations

from datetime import datetime

import pytest
from conftest import TINY
from small import D1, D3, base_rows, frames, item, order

from lumbung.operators.skew import DEFAULT
from lumbung.plans.fact import Dimensions
from lumbung.plans.models import Models
from lumbung.plans.rejects import REASONS, judged_items, reject_counts, rejected_items


def changed(row, **values):
    names = ["order_id", "order_number", "customer_id", "order_ts", "order_status", "cancellation_stage", "payment_method_id", "voucher_id",
             "shipping_service_id"]
    return tuple(values.get(n, v) for n, v in zip(names, row, strict=False)) + row[len(names):]


@pytest.mark.parametrize("settings", [DEFAULT, TINY])
def test_every_reason_is_named_and_the_rest_is_the_fact(spark, settings):
    data = base_rows()
    data["orders"] += [
        changed(order(200, 10, D3, "paid"), payment_method_id=99), changed(order(201, 11, D1, "paid"), payment_method_id=99),
        changed(order(202, 99, datetime(2024, 3, 1), "paid"))]
    data["order_items"] += [item(20, 200, 1), item(21, 201, 3), item(22, 202, 2), item(23, 999, 1), item(24, 999, 77)]
    models = Models(spark, frames(spark, data), as_of="date'2024-02-28'", settings=settings)
    judged = judged_items(models.stg, models.dimensions(), settings)
    found = {r["order_item_id"]: r["reasons"] for r in rejected_items(judged).collect()}
    assert found == {4: "customer_version", 6: "product", 20: "payment_method", 21: "customer_version,payment_method,product",
                     22: "customer_version", 23: "order", 24: "order,product"}
    fact = {r[0] for r in models["fct_order_item"].select("order_item_id").collect()}
    assert fact == {r["order_item_id"] for r in judged.filter("reject_mask = 0").collect()} and judged.count() == 11
    counts = {r["reason"]: r["items"] for r in reject_counts(judged).collect()}
    assert list(counts) == list(REASONS) and counts["product"] == 3 and counts["customer_version"] == 3 and counts["voucher"] == 0


def test_stored_statuses_and_empty_tables(spark):
    models = Models(spark, frames(spark, base_rows()), as_of="date'2024-02-28'")
    d = models.dimensions()
    listed = models["dim_order_status"].filter("order_status <> 'cancelled'")
    dims = Dimensions(d.customer, d.product, d.category, d.payment_method, d.shipping, d.voucher, listed)
    found = {r["order_item_id"]: r["reasons"] for r in rejected_items(judged_items(models.stg, dims)).collect()}
    assert found[3] == "order_status"
    none = judged_items({t: df.limit(0) for t, df in models.raw.items()}, d)
    assert none.count() == 0 and {r["items"] for r in reject_counts(none).collect()} == {0}
