"""Each check on clean rows and on rows with a planted violation."""

from __future__ import annotations

from collections import Counter

import pytest
from conftest import rows
from small import D1, base_rows, frames

from lumbung.operators import quality
from lumbung.plans.models import Models
from lumbung.plans.suite import DECLARED, ChecksFailed, require_passed, run_checks, singular_checks


def table(spark, values, ddl="a int, b string"):
    return spark.createDataFrame(values, ddl)


def test_row_checks(spark):
    clean, broken = table(spark, [(1, "x"), (2, "y")]), table(spark, [(1, "x"), (1, "z"), (None, None), (None, "x")])
    assert rows(quality.unique(clean, "a")) == []
    assert rows(quality.unique(broken, "a")) == [(1, 2)]
    assert rows(quality.unique(broken, "a", "b")) == []
    assert quality.not_null(clean, "a").count() == 0 and quality.not_null(broken, "a").count() == 2
    assert rows(quality.accepted_values(clean, "b", ["x", "y"])) == []
    assert rows(quality.accepted_values(broken, "b", ["x", "y"])) == [("z", 1)]
    assert quality.expression_is_true(broken, "a > 1").count() == 2
    assert quality.expression_is_true(clean, "a > 0").count() == 0
    assert rows(quality.row_count_is(clean, 2)) == [] and rows(quality.row_count_is(clean, 3)) == [(2,)]
    assert rows(quality.row_count_at_least(clean, 2)) == [] and rows(quality.row_count_at_least(clean, 3)) == [(2,)]
    assert quality.missing_measures(broken, ["a", "b"]).first()["bad_rows"] == 2


def test_key_checks(spark):
    child, parent = table(spark, [(1, "x"), (3, "y"), (3, "z"), (None, "n")]), table(spark, [(1, "p")])
    assert rows(quality.relationships(child, "a", parent, "a")) == [(3, 2)]
    assert quality.missing_parents(child, "a", parent, "a").first()["missing_rows"] == 3
    assert rows(quality.relationships(parent, "a", parent, "a")) == []


def test_current_version_check_does_not_see_customers_without_one(spark):
    versions = spark.createDataFrame([(1, True), (2, True), (2, True), (3, False)], "customer_nk int, is_current boolean")
    assert rows(quality.one_current_version(versions)) == [(2, 2)]


def test_declared_checks_are_complete():
    assert Counter(c.kind for c in DECLARED) == {
        "unique": 37, "not_null": 68, "relationships": 13, "accepted_values": 3, "is_true": 7}


def test_suite_finds_what_is_broken_and_nothing_else(spark):
    data = base_rows()
    data["products"] = data["products"][:2]
    data["order_items"][5] = data["order_items"][5][:2] + (2,) + data["order_items"][5][3:]
    clean = Models(spark, frames(spark, data))
    chosen = ("raw.", "stg.", "dim_city", "dim_customer", "int_customer_scd2")

    def report(models):
        return run_checks(models, DECLARED, select=lambda m: m.startswith(chosen))

    require_passed(report(clean))
    data["orders"][0] = data["orders"][0][:4] + ("lost",) + data["orders"][0][5:]
    data["order_items"][0] = data["order_items"][0][:4] + (0,) + data["order_items"][0][5:]
    data["order_items"].append(data["order_items"][1][:1] + (999,) + data["order_items"][1][2:])
    data["customer_profile_events"].append((3, *data["customer_profile_events"][2][1:]))
    with pytest.raises(ChecksFailed) as failed:
        require_passed(report(Models(spark, frames(spark, data))))
    assert {(f["check"], f["model"], f["column"], f["n_bad"]) for f in failed.value.failures} == {
        ("accepted_values", "raw.orders", "order_status", 1),
        ("is_true", "stg.order_items", "quantity", 1),
        ("unique", "raw.order_items", "order_item_id", 1),
        ("unique", "stg.order_items", "order_item_id", 1),
        ("relationships", "raw.order_items", "order_id", 1),
        ("unique", "raw.customer_profile_events", "customer_profile_event_id", 1),
        ("unique", "stg.customer_profile_events", "customer_profile_event_id", 1),
        ("unique", "int_customer_scd2", "customer_key", 1),
        ("unique", "dim_customer", "customer_key", 1),
    }


def test_singular_checks(spark):
    m = Models(spark, frames(spark, base_rows()))
    stored = Models(spark, m.raw, stored={"fct_order_item": m["fct_order_item"].cache()})
    bad = {name: df.count() for name, _, df in singular_checks(stored, city_rows=2, minimum_items=4)}
    assert set(bad.values()) == {0}
    bad = {name: df.count() for name, _, df in singular_checks(stored, city_rows=34, minimum_items=10_000)}
    assert {k for k, v in bad.items() if v} == {"city_rows", "minimum_rows"}
    assert D1 is not None
