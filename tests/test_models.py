from __future__ import annotations

from datetime import date, datetime

import pytest
from conftest import TESTDATA, TINY, rows
from small import D1, D2, base_rows, frames

from lumbung.catalog import CALENDAR, AS_OF
from lumbung.operators.skew import DEFAULT
from lumbung.plans.fact import FACT_COLUMNS, Dimensions, fct_order_item
from lumbung.plans.models import Models
from lumbung.sources.tpch_adapter import RetailTables

OPEN = datetime(9999, 12, 31)


@pytest.fixture(scope="module")
def small(spark):
    return Models(spark, frames(spark, base_rows()), as_of="date'2024-02-28'")


def test_scd2_versions_are_half_open(small):
    got = small["int_customer_scd2"].filter("customer_nk = 10").orderBy("valid_from").collect()
    assert [(r["valid_from"], r["valid_to"], r["is_current"]) for r in got] == [(D1, D2, False), (D2, OPEN, True)]
    assert got[0]["email"] == "ani@x.example"


def test_scd2_tie_gives_an_empty_version_and_one_key(spark):
    data = base_rows()
    first = data["customer_profile_events"][0]
    data["customer_profile_events"] = [first, (9, *first[1:])]
    got = Models(spark, frames(spark, data))["int_customer_scd2"].collect()
    assert sorted((r["valid_from"], r["valid_to"]) for r in got) == [(D1, D1), (D1, OPEN)]
    assert len({r["customer_key"] for r in got}) == 1


def test_age_on_leap_day(small):
    assert {r["customer_nk"]: r["age_years"] for r in small["dim_customer"].collect()} == {10: 23, 11: 33}


def test_asof_bounds_and_dropped_rows(small):
    fact = {r["order_item_id"]: r for r in small["fct_order_item"].collect()}
    assert sorted(fact) == [1, 2, 3, 5]
    city = {r["city_key"]: r["city_name"] for r in small["dim_city"].collect()}
    assert city[fact[1]["customer_city_key"]] == "Jakarta"
    assert city[fact[3]["customer_city_key"]] == "Bogor"
    # The dropped order still counts as the first one of its customer.
    assert fact[5]["customer_order_number"] == 2 and not fact[5]["is_new_customer_order"]
    assert fact[1]["payment_date_key"] == 20240111 and fact[3]["payment_date_key"] is None
    assert fact[1]["delivery_duration_minutes"] == 1440.025
    assert fact[3]["is_delayed"] is False and fact[5]["is_delayed"] is True
    assert small["fct_order_item"].columns == FACT_COLUMNS


def test_flags_of_missing_delivery_and_stage(small):
    flags = {tuple(r)[1:] for r in small["dim_order_flags"].collect()}
    assert (True, False, False, False, False, "placed") in flags
    assert (False, False, False, False, False, "not_cancelled") in flags


def test_computed_flag_and_status_keys_equal_the_lookup(small):
    looked_up = fct_order_item(small.stg, small.dimensions(stored_status_and_flags=True))
    assert rows(looked_up) == rows(small["fct_order_item"])


def test_stale_flag_dimension_drops_rows(small):
    d = small.dimensions()
    stale = small["dim_order_flags"].filter("not is_cancelled")
    dims = Dimensions(d.customer, d.product, d.category, d.payment_method, d.shipping, d.voucher, None, stale)
    assert 3 not in {r["order_item_id"] for r in fct_order_item(small.stg, dims).collect()}


def test_two_payments_double_the_rows(spark):
    data = base_rows()
    data["payments"].append((2, 100, datetime(2024, 1, 12), 1, "paid", 100, "P2", D2))
    m = Models(spark, frames(spark, data))
    assert m["fct_order_item"].filter("order_id = 100").count() == 4
    row = m["mart_monthly_revenue"].filter("month = 1").first()
    assert (row["order_count"], row["order_item_count"], row["net_revenue"]) == (1, 4, 3600)


def test_unknown_status_and_zero_revenue(spark):
    data = base_rows()
    data["orders"][0] = data["orders"][0][:4] + ("lost",) + data["orders"][0][5:]
    data["order_items"] = [t[:10] + (0,) + t[11:] for t in data["order_items"]]
    m = Models(spark, frames(spark, data))
    lost = m["dim_order_status"].filter("order_status = 'lost'").first()
    assert (lost["status_group"], lost["status_sort_order"]) == ("Unknown", 99)
    assert {r["profit_margin"] for r in m["mart_monthly_revenue"].collect()} == {None}


def test_calendar_and_minutes(spark, small):
    days = small["dim_date"]
    assert days.count() == 6940
    leap = days.filter("date_day = date'2024-12-30'").first()
    assert (leap["week_of_year"], leap["day_of_week"], leap["quarter"], leap["is_weekend"]) == (1, 1, 4, False)
    times = small["dim_time"]
    assert times.count() == 1440
    assert [times.filter(f"time_key = {m}").first()["daypart"] for m in (359, 360, 660, 900, 1080, 1320)] == [
        "Late Night", "Morning", "Lunch", "Afternoon", "Evening", "Night"]


@pytest.mark.parametrize("revenue, orders, group", [
    (5_000_000, 5, "VIP"), (5_000_000, 4, "High Revenue Low Frequency"), (3_000_000, 1, "High Revenue Low Frequency"),
    (999_999, 5, "Frequent Low Basket"), (999_999, 1, "New/One-time"), (2_000_000, 3, "Regular"),
])
def test_segment_rules_first_match_wins(spark, small, revenue, orders, group):
    from lumbung.plans.marts import customer_segments

    rolled = spark.range(orders).selectExpr(
        "id as order_id", "10L as customer_nk", f"if(id = 0, {revenue}L, 0L) as total_payment", "0L as profit",
        "timestamp_ntz'2024-01-01 00:00:00' as order_ts")
    got = customer_segments(rolled, small["dim_customer"], small["dim_city"]).first()
    assert got["customer_group"] == group
    assert got["city_name"] == "Bogor"


@pytest.mark.parametrize("model", [
    "int_customer_scd2", "int_order_status_lifecycle", "fct_order_item", "mart_product_performance",
])
def test_split_plans_give_the_same_models(spark, model):
    """Every key with more than 20 rows is treated as heavy; nothing is broadcast unseen."""
    def build(settings):
        return Models(spark, RetailTables(spark, TESTDATA, settings=settings), CALENDAR, AS_OF, settings)[model]

    assert rows(build(TINY)) == rows(build(DEFAULT))


def test_calendar_covers_driver_orders():
    assert CALENDAR[0] <= date(1995, 1, 1) <= CALENDAR[1]
