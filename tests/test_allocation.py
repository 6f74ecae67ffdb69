"""Pools shared over items without a rest."""

from __future__ import annotations

import pytest
from conftest import TINY, rows

from lumbung.operators import rules
from lumbung.operators.skew import DEFAULT

ITEMS = "order_item_id long, order_id long, product_id long, quantity int, subtotal long, discount_amount long, estimated_cost long, category_name string"
POOLS = "order_id long, cashback_pool long, electronics_pool long, shipping_pool long"


def largest_remainders(pool, weights):
    if not sum(weights):
        weights = [1] * len(weights)
    total = sum(weights)
    out = [pool * w // total for w in weights]
    for i in sorted(range(len(weights)), key=lambda i: (-(pool * weights[i] % total), i))[:pool - sum(out)]:
        out[i] += 1
    return out


@pytest.mark.parametrize("settings", [DEFAULT, TINY])
def test_item_amounts_add_up_to_every_pool(spark, settings):
    orders = {1: ([333, 333, 334], "BBB", (100, 0, 7)), 2: ([10, 20, 30], "EBE", (0, 11, 0)), 3: ([0, 0], "BB", (0, 0, 5)),
              4: ([(7 * i) % 50 + 1 for i in range(90)], "B" * 90, (1_001, 0, 13)), 5: ([5], "E", (0, 0, 0)),
              6: ([4 * 10**17, 4 * 10**17, 10**17], "BBB", (10**17, 0, 1))}
    items, pools, want = [], [], []
    for o, (worth, kinds, (cash, electronic, fee)) in orders.items():
        ids = [1_000 * o + i for i in range(len(worth))]
        items += [(i, o, 1, 1, w, 0, 0, "Electronics" if k == "E" else None) for i, w, k in zip(ids, worth, kinds, strict=True)]
        pools.append((o, cash, electronic, fee))
        voucher = largest_remainders(cash + electronic, [w if k == "E" or not electronic else 0 for w, k in zip(worth, kinds, strict=True)])
        want += list(zip(ids, voucher, largest_remainders(fee, worth), strict=True))
    got = rules.allocated_whole(spark.createDataFrame(items, ITEMS), spark.createDataFrame(pools, POOLS), settings)
    assert rows(got.select("order_item_id", "voucher_amount", "shipping_subsidy")) == sorted(want, key=repr)
    sums = {r["order_id"]: (r[1], r[2]) for r in got.groupBy("order_id").sum("voucher_amount", "shipping_subsidy").collect()}
    assert sums == {o: (c + e, s) for o, c, e, s in pools}


def test_no_items(spark):
    assert rules.allocated_whole(spark.createDataFrame([], ITEMS), spark.createDataFrame([(1, 5, 0, 5)], POOLS)).count() == 0


def test_items_and_pools_are_computed_once(spark):
    items = spark.createDataFrame([(1, 7, 1, 1, 100, 0, 0, "Electronics")], ITEMS)
    got = rules.allocated_whole(items, spark.createDataFrame([(7, 5, 0, 3)], POOLS))
    assert got._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 2
    assert rows(got.select("voucher_amount", "shipping_subsidy")) == [(5, 3)]
