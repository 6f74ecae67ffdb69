from __future__ import annotations

from conftest import rows

from lumbung.operators import rules


def allocate(spark, subtotals, voucher, categories=None, fee=0):
    categories = categories or ["Books"] * len(subtotals)
    items = spark.createDataFrame(
        [(i, 1, i, 1, s, 0, 0, c) for i, (s, c) in enumerate(zip(subtotals, categories))],
        "order_item_id long, order_id long, product_id long, quantity int, subtotal long, discount_amount long,"
        " estimated_cost long, category_name string")
    orders = spark.createDataFrame([(1, 1)], "order_id long, voucher_id long")
    vouchers = spark.createDataFrame([(1, voucher)], "voucher_id long, voucher_code string")
    shipments = spark.createDataFrame([(1, fee)], "order_id long, shipping_fee long")
    pools = rules.promotion_pools(orders, vouchers, shipments, items)
    return sorted(rules.allocated_items(items, pools).collect(), key=lambda r: r["order_item_id"])


def test_pool_is_shared_by_subtotal_and_rounded_per_item(spark):
    got = allocate(spark, [1, 1, 1], rules.FREE_SHIPPING, fee=100)
    assert [r["shipping_subsidy"] for r in got] == [33, 33, 33]
    assert [r["profit"] for r in got] == [-32, -32, -32]


def test_cashback_pool_is_ten_percent(spark):
    got = allocate(spark, [150_000, 50_000], rules.CASHBACK)
    assert [(r["voucher_amount"], r["total_payment"]) for r in got] == [(15_000, 135_000), (5_000, 45_000)]


def test_electronics_pool_goes_to_electronics_only(spark):
    got = allocate(spark, [60_000, 240_000, 9_000], rules.ELECTRONICS_OFF, ["Electronics", "Electronics", "Books"])
    assert [r["voucher_amount"] for r in got] == [20_000, 80_000, 0]
    got = allocate(spark, [60_000, 9_000], rules.ELECTRONICS_OFF, ["Electronics", "Books"])
    assert [r["voucher_amount"] for r in got] == [60_000, 0]


def test_zero_subtotal_divides_nothing(spark):
    assert [r["voucher_amount"] for r in allocate(spark, [0, 0], rules.CASHBACK)] == [0, 0]


def test_voucher_thresholds(spark):
    items = spark.createDataFrame(
        [(1, 49_999, "Books"), (2, 50_000, "Books"), (3, 200_000, "Electronics")],
        "order_id long, subtotal long, category_name string")
    assert rows(rules.eligible_vouchers(items)) == [
        (1, "NO_DISCOUNT"), (2, "FREE_SHIPPING_MIN_50K"), (2, "NO_DISCOUNT"), (3, "CASHBACK_10_MIN_200K"),
        (3, "ELECTRONICS_100K"), (3, "FREE_SHIPPING_MIN_50K"), (3, "NO_DISCOUNT")]


def test_illegal_steps(spark):
    events = spark.createDataFrame(
        [(1, 1, "placed"), (2, 1, "paid"), (3, 1, "shipped"), (4, 1, "cancelled"), (5, 2, "delivered"), (6, 2, "returned"),
         (7, 2, "returned")], "status_event_id long, order_id long, status string"
    ).selectExpr("*", "timestamp_ntz'2024-01-01 00:00:00' as status_ts")
    assert rows(rules.illegal_steps(events).select("status_event_id", "status", "next_status")) == [
        (2, "paid", "shipped"), (6, "returned", "returned")]


def test_numbers_keep_longer_ids(spark):
    got = spark.sql(f"""select {rules.order_number("timestamp_ntz'2024-01-02 00:00:00'", "123456789")} as o,
        {rules.sku("'Books'", "7")} as s""").first()
    assert (got["o"], got["s"]) == ("ORD-20240102-123456789", "SKU-BOO-00007")
