"""What travels in the shuffles of marts, fact and stored runs."""

from __future__ import annotations

from conftest import TINY, rows
from pyspark.sql import functions as F
from small import base_rows, frames

from lumbung.functions import surrogate_key
from lumbung.operators.skew import SkewSettings
from lumbung.plans import delta_marts, kpis, marts
from lumbung.plans.models import Models
from lumbung.session import DROP_SHUFFLES, short_shuffles
from lumbung.sources import versions, writers

SHUFFLED = SkewSettings(broadcast_bytes=0, broadcast_rows=0)
ITEMS = "order_id long, product_nk long, category_key string, customer_nk long, quantity int, total_payment long, profit long, is_returned boolean, is_cancelled boolean"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def product_frames(spark, rows):
    fact = spark.createDataFrame(rows, ITEMS).selectExpr("*", f"{surrogate_key('product_nk')} as product_key")
    product = spark.sql("select * from values (1L, 'Radio', 'S1'), (2L, 'Novel', 'S2') as t(product_nk, product_name, sku)")
    category = spark.sql("select * from values ('c', 'Books', 'Fiction') as t(category_key, category_name, subcategory_name)")
    return fact, product.selectExpr("*", f"{surrogate_key('product_nk')} as product_key"), category


def test_product_mart_counts_orders_and_customers_once_without_repeating_rows(spark):
    held = [
        (100, 1, "c", 10, 2, 900, 300, True, False), (100, 1, "c", 10, 1, 400, 100, False, True),  # twice in one order
        (100, 1, "c", 11, 1, 400, 100, False, False),  # an order held by two customers
        (101, 1, "c", None, 1, None, 50, None, False), (None, 1, "c", 12, 1, 70, 7, False, None),
        (102, 2, "c", 11, 5, 500, 5, False, False)]
    mart = marts.product_performance(*product_frames(spark, held))
    got = {r["product_name"]: r for r in mart.collect()}
    radio, novel = got["Radio"], got["Novel"]
    assert (radio["order_count"], radio["buying_customers"], radio["order_item_count"]) == (2, 3, 5)
    assert (radio["quantity_sold"], radio["revenue"], radio["profit"], radio["returned_quantity"]) == (6, 1770, 557, 2)
    assert (radio["return_rate"], radio["cancellation_rate"], radio["repurchase_proxy_rate"]) == (1 / 5, 1 / 5, 2 / 3)
    assert (novel["order_count"], novel["buying_customers"], novel["revenue"]) == (1, 1, 500)
    assert "Expand" not in plan(mart)


def test_hashed_keys_of_a_stored_table_are_made_behind_its_shuffle(spark, tmp_path):
    late = {"hashed": surrogate_key("id")}
    df = spark.sql("select id, md5('no') as hashed, cast(id % 2 as int) as part from range(6)")
    sent = writers._rebalanced(df, ["part"], late)
    text = plan(sent)
    assert text.index("md5") < text.index("REBALANCE_PARTITIONS") and "md5" not in text[text.index("REBALANCE_PARTITIONS"):]
    path = str(tmp_path / "t")
    writers.overwrite(df, path, ["part"], late=late)
    delta = spark.sql("select cast(id as long) as id, cast(0 as int) as part from values (5L), (7L) as t(id)")  # without the key
    writers.merge_into(spark, path, delta, ["id"], "part", TINY, late=late)
    want = spark.sql(f"select id, {surrogate_key('id')} as hashed, if(id > 4, 0, cast(id % 2 as int)) as part from values (0L), (1L), (2L), (3L), (4L), (5L), (7L) as t(id)")
    assert rows(versions.table(spark, path).select("id", "hashed", "part")) == rows(want)


def test_the_fact_hashes_categories_behind_its_joins(spark):
    m = Models(spark, frames(spark, base_rows()), settings=SHUFFLED)
    fact = m["fct_order_item"]
    above = fact.select("category_key")._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]  # made of joined rows
    assert "md5" in above and "category_nk" in above
    of = m["dim_product"].select("product_nk", F.col("category_key").alias("want"))
    found = fact.join(of, "product_nk").select("order_item_id", F.expr("category_key = want"))
    assert rows(found) == [(1, True), (2, True), (3, True), (5, True)]


def test_a_new_state_shuffles_its_source_once_and_holds_products_by_id(spark, tmp_path):
    rows_of = [(100, 1, "c", 10, 2, 900, 300, True, False), (100, 2, "c", 10, 1, 400, 100, False, True), (101, 1, "c", 10, 1, 5, 1, False, False)]
    source, path = str(tmp_path / "fact"), str(tmp_path / "state")
    versions.replace(product_frames(spark, rows_of)[0], source)
    state = delta_marts.STATES["product_customer"]
    delta = delta_marts.signed(state, *versions.changes(spark, source, 0))
    text = plan(delta)
    assert text.count("Exchange") == 2 and text.index("Union") < text.index("Exchange")  # one for each side, none above them
    delta_marts.update(spark, state, path, source)
    kept = versions.table(spark, path).select("product_nk", "customer_nk", "order_count", "revenue", "row_count")
    assert rows(kept) == [(1, 10, 2, 905, 2), (2, 10, 1, 400, 1)]


def test_queries_of_a_stored_run_leave_no_shuffle_files(spark):
    made = spark.range(40).repartition(4, "id")
    before = spark.conf.get(DROP_SHUFFLES)
    with short_shuffles(spark):
        assert spark.conf.get(DROP_SHUFFLES) == "true"
        assert made.groupBy("id").count().count() == 40 and made.count() == 40  # what is used again is computed again
    assert spark.conf.get(DROP_SHUFFLES) == before


def test_high_profit_products_are_summed_once(spark):
    products = spark.sql("""select concat('p', id) as product_key, 'n' as product_name, 'c' as category_name, id as quantity_sold,
        100 - id as profit from range(1, 9)""")
    found = kpis.high_profit_low_sales(products)
    assert {r["product_key"] for r in found.collect()} == {"p1", "p2", "p3"}
    assert "Range (" not in plan(found)  # read from the stored products
