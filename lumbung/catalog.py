"""Named queries over a folder of TPC-H-like Parquet files."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.functions import completed_years, date_key, minute_key, money, surrogate_key
from lumbung.operators import quality, rules
from lumbung.operators.asof import asof_join, overlapping_versions
from lumbung.operators.key_counts import KeyCounts, Side
from lumbung.operators.ordered import OrderedSpec, ordered
from lumbung.operators.percentile import exact_percentiles
from lumbung.operators.selection import selected_percentiles
from lumbung.operators.skew import lookup_join
from lumbung.operators.spine import minute_spine, spanning_date_spine
from lumbung.plans import analytics, dimensions, kpis, marts
from lumbung.plans.fact import Dimensions, fct_order_item, fct_order_item_since
from lumbung.plans.gates import ROW_KINDS, RowGate, report_frame
from lumbung.plans.history import CustomerHistory
from lumbung.plans.models import ALL_MODELS, DIMENSIONS, MARTS, Models
from lumbung.plans.rejects import judged_items, reject_counts, rejected_items
from lumbung.plans.replay import marks, replayed, stored_raw, stored_rollup
from lumbung.plans.suite import DECLARED, checked_by_model, singular_checks
from lumbung.plans.warehouse import Warehouse
from lumbung.schemas import RAW_SCHEMAS
from lumbung.session import COMPRESSION, remove, shared_folder, short_shuffles
from lumbung.sources import ingest, readers, versions, writers
from lumbung.sources.bucketed import BucketedTable
from lumbung.sources.tpch_adapter import RetailTables

Query = Callable[[SparkSession, str], DataFrame]

# Calendar around the order dates of the files, and the day ages are counted on.
CALENDAR = (date(1995, 1, 1), date(2004, 12, 31))
AS_OF = "date'2002-02-28'"
BATCH_CUT = datetime(1999, 1, 1)

#: Queries of a report over stored copies that hold shuffle files at the same time.
CHECKS_AT_ONCE = 2

QUERIES: dict[str, Query] = {}


def models(spark: SparkSession, sf_dir: str, faulty: bool = False) -> Models:
    return Models(spark, RetailTables(spark, sf_dir, faulty), CALENDAR, AS_OF)


def _query(name: str, faulty: bool = False):
    """Register a function of the model set."""
    def add(build: Callable[[Models], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(models(spark, sf_dir, faulty))
        return build
    return add


def _table_query(name: str):
    """Register a function of a reader for the given files."""
    def add(build: Callable[[Callable[[str], DataFrame]], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(lambda t: spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet"))
        return build
    return add


# staging and models

for _table in RAW_SCHEMAS:
    _query(f"stg_{_table}")(lambda m, t=_table: m[f"stg.{t}"])

for _name in ALL_MODELS:
    if _name not in ("dim_date", "dim_time"):
        _query(_name)(lambda m, n=_name: m[n])


@_query("dim_date")
def _(m: Models) -> DataFrame:
    return dimensions.dim_date(spanning_date_spine(m.stg["orders"], "order_ts"))


@_query("dim_time")
def _(m: Models) -> DataFrame:
    """The minute dimension beside the orders placed in each minute."""
    used = m.stg["orders"].groupBy(F.expr(f"{minute_key('order_ts')} as time_key")).agg(F.count(F.lit(1)).alias("n"))
    return dimensions.dim_time(minute_spine(m.spark)).join(used, "time_key", "left").select(
        "time_key", "time_value", "hour_of_day", "minute_of_hour", "daypart", F.coalesce("n", F.lit(0)).alias("order_count")
    )


# sources

@_query("src_latest_profiles")
def _(m: Models) -> DataFrame:
    return readers.latest_profiles(m.stg["customer_profile_events"])


@_query("src_max_keys")
def _(m: Models) -> DataFrame:
    return readers.max_keys(m.stg)


@_query("src_new_data_start")
def _(m: Models) -> DataFrame:
    return readers.new_data_start(m.stg["orders"])


@_query("src_date_spine")
def _(m: Models) -> DataFrame:
    return spanning_date_spine(m.stg["shipments"], "checkout_ts")


# write modes, as the rows they store

def _stored_items(m: Models) -> DataFrame:
    """Staged items, written once: each use of the derived ones numbers all items of all orders anew."""
    path = shared_folder(m.spark, "staged-items")
    m.stg["order_items"].write.option("compression", COMPRESSION).parquet(path)
    return m.spark.read.schema(m.stg["order_items"].schema).parquet(path)


def _items_and_batch(m: Models) -> tuple[DataFrame, DataFrame]:
    """Items loaded before the cut, and a batch of the later ones and of corrections of earlier ones.

    Corrected items come twice in the batch; the later version counts.
    """
    items = _stored_items(m)
    corrected = items.filter((F.col("loaded_at") <= F.lit(BATCH_CUT)) & (F.col("product_id") % 5 == 0)).withColumn(
        "quantity", F.col("quantity") + 1
    )
    first_try = corrected.withColumns({"quantity": F.lit(-1), "loaded_at": F.expr("loaded_at - interval 1 day")})
    delta = items.filter(F.col("loaded_at") > F.lit(BATCH_CUT)).unionByName(corrected).unionByName(first_try)
    return items.filter(F.col("loaded_at") <= F.lit(BATCH_CUT)), writers.latest_rows(delta.select(items.columns), "order_item_id")


@_query("snk_keyed_merge")
def _(m: Models) -> DataFrame:
    """Stored items merged with a later batch, read back."""
    items, delta = _items_and_batch(m)

    def by_year(df: DataFrame) -> DataFrame:
        return df.withColumn("year", F.year("loaded_at"))

    path = shared_folder(m.spark, "items")
    writers.overwrite(by_year(items), path, ["year"])
    writers.merge_into(m.spark, path, by_year(delta), ["order_item_id"], "year", m.settings)
    return writers.table_or_none(m.spark, path).select(items.columns)


@_query("snk_bucketed_merge")
def _(m: Models) -> DataFrame:
    """Stored items in buckets by item id, merged with a later batch without a shuffle of what is stored."""
    items, delta = _items_and_batch(m)
    stored = BucketedTable(m.spark, shared_folder(m.spark, "bucketed-items"), "order_item_id", 16, m.settings)
    stored.replace(items)
    stored.merge(delta)
    return stored.read()


@_query("int_customer_scd2_incremental")
def _(m: Models) -> DataFrame:
    """Customer history from the profile events after the cut, then with the earlier ones as late events."""
    events = m.stg["customer_profile_events"]
    history = CustomerHistory(m.spark, shared_folder(m.spark, "history"), 16, m.settings)
    history.add(events.filter(F.col("effective_at") > F.lit(BATCH_CUT)))
    history.add(events.filter(F.col("effective_at") <= F.lit(BATCH_CUT)))
    return history.versions()


@_query("snk_append")
def _(m: Models) -> DataFrame:
    """Payments before and after the cut, appended one after the other and read back."""
    payments, path = m.stg["payments"], shared_folder(m.spark, "payments")
    for late in (F.col("loaded_at") <= F.lit(BATCH_CUT), F.col("loaded_at") > F.lit(BATCH_CUT)):
        writers.append(payments.filter(late), path)
    return m.spark.read.parquet(path)


@_query("snk_csv_round_trip")
def _(m: Models) -> DataFrame:
    """Products written as CSV and read back with their declared types, beside the reported number of rows."""
    folder = shared_folder(m.spark, "csv")
    written = writers.export_csv({"products": m.stg["products"].drop("loaded_at")}, folder)
    back = readers.dimension_csv(m.spark, f"{folder}/products", "products").drop("loaded_at")
    return back.withColumn("reported_rows", F.lit(written["products"]).cast("long"))


@_query("src_typed_raw_tables")
def _(m: Models) -> DataFrame:
    """Raw tables written and scanned again with their declared schemas: rows and columns of each."""
    base, out = shared_folder(m.spark, "raw"), None
    for name in ("cities", "products", "orders", "shipments"):
        m.raw[name].write.parquet(f"{base}/{name}")
    for name in ("cities", "products", "orders", "shipments"):
        df = readers.raw_table(m.spark, base, name)
        row = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count"))
        out = row if out is None else out.unionByName(row)
    return out


@_query("snk_insert_absent")
def _(m: Models) -> DataFrame:
    """Products not yet sold before the cut, as insert-if-absent would add them."""
    known = m.stg["order_items"].filter(F.col("loaded_at") <= F.lit(datetime(1996, 1, 1))).select("product_id")
    return writers.absent_rows(m.stg["products"], known.distinct(), "product_id")


@_table_query("snk_nan_to_null")
def _(read) -> DataFrame:
    holed = F.when(F.col("user_id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("value")
    return writers.nan_to_null(read("events").select("event_id", "user_id", holed))


@_query("snk_watermarks")
def _(m: Models) -> DataFrame:
    """High-water mark of every transaction table."""
    result = None
    for name in ("orders", "order_items", "payments", "shipments", "order_status_events", "customer_profile_events"):
        row = m.stg[name].agg(F.max("loaded_at").alias("last_loaded_at")).select(
            F.lit(name).alias("table_name"), "last_loaded_at"
        )
        result = row if result is None else result.unionByName(row)
    return result


def _loaded_orders(m: Models) -> tuple[str, str]:
    """Orders taken in by two loads: the second has rows of the first again, two rows of one id, numbers in use, and gaps."""
    good, bad = shared_folder(m.spark, "ingest"), shared_folder(m.spark, "quarantine")
    orders = m.raw["orders"]
    early = F.col("loaded_at") <= F.lit(BATCH_CUT)
    late = orders.filter(~early | (F.col("order_id") % 50 == 0))
    changed = late.withColumns({
        "currency": F.expr("case when order_id % 64 = 1 then null else currency end"),
        "customer_id": F.expr("case when order_id % 96 = 33 then null else customer_id end"),
        "loaded_at": F.expr("case when order_id % 64 = 2 then null else loaded_at end")})
    twice = late.filter("order_id % 64 = 3").withColumn("customer_id", F.expr("customer_id + 1000000"))
    copied = late.filter("order_id % 64 = 4").withColumn("order_id", F.expr("-order_id"))
    for number, rows in enumerate((orders.filter(early), changed.unionByName(twice).unionByName(copied))):
        for _ in range(2):  # the second time it is known
            ingest.load(m.spark, "orders", rows, good, bad, number, datetime(2003, 1, 1), settings=m.settings)
    return good, bad


@_query("snk_checked_load")
def _(m: Models) -> DataFrame:
    """Orders that were stored under all constraints."""
    return versions.table(m.spark, f"{_loaded_orders(m)[0]}/orders")


@_query("snk_quarantine")
def _(m: Models) -> DataFrame:
    """Orders that were held back, with every reason."""
    held = versions.table(m.spark, f"{_loaded_orders(m)[1]}/orders")
    return held.select("load", "order_id", "order_number", "customer_id", F.array_join("reasons", ",").alias("reasons"))


@_query("snk_control_ledger")
def _(m: Models) -> DataFrame:
    """Marks and last batches after the loads of two years were stamped in turn, each with its batch."""
    path = shared_folder(m.spark, "ledger")
    for number, upto in enumerate((datetime(1997, 1, 1), datetime(2100, 1, 1))):
        for name in ("orders", "payments"):
            newest = m.stg[name].filter(F.col("loaded_at") <= F.lit(upto)).agg(F.max("loaded_at")).first()[0]
            writers.stamp(m.spark, path, {name: newest}, (f"stream of {name}", number))
    rows = writers.watermarks(m.spark, path)
    batches = {t: writers.last_batch(m.spark, path, f"stream of {t}") for t in ("orders", "payments", "shipments")}
    last = F.when(F.col("table_name") == "orders", batches["orders"]).otherwise(batches["payments"])
    return rows.select("*", last.cast("long").alias("last_batch"), F.lit(batches["shipments"]).cast("long").alias("unknown_batch"))


@_query("new_data_gate")
def _(m: Models) -> DataFrame:
    """Orders loaded after the cut, the number the gate compares with zero."""
    return m.stg["orders"].filter(F.col("loaded_at") > F.lit(BATCH_CUT)).agg(F.count(F.lit(1)).alias("new_rows"))


# stored runs

def _replay(name: str, how: str):
    """Register a function of a warehouse stored by one or two runs."""
    def add(build: Callable[[Warehouse], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(replayed(spark, sf_dir, how, CALENDAR, AS_OF, BATCH_CUT))
        return build
    return add


_replay("pipe_full_fact", "full")(lambda w: w.stored("fct_order_item"))
_replay("pipe_full_snapshot", "full")(lambda w: w.stored("dim_customer"))
_replay("pipe_full_marts", "full")(lambda w: w.stored("mart_city_performance"))
_replay("pipe_incremental_fact", "merge")(lambda w: w.stored("fct_order_item"))
_replay("pipe_incremental_rollup", "merge")(stored_rollup)
_replay("pipe_incremental_marts", "merge")(lambda w: w.stored("mart_monthly_revenue"))
_replay("pipe_incremental_segments", "merge")(lambda w: w.stored("mart_customer_segments"))
_replay("pipe_stream_fact", "stream")(lambda w: w.stored("fct_order_item"))
_replay("pipe_marks", "merge")(marks)
_replay("pipe_checks", "merge")(lambda w: w.report(stored_raw(w)))
for _mart in MARTS:  # after two loads, from states that followed the changed months
    _replay(f"pipe_delta_{_mart.removeprefix('mart_')}", "merge")(lambda w, n=_mart: w.stored(n))


# tables as versions

def _item_versions(m: Models) -> str:
    """Items loaded before the cut; a run that stopped before its switch; then the later ones merged by year."""
    items, path = _stored_items(m), shared_folder(m.spark, "versions")
    early = items.filter(F.col("loaded_at") <= F.lit(BATCH_CUT)).withColumn("year", F.year("loaded_at"))
    writers.overwrite(early, path, ["year"])

    def stop(_: DataFrame) -> None:
        raise InterruptedError

    try:
        writers.overwrite(early.limit(0), path, ["year"], accept=stop)
    except InterruptedError:
        pass
    late = items.filter((F.col("loaded_at") > F.lit(BATCH_CUT)) | (F.col("order_id") % 64 == 7)).withColumn("year", F.year("loaded_at"))
    writers.merge_into(m.spark, path, late, ["order_item_id"], "year", m.settings)
    return path


@_query("snk_versioned_merge")
def _(m: Models) -> DataFrame:
    """Items per version and year, read by version number; the run that stopped left none."""
    path, out = _item_versions(m), None
    for place, number in enumerate(versions.versions(m.spark, path)):
        rows = versions.table(m.spark, path, number).groupBy("year").agg(
            F.count(F.lit(1)).alias("items"), F.sum("total_payment").alias("paid")).withColumn("place", F.lit(place + 1))
        out = rows if out is None else out.unionByName(rows)
    return out


@_query("snk_version_changes")
def _(m: Models) -> DataFrame:
    """Signed difference of two versions of a table, from the folders that changed alone."""
    path = _item_versions(m)
    went, came = versions.changes(m.spark, path, versions.versions(m.spark, path)[0])
    both = went.withColumn("sign", F.lit(-1)).unionByName(came.withColumn("sign", F.lit(1)))
    return both.groupBy("year", "order_item_id").agg(F.sum("sign").alias("rows")).filter("rows <> 0").groupBy("year").agg(
        F.sum("rows").alias("new_items"))


# fact parts

@_query("key_surrogate")
def _(m: Models) -> DataFrame:
    """Keys over one and several columns of several types, NULL included."""
    several = surrogate_key("shipment_id", "is_delayed", "delivered_ts", "tracking_number")
    return m.stg["shipments"].selectExpr(
        "shipment_id", f"{surrogate_key('shipment_id')} as one", f"{several} as several"
    )


@_query("fct_incremental_slice")
def _(m: Models) -> DataFrame:
    return fct_order_item_since(m.stg, m.dimensions(), BATCH_CUT, m.settings)


@_query("fct_incremental_customers")
def _(m: Models) -> DataFrame:
    """All fact rows of customers with items loaded in the last year."""
    return fct_order_item_since(m.stg, m.dimensions(), datetime(2001, 1, 1), m.settings, refresh_customers=True)


@_query("fct_flags_lookup")
def _(m: Models) -> DataFrame:
    """Fact built against a flag dimension that lacks delayed deliveries and a status dimension."""
    base = m.dimensions()
    known = m["dim_order_flags"].filter(~F.col("is_delayed"))
    dims = Dimensions(base.customer, base.product, base.category, base.payment_method, base.shipping, base.voucher,
                      m["dim_order_status"], known)
    fact = fct_order_item(m.stg, dims, m.settings)
    return fact.select("order_item_id", "order_flags_key", "order_status_key", "is_delayed", "is_cancelled")


@_query("fct_date_time_keys")
def _(m: Models) -> DataFrame:
    joined = m.stg["orders"].join(m.stg["payments"].select("order_id", "payment_ts"), "order_id", "left")
    return joined.selectExpr(
        "order_id", f"{date_key('order_ts')} as order_date_key", f"{minute_key('order_ts')} as order_time_key",
        f"{date_key('payment_ts')} as payment_date_key",
    )


@_table_query("fct_asof_events")
def _(read) -> DataFrame:
    """Purchases with the user's latest other event, by validity intervals."""
    events = read("events")
    states = events.filter("event_type <> 'purchase'").select("user_id", "event_id", "event_type", "ts")
    versions = ordered(states, ["user_id"], ["ts", "event_id"], OrderedSpec(nexts={"until": "ts"})).select(
        F.col("user_id").alias("version_user"), F.col("event_id").alias("version_id"),
        F.col("event_type").alias("version_type"), F.col("ts").alias("valid_from"),
        F.coalesce("until", F.expr("timestamp_ntz'9999-12-31 00:00:00'")).alias("valid_to"),
    )
    purchases = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts", "value")
    return asof_join(purchases, versions, "user_id", "ts", "version_user", ["version_id", "version_type"])


@_query("fct_dropped_rows")
def _(m: Models) -> DataFrame:
    """Items that found no customer version at order time, per order year."""
    kept = m["fct_order_item"].select("order_item_id")
    lost = m.stg["order_items"].select("order_item_id", "order_id").join(kept, "order_item_id", "left_anti")
    years = m.stg["orders"].select("order_id", F.year("order_ts").alias("order_year"))
    return lost.join(years, "order_id").groupBy("order_year").agg(F.count(F.lit(1)).alias("dropped_items"))


@_query("fct_rejects", faulty=True)
def _(m: Models) -> DataFrame:
    """Items that are not in the fact, with all reasons."""
    return rejected_items(judged_items(m.stg, m.dimensions(), m.settings))


@_query("fct_reject_counts")
def _(m: Models) -> DataFrame:
    return reject_counts(judged_items(m.stg, m.dimensions(), m.settings))


@_query("order_rollup")
def _(m: Models) -> DataFrame:
    return marts.order_rollup(m["fct_order_item"])


# analytical questions

_REPORTS: dict[str, Callable[[Models], DataFrame]] = {
    "q01_monthly_trend": lambda m: analytics.monthly_trend(m["mart_monthly_revenue"]),
    "q02_city_ranking": lambda m: analytics.city_ranking(m["mart_city_performance"]),
    "q03_top_products": lambda m: analytics.top_products_by_revenue(m["mart_product_performance"]),
    "q04_payment_frequency": lambda m: analytics.payment_frequency(m["mart_payment_method_performance"]),
    "q05_voucher_rules": lambda m: analytics.voucher_rules(m["dim_voucher"]),
    "q06_shipping_usage": lambda m: analytics.shipping_usage(m["mart_shipping_performance"]),
    "q07_shipping_cancellations": lambda m: analytics.shipping_cancellations(m["mart_shipping_performance"]),
    "q08_return_rates": lambda m: analytics.highest_return_rates(m["mart_product_performance"]),
    "q08_return_rates_busy": lambda m: analytics.highest_return_rates(m["mart_product_performance"], 30),
    "q09_promo_loss": lambda m: analytics.promo_loss(m["mart_monthly_revenue"]),
    "q10_peak_hours": lambda m: analytics.peak_hours(m["mart_hourly_orders"]),
    "q11_cancellation_stage": lambda m: analytics.cancellation_by_stage(m.orders_by(["cancellation_stage"])),
    "q12_cancellation_rates": lambda m: analytics.highest_cancellation_rates(m["mart_product_performance"]),
    "q12_cancellation_rates_busy": lambda m: analytics.highest_cancellation_rates(m["mart_product_performance"], 30),
    "q13_payment_value": lambda m: analytics.payment_value(m["mart_payment_method_performance"]),
    "q14_provider_quarter": lambda m: analytics.orders_per_provider_quarter(
        m.orders_by(["order_date_key", "shipping_key"]), m["dim_date"], m["dim_shipping"], m.settings),
    "q15_loyalty_tier": lambda m: analytics.loyalty_tier_value(m.orders_by(["customer_key"]), m["dim_customer"]),
    "q16_category_margin": lambda m: analytics.category_margin(m["mart_product_performance"]),
    "kpi_promo_loss_total": lambda m: kpis.promo_loss_total(m["mart_monthly_revenue"]),
    "kpi_customers_in_group": lambda m: kpis.customers_in_group(m["mart_customer_segments"], "Frequent Low Basket"),
    "kpi_high_revenue_low_frequency": lambda m: kpis.customers_in_group(m["mart_customer_segments"]),
    "kpi_new_vs_returning": lambda m: kpis.new_vs_returning(m.orders_by(["is_new_customer_order"])),
    "kpi_top_products_by_quantity": lambda m: analytics.top_products_by_quantity(m["mart_product_performance"]),
    "kpi_high_profit_low_sales": lambda m: kpis.high_profit_low_sales(
        m["mart_product_performance"], settings=m.settings),
    "kpi_fastest_slowest_service": lambda m: kpis.fastest_and_slowest_service(m["mart_shipping_performance"]),
    "kpi_overall_rates": lambda m: kpis.overall_rates(m.orders_by([])),
    "kpi_average_order_value": lambda m: kpis.average_order_value(
        m.orders_by(["payment_method_key"]), ["payment_method_key"]),
    "kpi_delivery_percentiles": lambda m: kpis.delivery_percentiles(
        m["fct_order_item"], m["dim_shipping"], m.settings),
}
for _name, _build in _REPORTS.items():
    _query(_name)(_build)


# data quality, on tables with planted violations

@_table_query("dq_unique")
def _(read) -> DataFrame:
    return quality.unique(read("lineitem"), "l_orderkey", "l_linenumber")


@_query("dq_unique_customer_key", faulty=True)
def _(m: Models) -> DataFrame:
    return quality.unique(m["dim_customer"], "customer_key")


@_query("dq_not_null")
def _(m: Models) -> DataFrame:
    return quality.not_null(m["fct_order_item"], "payment_date_key").select("order_item_id", "order_id")


@_query("dq_relationships")
def _(m: Models) -> DataFrame:
    return quality.relationships(m.stg["order_items"], "order_id", m.stg["payments"], "order_id")


@_query("dq_accepted_values", faulty=True)
def _(m: Models) -> DataFrame:
    return quality.accepted_values(m.stg["orders"], "order_status", dimensions.STATUS_ORDER)


@_query("dq_expression", faulty=True)
def _(m: Models) -> DataFrame:
    return quality.expression_is_true(m.stg["order_items"], "quantity > 0").select("order_item_id", "quantity")


@_query("dq_table_expression", faulty=True)
def _(m: Models) -> DataFrame:
    bad = quality.expression_is_true(m["fct_order_item"], "total_payment >= 0 and profit <= total_payment")
    return bad.select("order_item_id", "total_payment", "profit")


@_query("dq_row_count")
def _(m: Models) -> DataFrame:
    return quality.row_count_is(m["dim_city"], 34)


@_query("dq_fact_grain", faulty=True)
def _(m: Models) -> DataFrame:
    return quality.unique(m["fct_order_item"], "order_id", "item_number")


@_query("dq_minimum_rows")
def _(m: Models) -> DataFrame:
    return quality.row_count_at_least(m["fct_order_item"], 10_000_000)


@_query("dq_one_current_version")
def _(m: Models) -> DataFrame:
    """Versions still in force after a date, of which some customers have two."""
    late = m["int_customer_scd2"].withColumn("is_current", F.col("valid_to") > F.lit(datetime(1997, 6, 1)))
    return quality.one_current_version(late)


@_query("dq_amount_formula", faulty=True)
def _(m: Models) -> DataFrame:
    return quality.amount_formula(m["fct_order_item"])


@_query("dq_profit_formula", faulty=True)
def _(m: Models) -> DataFrame:
    return quality.profit_formula(m["fct_order_item"])


@_query("dq_scd2_overlap")
def _(m: Models) -> DataFrame:
    """Customer versions that intersect an earlier one: none."""
    return overlapping_versions(m["dim_customer"], "customer_nk", "customer_key")


@_query("dq_interval_overlap")
def _(m: Models) -> DataFrame:
    """Deliveries of a customer that were under way at the same time."""
    under_way = m.stg["shipments"].filter("delivered_ts is not null").select("order_id", "checkout_ts", "delivered_ts")
    owned = under_way.join(m.stg["orders"].select("order_id", "customer_id"), "order_id")
    return overlapping_versions(owned, "customer_id", "order_id", "checkout_ts", "delivered_ts")


@_query("dq_missing_measures")
def _(m: Models) -> DataFrame:
    return quality.missing_measures(
        m["fct_order_item"], [*quality.REQUIRED_MEASURES, "payment_status", "delivery_duration_minutes"]
    )


@_query("dq_missing_parents")
def _(m: Models) -> DataFrame:
    return quality.missing_parents(m.stg["order_items"], "order_id", m.stg["shipments"], "order_id")


@_query("dq_suite", faulty=True)
def _(m: Models) -> DataFrame:
    """Report of all declared and singular checks over stored copies of every table and model."""
    base = shared_folder(m.spark, "suite")
    with short_shuffles(m.spark):
        for name in RAW_SCHEMAS:
            m.raw[name].write.option("compression", COMPRESSION).parquet(f"{base}/raw/{name}")
        have: dict[str, DataFrame] = {}
        raw = readers.raw_tables(m.spark, f"{base}/raw")
        for name in ("int_customer_scd2", "int_order_item_enriched", *DIMENSIONS, "fct_order_item"):
            Models(m.spark, raw, CALENDAR, AS_OF, m.settings, have)[name].write.option("compression", COMPRESSION).parquet(f"{base}/{name}")
            have[name] = m.spark.read.parquet(f"{base}/{name}")
        stored = Models(m.spark, raw, CALENDAR, AS_OF, m.settings, have)
        found = checked_by_model(stored, DECLARED, singular_checks(stored, minimum_items=10_000_000), at_once=CHECKS_AT_ONCE)
    return report_frame(m.spark, found)


def _followed_keys(m: Models) -> tuple[KeyCounts, KeyCounts]:
    """Grain of items, and their link to payments, followed over two loads of items and a removal of payments."""
    items, payments = (shared_folder(m.spark, n) for n in ("counted-items", "counted-payments"))
    base, early = shared_folder(m.spark, "key-counts"), F.col("loaded_at") <= F.lit(BATCH_CUT)
    loads = _stored_items(m)

    def by_year(df: DataFrame) -> DataFrame:
        return df.withColumn("year", F.year("loaded_at"))

    writers.overwrite(by_year(loads.filter(early)), items, ["year"])
    writers.overwrite(by_year(m.stg["payments"]), payments, ["year"])
    grain = KeyCounts(m.spark, f"{base}/grain", Side(items, ("order_id", "item_number")), None, 16, m.settings)
    link = KeyCounts(m.spark, f"{base}/link", Side(items, ("order_id",)), Side(payments, ("order_id",)), 16, m.settings)
    for counts in (grain, link):
        counts.follow()
    writers.merge_into(m.spark, items, by_year(loads.filter(~early)), ["order_item_id"], "year", m.settings)
    removed = by_year(m.stg["payments"].filter("order_id % 10 <> 3"))
    writers.overwrite(removed, payments, ["year"])
    for counts in (grain, link):
        counts.follow()
    return grain, link


@_query("dq_unique_incremental", faulty=True)
def _(m: Models) -> DataFrame:
    """Doubled item numbers of an order, by key counts that followed two loads."""
    return _followed_keys(m)[0].repeated()


@_query("dq_relationships_incremental", faulty=True)
def _(m: Models) -> DataFrame:
    """Orders of items without a payment, after a second load of items and the removal of payments."""
    return _followed_keys(m)[1].orphans()


@_query("dq_suite_measured", faulty=True)
def _(m: Models) -> DataFrame:
    """The same report with the row checks counted while the copies are written, and no scan of their own."""
    base, reports = shared_folder(m.spark, "measured"), []

    def kept(model: str, df: DataFrame) -> DataFrame:
        gate = RowGate(model, strict=False)
        writers.overwrite(df, f"{base}/{model}", gate=gate)
        reports.extend(gate.report())
        return versions.table(m.spark, f"{base}/{model}")

    with short_shuffles(m.spark):
        raw = {name: kept(f"raw.{name}", m.raw[name]) for name in RAW_SCHEMAS}
        have: dict[str, DataFrame] = {}
        for name in ("int_customer_scd2", "int_order_item_enriched", *DIMENSIONS, "fct_order_item"):
            have[name] = kept(name, Models(m.spark, raw, CALENDAR, AS_OF, m.settings, have)[name])
        stored = Models(m.spark, raw, CALENDAR, AS_OF, m.settings, have)
        for name in ("orders", "order_items", "customer_profile_events"):  # staged rows are views elsewhere
            kept(f"stg.{name}", stored.stg[name])
            remove(m.spark, f"{base}/stg.{name}")  # counted, and read by nothing
        keyed = [c for c in DECLARED if c.kind not in ROW_KINDS]
        found = checked_by_model(stored, keyed, singular_checks(stored, minimum_items=10_000_000), at_once=CHECKS_AT_ONCE)
    return report_frame(m.spark, [*found, *reports])


# order-processing rules

def _items_with_category(m: Models) -> DataFrame:
    return rules.with_category(m.stg["order_items"], m.stg["products"], m.stg["categories"], m.settings)


def _pools(m: Models) -> DataFrame:
    return rules.promotion_pools(
        m.stg["orders"], m.stg["vouchers"], m.stg["shipments"], _items_with_category(m), m.settings
    )


@_query("rule_voucher_eligibility")
def _(m: Models) -> DataFrame:
    return rules.eligible_vouchers(_items_with_category(m))


@_query("rule_promotion_pools")
def _(m: Models) -> DataFrame:
    return _pools(m)


@_query("rule_allocation")
def _(m: Models) -> DataFrame:
    return rules.allocated_items(_items_with_category(m), _pools(m), m.settings)


@_query("rule_allocation_whole")
def _(m: Models) -> DataFrame:
    """Pools shared over the items without a rest."""
    return rules.allocated_whole(_items_with_category(m), _pools(m), m.settings)


@_query("rule_item_amounts", faulty=True)
def _(m: Models) -> DataFrame:
    """Amounts derived again from their parts, beside the stored ones."""
    stored = m.stg["order_items"].withColumnsRenamed({"total_payment": "stored_payment", "profit": "stored_profit"})
    return rules.with_item_amounts(stored).select(
        "order_item_id", "total_payment", "profit", "stored_payment", "stored_profit"
    )


@_table_query("rule_money_rounding")
def _(read) -> DataFrame:
    return read("part").selectExpr(
        "p_partkey", f"{money('p_partkey / 2d')} as half", f"{money('p_retailprice')} as price"
    )


@_query("rule_payment_amounts")
def _(m: Models) -> DataFrame:
    return rules.payment_amounts(m.stg["order_items"])


@_query("rule_stage_times")
def _(m: Models) -> DataFrame:
    return rules.stage_times(m.stg["order_status_events"])


@_query("rule_late_deliveries")
def _(m: Models) -> DataFrame:
    return rules.late_deliveries(m.stg["shipments"], m.stg["shipping_services"], m.settings)


@_query("rule_payment_status")
def _(m: Models) -> DataFrame:
    return m.stg["orders"].selectExpr("order_id", f"{rules.PAYMENT_STATUS} as payment_status")


@_query("rule_shipping_status")
def _(m: Models) -> DataFrame:
    delivered = m.stg["shipments"].select("order_id", "delivered_ts")
    return m.stg["orders"].join(delivered, "order_id", "left").selectExpr(
        "order_id", f"{rules.SHIPPING_STATUS} as shipping_status"
    )


@_query("rule_order_numbers")
def _(m: Models) -> DataFrame:
    return m.stg["orders"].selectExpr("order_id", f"{rules.order_number('order_ts', 'order_id')} as order_number")


@_query("rule_skus")
def _(m: Models) -> DataFrame:
    names = m.stg["categories"].select("category_id", "category_name")
    named = lookup_join(m.stg["products"], names, ["category_id"], "inner", m.settings)
    return named.selectExpr("product_id", f"{rules.sku('category_name', 'product_id')} as sku")


@_query("rule_continued_keys")
def _(m: Models) -> DataFrame:
    """Payments loaded after the cut, numbered on from the largest earlier id."""
    payments = m.stg["payments"].select("payment_id", "order_id", "payment_ts", "loaded_at")
    earlier = payments.filter(F.col("loaded_at") <= F.lit(BATCH_CUT))
    last = readers.max_key(earlier, "payment_id").first()["max_key"]
    batch = payments.filter(F.col("loaded_at") > F.lit(BATCH_CUT)).select("order_id", "payment_ts")
    return rules.continued_keys(batch, ["payment_ts", "order_id"], "payment_id", last, m.settings)


@_query("rule_illegal_steps", faulty=True)
def _(m: Models) -> DataFrame:
    return rules.illegal_steps(m.stg["order_status_events"], m.settings)


@_query("expr_completed_years")
def _(m: Models) -> DataFrame:
    """Customer age on the day of each order."""
    born = m.stg["customer_profile_events"].filter("operation = 'insert'").select("customer_id", "birth_date")
    aged = m.stg["orders"].select("order_id", "customer_id", "order_ts").join(born, "customer_id")
    return aged.selectExpr("order_id", f"{completed_years('birth_date', 'order_ts')} as age_years")


@_table_query("expr_percentiles")
def _(read) -> DataFrame:
    """Exact quartiles of event values per event type."""
    shares = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    return exact_percentiles(read("events"), ["event_type"], "value", shares)


@_table_query("expr_percentiles_selected")
def _(read) -> DataFrame:
    """The same quartiles by selection, without ordering the values."""
    return selected_percentiles(read("events"), ["event_type"], "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75})
