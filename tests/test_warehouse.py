"""Stored layers: full run, incremental runs, merge, insert-if-absent, stream, control table."""

from __future__ import annotations

import shutil
from datetime import datetime

import pytest
from conftest import rows
from small import D1, D2, D3, LOAD1, LOAD2, base_rows, frames, item, order, store

from lumbung.plans.models import DIMENSIONS, MARTS
from lumbung.plans.suite import ChecksFailed
from lumbung.plans.warehouse import Warehouse
from lumbung.sources import readers, versions, writers
from lumbung.streaming.order_items import item_stream, start_merging

TABLES = [*DIMENSIONS, "fct_order_item", "order_rollup", *MARTS]


def clean_rows():
    data = base_rows()
    data["products"] = data["products"][:2]
    data["order_items"] = [t for t in data["order_items"] if t[2] != 3]
    return data


def later_rows():
    """A second load: two new orders, a flag combination not seen before, a new product, a corrected item."""
    empty = {t: [] for t in base_rows()}
    return empty | {
        "products": [(4, "SKU-BOO-00004", "Atlas", 2, 800, 500, True, D1, LOAD2)],
        "orders": [order(104, 10, D3, "returned", loaded=LOAD2), order(105, 11, D2, "delivered", loaded=LOAD2)],
        "order_items": [item(7, 104, 4, loaded=LOAD2), item(8, 105, 1, voucher=50, loaded=LOAD2)],
    }


def warehouse(spark, base, **kwargs):
    return Warehouse(spark, str(base), as_of="date'2024-06-01'", city_rows=2, minimum_items=1, **kwargs)


def contents(w):
    return {t: rows(w.stored(t)) for t in TABLES}


@pytest.fixture(scope="module")
def expected(spark, tmp_path_factory):
    """A full run over both loads at once."""
    base = tmp_path_factory.mktemp("all")
    data = clean_rows()
    raw = store(spark, {t: data[t] + later_rows()[t] for t in data}, base / "raw")
    w = warehouse(spark, base)
    w.run_full(raw(), check=False)
    return contents(w)


@pytest.fixture(scope="module")
def first_load(spark, tmp_path_factory):
    """A checked full run over the first load; tests work on copies of its folder."""
    base = tmp_path_factory.mktemp("first")
    raw = store(spark, clean_rows(), base / "raw")
    report = warehouse(spark, base).run_full(raw())
    assert report.count() == 128 + 7
    return base


@pytest.fixture
def loaded(spark, first_load, tmp_path):
    base = tmp_path / "copy"
    shutil.copytree(first_load, base)
    return base, warehouse(spark, base)


def test_full_then_incremental_equals_full(spark, loaded, expected):
    base, w = loaded
    raw = store(spark, {t: [] for t in base_rows()}, base / "raw")
    assert not w.has_new_data(raw()["orders"])
    assert w.run_incremental(raw()) is None

    raw = store(spark, later_rows(), base / "raw")
    assert w.has_new_data(raw()["orders"])
    assert w.run_incremental(raw(), refresh_customers=True).filter("n_bad > 0").count() == 0
    after = contents(w)
    for table in TABLES:
        assert after[table] == expected[table], table
    assert not w.has_new_data(raw()["orders"])


def test_stream_merges_what_arrives_once_and_twice(spark, loaded, expected):
    base, w = loaded
    raw = store(spark, later_rows(), base / "raw")

    def run(checkpoint):
        items = item_stream(spark, str(base / "raw" / "order_items"))
        start_merging(w, items, raw, str(base / checkpoint), refresh_customers=True).awaitTermination()

    run("c1")
    once = contents(w)
    for table in TABLES:
        assert once[table] == expected[table], table
    run("c1")  # nothing new
    run("c2")  # everything delivered again
    assert contents(w) == once


def test_slice_without_refresh_keeps_older_numbers(spark, loaded):
    base, w = loaded
    raw = store(spark, later_rows(), base / "raw")
    w.run_incremental(raw(), check=False, refresh_marts=False)
    numbers = {r["order_id"]: r["customer_order_number"] for r in w.stored("fct_order_item").collect()}
    assert numbers[105] == 2 and numbers[103] == 2  # 103 moved to third place in a full run


def test_late_row_with_the_newest_load_time_is_not_taken_by_the_slice(spark, loaded):
    base, w = loaded
    empty = {t: [] for t in base_rows()}
    raw = store(spark, empty | {
        "orders": [order(106, 10, D3, "paid", loaded=LOAD2)], "order_items": [item(9, 106, 1, loaded=LOAD1)],
    }, base / "raw")
    w.run_incremental(raw(), check=False, refresh_marts=False)
    assert w.stored("fct_order_item").filter("order_item_id = 9").count() == 0


def test_failed_checks_stop_the_run_before_the_stamp(spark, tmp_path):
    data = clean_rows()
    data["orders"][3] = data["orders"][3][:4] + ("lost",) + data["orders"][3][5:]
    w = warehouse(spark, tmp_path)
    with pytest.raises(ChecksFailed):
        w.run_full(store(spark, data, tmp_path / "raw")())
    assert writers.watermark(spark, w.control, "_dbt_last_run") == writers.EPOCH


def part(spark, values):
    return spark.createDataFrame(values, "id int, v string, p int")


def test_merge_replaces_adds_moves_and_repeats(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.merge_into(spark, path, part(spark, [(1, "a", 1), (2, "b", 1), (3, "c", 2), (4, "d", 3)]), ["id"], "p")
    untouched = [f for f in versions.version(spark, path).folders if f.endswith("p=3")]
    delta = [(2, "B", 1), (3, "C", 1), (5, "e", 4)]  # 3 leaves its partition empty
    for _ in range(2):
        writers.merge_into(spark, path, part(spark, delta), ["id"], "p")
        assert rows(versions.table(spark, path).select("id", "v", "p")) == [
            (1, "a", 1), (2, "B", 1), (3, "C", 1), (4, "d", 3), (5, "e", 4)]
    assert set(untouched) < set(versions.version(spark, path).folders)


def test_merge_may_read_its_own_target(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.merge_into(spark, path, part(spark, [(1, "a", 1), (2, "b", 2)]), ["id"], "p")
    shifted = versions.table(spark, path).selectExpr("id", "concat(v, v) as v", "p")
    writers.merge_into(spark, path, shifted, ["id"], "p")
    assert rows(versions.table(spark, path).select("id", "v", "p")) == [(1, "aa", 1), (2, "bb", 2)]


def test_insert_absent_keeps_the_old_row(spark, tmp_path):
    path = str(tmp_path / "d")
    writers.insert_absent(spark, part(spark, [(1, "old", 0), (1, "older", 0)]), path, "id")
    writers.insert_absent(spark, part(spark, [(1, "new", 0), (2, "two", 0)]), path, "id")
    assert rows(versions.table(spark, path)) == [(1, "old", 0), (2, "two", 0)]


def test_append_turns_nan_into_null(spark, tmp_path):
    path = str(tmp_path / "n")
    writers.append(spark.createDataFrame([(1, float("nan")), (2, 1.5), (3, None)], "id int, x double"), path)
    assert rows(spark.read.parquet(path)) == [(1, None), (2, 1.5), (3, None)]


def test_watermarks(spark, tmp_path):
    path = str(tmp_path / "w")
    assert writers.watermark(spark, path, "orders") == datetime(1970, 1, 1)
    writers.stamp(spark, path, {"orders": D1, "payments": D2})
    writers.stamp(spark, path, {"orders": D3})
    assert rows(writers.watermarks(spark, path)) == [("orders", D3), ("payments", D2)]
    w = warehouse(spark, tmp_path)
    w.stamp_tables(frames(spark, base_rows()))
    assert writers.watermarks(spark, w.control).count() == 12


def test_csv_export_and_read_back(spark, tmp_path):
    raw = frames(spark, base_rows())
    written = writers.export_csv({"cities": raw["cities"].drop("loaded_at"), "products": raw["products"].drop("loaded_at")},
                                 str(tmp_path))
    assert written == {"cities": 2, "products": 3}
    cities = readers.dimension_csv(spark, str(tmp_path / "cities"), "cities")
    assert rows(cities.drop("loaded_at")) == rows(raw["cities"].drop("loaded_at"))
    (tmp_path / "day.csv").write_text(
        "product_id,sku,product_name,category_id,standard_price,estimated_unit_cost,is_active,created_at\n"
        "1,SKU-ELE-00001,Sure Audio,2,6249795,4693915,True,2021-01-24\n")
    day = readers.dimension_csv(spark, str(tmp_path / "day.csv"), "products").first()
    assert day["created_at"] == datetime(2021, 1, 24) and day["is_active"] is True


def test_source_bounds(spark):
    raw = frames(spark, base_rows())
    assert {r["table_name"]: r["max_key"] for r in readers.max_keys(raw).collect()}["orders"] == 103
    assert readers.max_key(raw["orders"].limit(0), "order_id").first()["max_key"] == 0
    assert readers.new_data_start(raw["orders"]).first()["latest_order_ts"] == D3
    assert readers.new_data_start(raw["orders"].limit(0)).first()["latest_order_ts"] is not None
    newest = {r["customer_id"]: r["customer_profile_event_id"] for r in
              readers.latest_profiles(raw["customer_profile_events"]).collect()}
    assert newest == {10: 2, 11: 3}
