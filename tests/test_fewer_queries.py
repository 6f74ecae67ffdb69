"""Runs that take less time: independent queries side by side, small steps whole, folders listed without a job."""

from __future__ import annotations

import threading
from collections import defaultdict

import pytest
import small
from conftest import rows

from lumbung.plans.gates import RowGate
from lumbung.plans.warehouse import Warehouse
from lumbung.session import LISTED_FOLDERS, WorkFolder, parts_of, short_listings, side_by_side
from lumbung.sources import versions


def test_independent_queries_run_at_the_same_time_and_keep_their_order():
    together = threading.Barrier(2, timeout=20)
    assert side_by_side([lambda: together.wait() * 0 + 1, lambda: together.wait() * 0 + 2, lambda: 3], 2) == [1, 2, 3]
    assert side_by_side([]) == []


def test_the_first_failure_is_raised_and_what_has_not_begun_is_left_out():
    ran = []

    def fail():
        raise ValueError("first")

    with pytest.raises(ValueError, match="first"):
        side_by_side([fail, lambda: ran.append(1)], 1)
    assert ran == []


@pytest.mark.parametrize("size, whole, parts", [(0, 0, 7), (0, 10, 1), (10, 10, 1), (11, 10, 2), (10**9, 10, 7), (1 << 62, 10, 7)])
def test_a_step_has_a_query_per_whole_bytes(size, whole, parts):
    assert parts_of(size, whole, 7) == parts


def test_folders_of_a_table_are_listed_without_a_job(spark, tmp_path):
    versions.replace(spark.range(100).selectExpr("id", "id % 40 as p"), str(tmp_path / "t"), ["p"])
    name, tracker = LISTED_FOLDERS[0], spark.sparkContext.statusTracker()
    before = spark.conf.get(name, None)
    spark.sparkContext.setJobGroup("listed", "", False)
    try:
        with short_listings(spark):
            versions.table(spark, str(tmp_path / "t"))
        assert not tracker.getJobIdsForGroup("listed")
        assert spark.conf.get(name, None) == before
        versions.table(spark, str(tmp_path / "t"))
        assert tracker.getJobIdsForGroup("listed")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_small_incremental_run_makes_each_step_in_one_query(spark, tmp_path, monkeypatch):
    kept, keep, add = defaultdict(int), WorkFolder.keep, WorkFolder.add
    noted = lambda write: lambda self, df, name: (kept.update({name: kept[name] + 1}), write(self, df, name))[1]
    monkeypatch.setattr(WorkFolder, "keep", noted(keep))
    monkeypatch.setattr(WorkFolder, "add", noted(add))
    w = Warehouse(spark, str(tmp_path), as_of="date'2024-06-01'", city_rows=2, minimum_items=1, whole_bytes=1 << 20)
    raw = small.frames(spark, small.base_rows())
    w.run_full(raw, check=False)
    before = {t: rows(w.stored(t)) for t in ("fct_order_item", "order_rollup", "mart_city_performance")}
    w.apply_orders(raw, raw["orders"].select("order_id"), True, check=False)
    assert {t: rows(w.stored(t)) for t in before} == before
    assert kept["fact"] == 1


def test_a_large_fact_is_written_in_parts_with_the_same_rows(spark, tmp_path, monkeypatch):
    raw = small.frames(spark, small.base_rows())
    found, gates = [], []
    for whole in (0, 1):
        observed = RowGate.observed
        monkeypatch.setattr(RowGate, "observed", lambda self, df: (gates.append((whole, self.model)), observed(self, df))[1])  # noqa: B023
        w = Warehouse(spark, str(tmp_path / str(whole)), as_of="date'2024-06-01'", city_rows=2, minimum_items=1, whole_bytes=whole, check_models=["fct_order_item"])
        w.run_full(raw)
        found.append({t: rows(w.stored(t)) for t in ("fct_order_item", "order_rollup", "mart_monthly_revenue")})
        assert versions.version(spark, w.path("fct_order_item")).notes["row_checked"] == 1
        monkeypatch.undo()
    assert found[0] == found[1] and found[0]["fct_order_item"]
    assert [gates.count((whole, "fct_order_item")) for whole in (0, 1)] == [1, 4]
