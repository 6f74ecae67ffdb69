"""A report with a query per model: the same rows, and no shuffle files that outlast it."""

from __future__ import annotations

import time

import small
from conftest import TESTDATA

from lumbung.catalog import QUERIES
from lumbung.plans.models import Models
from lumbung.plans.suite import DECLARED, checked_by_model, run_checks, singular_checks


def test_a_report_by_model_has_the_rows_of_one_query(spark):
    models = Models(spark, small.frames(spark, small.base_rows()), as_of="date'2024-06-01'")
    chosen = lambda m: m in ("raw.orders", "raw.order_items", "dim_city", "fct_order_item")
    single = singular_checks(models)
    whole = run_checks(models, DECLARED, single, chosen)
    assert sorted(map(tuple, checked_by_model(models, DECLARED, single, chosen, at_once=2))) == sorted(map(tuple, whole.collect()))


def test_the_report_over_stored_copies_leaves_no_shuffle_files(spark):
    def held():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return {n for n in (blocks.apply(i).toString() for i in range(blocks.size())) if n.startswith("shuffle_")}

    before = held()
    assert len(QUERIES["dq_suite"](spark, TESTDATA).collect()) == 135
    until = time.time() + 20
    while held() - before and time.time() < until:  # they are removed in the background
        time.sleep(0.2)
    assert not held() - before
