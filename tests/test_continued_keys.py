"""Keys that go on from the largest stored one."""

from __future__ import annotations

import pytest
from conftest import TINY

from lumbung.operators.rules import continued_keys
from lumbung.operators.skew import DEFAULT


@pytest.mark.parametrize("settings", [DEFAULT, TINY])
def test_numbers_follow_the_order_though_all_rows_share_an_instant(spark, settings):
    rows_ = [(None if i == 3 else 5 if i < 150 else 6, i) for i in range(160)]
    got = continued_keys(spark.createDataFrame(rows_, "at int, id long").repartition(3), ["at", "id"], "key", 1_000, settings).collect()
    order = sorted(rows_, key=lambda r: (r[0] is not None, r))
    assert [(r["at"], r["id"]) for r in sorted(got, key=lambda r: r["key"])] == order
    assert sorted(r["key"] for r in got) == list(range(1_001, 1_161))


def test_one_instant_is_dealt_over_several_pieces(spark):
    same = spark.range(100).selectExpr("1 as at", "id")
    got = continued_keys(same, ["at", "id"], "key", 0, TINY)
    pieces = spark.read.parquet(got.inputFiles()[0].rsplit("/", 1)[0]).groupBy("_piece").count().collect()
    assert len(pieces) > 3 and max(r["count"] for r in pieces) < 60


def test_an_empty_batch(spark):
    assert continued_keys(spark.createDataFrame([], "at int, id long"), ["at", "id"], "key", 7).count() == 0
