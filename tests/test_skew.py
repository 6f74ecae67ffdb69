"""Heavy keys: the split plans must give exactly the rows of the plain ones."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from conftest import TINY, rows
from pyspark.sql import functions as F

from lumbung.operators.asof import asof_join, overlapping_versions
from lumbung.operators.ordered import OrderedSpec, ordered
from lumbung.operators.percentile import exact_percentiles
from lumbung.operators.rules import continued_keys
from lumbung.operators.skew import SkewSettings, hot_keys, lookup_join, skew_join, split_rows

T0 = datetime(2024, 1, 1)
PLAIN = SkewSettings(check_bytes=1 << 62)


@pytest.fixture(scope="module")
def events(spark):
    """300 rows; one key holds two thirds of them, half of these at one instant."""
    rng = random.Random(7)
    data = []
    for i in range(300):
        k = 1 if i % 3 else rng.randint(2, 30)
        at = T0 if k == 1 and i % 2 else T0 + timedelta(minutes=rng.randint(0, 500))
        data.append((i, k, at, rng.randint(0, 9) if rng.random() < 0.8 else None))
    return spark.createDataFrame(data, "id long, k long, at timestamp_ntz, v long")


SPEC = OrderedSpec(
    sequence="n", nexts={"next_at": "at", "next_v": "v"}, lasts={"last_v": "v"}, sums={"sum_v": "v"},
    peaks={"peak_v": "v"}, minimums={"min_at": "at"}, maximums={"max_v": "v"},
)


def test_hot_keys_are_bounded_and_exact(events):
    found = hot_keys(events, ["k"], TINY)
    assert [(r["k"], r["_rows"]) for r in found] == [(1, 200)]
    assert hot_keys(events, ["k"], PLAIN) == []


def test_split_keeps_every_row_and_cuts_the_heavy_key(events):
    cold, hot = split_rows(events, ["k"], ["at", "id"], TINY)
    assert cold.count() + hot.count() == 300
    assert hot.select("_chunk").distinct().count() > 3
    assert hot.groupBy("_chunk").count().agg(F.max("count")).first()[0] < 100


def test_ordered_with_heavy_key_equals_plain_window(events):
    plain = ordered(events, ["k"], ["at", "id"], SPEC, PLAIN)
    split = ordered(events, ["k"], ["at", "id"], SPEC, TINY)
    assert split.columns == plain.columns
    assert rows(split) == rows(plain)


def test_identical_rows_of_a_heavy_key_are_cut_too(spark):
    copies = spark.createDataFrame([(1, 5)] * 90, "k int, v int")
    numbered = ordered(copies, ["k"], ["v"], OrderedSpec(sequence="n"), TINY)
    assert sorted(r["n"] for r in numbered.collect()) == list(range(1, 91))
    _, hot = split_rows(copies, ["k"], ["v"], TINY)
    assert hot.groupBy("_chunk").count().agg(F.max("count")).first()[0] < 60


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_join(spark, events, how):
    right = spark.createDataFrame([(k, f"name{k}") for k in (1, 2, 3, 4, 40)] + [(1, "second")], "k long, name string")
    expected = events.join(right, ["k"], how)
    assert rows(skew_join(events, right, ["k"], how, TINY).select(expected.columns)) == rows(expected)
    assert rows(lookup_join(events, right, ["k"], how, TINY).select(expected.columns)) == rows(expected)


def test_skew_join_spreads_null_keys_of_a_left_join(spark):
    left = spark.createDataFrame([(i, None if i < 50 else 1) for i in range(60)], "id long, k long")
    right = spark.createDataFrame([(1, "a")], "k long, name string")
    assert rows(skew_join(left, right, ["k"], "left", TINY).select("id", "name")) == rows(
        left.join(right, ["k"], "left").select("id", "name"))


@pytest.mark.parametrize("settings", [PLAIN, TINY])
def test_asof_join_with_heavy_key(spark, events, settings):
    versions = ordered(
        events.filter("id % 4 = 0").selectExpr("k as vk", "id as vid", "at as valid_from"), ["vk"],
        ["valid_from", "vid"], OrderedSpec(nexts={"_n": "valid_from"}), PLAIN,
    ).selectExpr("vk", "vid", "valid_from", "coalesce(_n, timestamp_ntz'9999-12-31 00:00:00') as valid_to")
    facts = events.filter("id % 4 <> 0")
    expected = facts.join(versions, F.expr("k = vk and at >= valid_from and at < valid_to")).select(
        "id", "k", "at", "v", "vid")
    got = asof_join(facts, versions, "k", "at", "vk", ["vid"], position="nth", position_order=["id"], settings=settings)
    assert rows(got.drop("nth")) == rows(expected)
    numbers = ordered(facts, ["k"], ["at", "id"], OrderedSpec(sequence="n"), PLAIN).selectExpr("id", "n")
    assert rows(got.select("id", "nth").join(numbers, "id").filter("nth <> n")) == []


@pytest.mark.parametrize("settings", [PLAIN, TINY])
def test_overlaps_equal_pairwise_comparison(spark, events, settings):
    spans = events.selectExpr("k", "id", "at as valid_from", "at + make_dt_interval(0, 0, coalesce(int(v), 0)) as valid_to")
    found = overlapping_versions(spans, "k", "id", settings=settings)
    pairs = spans.alias("a").join(spans.alias("b"), F.expr(
        "a.k = b.k and struct(a.valid_from, a.valid_to, a.id) < struct(b.valid_from, b.valid_to, b.id)"
        " and b.valid_from < a.valid_to"))
    assert rows(found.select("id")) == rows(pairs.select("b.id").distinct())


@pytest.mark.parametrize("settings", [PLAIN, TINY])
def test_exact_percentiles(events, settings):
    got = {r["k"]: r for r in exact_percentiles(events, ["k"], "v", {"mid": 0.5, "top": 1.0}, settings).collect()}
    values = sorted(r["v"] for r in events.filter("k = 1 and v is not null").collect())
    assert got[1]["value_count"] == len(values)
    assert got[1]["mid"] == values[(len(values) + 1) // 2 - 1]
    assert got[1]["top"] == values[-1]


def test_continued_keys_of_one_long_run(events):
    got = continued_keys(events.select("id"), ["id"], "key", 1000, TINY)
    assert sorted(tuple(r) for r in got.collect()) == [(i, 1001 + i) for i in range(300)]
