"""Percentiles by selection against sorted lists."""

from __future__ import annotations

import math
import random

import pytest
from conftest import TINY

from lumbung.operators.percentile import exact_percentiles
from lumbung.operators.selection import selected_percentiles
from lumbung.operators.skew import DEFAULT

SHARES = {"none": 0.0, "low": 0.1, "mid": 0.5, "high": 0.9, "all": 1.0}


def expected(groups):
    out = {}
    for k, values in groups.items():
        line = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), v))
        if line:
            out[k] = (len(line), *[line[max(1, math.ceil(len(line) * s)) - 1] for s in SHARES.values()])
    return out


def found(df, **more):
    return {r["k"]: tuple(r)[1:] for r in selected_percentiles(df, ["k"], "v", SHARES, **more).collect()}


@pytest.mark.parametrize("settings,more", [
    (DEFAULT, {}), (DEFAULT, {"rest_rows": 0, "bins": 4, "passes": 3}), (TINY, {"rest_rows": 5, "bins": 16}), (TINY, {"passes": 0, "rest_rows": 0}),
    (DEFAULT, {"rest_rows": 0, "bins": 64, "passes": 6})])
def test_equal_to_sorted_lists(spark, settings, more):
    rng = random.Random(7)
    groups = {
        "plain": [rng.gauss(0, 1) for _ in range(300)], "ties": [float(rng.randrange(3)) for _ in range(200)], "one": [5.0], "empty": [None],
        None: [float(x) for x in range(50)], "steps": [2.0 ** k for k in range(-500, 500, 9)], "far": [1e308, -1e308, 0.0, 1.0, 2.0] * 9,
        "wild": [math.inf, -math.inf, 1.5, 2.5, None, 3.5, math.inf] * 7, "infinite": [math.inf, math.inf, -math.inf]}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k string, v double")
    assert found(df, settings=settings, **more) == expected(groups)


def test_nan_is_the_largest_value(spark):
    df = spark.createDataFrame([("a", v) for v in [1.0, 2.0, math.nan, math.nan, 3.0]] + [("b", math.nan)], "k string, v double")
    got = found(df, rest_rows=0)
    assert got["a"][:4] == (5, 1.0, 1.0, 3.0) and math.isnan(got["a"][5]) and math.isnan(got["b"][1])


def test_whole_numbers_beyond_double_precision(spark):
    values = [2**62 + k for k in range(100)] + [-(2**63), 2**63 - 1]
    df = spark.createDataFrame([("a", v) for v in values], "k string, v long")
    assert found(df, rest_rows=0)["a"] == (102, *[sorted(values)[max(1, math.ceil(102 * s)) - 1] for s in SHARES.values()])


def test_no_key_no_rows_and_same_as_the_ordered_walk(spark):
    df = spark.range(1000).selectExpr("id % 7 as k", "id * id % 997 as v")
    assert selected_percentiles(df, [], "v", {"mid": 0.5}, rest_rows=0).collect() == exact_percentiles(df, [], "v", {"mid": 0.5}).collect()
    assert selected_percentiles(df.limit(0), ["k"], "v", SHARES).count() == 0
    both = [sorted(f(df, ["k"], "v", {"a": 0.3, "b": 0.8}).collect()) for f in (selected_percentiles, exact_percentiles)]
    assert both[0] == both[1]
    with pytest.raises(TypeError):
        selected_percentiles(df.selectExpr("k", "cast(v as string) as v"), ["k"], "v", SHARES)
