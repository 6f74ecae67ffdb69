"""Bucketed tables merged without a shuffle of what is stored, and customer history by new events."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from conftest import TINY, rows
from pyspark.sql import functions as F

from lumbung.plans.history import CustomerHistory
from lumbung.plans.intermediate import customer_scd2
from lumbung.schemas import RAW_SCHEMAS
from lumbung.sources import versions
from lumbung.sources.bucketed import BucketedTable, bucket_of


def pairs(spark, values):
    return spark.createDataFrame(values, "id long, v string")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_merge_reads_and_writes_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    table = BucketedTable(spark, path, "id", 8)
    table.replace(pairs(spark, [(i, "old") for i in range(400)]))
    before = versions.version(spark, path)
    assert len(before.folders) == 8 and rows(table.read()) == sorted([(i, "old") for i in range(400)], key=repr)
    delta = pairs(spark, [(5, "new"), (5, "twice"), (1000, "more")])
    hit = table.touched(delta)
    assert hit == sorted({r[0] for r in delta.select(bucket_of("id", 8)).collect()}) and len(hit) < 8
    semi = plan(table.rows_of(delta))
    stored_side = semi[semi.index("SortMergeJoin"):semi.index("FileScan")]
    assert "Exchange" not in stored_side and "Bucketed: true" in semi
    opened = table.read()
    table.merge(delta)
    after = versions.version(spark, path)
    assert len(set(before.folders) & set(after.folders)) == 8 - len(hit)
    want = sorted([(i, "old") for i in range(400) if i != 5] + [(5, "new"), (5, "twice"), (1000, "more")], key=repr)
    assert rows(table.read()) == want and opened.count() == 400
    again = BucketedTable(spark, path, "id", 3)  # the stored number counts
    assert again.buckets == 8 and again.merge(delta) and rows(again.read()) == want
    assert again.merge(pairs(spark, [])) is None and "Exchange" not in plan(again.read().groupBy("id").count())


def test_stopped_merge_keyless_rows_and_empty_table(spark, tmp_path):
    path = str(tmp_path / "t")
    table = BucketedTable(spark, path, "id", 4)
    with pytest.raises(LookupError):
        table.read()
    table.replace(pairs(spark, []))
    assert table.read().count() == 0
    table.merge(pairs(spark, [(1, "a"), (2, None)]))

    def refuse(_):
        raise ValueError("no")

    with pytest.raises(ValueError):
        table.merge(pairs(spark, [(1, "b")]), accept=refuse)
    with pytest.raises(Exception, match="needs its key"):
        table.merge(pairs(spark, [(None, "x")]))
    assert rows(table.read()) == [(1, "a"), (2, None)]


def test_heavy_key_is_written_by_several_tasks(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), "id", 4, TINY)
    table.replace(pairs(spark, [(7, str(i)) for i in range(90)] + [(i, "x") for i in range(40, 50)]))
    table.merge(pairs(spark, [(7, f"n{i}") for i in range(70)] + [(41, "y")]))
    want = [(7, f"n{i}") for i in range(70)] + [(i, "y" if i == 41 else "x") for i in range(40, 50)]
    assert rows(table.read()) == sorted(want, key=repr)


@pytest.mark.parametrize("settings", [None, TINY])
def test_history_by_new_events_equals_the_full_build(spark, tmp_path, settings):
    """Late events, events of one instant, corrected and repeated events, new customers."""
    r, start = random.Random(3), datetime(2024, 1, 1)
    more = {} if settings is None else {"settings": settings}
    history = CustomerHistory(spark, str(tmp_path / "h"), 32, **more)
    held = {}

    def event(eid, customer, load):
        at = start + timedelta(days=r.randrange(40))
        return (eid, customer, f"n{r.randrange(9)}", "e", "f", date(2000, 1, 1), r.randrange(5), "Gold", True, at, "update", start + timedelta(days=100 + load))

    for load in range(3):
        batch = [event(1000 * load + i, r.randrange(30) if load < 2 else r.randrange(28, 33), load) for i in range(60 if not load else 8)]
        batch += [event(i, held[i][1], load) for i in r.sample(sorted(held), min(3, len(held)))]  # corrected
        frame = spark.createDataFrame(batch, RAW_SCHEMAS["customer_profile_events"])
        kept = versions.version(spark, str(tmp_path / "h"))
        history.add(frame)
        held |= {b[0]: b for b in batch}
        whole = spark.createDataFrame(list(held.values()), RAW_SCHEMAS["customer_profile_events"])
        want = rows(customer_scd2(whole))
        assert rows(history.versions()) == want and history.newest_load() == start + timedelta(days=100 + load)
        if kept:
            assert set(kept.folders) & set(versions.version(spark, str(tmp_path / "h")).folders)
    history.add(frame)  # the same batch again
    assert rows(history.versions()) == want and history.add(frame.filter(F.lit(False))) is None
    history.rebuild(whole)
    assert rows(history.versions()) == want
