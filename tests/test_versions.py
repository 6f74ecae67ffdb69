"""Tables as versions, and marts that follow the differences between them."""

from __future__ import annotations

import random
from datetime import date

import pytest
from conftest import rows

from lumbung.plans import delta_marts
from lumbung.sources import versions, writers


def part(spark, values):
    return spark.createDataFrame(values, "id int, v string, p int")


def test_a_run_that_stops_before_the_switch_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace(part(spark, [(1, "a", 1), (2, "b", None)]), path, ["p"])
    opened = versions.table(spark, path)

    def refuse(new):
        assert new.count() == 1
        raise ValueError("not good")

    with pytest.raises(ValueError):
        versions.replace(part(spark, [(3, "c", 1)]), path, ["p"], accept=refuse)
    assert rows(versions.table(spark, path)) == rows(opened) == [(1, "a", 1), (2, "b", None)]
    versions.replace(part(spark, [(4, "d", 2)]), path, ["p"])
    assert rows(versions.table(spark, path)) == [(4, "d", 2)] and rows(opened) == [(1, "a", 1), (2, "b", None)]
    assert rows(versions.table(spark, path, 1)) == rows(opened) and versions.versions(spark, path) == [1, 3]
    assert versions.table(spark, path, 2) is None and versions.table(spark, str(tmp_path / "none")) is None


def test_only_touched_partitions_change(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace(part(spark, [(1, "a", 1), (2, "b", 2), (3, "c", None)]), path, ["p"])
    versions.replace_partitions(part(spark, [(2, "B", 2), (4, "d", 4)]), path, "p", [2, 4, None])
    assert rows(versions.table(spark, path)) == [(1, "a", 1), (2, "B", 2), (4, "d", 4)]
    went, came = versions.changes(spark, path, 1)
    assert rows(went) == [(2, "b", 2), (3, "c", None)] and rows(came) == [(2, "B", 2), (4, "d", 4)]
    versions.append(part(spark, [(5, "e", 1)]), path)
    assert rows(versions.table(spark, path)) == [(1, "a", 1), (2, "B", 2), (4, "d", 4), (5, "e", 1)]
    assert rows(versions.changes(spark, path, 2)[1]) == [(5, "e", 1)]
    versions.vacuum(spark, path, 1)
    assert rows(versions.table(spark, path)) == [(1, "a", 1), (2, "B", 2), (4, "d", 4), (5, "e", 1)]
    assert versions.changes(spark, path, 1) is None and rows(versions.changes(spark, path, 0)[0]) == []


def test_the_second_of_two_writers_is_turned_away(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace(part(spark, [(1, "a", 1)]), path)
    with pytest.raises(versions.Superseded):
        versions.replace(part(spark, [(2, "late", 1)]), path, accept=lambda _: versions.replace(part(spark, [(3, "first", 1)]), path))
    assert rows(versions.table(spark, path)) == [(3, "first", 1)]


def test_plain_files_become_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    part(spark, [(1, "a", 1), (2, "b", 2)]).write.partitionBy("p").parquet(path)
    writers.merge_into(spark, path, part(spark, [(2, "B", 2)]), ["id"], "p")
    assert rows(versions.table(spark, path).select("id", "v", "p")) == [(1, "a", 1), (2, "B", 2)]


ROLLUP = "customer_nk long, shipping_key string, order_ts timestamp_ntz, minutes_min long, minutes_max long, total_payment long, cancelled_items long, order_month int, order_id long"


def orders(spark, values):
    return spark.createDataFrame([(c, s, d, m, m, t, x, int(f"{d:%Y%m}"), i) for i, (c, s, d, m, t, x) in values.items()],
                                 ROLLUP.replace("order_ts timestamp_ntz", "order_ts date"))


def test_states_follow_inserts_changes_and_deletions(spark, tmp_path):
    """Every update equals a state built anew; repeating it, or missing a version, changes nothing."""
    r, now = random.Random(4), {}
    state = delta_marts.State("order_rollup", ("customer_nk", "order_day"), ("order_count", "total_payment"), "customer_nk")
    minutes = delta_marts.State("order_rollup", ("shipping_key", "minutes"), ("order_count",), rows=delta_marts._minutes)
    source = str(tmp_path / "rollup")

    def content(name):
        return rows(versions.table(spark, str(tmp_path / name)))

    for step in range(4):
        for i in range(12):
            if now and r.random() < 0.3:
                now.pop(r.choice(list(now)))
            now[r.randrange(20) if r.random() < 0.5 else 100 * step + i] = (
                r.choice([1, 2, None]), r.choice("ab"), date(2024, r.randrange(1, 4), 1 + r.randrange(3)), r.choice([5, 9, None]),
                r.choice([10, None]), r.randrange(2))
        if step == 3:
            now.clear()
        if step:
            versions.replace_partitions(orders(spark, now), source, "order_month", [202401, 202402, 202403])
        else:
            versions.replace(orders(spark, now), source, ["order_month"])
        if step == 1:
            continue  # two versions of the source at once
        for name, s in (("days", state), ("minutes", minutes)):
            for _ in range(2):
                delta_marts.update(spark, s, str(tmp_path / name), source, buckets=4)
            delta_marts.update(spark, s, str(tmp_path / f"new_{name}_{step}"), source, rebuild=True, buckets=4)
            assert content(name) == content(f"new_{name}_{step}")
    assert content("days") == [] and content("minutes") == []


def test_an_update_reads_changed_folders_only(spark, tmp_path):
    source = str(tmp_path / "rollup")
    versions.replace(orders(spark, {1: (1, "a", date(2024, 1, 1), 5, 10, 0), 2: (2, "a", date(2024, 2, 1), 5, 10, 0)}), source, ["order_month"])
    versions.replace_partitions(orders(spark, {2: (2, "b", date(2024, 2, 1), 7, 20, 1)}), source, "order_month", [202402])
    state = delta_marts.STATES["shipping_minutes"]
    delta = delta_marts.signed(state, *versions.changes(spark, source, 1))
    files = [f for side in versions.changes(spark, source, 1) for f in side.inputFiles()]
    assert len(files) == 2 and all("order_month=202402" in f for f in files)
    assert sorted(tuple(x) for x in delta.select("shipping_key", "minutes", "order_count").collect()) == [("a", 5, -2), ("b", 7, 2)]
