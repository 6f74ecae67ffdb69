"""Slices, roll-ups and states made in several queries, so that the shuffle files of one can go before the next starts."""

from __future__ import annotations

import os
import re
from collections import defaultdict

import small
from conftest import rows

from lumbung.plans import delta_marts
from lumbung.plans import warehouse as module
from lumbung.plans.delta_marts import State
from lumbung.plans.warehouse import Warehouse
from lumbung.session import WorkFolder
from lumbung.sources import versions


def jobs(folder):
    """Buckets by the job that wrote them: a job has an id of its own in the names of its files."""
    found = defaultdict(set)
    for bucket in os.listdir(folder):
        if "=" in bucket:
            for name in os.listdir(f"{folder}/{bucket}"):
                if name.startswith("part-"):
                    found[re.match(r"part-\d+-([0-9a-f-]{36})", name)[1]].add(int(bucket.split("=")[1]))
    return found


def test_a_state_is_made_and_updated_some_buckets_at_a_time(spark, tmp_path):
    source, path = str(tmp_path / "t"), str(tmp_path / "state")
    state = State("t", ("c", "k"), ("v",), "c", lambda df: df)
    first = [(i % 50 if i % 13 else None, i % 3, i, i % 4) for i in range(300)]
    later = [(i % 50 if i % 7 else None, i % 3, None if i % 5 == 0 else 2 * i, i % 4) for i in range(400)]

    def summed(values):
        out = defaultdict(lambda: [0, 0, 0])
        for c, k, v, _ in values:
            for j, x in enumerate((v or 0, v is not None, 1)):
                out[c, k][j] += x
        return sorted([(*key, *got) for key, got in out.items()], key=repr)

    for step, values in enumerate((first, later), 1):
        versions.replace(spark.createDataFrame(values, "c int, k int, v int, p int"), source, ["p"])
        delta_marts.update(spark, state, path, source, buckets=16)
        assert rows(versions.table(spark, path).select("c", "k", "v", "v_known", "row_count")) == summed(values)
        by_job = jobs(f"{path}/written={step}")
        assert len(by_job) == 4 and all(len(b) <= 4 for b in by_job.values())


def test_an_incremental_run_makes_its_rows_in_parts(spark, tmp_path, monkeypatch):
    kept, keep, add = defaultdict(list), WorkFolder.keep, getattr(WorkFolder, "add", None)

    def noted(write):
        def run(self, df, name):
            if {"order_id"} <= set(df.columns) and name in ("fact", "delta"):
                kept[os.path.basename(self.path).split("-")[0], name].append({r[0] for r in df.select("order_id").collect()})
            return write(self, df, name)
        return run

    monkeypatch.setattr(WorkFolder, "keep", noted(keep))
    monkeypatch.setattr(WorkFolder, "add", noted(add), raising=False)
    w = Warehouse(spark, str(tmp_path), as_of="date'2024-06-01'", city_rows=2, minimum_items=1)
    raw = small.frames(spark, small.base_rows())
    w.run_full(raw, check=False)
    before = {t: rows(w.stored(t)) for t in ("fct_order_item", "order_rollup")}
    w.apply_orders(raw, raw["orders"].select("order_id"), True, refresh_marts=False, check=False)
    assert {t: rows(w.stored(t)) for t in before} == before
    for parts in (kept["slice", "fact"], kept["rollup", "delta"]):
        assert len(parts) == module.SLICE_PARTS
        assert sum(map(len, parts)) == len(set().union(*parts)) == len(before["order_rollup"])
