"""Merges and reports in several queries: what one of them needs on disk goes before the next one starts."""

from __future__ import annotations

import os

import pytest
import small
from conftest import TINY, rows

from lumbung.plans.gates import RowGate
from lumbung.plans.suite import Check, ChecksFailed
from lumbung.plans.warehouse import Warehouse
from lumbung.session import WorkFolder
from lumbung.sources import versions, writers

CHECKS = [Check("t", "v", "not_null"), Check("t", "v", "is_true", ">= 0")]


def table(spark, values):
    return spark.createDataFrame(values, "id int, v int, p int")


@pytest.mark.parametrize("bad", [False, True])
def test_a_merge_writes_few_partitions_at_once_and_its_gate_sees_all(spark, tmp_path, monkeypatch, bad):
    monkeypatch.setattr(writers, "AT_ONCE", 2)
    path = str(tmp_path / "t")
    old = [(i, i, i % 7 if i % 7 < 6 else None) for i in range(70)] + [(None, 5, 1)]
    writers.overwrite(table(spark, old), path, ["p"])
    delta = [(i, None if bad and i == 60 else 1000 + i, 8 if i == 3 else (i % 7 if i % 7 < 6 else None)) for i in range(0, 70, 3)] + [(99, 1, 9)]
    gate, folders = RowGate("t", CHECKS), []
    monkeypatch.setattr(RowGate, "observed", lambda self, df, seen=RowGate.observed: folders.append(
        len(df.select("p").distinct().collect())) or seen(self, df))
    if bad:
        with pytest.raises(ChecksFailed) as failed:
            writers.merge_into(spark, path, table(spark, delta), ["id"], "p", TINY, gate=gate)
        assert [(f["check"], f["n_bad"]) for f in failed.value.failures] == [("not_null", 1)]
        assert rows(versions.table(spark, path)) == sorted(old, key=repr)
        return
    writers.merge_into(spark, path, table(spark, delta), ["id"], "p", TINY, gate=gate)
    changed = {i for i, _, _ in delta}
    assert rows(versions.table(spark, path)) == sorted([r for r in old if r[0] not in changed] + delta, key=repr)
    assert len(folders) > 1 and max(folders) <= 2 and [r["n_bad"] for r in gate.report()] == [0, 0]


def test_the_slice_drops_its_inputs_before_the_merge(spark, tmp_path, monkeypatch):
    kept, merging = {}, []
    keep, merge = WorkFolder.keep, writers.merge_into
    monkeypatch.setattr(WorkFolder, "keep", lambda self, df, name: kept.setdefault(name, self.path) and keep(self, df, name))
    monkeypatch.setattr(writers, "merge_into", lambda *a, **k: merging.append(sorted(os.listdir(
        kept["fact"].removeprefix("file:")))) or merge(*a, **k))
    w = Warehouse(spark, str(tmp_path), as_of="date'2024-06-01'", city_rows=2, minimum_items=1)
    raw = small.frames(spark, small.base_rows())
    w.run_full(raw, check=False)
    w.apply_orders(raw, raw["orders"].select("order_id"), refresh_marts=False, check=False)
    assert merging == [["fact"]] * 2


def test_the_report_runs_a_query_per_model(spark, tmp_path, monkeypatch):
    import lumbung.plans.warehouse as module

    asked, run = [], module.run_checks
    monkeypatch.setattr(module, "run_checks", lambda models, checks, singular, select: asked.append(
        {c.model for c in checks if select(c.model)} | {m for _, m, _ in singular if select(m)}) or run(models, checks, singular, select))
    w = Warehouse(spark, str(tmp_path), as_of="date'2024-06-01'", city_rows=2, minimum_items=1)
    raw = small.frames(spark, small.base_rows())
    w.run_full(raw, check=False)
    found = rows(w.report(raw).select("check", "model", "column"))
    assert len(found) == 128 + 7 == len(set(found))
    assert len(asked) > 10 and all(len(models) == 1 for models in asked)
