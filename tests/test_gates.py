"""Row checks counted while rows are written."""

from __future__ import annotations

import pytest
from conftest import rows

from lumbung.plans.gates import CHECKED, RowGate, passed_while_written
from lumbung.plans.suite import Check, ChecksFailed, run_checks
from lumbung.sources import versions, writers

CHECKS = [
    Check("t", "id", "not_null"), Check("t", "v", "accepted_values", ["a", "b"]), Check("t", "n", "is_true", ">= 0"),
    Check("t", "id", "unique"), Check("other", "id", "not_null")]


def table(spark, values):
    return spark.createDataFrame(values, "id int, v string, n int, p int")


GOOD, BAD = [(1, "a", 0, 1), (2, None, None, 2), (3, "b", 5, 2)], [(None, "a", 1, 1), (4, "x", -1, 1), (4, "y", 2, 3)]


@pytest.mark.parametrize("partition", [[], ["p"]])
def test_counts_equal_the_scan_and_a_violation_keeps_the_old_version(spark, tmp_path, partition):
    path = str(tmp_path / "t")
    first = RowGate("t", CHECKS)
    writers.overwrite(table(spark, GOOD), path, partition, first)
    assert [r["n_bad"] for r in first.report()] == [0, 0, 0] and passed_while_written(spark, path)
    with pytest.raises(ChecksFailed) as failed:
        writers.overwrite(table(spark, BAD), path, partition, RowGate("t", CHECKS))
    assert {(f["check"], f["n_bad"]) for f in failed.value.failures} == {("not_null", 1), ("accepted_values", 2), ("is_true", 1)}
    assert rows(versions.table(spark, path).select("id")) == [(1,), (2,), (3,)]
    loose = RowGate("t", CHECKS, strict=False)
    writers.overwrite(table(spark, BAD), path, partition, loose)
    scanned = run_checks({"t": versions.table(spark, path)}, [c for c in CHECKS[:3]])
    assert sorted(map(tuple, loose.report())) == sorted(map(tuple, scanned.collect()))
    assert not passed_while_written(spark, path)


def test_merges_count_what_they_write_and_inherit_the_note(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.merge_into(spark, path, table(spark, GOOD), ["id"], "p", gate=RowGate("t", CHECKS))
    writers.merge_into(spark, path, table(spark, [(3, "a", 1, 2)]), ["id"], "p", gate=RowGate("t", CHECKS))
    assert passed_while_written(spark, path)
    before = versions.version(spark, path).number
    with pytest.raises(ChecksFailed):
        writers.merge_into(spark, path, table(spark, [(9, "z", 1, 1)]), ["id"], "p", gate=RowGate("t", CHECKS))
    assert versions.version(spark, path).number == before
    writers.merge_into(spark, path, table(spark, [(8, "z", 1, 7)]), ["id"], "p")  # unseen by a gate
    gate = RowGate("t", CHECKS)
    writers.merge_into(spark, path, table(spark, [(3, "b", 1, 2)]), ["id"], "p", gate=gate)
    assert [r["n_bad"] for r in gate.report()] == [0, 0, 0] and versions.version(spark, path).notes[CHECKED] == 0


def test_empty_frames_insert_if_absent_and_models_without_checks(spark, tmp_path):
    gate = RowGate("t", CHECKS)
    writers.overwrite(table(spark, []), str(tmp_path / "empty"), gate=gate)
    assert [r["n_bad"] for r in gate.report()] == [0, 0, 0]
    path = str(tmp_path / "d")
    for values in (GOOD, [(1, "x", -5, 1), (7, "a", 1, 1)]):  # the first row is stored already, so it is not judged
        writers.insert_absent(spark, table(spark, values), path, "id", RowGate("t", CHECKS))
    assert rows(versions.table(spark, path).select("id")) == [(1,), (2,), (3,), (7,)] and passed_while_written(spark, path)
    with pytest.raises(ChecksFailed):
        writers.insert_absent(spark, table(spark, [(11, "x", 1, 1)]), path, "id", RowGate("t", CHECKS))
    none = RowGate("unknown", CHECKS)
    writers.overwrite(table(spark, BAD), str(tmp_path / "u"), gate=none)
    assert none.report() == []
    with pytest.raises(LookupError):
        RowGate("t", CHECKS).report()
