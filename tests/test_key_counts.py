"""Key checks on increments against the full checks."""

from __future__ import annotations

from conftest import rows

from lumbung.operators import quality
from lumbung.operators.key_counts import KeyCounts, Side
from lumbung.sources import versions, writers


def test_same_verdict_as_the_full_checks(spark, tmp_path):
    child, parent = str(tmp_path / "child"), str(tmp_path / "parent")

    def items(values):
        return spark.createDataFrame(values, "id int, fk long, n int, p int")

    def parents(values):
        return spark.createDataFrame([(v,) for v in values], "pk long")

    link = KeyCounts(spark, str(tmp_path / "link"), Side(child, ("fk",)), Side(parent, ("pk",)), 4)
    grain = KeyCounts(spark, str(tmp_path / "grain"), Side(child, ("fk", "n")), None, 4)

    def judged():
        assert link.follow() and not link.follow()
        grain.follow()
        now, above = versions.table(spark, child), versions.table(spark, parent)
        assert rows(link.orphans()) == rows(quality.relationships(now, "fk", above, "pk"))
        assert rows(grain.repeated()) == rows(quality.unique(now, "fk", "n"))
        return [r[0] for r in rows(link.orphans())], [r[0] for r in rows(grain.repeated())]

    # Faults in the history: an orphan and a doubled grain; NULL keys are not compared.
    writers.overwrite(items([(1, 10, 1, 1), (2, 10, 1, 1), (3, 99, 1, 2), (4, None, 1, 2), (5, 11, None, 2), (6, 12, 1, 3)]), child, ["p"])
    writers.overwrite(parents([10, 11, 12]), parent)
    assert judged() == ([99], [10])
    # Faults in the delta: a new orphan, a grain doubled with a stored row.
    writers.merge_into(spark, child, items([(7, 98, 1, 3), (8, 12, 1, 4)]), ["id"], "p")
    assert judged() == ([98, 99], [10, 12])
    # A removed parent, and both faults of the history mended.
    writers.overwrite(parents([10, 11, 98, 99]), parent)
    writers.merge_into(spark, child, items([(2, 10, 2, 1)]), ["id"], "p")
    assert judged() == ([12], [12])
    # The version the counts stand for is gone: counted anew.
    for _ in range(3):
        writers.overwrite(items([(1, 12, 1, 1), (2, 13, 1, 1)]), child, ["p"])
    versions.vacuum(spark, child, 1)
    assert judged() == ([12, 13], [])
    writers.overwrite(items([]), child, ["p"])
    assert judged() == ([], [])
