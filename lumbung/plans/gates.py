"""Row checks counted while a table is written, deciding over its commit.

The rows pass an ``Observation`` on their way into the files of the next version: a conditional count per check, in the same
stage as the write, so that not NULL, accepted values and conditions need no scan of their own. Before the pointer is
switched the counts are looked at: a violation raises, the old version stays the current one. A version committed
through a gate notes it (``CHECKED``). A version that keeps folders of one before is as clean as that one was, so the note
also needs the note of the version before.

A stage that runs again after a lost executor may count rows twice, which never turns a violation into none.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import Row

from lumbung.sources import versions

from .suite import DECLARED, Check, ChecksFailed, row_violations

CHECKED = "row_checked"
ROW_KINDS = ("not_null", "accepted_values", "is_true")


class RowGate:
    """The row checks of one model over the rows of one write.

    ``strict`` False lets violations through and only counts them. A gate is used for one write.
    """

    def __init__(self, model: str, checks: Iterable[Check] = tuple(DECLARED), strict: bool = True):
        self.model, self.strict = model, strict
        self.checks = [c for c in checks if c.model == model and c.kind in ROW_KINDS]
        self._seen, self._counts = [], None

    def _columns(self) -> list:
        return [F.count(F.when(row_violations(c), 1)).alias(f"n{i}") for i, c in enumerate(self.checks)]

    def observed(self, df: DataFrame) -> DataFrame:
        """The same rows, counted when they are written; a version may be written in several parts."""
        if not self.checks:
            return df
        self._seen.append(Observation(f"checks of {self.model}, part {len(self._seen)}"))
        return df.observe(self._seen[-1], *self._columns())

    def accept(self, written: DataFrame) -> None:
        """Raise if a written row breaks a check; for ``versions.commit``."""
        found = [seen.get for seen in self._seen]
        if any(len(part) < len(self.checks) for part in found):  # the plan of an empty frame may have lost the counts
            found = [written.agg(*self._columns()).first().asDict()]
        self._counts = [sum(part[f"n{i}"] for part in found) for i in range(len(self.checks))]
        failures = [r for r in self.report() if r["n_bad"]]
        if failures and self.strict:
            raise ChecksFailed(failures)

    def notes(self, old: versions.Version | None) -> dict[str, int]:
        """What the new version notes; ``old`` is the version of which folders are kept, if any."""
        return {CHECKED: int(self.strict and (old is None or bool(old.notes.get(CHECKED))))}

    def report(self) -> list[Row]:
        """(check, model, column, n_bad) of each row check, once the rows are written."""
        if self._counts is None:
            raise LookupError(f"{self.model} has not been written through this gate")
        return [Row(check=c.kind, model=c.model, column=c.column, n_bad=n) for c, n in zip(self.checks, self._counts, strict=True)]


def report_frame(spark: SparkSession, reports: Iterable[Row]) -> DataFrame:
    """Report rows as a frame; as many as there are checks."""
    return spark.createDataFrame([tuple(r) for r in reports], "check string, model string, column string, n_bad long")


def passed_while_written(spark: SparkSession, path: str) -> bool:
    """Whether every row of the newest version at ``path`` went through a strict gate."""
    v = versions.version(spark, path)
    return bool(v and v.notes.get(CHECKED))
