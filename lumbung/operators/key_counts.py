"""Uniqueness and foreign keys checked on increments.

A full check groups all keys of a table, and joins them with all keys of the parent, in every run. Here a state holds how many
rows of the child and of the parent have each key, in buckets by key. Both tables are versions (``sources.versions``): rows of folders
that went count -1, rows of folders that came +1, whatever side they are on, and are summed per key before they are
shuffled. So a new child row is checked against stored keys, and a parent that was removed against stored children, at the cost
of the changed folders and the buckets their keys fall into. A key with a third of all rows is one row of the state.

The verdicts are the rows the full checks give, ``quality.unique`` and ``quality.relationships``: violations of earlier loads
stay until they are mended. The filters on counts reach the Parquet scan, and row groups without a violation are
skipped by their statistics. Keys with a NULL are not compared. A key without rows keeps a state row with counts of 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.session import WorkFolder
from lumbung.sources import versions
from lumbung.sources.bucketed import BucketedTable

from .skew import DEFAULT, SkewSettings


@dataclass(frozen=True)
class Side:
    """The key columns of a stored table of versions."""

    path: str
    columns: tuple[str, ...]


class KeyCounts:
    """Rows per key of a child table and, for a foreign key, of its parent table."""

    def __init__(
        self, spark: SparkSession, path: str, child: Side, parent: Side | None = None, buckets: int = 32, settings: SkewSettings = DEFAULT,
    ):
        self.spark, self.child, self.parent = spark, child, parent
        self.state = BucketedTable(spark, path, "key", buckets, settings)

    def _sides(self) -> list[tuple[str, Side]]:
        return [("children", self.child), *([("parents", self.parent)] if self.parent else [])]

    def follow(self) -> bool:
        """Bring the counts up to the newest versions of both tables; False when there is nothing new.

        The versions the counts stand for are committed with them, so a repeated or interrupted call counts nothing twice. If
        one of them can't be read any more, everything is counted anew.
        """
        old = versions.version(self.spark, self.state.path)
        newest = {n: versions.version(self.spark, s.path).number for n, s in self._sides()}
        since = {n: old.notes[n] if old else 0 for n in newest}
        if since == newest:
            return False
        diffs = {n: versions.changes(self.spark, s.path, since[n]) for n, s in self._sides()}
        if any(d is None for d in diffs.values()):
            old, diffs = None, {n: versions.changes(self.spark, s.path, 0) for n, s in self._sides()}
        with WorkFolder(self.spark, "keys") as work:
            signed = [
                self._keys(df, side.columns, name, sign)
                for name, side in self._sides() for df, sign in zip(diffs[name], (-1, 1), strict=True)]
            delta = work.keep(self._summed(reduce(DataFrame.unionByName, signed)).filter("children <> 0 or parents <> 0"), "delta")
            if old is None:
                self.state.replace(delta, notes=newest)
            else:
                known = self.state.rows_of(delta)
                self.state.merge(work.keep(self._summed(known.unionByName(delta)), "counts"), notes=newest)
        return True

    def _keys(self, df: DataFrame, columns: Sequence[str], name: str, sign: int) -> DataFrame:
        known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
        values = F.struct(*[F.col(c).alias(own) for c, own in zip(columns, self.child.columns, strict=True)])
        count = {n: F.lit(sign if n == name else 0).cast("long").alias(n) for n in ("children", "parents")}
        return df.filter(known).select(F.to_json(values).alias("key"), values.alias("values"), *count.values())

    def _summed(self, df: DataFrame) -> DataFrame:
        return df.groupBy("key").agg(F.first("values").alias("values"), F.sum("children").alias("children"), F.sum("parents").alias("parents"))

    def repeated(self) -> DataFrame:
        """Child keys that occur more than once, as ``quality.unique`` gives them."""
        return self.state.read().filter("children > 1").select("values.*", F.col("children").alias("row_count"))

    def orphans(self) -> DataFrame:
        """Child keys without a parent row, as ``quality.relationships`` gives them."""
        if self.parent is None:
            raise LookupError("there is no parent table")
        key = F.col("values")[self.child.columns[0]]
        return self.state.read().filter("children > 0 and parents = 0").select(key.alias("missing_key"), F.col("children").alias("row_count"))
