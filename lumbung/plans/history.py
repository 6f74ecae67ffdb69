"""Customer history kept up to date by new profile events.

The stored state has a row per profile event with the start of the next version, in buckets by customer. New events close
the version that was open, open the next one, and late events take their place between two versions. Only customers
with new events are computed, and only their buckets are read and written. The result equals ``customer_scd2`` over all events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.operators.ordered import OrderedSpec, ordered
from lumbung.operators.skew import DEFAULT, SkewSettings
from lumbung.session import WorkFolder
from lumbung.sources import versions
from lumbung.sources.bucketed import BucketedTable
from lumbung.sources.writers import latest_rows

from .intermediate import versions_of

NEXT = "_next"


class CustomerHistory:
    """Versions of all customers at ``path``."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 32, settings: SkewSettings = DEFAULT):
        self.state, self.settings = BucketedTable(spark, path, "customer_id", buckets, settings), settings
        self.spark = spark

    def rebuild(self, events: DataFrame) -> None:
        """The state of all staged profile events."""
        self.state.replace(self._followed(events))

    def add(self, events: DataFrame) -> versions.Version | None:
        """Take in new events; None when there are none.

        An event that is stored already counts in its later version, so that the same events may come again.
        """
        if not self.state.exists():
            return self.state.replace(self._followed(latest_rows(events, "customer_profile_event_id")))
        with WorkFolder(self.spark, "history") as work:
            new = work.keep(events, "events")
            if new.isEmpty():
                return None
            theirs = self.state.rows_of(new).drop(NEXT).unionByName(new)
            return self.state.merge(self._followed(latest_rows(theirs, "customer_profile_event_id")))

    def newest_load(self):
        """Latest load time of a stored event; None when there is none."""
        return self.state.read().agg(F.max("loaded_at")).first()[0] if self.state.exists() else None

    def versions(self) -> DataFrame:
        """The type-2 history, as ``customer_scd2`` gives it."""
        return versions_of(self.state.read())

    def _followed(self, events: DataFrame) -> DataFrame:
        return ordered(
            events, ["customer_id"], ["effective_at", "customer_profile_event_id"], OrderedSpec(nexts={NEXT: "effective_at"}), self.settings)
