"""Tables bucketed by a key, merged without a shuffle of what is stored.

A table is a version table (``sources.versions``) with a folder per bucket, the bucket being the one Spark's bucketed
writer and its hash partitioning give to the key. Read through a catalog table whose partitions are the folders of one
version, a scan has the distribution ``hashpartitioning(key, buckets)``: a join or an aggregation by the key needs
no Exchange above it, and a choice of buckets prunes folders. So a merge shuffles the delta alone, reads only the buckets
that the delta's keys fall into and writes only these; all other buckets stay the same files.

Rows without a key end a write with an error. A key with very many rows (``operators.skew``) is written by several tasks,
and a table that has one is read by files instead of by buckets, with joins that split such keys.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.operators.skew import DEFAULT, SkewSettings, hot_keys, lookup_join
from lumbung.session import WorkFolder
from lumbung.sources import versions

BUCKET = "key_bucket"


def bucket_of(key: str, buckets: int) -> Column:
    """The bucket Spark deals a key to."""
    missing = F.raise_error(F.lit(f"{key} is NULL: a bucketed table needs its key")).cast("int")
    return F.when(F.col(key).isNull(), missing).otherwise(F.pmod(F.hash(key), F.lit(buckets)).cast("int"))


class BucketedTable:
    """Rows by ``key`` in ``buckets`` buckets at ``path``.

    ``buckets`` is fixed when the table is made (about table bytes / 256 MB): it is kept with each version, and a later opener
    works with that one, whatever they ask for.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 32, settings: SkewSettings = DEFAULT):
        self.spark, self.path, self.key, self.settings = spark, path.rstrip("/"), key, settings
        stored = versions.version(spark, self.path)
        self.buckets = stored.notes["buckets"] if stored else buckets

    def exists(self) -> bool:
        return versions.exists(self.spark, self.path)

    def read(self, only: Sequence[int] | None = None) -> DataFrame:
        """The newest version's rows, dealt by key unless a key is heavy; ``only`` names the buckets to read."""
        v = versions.version(self.spark, self.path)
        if v is None:
            raise LookupError(f"{self.path} is not stored yet")
        rows = versions.table(self.spark, self.path, v.number) if v.notes["heavy"] else self.spark.table(self._registered(v))
        if only is not None:
            rows = rows.filter(F.col(BUCKET).isin(list(only)))
        return rows.select(*[c for c in v.schema.names if c != BUCKET])

    def rows_of(self, keys: DataFrame) -> DataFrame:
        """Stored rows whose key is among ``keys``; only their buckets are read."""
        return self._matching(keys, self.touched(keys), "left_semi")

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets the rows' keys fall into: at most ``buckets`` numbers."""
        return sorted(r[0] for r in rows.select(bucket_of(self.key, self.buckets)).distinct().collect())

    def replace(self, df: DataFrame, notes: Mapping[str, int] | None = None, **more) -> versions.Version:
        """A version that holds ``df`` alone; ``notes`` are the caller's own, beside those of the table."""
        dealt, heavy = self._dealt(df)
        return versions.replace(
            self._numbered(dealt), self.path, [BUCKET], notes={**(notes or {}), **self._notes(heavy)}, write=self._write, **more)

    def merge(self, delta: DataFrame, notes: Mapping[str, int] | None = None, **more) -> versions.Version | None:
        """Stored rows whose key the delta has give way to the delta's rows; None when the delta is empty.

        Repeating a merge leaves the same rows. The delta is read several times: pass stored rows, or it is stored first.
        """
        if not self.exists():
            return self.replace(delta, notes, **more)
        with WorkFolder(self.spark, "bucketed") as work:
            delta = work.keep(delta, "delta")
            buckets = self.touched(delta)
            if not buckets:
                return None
            kept = self._matching(delta, buckets, "left_anti")
            fresh, heavy = self._dealt(delta.select(*kept.columns))
            heavy = heavy or bool(versions.version(self.spark, self.path).notes["heavy"])
            # Both sides lie by bucket already, so a bucket gets at most a file of each.
            return versions.replace_partitions(
                self._numbered(kept.unionByName(fresh)), self.path, BUCKET, buckets,
                notes={**(notes or {}), **self._notes(heavy)}, write=self._write, **more)

    def _matching(self, keys: DataFrame, buckets: Sequence[int], how: str) -> DataFrame:
        stored = self.read(buckets)
        if versions.version(self.spark, self.path).notes["heavy"]:
            return lookup_join(stored, keys.select(self.key).distinct(), [self.key], how, self.settings)
        once = keys.select(self.key).repartition(self.buckets, self.key).distinct()
        return stored.join(once.hint("merge"), self.key, how)

    def _dealt(self, df: DataFrame) -> tuple[DataFrame, bool]:
        """Rows in one task per bucket; rows of heavy keys in as many more as they need."""
        hot = hot_keys(df, [self.key], self.settings)
        if not hot:
            return df.repartition(self.buckets, self.key), False
        salts = sum(r["_rows"] for r in hot) // self.settings.group_rows + 1
        return df.repartition(self.buckets * salts, self.key, F.pmod(F.xxhash64(*df.columns), F.lit(salts))), True

    def _numbered(self, df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET, bucket_of(self.key, self.buckets))

    def _notes(self, heavy: bool) -> dict[str, int]:
        return {"buckets": self.buckets, "heavy": int(heavy)}

    def _write(self, df: DataFrame, folder: str) -> None:
        name = f"writing_{uuid.uuid4().hex}"
        df.write.format("parquet").partitionBy(BUCKET).bucketBy(self.buckets, self.key).sortBy(self.key).option("path", folder).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")  # the entry of the catalog; the files stay

    def _registered(self, v: versions.Version) -> str:
        """Catalog table over the folders of one version, which never change; made once per catalog."""
        name = f"bucketed_{hashlib.sha256(f'{self.path}|{v.number}|{v.folders}'.encode()).hexdigest()[:32]}"
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in v.schema.fields if f.name != BUCKET)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}, {BUCKET} INT) USING parquet PARTITIONED BY ({BUCKET}) CLUSTERED BY (`{self.key}`) "
                f"SORTED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{self.path}/_catalog/{v.number}'")
            parts = [f"PARTITION ({f.split('/')[-1]}) LOCATION '{self.path}/{f}'" for f in v.folders]
            if parts:
                self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(parts)}")
        return name
