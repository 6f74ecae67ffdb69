"""Write modes on Parquet tables: append, replace, insert if absent, keyed merge, control table, CSV.

Replaced, merged and insert-if-absent tables are versions (``sources.versions``): the new rows are complete before
readers see them, so a result may read the table it replaces, and a run that stops leaves the old table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from typing import Protocol

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbung.operators.skew import DEFAULT, SkewSettings, estimated_bytes, lookup_join
from lumbung.session import COMPRESSION, WorkFolder, parts_of
from lumbung.sources import versions

EPOCH = datetime(1970, 1, 1)
#: Partitions that a merge writes in one query; the shuffle files of one query can go before the next one starts.
AT_ONCE = 12


class Gate(Protocol):
    """Counts rows on their way into a version, and decides over its commit."""

    def observed(self, df: DataFrame) -> DataFrame: ...

    def accept(self, written: DataFrame) -> None: ...

    def notes(self, old: versions.Version | None) -> dict[str, int]: ...


def table_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest version of the table at ``path``, or its plain Parquet files, or None when there is none yet."""
    found = versions.table(spark, path)
    return versions.plain_or_none(spark, path) if found is None else found


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in floating-point columns becomes NULL."""
    floats = (T.DoubleType, T.FloatType)
    return df.select(*[
        F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name) if isinstance(f.dataType, floats) else F.col(f.name)
        for f in df.schema.fields
    ])


def append(df: DataFrame, path: str) -> None:
    nan_to_null(df).write.mode("append").parquet(path)


def overwrite(
    df: DataFrame, path: str, partition: Sequence[str] = (), gate: Gate | None = None, late: Mapping[str, str] | None = None,
    parts: Sequence[DataFrame] = (), **more,
) -> versions.Version:
    """Replace a table by a new version. Partitioned output is rebalanced first: AQE then splits large
    partitions and joins small ones, so that file sizes follow the data. ``gate`` sees the rows as they are written.
    ``late`` names columns that follow from others, as SQL texts: they are made behind the shuffle. ``parts`` may be frames
    that make up ``df``: each is written by a query of its own, and the shuffle files of one can go before the next one starts."""
    if parts:
        def write(_: DataFrame, folder: str) -> None:
            for some in parts:
                rows = _rebalanced(some, partition, late)
                rows = rows if gate is None else gate.observed(rows)
                rows.write.mode("append").option("compression", COMPRESSION).partitionBy(*partition).parquet(folder)

        if gate is not None:
            more = more | {"accept": gate.accept, "notes": {**more.get("notes", {}), **gate.notes(None)}}
        return versions.replace(df, path, partition, write=write, **more)
    df, more = _through(gate, _rebalanced(df, partition, late), None, more)
    return versions.replace(df, path, partition, **more)


def _through(gate: Gate | None, df: DataFrame, old: versions.Version | None, more: dict) -> tuple[DataFrame, dict]:
    """The frame and the arguments of its commit with a gate in the way; folders of ``old`` are kept."""
    if gate is None:
        return df, more
    return gate.observed(df), more | {"accept": gate.accept, "notes": {**more.get("notes", {}), **gate.notes(old)}}


def _rebalanced(df: DataFrame, partition: Sequence[str], late: Mapping[str, str] | None = None) -> DataFrame:
    if not partition:
        return df
    narrow = df.drop(*(late or {})).hint("rebalance", *[F.col(c) for c in partition])
    return with_late(narrow, late, df.columns)


def with_late(df: DataFrame, late: Mapping[str, str] | None, columns: Sequence[str]) -> DataFrame:
    """The columns in order, those in ``late`` made from the others."""
    return df.withColumns({n: F.expr(t) for n, t in late.items()}).select(*columns) if late else df


def absent_rows(new: DataFrame, existing: DataFrame, key: str, settings: SkewSettings = DEFAULT) -> DataFrame:
    """Rows of ``new`` whose key does not exist yet; one row per key, the smallest one."""
    whole = F.struct(*[F.col(c) for c in new.columns])
    once = new.groupBy(key).agg(F.min(whole).alias("_row")).select("_row.*")
    return lookup_join(once, existing.select(key), [key], "left_anti", settings)


def insert_absent(spark: SparkSession, new: DataFrame, path: str, key: str, gate: Gate | None = None) -> None:
    """Append rows with new keys; existing rows stay as they are. ``gate`` sees the rows as they are written."""
    existing = table_or_none(spark, path)
    fresh = nan_to_null(absent_rows(new, new.limit(0) if existing is None else existing, key))
    if existing is not None and not versions.exists(spark, path):  # plain files so far
        overwrite(existing.unionByName(fresh), path, gate=gate)
    else:
        fresh, more = _through(gate, fresh, versions.version(spark, path), {})
        versions.append(fresh, path, **more)


def merged_rows(
    target: DataFrame, delta: DataFrame, keys: Sequence[str], settings: SkewSettings = DEFAULT
) -> DataFrame:
    """Target rows replaced by delta rows of the same key, plus delta rows with new keys."""
    changed = delta.select(*keys).distinct()
    return lookup_join(target, changed, keys, "left_anti", settings, unique=True).unionByName(delta)


def latest_rows(df: DataFrame, key: str, by: str = "loaded_at") -> DataFrame:
    """One row per key: the latest, of equally late ones the largest in all columns.

    An aggregation that combines on the map side, so a key with very many corrections is no hot spot.
    """
    rest = [c for c in df.columns if c not in (key, by)]
    newest = df.groupBy(key).agg(F.max(F.struct(by, *rest)).alias("_row"))
    return newest.select(key, "_row.*").select(*df.columns)


def merge_into(
    spark: SparkSession, path: str, delta: DataFrame, keys: Sequence[str], partition: str,
    settings: SkewSettings = DEFAULT, index: DataFrame | None = None, stored: bool = False, gate: Gate | None = None,
    late: Mapping[str, str] | None = None, whole: int = 0, **more,
) -> None:
    """Keyed merge into a table partitioned by ``partition``: target rows with a key of the delta give way to its rows.

    Only partitions that hold a changed key, now or before, are written anew, once, as a new version; all others stay
    the same files; at most ``AT_ONCE`` of them per query, or more while table and delta have at most ``whole`` bytes for each. A run that stops half way leaves the old version and can be
    repeated. The list of partitions is the only thing that reaches the driver. ``index`` may name a smaller frame (keys, partition) that
    tells in which partitions a key is now; ``stored`` says that the delta is read from files and needs no copy.
    ``late`` names columns that follow from others, as SQL texts: they are made behind the shuffles, and the delta has no need of them.
    """
    target = table_or_none(spark, path)
    if target is None:
        overwrite(delta if not late else with_late(delta, late, [*delta.columns, *(c for c in late if c not in delta.columns)]), path,
                  [partition], gate, late, **more)
        return
    with WorkFolder(spark, "merge") as work:
        delta = delta if stored else work.keep(delta, "delta")
        changed = work.keep(delta.select(*keys).distinct(), "keys")
        places = (target if index is None else index).select(*keys, partition)
        held = lookup_join(places, changed, keys, "left_semi", settings, unique=True).select(partition)
        touched = [r[0] for r in held.union(delta.select(partition)).distinct().collect()]  # in any order
        if not touched:
            return
        columns, narrow = target.columns, [c for c in target.columns if c not in (late or {})]

        def merged(kept: DataFrame, came: DataFrame) -> DataFrame:
            kept = lookup_join(kept.select(*narrow), changed, keys, "left_anti", settings, unique=True)
            return with_late(kept.unionByName(came.select(*narrow)), late, columns)

        if not versions.exists(spark, path):  # plain files so far: the first version holds them all
            overwrite(merged(target, delta), path, [partition], gate, late, **more)
            return
        size = estimated_bytes(target) + estimated_bytes(delta) if whole else 0
        parts = parts_of(size, whole, -(-len(touched) // AT_ONCE))

        def write(_: DataFrame, folder: str) -> None:
            for some in (touched[i::parts] for i in range(parts)):
                here = F.col(partition).isin([t for t in some if t is not None]) | (F.col(partition).isNull() if None in some else F.lit(False))
                rows = _rebalanced(merged(target.filter(here), delta.filter(here)), [partition], late)
                rows = rows if gate is None else gate.observed(rows)
                rows.write.mode("append").option("compression", COMPRESSION).partitionBy(partition).parquet(folder)

        if gate is not None:
            more = more | {"accept": gate.accept, "notes": {**more.get("notes", {}), **gate.notes(versions.version(spark, path))}}
        versions.replace_partitions(merged(target, delta), path, partition, touched, write=write, **more)


CONTROL = "table_name string, last_loaded_at timestamp_ntz, stamped_at timestamp, stream string, batch_id long"


def _control(spark: SparkSession, path: str) -> DataFrame:
    """A row per stamped table and a row per stream with its last batch."""
    log = table_or_none(spark, path)
    if log is None:
        return spark.createDataFrame([], CONTROL)
    for name, kind in (("stream", "string"), ("batch_id", "long")):
        if name not in log.columns:  # plain files of earlier stamps
            log = log.withColumn(name, F.lit(None).cast(kind))
    return log.select("table_name", "last_loaded_at", "stamped_at", "stream", "batch_id")


def stamp(
    spark: SparkSession, path: str, marks: Mapping[str, datetime], batch: tuple[str, int] | None = None, tries: int = 20, keep: int = 3,
) -> None:
    """Set high-water marks by table name, and in the same commit the last batch of a stream (its id, batch number).

    The control table is a version with a row per table and per stream. Of two stamps the one committed later counts, whatever the
    clocks say; a writer that another one has overtaken reads the table again and repeats.
    """
    for attempt in range(tries):
        before = _control(spark, path)
        gone = F.coalesce(F.col("table_name").isin(list(marks)), F.lit(False))
        if batch:
            gone = gone | F.coalesce(F.col("stream") == batch[0], F.lit(False))
        now = [(t, at, None, None, None) for t, at in marks.items()] + ([(None, None, None, *batch)] if batch else [])
        fresh = spark.createDataFrame(now, CONTROL).withColumn("stamped_at", F.current_timestamp())
        try:
            versions.replace(before.filter(~gone).unionByName(fresh).coalesce(1), path)
        except versions.Superseded:
            if attempt + 1 == tries:
                raise
        else:
            versions.vacuum(spark, path, keep)
            return


def watermarks(spark: SparkSession, path: str) -> DataFrame:
    """Latest mark per table name: (table_name, last_loaded_at)."""
    latest = F.max_by("last_loaded_at", F.struct("stamped_at", "last_loaded_at"))  # of earlier stamps in plain files
    return _control(spark, path).filter("table_name is not null").groupBy("table_name").agg(latest.alias("last_loaded_at"))


def last_batch(spark: SparkSession, path: str, stream: str) -> int:
    """Number of the last batch of a stream that was stamped; -1 when there is none."""
    found = _control(spark, path).filter(F.col("stream") == stream).agg(F.max("batch_id")).first()[0]
    return -1 if found is None else found


def watermark(spark: SparkSession, path: str, table: str) -> datetime:
    """Mark of one table; 1970-01-01 when it has none."""
    found = watermarks(spark, path).filter(F.col("table_name") == table).collect()
    return found[0]["last_loaded_at"] if found else EPOCH


def export_csv(tables: Mapping[str, DataFrame], folder: str) -> dict[str, int]:
    """Write each table as CSV files with a header; returns the rows written per table."""
    written = {}
    for name, df in tables.items():
        seen = Observation(f"csv_{name}")
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.write.mode("overwrite").option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(f"{folder.rstrip('/')}/{name}")
        written[name] = seen.get["rows"]
    return written
