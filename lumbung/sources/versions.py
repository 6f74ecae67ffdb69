"""Tables as versions: data goes to new folders, and a pointer that is written last says which folders count.

Below a table's path, ``written=<n>`` holds what version n wrote (and, if the table is partitioned, a folder per value),
and ``_pointer/<n>.json`` names the schema and the folders that make up version n. A version takes over the folders of
the one before that it doesn't replace. So a run that stops half way leaves the old table as it was, a frame that
was opened earlier stays readable while the table is replaced, and two versions differ by whole folders, which
``changes`` gives as rows.

Two writers that commit the same version number don't overwrite each other: the later one gets ``Superseded`` and
its folders are never read.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lumbung.session import COMPRESSION

WRITTEN = "written"
POINTERS = "_pointer"


class Superseded(RuntimeError):
    """Another writer has committed the version first."""


@dataclass(frozen=True)
class Version:
    """What makes up one version of a table; ``notes`` are the writer's own."""

    number: int
    schema: T.StructType
    partition: tuple[str, ...]
    folders: tuple[str, ...]
    notes: Mapping[str, int] = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps({
            "number": self.number, "schema": self.schema.jsonValue(), "partition": self.partition, "folders": self.folders,
            "notes": dict(self.notes)})

    @staticmethod
    def of(text: str) -> Version:
        d = json.loads(text)
        return Version(d["number"], T.StructType.fromJson(d["schema"]), tuple(d["partition"]), tuple(d["folders"]), d["notes"])


class _Files:
    """The few file operations a table needs, on any file system Spark knows."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.base = spark._jvm, path.rstrip("/")
        self.fs = self.at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}" if name else self.base)

    def names(self, name: str) -> list[str]:
        return [s.getPath().getName() for s in self.fs.listStatus(self.at(name))] if self.fs.exists(self.at(name)) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write a whole file under a name of its own, then rename it; False when the name is taken."""
        if self.fs.exists(self.at(name)):
            return False
        draft = f"{name}.{self.jvm.java.util.UUID.randomUUID()}.draft"
        stream = self.fs.create(self.at(draft), False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if self.fs.exists(self.at(name)) or not self.fs.rename(self.at(draft), self.at(name)):
            self.remove(draft)
            return False
        return True

    def remove(self, name: str) -> None:
        self.fs.delete(self.at(name), True)


def _pointer(number: int) -> str:
    return f"{POINTERS}/{number:012d}.json"


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions that can be read, oldest first."""
    return sorted(int(n[:-5]) for n in _Files(spark, path).names(POINTERS) if n.endswith(".json"))


def version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """One version, the newest by default; None when there is none."""
    known = versions(spark, path)
    if not known or (number is not None and number not in known):
        return None
    return Version.of(_Files(spark, path).read(_pointer(known[-1] if number is None else number)))


def _rows(spark: SparkSession, path: str, v: Version, folders: Sequence[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], v.schema)
    # Each folder name is a partition value, so that folders of many versions read as one table.
    whole = T.StructType([*v.schema.fields, T.StructField(WRITTEN, T.LongType())])
    found = spark.read.schema(whole).option("basePath", path).parquet(*[f"{path.rstrip('/')}/{f}" for f in folders])
    return found.select(*v.schema.names)


def table(spark: SparkSession, path: str, number: int | None = None) -> DataFrame | None:
    """The rows of a version, the newest by default; None when there is none."""
    v = version(spark, path, number)
    return None if v is None else _rows(spark, path, v, v.folders)


def commit(
    df: DataFrame, path: str, partition: Sequence[str] = (),
    keep: Callable[[Version, set[str]], Sequence[str]] = lambda old, new: (), notes: Mapping[str, int] | None = None,
    accept: Callable[[DataFrame], None] | None = None, write: Callable[[DataFrame, str], None] | None = None,
) -> Version:
    """Write ``df`` as the next version of the table at ``path``.

    ``keep`` chooses the folders of the old version that stay, given the names of the new partition folders. ``accept``
    sees the written rows before the switch and raises to prevent it: the old version then stays the current one.
    ``write`` puts the rows as Parquet into the folder it is given, in place of the usual writer.
    """
    spark, files = df.sparkSession, _Files(df.sparkSession, path)
    old = version(spark, path)
    number = 1 + max([0, *versions(spark, path), *(int(n.split("=")[1]) for n in files.names("") if n.startswith(f"{WRITTEN}="))])
    folder = f"{WRITTEN}={number}"
    if write:
        write(df, f"{path.rstrip('/')}/{folder}")
    else:
        df.write.option("compression", COMPRESSION).partitionBy(*partition).parquet(f"{path.rstrip('/')}/{folder}")
    own = [f"{folder}/{n}" for n in files.names(folder) if "=" in n] if partition else [folder]
    kept = keep(old, {f.split("/")[-1] for f in own}) if old else ()
    new = Version(number, df.schema, tuple(partition), (*kept, *own), notes or {})
    if accept:
        accept(_rows(spark, path, new, new.folders))
    if (old.number if old else 0) != ([0, *versions(spark, path)])[-1] or not files.create(_pointer(number), new.text()):
        raise Superseded(f"version {number} of {path} was not committed: another writer was first")
    return new


def replace(df: DataFrame, path: str, partition: Sequence[str] = (), **more) -> Version:
    """A version that holds ``df`` alone."""
    return commit(df, path, partition, **more)


def append(df: DataFrame, path: str, **more) -> Version:
    """A version with the rows of ``df`` beside all earlier ones."""
    old = version(df.sparkSession, path)
    return commit(df, path, old.partition if old else (), lambda v, _: v.folders, **more)


def replace_partitions(df: DataFrame, path: str, partition: str, touched: Sequence[object], **more) -> Version:
    """A version in which ``df`` stands for the ``touched`` partition values; all other partitions stay the same folders."""
    gone = {f"{partition}={'__HIVE_DEFAULT_PARTITION__' if t is None else t}" for t in touched}
    return commit(df, path, [partition], lambda v, new: [f for f in v.folders if f.split("/")[-1] not in gone | new], **more)


def changes(spark: SparkSession, path: str, since: int) -> tuple[DataFrame, DataFrame] | None:
    """(rows of folders that went, rows of folders that came) between version ``since`` and the newest one.

    Rows that a partition holds before and after are in both. Only changed folders are read. None when either version
    can't be read any more; ``since`` 0 is the empty table.
    """
    new, old = version(spark, path), version(spark, path, since)
    if new is None or (old is None and since):
        return None
    before = set(old.folders) if old else set()
    went = [f for f in (old.folders if old else ()) if f not in set(new.folders)]
    return _rows(spark, path, old or new, went), _rows(spark, path, new, [f for f in new.folders if f not in before])


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Forget all but the newest ``keep`` versions and remove folders that none of these uses."""
    files, known = _Files(spark, path), versions(spark, path)
    for n in known[:-keep]:
        files.remove(_pointer(n))
    held = [Version.of(files.read(_pointer(n))) for n in known[-keep:]]
    used = {f for v in held for f in v.folders}
    for top in files.names(""):
        if not top.startswith(f"{WRITTEN}=") or (held and int(top.split("=")[1]) > held[-1].number):
            continue  # of a writer that may still be at work
        if not any(f == top or f.startswith(f"{top}/") for f in used):
            files.remove(top)
        elif top not in used:
            for part in files.names(top):
                if "=" in part and f"{top}/{part}" not in used:
                    files.remove(f"{top}/{part}")


def exists(spark: SparkSession, path: str) -> bool:
    return bool(versions(spark, path))


def plain_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """A plain Parquet folder, or None when there is none yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
