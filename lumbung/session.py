"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "lumbung", **conf: str) -> SparkSession:
    """Session for tests and benchmarks on one machine; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Codec of the tables the library stores: half of a hashed key's text goes.
COMPRESSION = "zstd"
#: Shuffle files go when the query that made them ends, not when the driver's garbage collector finds them.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Up to this many folders are listed by the driver itself; Spark's default of 32 starts a job for the months of every table.
LISTED_FOLDERS = ("spark.sql.sources.parallelPartitionDiscovery.threshold", "256")
#: Independent queries that run at the same time. More fill no more cores, and hold the shuffle files of more queries.
SIDE_BY_SIDE = 4

T = TypeVar("T")


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within the block, a finished query leaves no shuffle files. A run of many queries otherwise holds those of all."""
    with _setting(spark, DROP_SHUFFLES, "true"):
        yield


@contextmanager
def short_listings(spark: SparkSession) -> Iterator[None]:
    """Within the block, the folders of a table are listed without a Spark job, unless there are hundreds."""
    with _setting(spark, *LISTED_FOLDERS):
        yield


def side_by_side(jobs: Sequence[Callable[[], T]], at_once: int = SIDE_BY_SIDE) -> list[T]:
    """Run independent queries at the same time, so that small ones fill the cores together; results in the order given.

    When one fails, those that have not begun are left out, and the first failure in the order given is raised once
    the others have ended.
    """
    failed = []

    def run(job: Callable[[], T]) -> T | None:
        if failed:
            return None
        try:
            return job()
        except BaseException:
            failed.append(True)
            raise

    with ThreadPoolExecutor(at_once) as pool:
        begun = [pool.submit(run, job) for job in jobs]
    return [b.result() for b in begun]


def parts_of(size: int, whole: int, most: int) -> int:
    """Queries to make ``size`` bytes in, at most ``most``: one per ``whole`` bytes begun, all of them when ``whole`` is 0."""
    return min(most, max(1, -(-size // whole))) if whole else most


class WorkFolder:
    """Folder for intermediate tables below the shared storage, removed when the block ends."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark, self.path = spark, shared_folder(spark, purpose)

    def __enter__(self) -> WorkFolder:
        return self

    def __exit__(self, *_) -> None:
        remove(self.spark, self.path)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write a frame and read it back, so that what is built on it computes it once."""
        df.write.option("compression", COMPRESSION).parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def add(self, df: DataFrame, name: str) -> DataFrame:
        """Write more rows of a kept frame, in a query of their own, and read all of them back."""
        df.write.mode("append").option("compression", COMPRESSION).parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def keep_parts(self, parts: Iterable[DataFrame], name: str) -> DataFrame:
        """Keep one frame of several parts: the shuffle files of one can go before the next one starts."""
        kept = None
        for df in parts:
            kept = self.keep(df, name) if kept is None else self.add(df, name)
        return kept

    def drop(self, *names: str) -> None:
        """Remove tables that nothing reads any more, before the block ends."""
        for name in names:
            remove(self.spark, f"{self.path}/{name}")


def remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """New folder below ``spark.checkpoint.dir``, the storage every executor can reach.

    Only a local master may fall back to the temporary folder of the machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="lumbung-")
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
