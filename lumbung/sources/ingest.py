"""Loading raw tables under their declared constraints: good rows are stored, all others go to quarantine with every reason.

A row is held back when a required column is NULL (``null:<column>``), when its key or a unique column has a value that is stored
already (``stored:<column>``), or when an earlier row of the load has it (``repeated:<column>``). Of several such rows the smallest
in all columns stays; only rows that pass the NOT NULL checks and the constraints named before compete, so one bad row
doesn't push out a good one. A missing load time gets the time of the load. Constraints are judged one after the other, each
with one shuffle of the load by its column; stored values come as one column of the stored table.

Both tables are versions. Each notes the number of the load it took in last, so a load that is repeated after a failure
between the two commits adds nothing twice. Load numbers rise.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.operators.ordered import OrderedSpec, ordered
from lumbung.operators.skew import DEFAULT, SkewSettings, lookup_join
from lumbung.schemas import PRIMARY_KEYS, RAW_SCHEMAS
from lumbung.session import WorkFolder

from . import versions

# Columns that are unique beside the primary keys.
UNIQUE_COLUMNS = {"products": ("sku",), "orders": ("order_number",)}
LOAD = "load"


@dataclass(frozen=True)
class Constraints:
    """Columns of a table that must be filled, and those whose values may occur once, the key first."""

    required: tuple[str, ...]
    unique: tuple[str, ...]

    @staticmethod
    def of(table: str) -> Constraints:
        required = tuple(f.name for f in RAW_SCHEMAS[table].fields if not f.nullable)
        return Constraints(required, (PRIMARY_KEYS[table], *UNIQUE_COLUMNS.get(table, ())))


def judged(
    rows: DataFrame, stored: DataFrame | None, constraints: Constraints, settings: SkewSettings = DEFAULT
) -> DataFrame:
    """All rows with ``reasons``, an array that is empty for a row that may be stored."""
    columns = rows.columns
    missing = [F.when(F.col(c).isNull(), F.lit(f"null:{c}")) for c in constraints.required]
    found = rows.withColumn("reasons", F.array_compact(F.array(*missing)) if missing else F.array().cast("array<string>"))
    for c in constraints.unique:
        if stored is not None:
            marks = stored.filter(F.col(c).isNotNull()).select(c).distinct().withColumn("_stored", F.lit(True))
            found = lookup_join(found, marks, [c], "left", settings).select(*columns, "reasons", F.coalesce("_stored", F.lit(False)).alias("_stored"))
        else:
            found = found.withColumn("_stored", F.lit(False))
        # Rows out of the race come last, so the first place among those of one value is the row that stays.
        found = found.withColumn("_out", (F.size("reasons") > 0) | F.col("_stored"))
        place = ordered(found, [c], ["_out", *columns], OrderedSpec(sequence="_place"), settings)
        again = F.when(F.col(c).isNotNull() & ~F.col("_out") & (F.col("_place") > 1), F.lit(f"repeated:{c}"))
        held = F.when(F.col("_stored"), F.lit(f"stored:{c}"))
        found = place.select(*columns, F.concat("reasons", F.array_compact(F.array(held, again))).alias("reasons"))
    return found


def _taken(spark: SparkSession, path: str, number: int) -> bool:
    v = versions.version(spark, path)
    return bool(v and v.notes.get(LOAD, -1) >= number)


def load(
    spark: SparkSession, table: str, rows: DataFrame, base: str, quarantine: str, number: int, at: datetime,
    constraints: Constraints | None = None, settings: SkewSettings = DEFAULT,
) -> tuple[int, int]:
    """Take load ``number`` into ``<base>/<table>`` and ``<quarantine>/<table>``: (rows stored, rows held back).

    ``at`` is the load time of rows without one. (0, 0) when the load was taken in before.
    """
    good_path, bad_path = f"{base.rstrip('/')}/{table}", f"{quarantine.rstrip('/')}/{table}"
    if _taken(spark, good_path, number):
        return 0, 0
    names = [f.name for f in RAW_SCHEMAS[table].fields]
    whole = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_SCHEMAS[table].fields])
    timed = whole.withColumn("loaded_at", F.coalesce("loaded_at", F.lit(at)))
    with WorkFolder(spark, "load") as work:
        seen = work.keep(
            judged(work.keep(timed, "rows"), versions.table(spark, good_path), constraints or Constraints.of(table), settings), "judged")
        bad = seen.filter(F.size("reasons") > 0).withColumn(LOAD, F.lit(number).cast("long"))
        good = seen.filter(F.size("reasons") == 0).select(*names)
        # Good rows last: a load counts as taken in when they are stored, and quarantine knows its own number.
        if not _taken(spark, bad_path, number):
            versions.append(bad, bad_path, notes={LOAD: number})
        versions.append(good, good_path, notes={LOAD: number})
        return good.count(), bad.count()


def reason_counts(spark: SparkSession, quarantine: str, tables: Sequence[str]) -> DataFrame:
    """(table_name, load, reason, rows) over the given quarantine tables."""
    out = spark.createDataFrame([], "table_name string, load long, reason string, rows long")
    for t in tables:
        held = versions.table(spark, f"{quarantine.rstrip('/')}/{t}")
        if held is not None:
            counts = held.select(LOAD, F.explode("reasons").alias("reason")).groupBy(LOAD, "reason").agg(F.count(F.lit(1)).alias("rows"))
            out = out.unionByName(counts.select(F.lit(t).alias("table_name"), LOAD, "reason", "rows"))
    return out
