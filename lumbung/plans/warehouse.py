"""Full and incremental runs over stored layers.

Layout below ``base``: ``analytics/<model>`` for dimensions, fact, roll-up and marts, and
``control/watermark``. Staging and intermediate models stay lazy. Tables are versions (``sources.versions``): readers
see a new one when it is complete. The fact and the order roll-up are partitioned by order month, so a merge
rewrites the months it touches and date filters prune; marts follow the changed months (``plans.delta_marts``).
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import Row

from lumbung.operators import quality
from lumbung.operators.skew import DEFAULT, SkewSettings, estimated_bytes, lookup_join
from lumbung.session import WorkFolder, parts_of, side_by_side
from lumbung.sources import versions, writers

from . import delta_marts, marts
from .dimensions import dim_order_flags
from .fact import FACT_COLUMNS, LATE_KEYS, SLICE_INPUTS, fct_of_orders, fct_order_item
from .gates import ROW_KINDS, RowGate, passed_while_written, report_frame
from .intermediate import order_item_enriched
from .models import CALENDAR_END, CALENDAR_START, DIMENSIONS, MARTS, Models
from .suite import DECLARED, checked_by_model, require_passed, run_checks, singular_checks

LAST_RUN = "_dbt_last_run"  # Fixed value: name of the run stamp in the control table.
MONTH = "order_month"
HEADERS = ["orders", "payments", "shipments"]
SLICE_PARTS = 4  # Queries, by hash of the order, that make the fact rows of an incremental run, at most.


@dataclass(frozen=True)
class Warehouse:
    """Where and how a warehouse is built.

    Runs make slices, roll-ups, states and merges in several queries, so that shuffle files of one go before the next starts.
    ``whole_bytes``: a step uses no more queries than its files have times this many bytes; 0 always uses all of them.
    """

    spark: SparkSession
    base: str
    calendar: tuple[date, date] = (CALENDAR_START, CALENDAR_END)
    as_of: str = "current_date()"
    settings: SkewSettings = DEFAULT
    city_rows: int = 34
    minimum_items: int = 10_000
    check_models: Sequence[str] | None = field(default=None)
    keep_versions: int = 3
    whole_bytes: int = 0

    def path(self, model: str) -> str:
        return f"{self.base.rstrip('/')}/analytics/{model}"

    @property
    def control(self) -> str:
        return f"{self.base.rstrip('/')}/control/watermark"

    def stored(self, model: str) -> DataFrame:
        df = writers.table_or_none(self.spark, self.path(model))
        if df is None:
            raise LookupError(f"{model} is not stored yet")
        return df.select(*FACT_COLUMNS) if model == "fct_order_item" else df

    def models(self, raw: Mapping[str, DataFrame], stored: Sequence[str] = ()) -> Models:
        have = {m: self.stored(m) for m in stored}
        return Models(self.spark, raw, self.calendar, self.as_of, self.settings, have)

    # runs

    def run_full(self, raw: Mapping[str, DataFrame], check: bool = True) -> DataFrame | None:
        """Rebuild every stored model, check, stamp; returns the check report."""
        seen = self.newest_order_load(raw)
        models = self.models(raw)
        self._write_dimensions(models, DIMENSIONS, check)
        models = self.models(raw, DIMENSIONS)
        self._write_fact(models, check)
        self._write_by_month(self._rollup(self.stored("fct_order_item")), "order_rollup")
        self._write_marts(rebuild=True)
        return self.finish(raw, check, seen)

    def has_new_data(self, orders: DataFrame) -> bool:
        """Whether any order was loaded after the last run."""
        last = writers.watermark(self.spark, self.control, LAST_RUN)
        return not orders.filter(F.col("loaded_at") > F.lit(last)).isEmpty()

    def run_incremental(
        self, raw: Mapping[str, DataFrame], check: bool = True, refresh_customers: bool = False, refresh_marts: bool = True,
        refresh_headers: bool = False,
    ) -> DataFrame | None:
        """Merge the orders of items loaded since the newest fact row; None when no order is new.

        ``refresh_headers`` also takes orders whose header, payment or shipment was loaded since, though no item
        was; ``refresh_customers`` all orders of the customers of touched orders.

        Dimensions are refreshed before the fact, so that rows with a new flag combination
        or a new product find their dimension row.
        """
        if not self.has_new_data(raw["orders"]):
            return None
        seen = self.newest_order_load(raw)
        changed = self.changed_orders(raw, ["order_items", *(HEADERS if refresh_headers else [])])
        self.apply_orders(raw, changed, refresh_customers, refresh_marts, check)
        return self.finish(raw, check, seen)

    def changed_orders(self, raw: Mapping[str, DataFrame], tables: Sequence[str]) -> DataFrame:
        """Orders (order_id) with rows in the given tables that were loaded since the newest fact row."""
        newest = self.stored("fct_order_item").agg(F.max("loaded_at")).first()[0] or writers.EPOCH
        stg = self.models(raw).stg
        return reduce(DataFrame.unionByName, [stg[t].filter(F.col("loaded_at") > F.lit(newest)).select("order_id") for t in tables])

    def apply_orders(
        self, raw: Mapping[str, DataFrame], orders: DataFrame, refresh_customers: bool = False, refresh_marts: bool = True,
        check: bool = True,
    ) -> None:
        """Bring dimensions up to date, merge the facts of the given orders (order_id), refresh the marts.

        All items of a touched order are computed anew and replace all its fact rows and its roll-up row, so the
        roll-up has one row per order and the sums of the fact. Applying the same orders again leaves the tables as
        they are. With ``check``, rows are checked while they are written: a table with a violation stays as it was.
        """
        models = self.models(raw)
        self._write_dimensions(models, [d for d in DIMENSIONS if d != "dim_order_flags"], check)
        with WorkFolder(self.spark, "slice") as work:
            touched = work.keep(orders.filter("order_id is not null").distinct(), "touched")
            # New flag combinations can only come from the touched orders.
            items = lookup_join(models.stg["order_items"], touched, ["order_id"], "left_semi", self.settings)
            flags = dim_order_flags(order_item_enriched({**models.stg, "order_items": items}, self.settings))
            writers.insert_absent(self.spark, flags, self.path("dim_order_flags"), "order_flags_key", self._gate("dim_order_flags", check))
            current = self.models(raw, DIMENSIONS)
            rows = fct_of_orders(
                current.stg, current.dimensions(stored_status_and_flags=True), touched, work, self.settings, refresh_customers)
            rows = with_month(rows).drop(*LATE_KEYS)
            delta = work.keep_parts(self._in_parts(rows), "fact")
            work.drop("touched", *SLICE_INPUTS)
            # The roll-up tells in which month an order is stored; it is merged last, so a repeated run finds it as it was.
            index = writers.table_or_none(self.spark, self.path("order_rollup"))
            writers.merge_into(
                self.spark, self.path("fct_order_item"), delta, ["order_id"], MONTH, self.settings, index, stored=True,
                gate=self._gate("fct_order_item", check), late=LATE_KEYS, whole=self.whole_bytes)
            with WorkFolder(self.spark, "rollup") as sums:
                orders = sums.keep_parts(map(self._rollup, self._in_parts(delta)), "delta")
                writers.merge_into(
                    self.spark, self.path("order_rollup"), orders, ["order_id"], MONTH, self.settings, stored=True, whole=self.whole_bytes)
        if refresh_marts:
            self._write_marts()

    # steps

    def _write_dimensions(self, models: Models, names: Sequence[str], check: bool) -> None:
        """Dimensions follow from raw tables alone, so none waits for another."""
        side_by_side([lambda n=name: writers.overwrite(models[n], self.path(n), gate=self._gate(n, check)) for name in names])

    def _write_fact(self, models: Models, check: bool) -> None:
        """The whole fact; beyond ``whole_bytes`` in parts by order, over orders that are resolved once."""
        size = sum(estimated_bytes(models.stg[t]) for t in ("order_items", "orders", "payments", "shipments")) if self.whole_bytes else 0
        gate = self._gate("fct_order_item", check)
        if size <= self.whole_bytes:
            self._write_by_month(with_month(models["fct_order_item"]), "fct_order_item", gate, LATE_KEYS)
            return
        with WorkFolder(self.spark, "full") as work:
            rows = with_month(fct_order_item(models.stg, models.dimensions(), self.settings, work))
            writers.overwrite(rows, self.path("fct_order_item"), [MONTH], gate, LATE_KEYS, parts=list(self._in_parts(rows)))

    def _in_parts(self, rows: DataFrame) -> Iterator[DataFrame]:
        """The rows of some orders at a time."""
        parts = parts_of(estimated_bytes(rows) if self.whole_bytes else 0, self.whole_bytes, SLICE_PARTS)
        yield from [rows] if parts == 1 else (rows.filter(F.expr(f"pmod(xxhash64(order_id), {parts}) = {i}")) for i in range(parts))

    def _rollup(self, fact: DataFrame) -> DataFrame:
        return with_month(marts.order_rollup(fact))

    def _write_by_month(
        self, df: DataFrame, name: str, gate: RowGate | None = None, late: Mapping[str, str] | None = None
    ) -> None:
        writers.overwrite(df, self.path(name), [MONTH], gate, late)

    def _gate(self, model: str, check: bool) -> RowGate | None:
        """The row checks of a model for one write, if they are asked for."""
        chosen = self.check_models
        return RowGate(model) if check and (chosen is None or model in chosen) else None

    def _write_marts(self, rebuild: bool = False) -> None:
        """Bring the marts' states up to the newest fact and roll-up, and write the marts from them."""
        delta_marts.refresh(self.spark, self.path, rebuild, whole=self.whole_bytes)
        state = lambda name: delta_marts.sums(self.spark, name, self.path(f"state_{name}"))
        dims = {d: self.stored(d) for d in DIMENSIONS}
        side_by_side([
            lambda n=name, df=df: writers.overwrite(df, self.path(n)) for name, df in delta_marts.marts_of(state, dims, self.settings).items()])
        writers.overwrite(marts.voucher_recommendations(self.stored("mart_customer_segments")), self.path("mart_voucher_recommendations"))
        for name in [*DIMENSIONS, *MARTS, "fct_order_item", "order_rollup", *(f"state_{s}" for s in delta_marts.STATES)]:
            versions.vacuum(self.spark, self.path(name), self.keep_versions)

    def newest_order_load(self, raw: Mapping[str, DataFrame]) -> datetime:
        return raw["orders"].agg(F.max("loaded_at")).first()[0] or writers.EPOCH

    def finish(
        self, raw: Mapping[str, DataFrame], check: bool, seen: datetime, batch: tuple[str, int] | None = None
    ) -> DataFrame | None:
        """Check, then stamp the run with the newest load time it saw at its start, and a stream's batch with it.

        The wall clock would hide rows that land while the run is at work.
        """
        report = None
        if check:
            rollup, report = side_by_side([lambda: self.rollup_report().collect(), lambda: self.report(raw)])
            require_passed(report_frame(self.spark, rollup))
            require_passed(report)
        writers.stamp(self.spark, self.control, {LAST_RUN: seen}, batch)
        return report

    def report(self, raw: Mapping[str, DataFrame]) -> DataFrame:
        """Declared and singular checks over the stored models.

        Row checks of a table whose rows all went through their gates are not counted again: a violation would have
        kept its version from being committed.
        """
        stored = [*DIMENSIONS, "fct_order_item"]
        models = self.models(raw, stored)
        singular = singular_checks(models, self.city_rows, self.minimum_items)
        clean = {m for m in stored if passed_while_written(self.spark, self.path(m))}
        known = [c for c in DECLARED if c.model in clean and c.kind in ROW_KINDS]
        chosen = lambda m: self.check_models is None or m in self.check_models
        asked = [c for c in DECLARED if c not in known]
        rows = [Row(check=c.kind, model=c.model, column=c.column, n_bad=0) for c in known if chosen(c.model)]
        return report_frame(self.spark, [*rows, *checked_by_model(models, asked, singular, chosen, run=run_checks)])

    def rollup_report(self) -> DataFrame:
        """Whether the roll-up has one row per order and the sums of the fact, per order month."""
        rollup, fact = (versions.table(self.spark, self.path(t)) for t in ("order_rollup", "fct_order_item"))
        here = fact.groupBy(MONTH).agg(F.count(F.lit(1)).alias("items"), F.sum("total_payment").alias("paid"), F.sum("profit").alias("gain"))
        there = rollup.groupBy(MONTH).agg(
            F.sum("item_count").alias("items"), F.sum("total_payment").alias("paid"), F.sum("profit").alias("gain"))
        differing = here.exceptAll(there).unionByName(there.exceptAll(here))
        checks = [("unique", "order_id", quality.unique(rollup, "order_id")), ("sums_of_fact", "", differing)]
        return reduce(DataFrame.unionByName, [
            bad.agg(F.count(F.lit(1)).alias("n_bad")).select(
                F.lit(kind).alias("check"), F.lit("order_rollup").alias("model"), F.lit(column).alias("column"), "n_bad")
            for kind, column, bad in checks])

    def stamp_tables(self, raw: Mapping[str, DataFrame]) -> None:
        """Record the newest ``loaded_at`` of every raw table."""
        newest = None
        for name, df in raw.items():
            row = df.agg(F.max("loaded_at").alias("newest")).select(F.lit(name).alias("name"), "newest")
            newest = row if newest is None else newest.unionByName(row)
        writers.stamp(self.spark, self.control, {r["name"]: r["newest"] for r in newest.collect() if r["newest"]})


def with_month(fact: DataFrame) -> DataFrame:
    """Fact or roll-up rows with their storage partition, YYYYMM of the order date."""
    return fact.withColumn(MONTH, F.expr("cast(order_date_key div 100 as int)"))
