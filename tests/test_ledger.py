"""Marks and batches in one commit; a batch that comes again is passed over."""

from __future__ import annotations

import shutil
from dataclasses import dataclass, field
from datetime import datetime, timedelta

import pytest
from conftest import rows
from small import LOAD1, LOAD2, base_rows, frames, item

from lumbung.plans.warehouse import LAST_RUN, Warehouse
from lumbung.schemas import RAW_SCHEMAS
from lumbung.sources import versions, writers
from lumbung.streaming.order_items import merge_batch, start_merging


@dataclass(frozen=True)
class Recorded(Warehouse):
    """Notes which orders are applied instead of computing them."""

    applied: list = field(default_factory=list)

    def apply_orders(self, raw, orders, *more):
        self.applied.append(sorted(r[0] for r in orders.collect()))


def test_later_commit_counts_and_marks_come_with_batches(spark, tmp_path):
    path = str(tmp_path / "control")
    assert writers.last_batch(spark, path, "s") == -1
    writers.stamp(spark, path, {"orders": LOAD2, "payments": LOAD1}, ("s", 3))
    writers.stamp(spark, path, {"orders": LOAD1}, ("t", 0))  # an earlier time, committed later
    assert rows(writers.watermarks(spark, path)) == [("orders", LOAD1), ("payments", LOAD1)]
    assert (writers.last_batch(spark, path, "s"), writers.last_batch(spark, path, "t")) == (3, 0)
    for n in range(4, 8):
        writers.stamp(spark, path, {"orders": LOAD1 + timedelta(n)}, ("s", n))
    assert versions.table(spark, path).count() == 4 and len(versions.versions(spark, path)) == 3


def test_overtaken_writer_repeats_and_plain_stamps_are_taken_over(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "control")
    spark.sql("select 'orders' as table_name, timestamp_ntz'2024-01-01 00:00:00' as last_loaded_at, timestamp'2024-01-02 00:00:00' as stamped_at"
              ).write.parquet(path)
    assert writers.watermark(spark, path, "orders") == datetime(2024, 1, 1)
    replace, calls = versions.replace, []

    def overtaken(df, where, *more, **rest):
        calls.append(where)
        if len(calls) == 1:
            raise versions.Superseded
        return replace(df, where, *more, **rest)

    monkeypatch.setattr(versions, "replace", overtaken)
    writers.stamp(spark, path, {"payments": LOAD1})
    assert len(calls) == 2 and rows(writers.watermarks(spark, path)) == [("orders", datetime(2024, 1, 1)), ("payments", LOAD1)]
    monkeypatch.setattr(versions, "replace", lambda *a, **k: (_ for _ in ()).throw(versions.Superseded()))
    with pytest.raises(versions.Superseded):
        writers.stamp(spark, path, {"payments": LOAD2}, tries=2)


def test_repeated_batch_changes_neither_tables_nor_marks(spark, tmp_path):
    w, raw = Recorded(spark, str(tmp_path)), frames(spark, base_rows())
    batch = spark.createDataFrame([item(1, 100, 1), item(2, 101, 1)], RAW_SCHEMAS["order_items"])
    assert merge_batch(w, batch, ("s", 0), lambda: raw, check=False) and w.applied == [[100, 101]]
    marks = versions.version(spark, w.control).number
    assert not merge_batch(w, batch, ("s", 0), lambda: raw, check=False)
    assert w.applied == [[100, 101]] and versions.version(spark, w.control).number == marks
    assert merge_batch(w, batch, ("s", 1), lambda: raw, check=False) and merge_batch(w, batch, ("other", 0), lambda: raw, check=False)
    assert len(w.applied) == 3 and writers.watermark(spark, w.control, LAST_RUN) == LOAD1


def test_new_checkpoint_at_the_same_place_is_another_stream(spark, tmp_path):
    w, raw = Recorded(spark, str(tmp_path / "w")), frames(spark, base_rows())
    landing, checkpoint = str(tmp_path / "landing"), tmp_path / "checkpoint"
    raw["order_items"].coalesce(1).write.parquet(landing)

    def run():
        items = spark.readStream.schema(RAW_SCHEMAS["order_items"]).parquet(landing)
        start_merging(w, items, lambda: raw, str(checkpoint), check=False).awaitTermination()

    run()
    run()  # nothing new
    assert len(w.applied) == 1
    shutil.move(str(checkpoint), str(tmp_path / "old"))
    run()
    assert len(w.applied) == 2
