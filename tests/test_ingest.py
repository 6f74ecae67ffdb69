"""Constraints on load: what is stored, what is held back and why."""

from __future__ import annotations

from datetime import datetime

import pytest
from conftest import TINY, rows
from small import D1, LOAD1

from lumbung.operators.skew import DEFAULT
from lumbung.schemas import RAW_SCHEMAS
from lumbung.sources import ingest, versions

AT = datetime(2025, 1, 1)


def product(pid, sku, name="n", category=1, loaded=LOAD1):
    return (pid, sku, name, category, 10, 5, True, D1, loaded)


def frame(spark, values):
    from pyspark.sql import types as T

    loose = T.StructType([T.StructField(f.name, f.dataType) for f in RAW_SCHEMAS["products"].fields])
    return spark.createDataFrame(values, loose)


@pytest.mark.parametrize("settings", [DEFAULT, TINY])
def test_reasons_and_repeated_loads(spark, tmp_path, settings):
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")

    def load(number, values):
        return ingest.load(spark, "products", frame(spark, values), good, bad, number, AT, settings=settings)

    # The smaller of two rows stays; a row with a gap doesn't push out a good one; equal rows are stored once.
    assert load(0, [product(1, "A", "b"), product(1, "A2", "a"), product(2, None), product(2, "B", loaded=None),
                    product(None, "C"), product(None, None), product(3, "D"), product(3, "D")]) == (3, 5)
    assert [(r.product_id, r.sku, r.loaded_at) for r in versions.table(spark, f"{good}/products").orderBy("product_id").collect()] == [
        (1, "A", LOAD1), (2, "B", AT), (3, "D", LOAD1)]
    held = versions.table(spark, f"{bad}/products")
    assert rows(held.select("product_id", "sku", "reasons")) == sorted([
        (1, "A2", ["repeated:product_id"]), (2, None, ["null:sku"]), (None, "C", ["null:product_id"]),
        (None, None, ["null:product_id", "null:sku"]), (3, "D", ["repeated:product_id"])], key=repr)
    # Against stored rows: the key, the unique column, both; a row held back for its key leaves its sku to the next.
    second = [product(1, "Z"), product(4, "B"), product(2, "D"), product(5, "Z"), product(6, "Z")]
    assert load(1, second) == (1, 4) and load(1, second) == (0, 0) and load(0, second) == (0, 0)
    late = versions.table(spark, f"{bad}/products").filter("load = 1")
    assert rows(late.select("product_id", "reasons")) == sorted([
        (1, ["stored:product_id"]), (4, ["stored:sku"]), (2, ["stored:product_id", "stored:sku"]), (6, ["repeated:sku"])], key=repr)
    counts = {(r["load"], r["reason"]): r["rows"] for r in ingest.reason_counts(spark, bad, ["products", "orders"]).collect()}
    assert counts[1, "stored:product_id"] == 2 and counts[0, "repeated:product_id"] == 2
    assert load(2, []) == (0, 0) and versions.table(spark, f"{good}/products").count() == 4


def test_a_load_that_stopped_between_its_commits(spark, tmp_path, monkeypatch):
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    append, calls = versions.append, []

    def stopping(df, path, **more):
        calls.append(path)
        if len(calls) == 2:
            raise InterruptedError
        return append(df, path, **more)

    monkeypatch.setattr(versions, "append", stopping)
    values = [product(1, "A"), product(1, "B"), product(2, None)]
    with pytest.raises(InterruptedError):
        ingest.load(spark, "products", frame(spark, values), good, bad, 0, AT)
    assert versions.table(spark, f"{good}/products") is None
    assert ingest.load(spark, "products", frame(spark, values), good, bad, 0, AT) == (1, 2)
    assert versions.table(spark, f"{bad}/products").count() == 2
