"""A lookup is broadcast by what its rows take in memory, not by the size of well compressed files."""

from __future__ import annotations

import pytest
from conftest import rows

from lumbung.operators.skew import SkewSettings, estimated_bytes, lookup_join, row_bytes


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "left_semi", "left_anti"])
def test_many_rows_in_small_files_are_not_broadcast(spark, tmp_path, how):
    spark.range(20_000).coalesce(1).write.option("compression", "zstd").parquet(str(tmp_path / "ids"))
    ids, left = spark.read.parquet(str(tmp_path / "ids")), spark.range(0, 30_000, 7)
    size = estimated_bytes(ids)
    assert size < 20_000 * row_bytes(ids) == 20_000 * 40

    def joined(memory, rows=0):
        settings = SkewSettings(unseen_bytes=1000, broadcast_bytes=2 * size, broadcast_memory=memory, broadcast_rows=rows)
        return lookup_join(left, ids, ["id"], how, settings)

    fits, over, few = joined(20_000 * 40), joined(20_000 * 40 - 1), joined(1, 20_000)
    assert "strategy=broadcast" in plan(fits) and "strategy=broadcast" in plan(few)
    assert "strategy=broadcast" not in plan(over)
    assert "BroadcastHashJoin" not in over._jdf.queryExecution().executedPlan().toString()  # Spark's own choice goes by files
    assert rows(fits) == rows(over)


def test_texts_count_for_more_than_numbers(spark):
    assert row_bytes(spark.createDataFrame([], "a long, b string, c timestamp_ntz")) == 32 + 8 + 32 + 8
