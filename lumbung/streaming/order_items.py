"""Order items arriving as files, merged into the stored fact.

The file source remembers which files it has taken, which replaces the comparison of load
times: rows that arrive late or share the newest load time are not lost. A finished batch is noted in the control table
together with its stamp: delivered again after a failure, it is passed over. One that stopped before its stamp is applied again,
which the keyed merge allows.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lumbung.plans.staging import staged
from lumbung.plans.warehouse import HEADERS, Warehouse
from lumbung.schemas import RAW_SCHEMAS
from lumbung.sources import writers


def item_stream(spark: SparkSession, landing: str, files_per_batch: int = 1000) -> DataFrame:
    """Stream of raw order items landing as Parquet files."""
    reader = spark.readStream.schema(RAW_SCHEMAS["order_items"])
    return reader.option("maxFilesPerTrigger", files_per_batch).parquet(landing)


def start_merging(
    warehouse: Warehouse,
    items: DataFrame,
    raw: Callable[[], Mapping[str, DataFrame]],
    checkpoint: str,
    refresh_customers: bool = False,
    refresh_marts: bool = True,
    check: bool = True,
    refresh_headers: bool = False,
) -> StreamingQuery:
    """Process everything that has arrived, batch by batch, then stop; every batch is checked and stamped.

    ``raw`` is called for every batch, so that files added to the other raw tables are seen. Its ``order_items`` hold
    the items of the batch as well, as the orders of these are computed whole. ``refresh_headers`` also takes orders
    whose header, payment or shipment is new.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        stream = stream_id(warehouse.spark, checkpoint)
        merge_batch(warehouse, batch, (stream, batch_id), raw, refresh_customers, refresh_marts, check, refresh_headers)

    return (
        items.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id a checkpoint was made with. A new checkpoint at the same place is another stream, whose batches start again."""
    lines = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").collect()  # one line that Spark writes
    return json.loads(lines[0][0])["id"]


def merge_batch(
    warehouse: Warehouse, batch: DataFrame, number: tuple[str, int], raw: Callable[[], Mapping[str, DataFrame]],
    refresh_customers: bool = False, refresh_marts: bool = True, check: bool = True, refresh_headers: bool = False,
) -> bool:
    """Merge one batch, known by its stream and number; False when it has been merged and stamped before."""
    if number[1] <= writers.last_batch(warehouse.spark, warehouse.control, number[0]):
        return False
    tables = raw()
    seen = warehouse.newest_order_load(tables)
    touched = staged("order_items", batch).select("order_id")
    if refresh_headers:
        touched = touched.unionByName(warehouse.changed_orders(tables, HEADERS))
    warehouse.apply_orders(tables, touched, refresh_customers, refresh_marts, check)
    warehouse.finish(tables, check, seen, number)
    return True
