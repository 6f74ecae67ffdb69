"""A hand-made warehouse of a few rows; every raw table as a list of tuples."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from lumbung.schemas import RAW_SCHEMAS

D1, D2, D3 = datetime(2024, 1, 10), datetime(2024, 2, 10), datetime(2024, 3, 10)
LOAD1, LOAD2 = datetime(2024, 4, 1), datetime(2024, 4, 2)


def base_rows() -> dict[str, list[tuple]]:
    return {
        "cities": [(1, "Jakarta", "DKI Jakarta", "Java", "Indonesia", LOAD1),
                   (2, "Bogor", "Jawa Barat", "Java", "Indonesia", LOAD1)],
        "categories": [(1, "Electronics", "Audio", "Electronics", LOAD1), (2, "Books", "Fiction", "Books", LOAD1)],
        "products": [(1, "SKU-ELE-00001", "Radio", 1, 1000, 700, True, D1, LOAD1),
                     (2, "SKU-BOO-00002", "Novel", 2, 500, 300, True, D1, LOAD1),
                     (3, "SKU-XXX-00003", "Orphan", 9, 500, 300, True, D1, LOAD1)],
        "payment_methods": [(1, "E-wallet", "Digital wallet", LOAD1), (3, "COD", "Cash on delivery", LOAD1)],
        "shipping_services": [(1, "JNE", "REG", "Regular", 2, 5, LOAD1)],
        "vouchers": [(1, "NO_DISCOUNT", "No discount", "none", "-", 0, 0, Decimal("0.0000"), LOAD1),
                     (2, "CASHBACK_10_MIN_200K", "Cashback", "cashback", "-", 200000, 0, Decimal("0.1000"), LOAD1)],
        "customer_profile_events": [
            (1, 10, "Ani", "Ani@X.Example", "Female", date(2000, 2, 29), 1, "New", True, D1, "insert", LOAD1),
            (2, 10, "Ani", "ani@x.example", "Female", date(2000, 2, 29), 2, "Gold", True, D2, "update", LOAD1),
            (3, 11, "Budi", "b@x.example", "Male", date(1990, 5, 1), 1, "New", False, D2, "insert", LOAD1)],
        "orders": [
            order(100, 10, D1, "delivered"),                        # exactly at valid_from
            order(101, 10, D2, "cancelled", "placed"),              # exactly at valid_to: next version
            order(102, 11, D1, "paid"),                             # before the first version: dropped
            order(103, 11, D3, "shipped")],
        "order_items": [item(1, 100, 1), item(2, 100, 2), item(3, 101, 1, cancelled=True), item(4, 102, 1),
                        item(5, 103, 2), item(6, 103, 3)],          # product 3 has no category: dropped
        "payments": [(1, 100, datetime(2024, 1, 11, 9), 1, "paid", 100, "P1", LOAD1)],
        "shipments": [
            (1, 100, 1, D1, datetime(2024, 1, 10, 6), datetime(2024, 1, 11, 0, 0, 1, 500000), 9000, 0, False,
             "delivered", "T1", LOAD1),
            (2, 103, 1, D3, datetime(2024, 3, 11), None, 9000, 0, True, "in_progress", "T2", LOAD1)],
        "order_status_events": [
            (1, 100, "placed", D1, LOAD1), (2, 100, "paid", datetime(2024, 1, 11), LOAD1),
            (3, 100, "shipped", datetime(2024, 1, 12), LOAD1),      # skips packed
            (4, 101, "placed", D2, LOAD1), (5, 101, "cancelled", D2, LOAD1)],
    }


def order(oid, customer, ts, status, stage=None, loaded=LOAD1):
    return (oid, f"ORD-{ts:%Y%m%d}-{oid:08d}", customer, ts, status, stage, 1, 1, 1, "web", "IDR", loaded)


def item(iid, oid, product, cancelled=False, number=None, total=900, voucher=0, loaded=LOAD1):
    return (iid, oid, product, number or iid, 2, 500, 1000, 100 - voucher, 0, voucher, total, 600, total - 600, False,
            cancelled, loaded)


def frames(spark, rows):
    return {t: spark.createDataFrame(rows[t], RAW_SCHEMAS[t]) for t in RAW_SCHEMAS}


def store(spark, rows, base):
    """Write the tables as Parquet and return readers that list the files again on each use."""
    from lumbung.sources.readers import raw_tables

    for t, df in frames(spark, rows).items():
        df.write.mode("append").parquet(f"{base}/{t}")
    return lambda: raw_tables(spark, str(base))
