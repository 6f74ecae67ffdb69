"""Data-quality checks. Each returns the violating rows or groups; empty means passed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Values that occur more than once; NULL keys are not compared."""
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return df.filter(known).groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def relationships(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Foreign keys without a parent row, with the number of child rows.

    Child keys are counted first, so the join sees each key once whatever its row count.
    """
    used = child.filter(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("missing_key")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    return used.join(parent.select(F.col(pk).alias("missing_key")), "missing_key", "left_anti")


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list, with the number of rows; NULL is not judged."""
    return df.filter(~F.col(column).isin(*values)).groupBy(F.col(column).alias("value")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


def expression_is_true(df: DataFrame, expression: str | Column) -> DataFrame:
    """Rows for which the expression is false; NULL passes."""
    condition = F.expr(expression) if isinstance(expression, str) else expression
    return df.filter(~condition)


def row_count_is(df: DataFrame, expected: int) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") != expected)


def row_count_at_least(df: DataFrame, minimum: int) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") < minimum)


def one_current_version(versions: DataFrame) -> DataFrame:
    """Customers whose number of current versions is not one; those with none are not seen."""
    return versions.filter("is_current").groupBy("customer_nk").agg(
        F.count(F.lit(1)).alias("current_row_count")
    ).filter("current_row_count <> 1")


def amount_formula(items: DataFrame) -> DataFrame:
    """Items whose payment is not subtotal minus discount minus voucher."""
    expected = F.col("subtotal") - F.col("discount_amount") - F.col("voucher_amount")
    return items.filter(F.abs(F.col("total_payment") - expected) > F.lit(0.01)).select(
        "order_item_id", "subtotal", "discount_amount", "voucher_amount", "total_payment"
    )


def profit_formula(items: DataFrame) -> DataFrame:
    """Items whose profit is not payment minus cost minus shipping subsidy."""
    expected = F.col("total_payment") - F.col("estimated_cost") - F.col("shipping_subsidy")
    return items.filter(F.abs(F.col("profit") - expected) > F.lit(0.01)).select(
        "order_item_id", "total_payment", "estimated_cost", "shipping_subsidy", "profit"
    )


REQUIRED_MEASURES = [
    "quantity", "unit_price", "subtotal", "discount_amount", "shipping_subsidy", "voucher_amount",
    "total_payment", "estimated_cost", "profit", "is_returned", "is_cancelled",
]


def missing_measures(fact: DataFrame, columns: Sequence[str] = tuple(REQUIRED_MEASURES)) -> DataFrame:
    """Number of rows with a NULL in any required column."""
    gap = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    return fact.agg(F.count(F.when(gap, 1)).alias("bad_rows"))


def missing_parents(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Number of child rows whose key, or lack of one, finds no parent row."""
    used = child.groupBy(F.col(fk).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    lost = used.join(parent.select(F.col(pk).alias("_key")), "_key", "left_anti")
    return lost.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("missing_rows"))
