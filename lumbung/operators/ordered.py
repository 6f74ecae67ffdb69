"""Ordered per-key calculations: positions, next values, running last values, sums and peaks.

Ordinary keys use one window per call: one shuffle, one sort. Keys too large for one task
are cut into consecutive chunks (see ``skew.split_rows``); each chunk is computed on its
own, and a summary with one row per chunk carries the running state across the cuts.
NULLs in order columns come first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .skew import DEFAULT, SkewSettings, split_rows

Named = Mapping[str, str]


@dataclass(frozen=True)
class OrderedSpec:
    """Columns to add, each as output name -> input column.

    sequence: name for the 1-based position of the row.
    nexts: value in the following row.
    lasts: latest non-NULL value up to and including this row.
    sums: running sum up to and including this row.
    peaks: largest value among the earlier rows.
    minimums, maximums, totals: over all rows of the key.
    """

    sequence: str | None = None
    nexts: Named = field(default_factory=dict)
    lasts: Named = field(default_factory=dict)
    sums: Named = field(default_factory=dict)
    peaks: Named = field(default_factory=dict)
    minimums: Named = field(default_factory=dict)
    maximums: Named = field(default_factory=dict)
    totals: Named = field(default_factory=dict)


def ordered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    spec: OrderedSpec,
    settings: SkewSettings = DEFAULT,
    measure: DataFrame | None = None,
) -> DataFrame:
    """Add the columns of ``spec``, computed per key in the given ascending order.

    ``measure`` may name a cheaper frame with at least the same rows per key to count on.
    """
    cold, hot = split_rows(df, keys, order, settings, measure)
    result = _one_window(cold, keys, order, spec)
    if hot is None:
        return result
    return result.unionByName(_chunked(hot, keys, order, spec))


def _frames(keys: Sequence[str], order: Sequence[str]):
    group = Window.partitionBy(*keys)
    line = group.orderBy(*order)
    upto = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    return group, line, upto, before


def _one_window(df: DataFrame, keys: Sequence[str], order: Sequence[str], spec: OrderedSpec) -> DataFrame:
    group, line, upto, before = _frames(keys, order)
    added: list[Column] = []
    if spec.sequence:
        added.append(F.row_number().over(line).cast("long").alias(spec.sequence))
    added += [F.lead(c).over(line).alias(n) for n, c in spec.nexts.items()]
    added += [F.last(c, ignorenulls=True).over(upto).alias(n) for n, c in spec.lasts.items()]
    added += [F.sum(c).over(upto).alias(n) for n, c in spec.sums.items()]
    added += [F.max(c).over(before).alias(n) for n, c in spec.peaks.items()]
    added += [F.min(c).over(group).alias(n) for n, c in spec.minimums.items()]
    added += [F.max(c).over(group).alias(n) for n, c in spec.maximums.items()]
    added += [F.sum(c).over(group).alias(n) for n, c in spec.totals.items()]
    return df.select("*", *added)


def _chunked(df: DataFrame, keys: Sequence[str], order: Sequence[str], spec: OrderedSpec) -> DataFrame:
    parts = [*keys, "_chunk"]
    _, line, upto, before = _frames(parts, [*order, "_tie"])

    local: list[Column] = [F.row_number().over(line).alias("_position")]
    # A one-field struct tells "no following row" apart from "following value is NULL".
    local += [F.lead(F.struct(F.col(c).alias("v"))).over(line).alias(f"_next_{n}") for n, c in spec.nexts.items()]
    local += [F.last(c, ignorenulls=True).over(upto).alias(f"_last_{n}") for n, c in spec.lasts.items()]
    local += [F.sum(c).over(upto).alias(f"_sum_{n}") for n, c in spec.sums.items()]
    local += [F.max(c).over(before).alias(f"_peak_{n}") for n, c in spec.peaks.items()]
    rows = df.select("*", *local)

    place = F.struct(*order, "_tie")
    facts: list[Column] = [F.count(F.lit(1)).alias("_n")]
    facts += [F.min_by(F.struct(F.col(c).alias("v")), place).alias(f"_first_{n}") for n, c in spec.nexts.items()]
    facts += [
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), place)).alias(f"_final_{n}") for n, c in spec.lasts.items()
    ]
    facts += [F.sum(c).alias(f"_part_{n}") for n, c in spec.sums.items()]
    facts += [F.max(c).alias(f"_top_{n}") for n, c in spec.peaks.items()]
    facts += [F.min(c).alias(f"_edge_{n}") for n, c in spec.minimums.items()]
    facts += [F.max(c).alias(f"_edge_{n}") for n, c in spec.maximums.items()]
    facts += [F.sum(c).alias(f"_edge_{n}") for n, c in spec.totals.items()]
    chunks = df.groupBy(*parts).agg(*facts)

    whole, seq, _, earlier = _frames(keys, ["_chunk"])
    carried: list[Column] = [F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")]
    carried += [F.lead(f"_first_{n}").over(seq).alias(f"_after_{n}") for n in spec.nexts]
    carried += [F.last(f"_final_{n}", ignorenulls=True).over(earlier).alias(f"_carry_{n}") for n in spec.lasts]
    carried += [F.sum(f"_part_{n}").over(earlier).alias(f"_carry_{n}") for n in spec.sums]
    carried += [F.max(f"_top_{n}").over(earlier).alias(f"_carry_{n}") for n in spec.peaks]
    carried += [F.min(f"_edge_{n}").over(whole).alias(n) for n in spec.minimums]
    carried += [F.max(f"_edge_{n}").over(whole).alias(n) for n in spec.maximums]
    carried += [F.sum(f"_edge_{n}").over(whole).alias(n) for n in spec.totals]
    # One row per (key, chunk), a few million times fewer than rows; whether that is broadcast is left to AQE.
    summary = chunks.select(*[F.col(p).alias(f"_s_{p}") for p in parts], *carried)

    cond = F.lit(True)
    for p in parts:
        cond = cond & rows[p].eqNullSafe(F.col(f"_s_{p}"))
    out = [F.col(c) for c in df.columns if c not in ("_chunk", "_tie")]
    if spec.sequence:
        out.append((F.col("_position") + F.col("_before")).cast("long").alias(spec.sequence))
    out += [F.coalesce(F.col(f"_next_{n}"), F.col(f"_after_{n}")).getField("v").alias(n) for n in spec.nexts]
    out += [F.coalesce(F.col(f"_last_{n}"), F.col(f"_carry_{n}")).alias(n) for n in spec.lasts]
    for n in spec.sums:
        here, carry = F.col(f"_sum_{n}"), F.col(f"_carry_{n}")
        out.append(F.coalesce(here + carry, here, carry).alias(n))
    out += [F.greatest(f"_peak_{n}", f"_carry_{n}").alias(n) for n in spec.peaks]
    out += [F.col(n) for n in (*spec.minimums, *spec.maximums, *spec.totals)]
    return rows.join(summary, cond, "inner").select(*out)
