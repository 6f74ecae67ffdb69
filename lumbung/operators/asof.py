"""Point-in-time join of facts to validity intervals, and the overlap check of intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import OrderedSpec, ordered
from .skew import DEFAULT, SkewSettings


def asof_join(
    facts: DataFrame,
    versions: DataFrame,
    fact_key: str,
    fact_ts: str,
    version_key: str,
    take: Sequence[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    position: str | None = None,
    position_order: Sequence[str] = (),
    settings: SkewSettings = DEFAULT,
    unmatched: bool = False,
) -> DataFrame:
    """Add columns ``take`` of the version with ``valid_from <= fact_ts < valid_to``.

    Facts without such a version are dropped, or with ``unmatched`` stay with NULL in ``take``. The versions of a key must not overlap; empty
    ones (``valid_from = valid_to``) never match. Both sides are laid on one time line per
    key and each fact takes the version seen last, so the work is one shuffle and one sort
    however many facts and versions a key has; no fact-version pairs are built.

    ``position`` numbers the facts of a key by time and ``position_order`` in the same pass,
    counting dropped facts too.
    """
    key, ts = "_asof_key", "_asof_ts"
    tails = {f"_tail_{i}": c for i, c in enumerate(position_order)}
    # One-element arrays tell "attribute is NULL" apart from "row is not a version".
    taken = {f"_take_{i}": c for i, c in enumerate(take)}
    open_versions = versions.filter(f"{valid_from} < {valid_to}").selectExpr(
        f"{version_key} as {key}", f"{valid_from} as {ts}", "0 as _side", f"{valid_to} as _until",
        *[f"array({c}) as {t}" for t, c in taken.items()],
    )
    moments = facts.filter(f"{fact_key} is not null and {fact_ts} is not null").selectExpr(
        f"{fact_key} as {key}", f"{fact_ts} as {ts}", "1 as _side", "*", *[f"{c} as {t}" for t, c in tails.items()]
    )
    line = open_versions.unionByName(moments, allowMissingColumns=True)
    seen = {f"_seen{c}": c for c in ("_until", *taken)}
    spec = OrderedSpec(lasts=seen, sums={"_nth": "_side"} if position else {})
    # Counted on the bare keys, so that nothing above the key columns is computed twice.
    bare = versions.selectExpr(f"{version_key} as {key}").unionAll(facts.selectExpr(f"{fact_key} as {key}"))
    placed = ordered(line, [key], [ts, "_side", *tails], spec, settings, measure=bare)
    number = [f"cast(_nth as int) as {position}"] if position else []
    found = f"{ts} < _seen_until"
    if not unmatched:
        return placed.filter(f"_side = 1 and {found}").selectExpr(
            *facts.columns, *[f"_seen{t}[0] as {c}" for t, c in taken.items()], *number
        )
    kept = placed.filter("_side = 1").selectExpr(
        *facts.columns, *[f"if({found}, _seen{t}[0], null) as {c}" for t, c in taken.items()], *number
    )
    return kept.unionByName(facts.filter(f"{fact_key} is null or {fact_ts} is null"), allowMissingColumns=True)


def overlapping_versions(
    versions: DataFrame,
    key: str,
    version_id: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    settings: SkewSettings = DEFAULT,
) -> DataFrame:
    """Versions that start before an earlier version of the same key has ended.

    Rows of one version id are one version, from its first start to its last end. Empty exactly when no two
    versions of a key intersect. One ordered pass per key replaces
    the self-join, whose work and output grow with the square of the versions of a key.
    """
    once = versions.groupBy(key, version_id).agg(F.min(valid_from).alias(valid_from), F.max(valid_to).alias(valid_to))
    swept = ordered(
        once.select(key, version_id, valid_from, valid_to),
        [key], [valid_from, valid_to, version_id], OrderedSpec(peaks={"earlier_valid_to": valid_to}), settings,
    )
    return swept.filter(F.col(valid_from) < F.col("earlier_valid_to"))
