"""Mixing sources to target weights by Pfair scheduling, with DataFrame operations only.

Every source gets an integer share of a period of ``period`` slots: one slot each, the rest in proportion to the
square root of its bytes (or to given weights), by largest remainders. Its texts, in the order of md5(doc_id), are cut
into blocks of ``block_bytes``. Block j (from 0) of a source with share w of W is released at floor(j W / w) and due at
ceil((j + 1) W / w). One slot takes one block: among the released blocks the one that is due first, then the
source whose name sorts first. All shares together fill the period, so every block runs between release and
due time, and no source is ever a whole block ahead of or behind its share.

Shares repeat from period to period, so one period is scheduled and the slot of any block follows from it; no order of
all blocks is ever built in one place. The period is the least multiple of 1,000 slots with ``ROOM`` slots a source, whatever
their number, so a share differs from its weight by 1 / ROOM of the whole at most (and rounding to a slot). Up to 1,000 sources are scheduled by a fold over the slots. More are scheduled by their shares: sources of one
share have the same windows, so of blocks due at the same time those of the smallest share come first, then the
source whose name sorts first, and the driver sees one number per share. All rows are kept: when a source runs
out, its later slots stay empty and the others go on as before. Rows with a NULL source form a source of their
own. NULL text has no bytes. Equal rows share an order place; ties are broken by the text's md5.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumbung.llm.common import Scratch, checked, hot_join, result, same_text, table

#: Sources that are scheduled by a fold over the period, and its slots.
FOLDED = 1_000
#: Slots per source of a period, on average: each has one for certain, the others follow the weights.
ROOM = 20


def period_of(sources: int) -> int:
    return 1000 * max(1, -(-ROOM * sources // 1000))


def shares(sizes: DataFrame, period: int, weights: Mapping[str, int] | None) -> DataFrame:
    """(name, share) from (name, bytes); shares are at least 1 and sum to the period."""
    if weights is None:
        raw = F.floor(F.sqrt(F.col("bytes").cast("double")))
    else:
        raw = F.lit(0)
        for name, w in weights.items():
            raw = F.when(F.col("name") == f"s:{name}", F.lit(int(w))).otherwise(raw)
    whole = Window.partitionBy()
    rows = sizes.select("name", (raw + 1).cast("decimal(38,0)").alias("raw")).withColumns(
        {"all": F.sum("raw").over(whole), "sources": F.count(F.lit(1)).over(whole)})  # a row per source
    free = (F.lit(period) - F.col("sources")).cast("decimal(38,0)") * F.col("raw")
    rows = rows.withColumns({"floor": F.expr(f"cast(({period} - sources) * raw div all as long)")})
    rows = rows.withColumn("rest", free - F.col("floor") * F.col("all"))
    rank = F.row_number().over(Window.partitionBy().orderBy(F.desc("rest"), "name"))
    left = F.col("sources") * 0 + F.lit(period) - F.col("sources") - F.sum("floor").over(whole)
    return rows.select("name", (F.col("floor") + 1 + F.when(rank <= left, 1).otherwise(0)).cast("int").alias("share"))


def _schedule(share: DataFrame, period: int) -> DataFrame:
    """(name, share, nth, slot) of one period: earliest due time first among released blocks."""
    rows = share.agg(F.sort_array(F.collect_list(F.struct("name", "share"))).alias("sources")).filter("size(sources) > 0")
    due_first = """
      array_min(transform(s.done, (n, i) ->
        if(n < sources[i].share and n * {W} div sources[i].share <= t,
           named_struct('due', -(-(n + 1) * {W} div sources[i].share) + if((n + 1) * {W} % sources[i].share > 0, 1, 0), 'i', i), null)))
    """.replace("{W}", str(period)).strip()
    fold = f"""
      aggregate(sequence(0, {period - 1}),
        named_struct('done', transform(sources, x -> 0), 'picks', cast(array() as array<int>)),
        (s, t) -> element_at(transform(array({due_first}), b -> named_struct(
          'done', transform(s.done, (n, i) -> n + if(i = b.i, 1, 0)),
          'picks', array_append(s.picks, b.i))), 1),
        s -> s.picks)
    """
    picks = rows.select("sources", F.posexplode(F.expr(fold)).alias("slot", "i"))
    turn = Window.partitionBy("name").orderBy("slot")
    return picks.select(F.expr("sources[i].name").alias("name"), F.expr("sources[i].share").alias("share"), "slot").withColumn(
        "nth", F.row_number().over(turn) - 1)


def class_runs(sources: Mapping[int, int], period: int) -> list[tuple[int, int, int, int, int]]:
    """(share, nth, from, slot, count): ``count`` sources of a share, from place ``from`` by name, have their block ``nth`` at ``slot`` on.

    ``sources`` has the number of sources per share. Earliest due time first; a stretch ends when its blocks are
    done or others are released.
    """
    groups = sorted((nth * period // w, -(-(nth + 1) * period // w), w, nth) for w in sources for nth in range(w))
    ready: list[list[int]] = []
    runs, slot, at = [], 0, 0
    while ready or at < len(groups):
        while at < len(groups) and groups[at][0] <= slot:
            heapq.heappush(ready, [*groups[at][1:], 0])
            at += 1
        _, w, nth, done = ready[0]
        until = groups[at][0] if at < len(groups) else period
        count = min(sources[w] - done, until - slot)
        runs.append((w, nth, done, slot, count))
        slot += count
        if done + count == sources[w]:
            heapq.heappop(ready)
        else:
            ready[0][3] += count
    return runs


def _schedule_by_share(share: DataFrame, period: int) -> DataFrame:
    """Like ``_schedule``, by runs of sources that have one share."""
    ranked = share.withColumn("place", F.row_number().over(Window.partitionBy("share").orderBy("name")) - 1)  # a row per source
    sources = {r["share"]: r["n"] for r in share.groupBy("share").agg(F.count(F.lit(1)).alias("n")).collect()}
    # Different shares sum to the period at most, so they are fewer than sqrt(2 period).
    runs = share.sparkSession.createDataFrame(class_runs(sources, period), "share int, nth int, first long, start long, count long")
    slots = runs.select("share", "nth", "first", "start", F.explode(F.expr("sequence(first, first + count - 1)")).alias("place"))
    return ranked.join(slots, ["share", "place"]).select(
        "name", "share", (F.col("start") + F.col("place") - F.col("first")).cast("int").alias("slot"), "nth")


def source_name(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s:"), source.cast("string")), F.lit("none"))


def schedule(docs: DataFrame, scratch: Scratch, period: int | None = None, block_bytes: int = 32_768,
             weights: Mapping[str, int] | None = None, chunk_rows: int = 20_000) -> DataFrame:
    """(doc_id, hash, source, bytes, share, block, at, slot, released, due) for every row of ``docs`` (doc_id, text, source).

    ``block`` is the block in which a text starts, ``at`` the byte of its source where it starts: rows in the
    order of (slot, at) are the mixture. A text longer than a block also takes the source's next slots.
    ``period``, if given, has to have a slot for every source. ``weights`` (by source name) replaces the square roots. ``chunk_rows`` sets how many rows of a source one
    task numbers; the result doesn't depend on it.
    """
    rows = docs.select(
        "doc_id", F.xxhash64("text").alias("hash"), F.col("source").cast("string").alias("source"),
        source_name(F.col("source")).alias("name"), F.coalesce(F.octet_length(F.col("text")), F.lit(0)).cast("long").alias("bytes"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("mark"),
        F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("tie"),
    )
    rows = scratch.keep(rows, "rows")
    sizes = scratch.keep(rows.groupBy("name").agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n")), "sizes")
    sources, total = sizes.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if period is None:
        period = period_of(sources)
    if sources > period:
        raise ValueError(f"{sources} sources do not fit a period of {period} slots, as each has one at least")

    # Byte positions within a source: inside chunks of its order, then over the chunks' sums.
    digits = max(1, math.ceil(math.log(max(total / chunk_rows, 1), 16)) + 1)
    rows = rows.withColumn("chunk", F.substring("mark", 1, digits))
    inner = Window.partitionBy("name", "chunk").orderBy("mark", "doc_id", "tie").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("bytes").over(inner), F.lit(0)))
    outer = Window.partitionBy("name").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = rows.groupBy("name", "chunk").agg(F.sum("bytes").alias("sum")).select(
        "name", "chunk", F.coalesce(F.sum("sum").over(outer), F.lit(0)).alias("before"))
    placed = rows.join(chunks, ["name", "chunk"]).withColumn("at", F.col("inside") + F.col("before"))

    share = shares(sizes, period, weights)
    if sources <= FOLDED:
        plan = scratch.keep(_schedule(share, period), "plan")
        by_source = plan.select("name", "share").distinct()
    else:
        by_source = scratch.keep(share, "shares")
        plan = scratch.keep(_schedule_by_share(by_source, period), "plan")
    turns = checked(plan.select("name", "nth", F.col("slot").alias("first_slot")))
    placed = hot_join(placed, by_source.join(sizes.select("name", "n"), "name"), "name", "n", total).drop("n").withColumn(
        "block", F.expr(f"at div {block_bytes}")).withColumn("nth", (F.col("block") % F.col("share")).cast("int"))
    return placed.join(turns, ["name", "nth"]).select(
        "doc_id", "hash", "source", "bytes", "share", "block", "at",
        F.expr(f"block div share * {period} + first_slot").alias("slot"),
        F.expr(f"block * {period} div share").alias("released"),
        F.expr(f"(block + 1) * {period} div share + if((block + 1) * {period} % share > 0, 1, 0)").alias("due"),
    )


def op9_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot of every document in the mixture of all sources."""
    with Scratch(spark, "mixing") as scratch:
        rows = schedule(table(spark, sf_dir, "documents"), scratch)
        return result(rows.drop("hash"), "op9")


def interleaved(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` sorted in the order of the mixture."""
    with Scratch(docs.sparkSession, "mixing") as scratch:
        places = schedule(docs.select("doc_id", "text", "source"), scratch).groupBy(
            F.col("doc_id").alias("_id"), F.col("hash").alias("_hash")).agg(F.min(F.struct("slot", "at")).alias("_place"))
        places = result(places, "places")
    return docs.join(checked(places), same_text()).orderBy("_place", "_id", "_hash").select(*docs.columns)


ORACLE_OP9 = r"""
with recursive rows_ as (
  select doc_id, source, coalesce('s:' || source, 'none') as name, coalesce(strlen(text), 0)::bigint as bytes,
         md5(coalesce(doc_id::varchar, '')) as mark, md5(coalesce(text, '')) as tie
  from documents
), sizes as (select name, floor(sqrt(sum(bytes)::double))::bigint + 1 as raw from rows_ group by name),
period as (select greatest(1000, 1000 * ((20 * count(*) + 999) // 1000)) as p from sizes),
quota as (select name, raw, sum(raw) over ()::bigint as total, count(*) over () as sources, (select p from period) as p from sizes),
floors as (select *, ((p - sources) * raw) // total as fl, ((p - sources) * raw) % total as rest from quota),
share_ as (
  select name, p, (fl + 1 + case when row_number() over (order by rest desc, name) <= p - sources - sum(fl) over () then 1 else 0 end)::int as share
  from floors
), steps(t, name, p, share, done, picked) as (
  select 0, name, p, share, 0, false from share_
  union all
  select t + 1, name, p, share, done + (turn = 1)::int, turn = 1 from (
    select *, row_number() over (order by
      case when done < share and (done * p) // share <= t then ((done + 1) * p + share - 1) // share else 1000000000 end, name) as turn
    from steps where t < p)
), plan as (select name, p, share, done - 1 as nth, t - 1 as first_slot from steps where picked),
placed as (
  select r.*, share, sum(bytes) over (partition by r.name order by mark, doc_id, tie rows unbounded preceding)::bigint - bytes as "at"
  from rows_ r join share_ using (name)
), blocks as (select *, "at" // 32768 as block from placed)
select doc_id, source, bytes, b.share, block, "at", (block // b.share) * p + first_slot as slot,
       (block * p) // b.share as released, ((block + 1) * p + b.share - 1) // b.share as due
from blocks b join plan p on b.name = p.name and block % b.share = p.nth
"""
