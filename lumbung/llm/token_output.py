"""Token-ID output in shards compressed by Re-Pair grammars.

Documents are range-partitioned and sorted by doc_id, encoded whole by a public byte-level vocabulary, closed by an
end id and gathered into shards of about ``shard_ids`` ids (a longer document is a shard of its own). A shard's
ids are shortened by a grammar: in each round the frequent pairs of neighbouring symbols become nonterminals, the more
frequent pair first where two overlap, and never across documents. Symbols fit 16 bits. A shard is a row of a
Parquet file: its number, the ids of its documents and a binary payload, all little-endian:

    magic "RPG1" | u32 documents, rules, symbols, first nonterminal
    rules: u16 left, u16 right (terminals, or earlier nonterminals) | u32 expansion length per rule
    u32 per document + 1: first symbol | u64 per document + 1: first id within the shard | u16 symbols

Expansion lengths and document starts give random access: ``ids_between`` decodes any stretch of a document.
Order of rows: doc_id (NULL first), then a hash of the text; equal rows follow each other. NULL text is empty and
holds the end id alone. Other columns are not looked at.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumbung.llm.common import checked, result, slices, table
from lumbung.llm.pieces import byte_bpe, text_slots
from lumbung.session import shared_folder

MAGIC = b"RPG1"
HEAD = struct.Struct("<4s4I")
END_ID = 2
#: Terminals of the vocabulary; with at most 65,536 - TERMINALS rules a symbol has 16 bits.
TERMINALS = 50_257


def grammar(ids: np.ndarray, firsts: np.ndarray, per_round: int = 3_000, least: int = 8):
    """Symbols, where documents start among them, and rules, for ids and the starts of their documents.

    Rounds go on until no pair is seen ``least`` times (a rule takes the space of four replacements) or the
    symbols of 16 bits have run out.
    """
    symbols = ids.astype(np.uint16)
    head = np.zeros(len(ids), bool)
    head[firsts[:-1]] = True
    rules = np.empty((0, 2), np.uint16)
    while len(symbols) > 1:
        pairs = symbols[:-1].astype(np.uint32) << 16 | symbols[1:]
        inside = ~head[1:]
        codes, times = np.unique(pairs[inside], return_counts=True)
        mixed = codes * np.uint32(0x9E3779B1)  # among equally frequent pairs, in no order of the alphabet
        order = np.lexsort((mixed, -times))[: min(per_round, 65_536 - TERMINALS - len(rules))]
        order = order[times[order] >= least]
        if not len(order):
            break
        chosen = codes[order]
        # rank[i]: place of the pair at i among the chosen ones, or none
        none, by_code = len(chosen), np.argsort(chosen)
        bits = np.zeros(1 << 16, bool)
        bits[(chosen * np.uint32(0x9E3779B1)) >> np.uint32(16)] = True
        maybe = np.flatnonzero(inside & bits[(pairs * np.uint32(0x9E3779B1)) >> np.uint32(16)])
        at = np.minimum(np.searchsorted(chosen[by_code], pairs[maybe]), none - 1)
        found = chosen[by_code][at] == pairs[maybe]
        rank = np.full(len(pairs) + 2, none, np.int32)
        rank[1:-1][maybe[found]] = by_code[at[found]]
        # A pair wins against its neighbours by rank; in runs of one symbol every other pair, from the left, wins.
        here, of = rank[1:-1], rank[1:-1].copy()
        won = np.zeros(len(rank), bool)
        for _ in range(2):
            wins = (here < none) & (here <= rank[:-2]) & (here <= rank[2:])
            same = wins & (here == rank[:-2])
            if same.any():
                place = np.arange(len(here), dtype=np.int32)
                wins &= (place - np.maximum.accumulate(np.where(same, 0, place))) % 2 == 0
                wins[1:] &= ~wins[:-1]
            won[1:-1] |= wins
            here[won[1:-1] | won[:-2] | won[2:]] = none  # taken, or without one of its symbols
        where = np.flatnonzero(won[1:-1])
        used, number = np.unique(of[where], return_inverse=True)
        symbols[where] = (TERMINALS + len(rules) + number).astype(np.uint16)
        rules = np.concatenate([rules, np.stack([chosen[used] >> np.uint32(16), chosen[used] & np.uint32(0xFFFF)], 1).astype(np.uint16)])
        keep = np.ones(len(symbols), bool)
        keep[where + 1] = False
        symbols, head = symbols[keep], head[keep]
    return symbols, np.append(np.flatnonzero(head), len(symbols)), rules


def expansions(rules: np.ndarray) -> np.ndarray:
    """How many ids each nonterminal stands for."""
    sizes = np.ones(TERMINALS + len(rules), np.int64)
    for i, (a, b) in enumerate(rules):
        sizes[TERMINALS + i] = sizes[a] + sizes[b]
    return sizes[TERMINALS:]


def expanded(symbols: np.ndarray, rules: np.ndarray) -> np.ndarray:
    while True:
        inner = symbols >= TERMINALS
        if not inner.any():
            return symbols.astype(np.uint32)
        width = inner.astype(np.int64) + 1
        at = np.cumsum(width) - width
        out = np.empty(int(width.sum()), np.uint16)
        out[at[~inner]] = symbols[~inner]
        pair = rules[symbols[inner] - TERMINALS]
        out[at[inner]], out[at[inner] + 1] = pair[:, 0], pair[:, 1]
        symbols = out


def payload(ids: np.ndarray, sizes: np.ndarray) -> bytes:
    """A shard of documents with the given numbers of ids."""
    firsts = np.append(0, np.cumsum(sizes))
    symbols, starts, rules = grammar(ids, firsts)
    return b"".join([
        HEAD.pack(MAGIC, len(sizes), len(rules), len(symbols), TERMINALS), rules.astype("<u2").tobytes(),
        expansions(rules).astype("<u4").tobytes(), starts.astype("<u4").tobytes(), firsts.astype("<u8").tobytes(),
        symbols.astype("<u2").tobytes(),
    ])


class Shard:
    """A payload, read without being decoded."""

    def __init__(self, data: bytes):
        magic, docs, rules, symbols, terminals = HEAD.unpack_from(data)
        if magic != MAGIC or terminals != TERMINALS:
            raise ValueError("not a token shard")
        at = HEAD.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        self.rules = take("<u2", 2 * rules).reshape(-1, 2)
        self.sizes, self.starts, self.firsts, self.symbols = take("<u4", rules), take("<u4", docs + 1), take("<u8", docs + 1), take("<u2", symbols)

    def all_ids(self) -> np.ndarray:
        return expanded(self.symbols, self.rules)

    def ids_between(self, doc: int, start: int, stop: int) -> np.ndarray:
        """Ids [start, stop) of the doc-th document of the shard; only the symbols that cover them are expanded."""
        own = self.symbols[self.starts[doc]: self.starts[doc + 1]]
        width = np.where(own < TERMINALS, 1, self.sizes[np.maximum(own.astype(np.int64) - TERMINALS, 0)]) if len(self.sizes) else np.ones(len(own), np.int64)
        ends = np.cumsum(width)
        a, b = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
        before = int(ends[a - 1]) if a else 0
        return expanded(own[a:b], self.rules)[start - before: stop - before]


def _shards(vocabulary: str | None, shard_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = byte_bpe(vocabulary)
        ids, sizes, names, number, full = [], [], [], 0, 0

        def row() -> pa.RecordBatch:
            nonlocal ids, sizes, names, number, full
            data = payload(np.concatenate(ids), np.array(sizes, np.int64))
            out = pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([full], pa.int64()), pa.array([names], pa.list_(pa.int64())), pa.array([data], pa.binary())],
                ["shard", "n_ids", "doc_ids", "payload"])
            ids, sizes, names, number, full = [], [], [], number + 1, 0
            return out

        for b in slices(batches):
            pieces.start()
            slots = [text_slots(t or "", pieces) for t in b.column("text").to_pylist()]
            counts = pieces.counts(np.concatenate([*slots, np.empty(0, np.int64)]))
            ends = np.cumsum([0, *map(len, slots)])
            for doc, s, e, own in zip(b.column("doc_id").to_pylist(), ends, ends[1:], slots, strict=False):
                n = int(counts[s:e].sum()) + 1
                if ids and full + n > shard_ids:
                    yield row()
                ids += [pieces.ids(own), np.array([END_ID], np.uint32)]
                sizes.append(n)
                names.append(doc)
                full += n
        if ids:
            yield row()
    return run


def write_tokens(docs: DataFrame, path: str, shard_ids: int = 1_000_000, vocabulary: str | None = None) -> None:
    """Write the shards of ``docs`` (doc_id, text) below ``path``: (part, shard, n_ids, doc_ids, payload)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    shards = rows.drop("tie").mapInArrow(_shards(vocabulary, shard_ids), "shard long, n_ids long, doc_ids array<long>, payload binary")
    shards.withColumn("part", F.spark_partition_id()).write.parquet(path)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for part, number, docs, data in zip(*(b.column(c).to_pylist() for c in ("part", "shard", "doc_ids", "payload")), strict=True):
            shard = Shard(data)
            raw = shard.all_ids().astype("<u4").tobytes()
            firsts = shard.firsts.astype(np.int64)
            sums = [zlib.crc32(raw[4 * s: 4 * e]) for s, e in zip(firsts, firsts[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(docs), pa.int32()), pa.array([number] * len(docs), pa.int64()), pa.array(docs, pa.int64()),
                 pa.array(firsts[:-1]), pa.array(np.diff(firsts)), pa.array(sums, pa.int64())],
                ["part", "shard", "doc_id", "inside", "n_tokens", "ids_crc32"])


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files below ``path``."""
    shards = spark.read.parquet(path)
    sums = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))  # a row per partition of the writing job
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sums.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before_part"))
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    places = shards.select("part", "shard", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("before")).join(parts, "part")
    docs = shards.select("part", "shard", "doc_ids", "payload").mapInArrow(
        _documents, "part int, shard long, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return docs.join(checked(places), ["part", "shard"]).select(
        "doc_id", F.expr("before_part + before + inside").alias("start"), "n_tokens", "ids_crc32")


def op10_repair_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as read back from the shards."""
    path = shared_folder(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path)
    return result(read_tokens(spark, path), "op10")
