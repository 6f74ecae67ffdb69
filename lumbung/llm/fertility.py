"""Quality rules by tokeniser fertility, after a base rule on words.

Two public vocabularies measure every document: characters per token and token entropy under a byte-level
BPE, and the share of byte-fallback tokens under a piece vocabulary. Entropy is the mean over windows of ``WINDOW``
tokens that cover the whole text, so that it does not fall with length. Per language the
quartiles of each measure over all documents with enough words give a rejection band: documents outside
``median -+ width * (quartile range)`` go. Documents without a language, and those of languages with fewer than
``least_docs`` such documents, are held against the band of all documents of their script, whatever the
languages; where the script has too few, against the band of all documents. Only in a table with fewer than ``least_docs``
documents that have enough words is there no band, and the base rule decides alone.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.llm.common import Scratch, checked, hot_join, result, same_text, slices, table
from lumbung.llm.pieces import Pieces, byte_bpe_ranks, fallback_counts

MEASURES = ("chars_per_token", "byte_share", "entropy")
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = b"#*$%&|<>"
ASCII = bytes(range(128))
#: Tokens of a window over which entropy is taken; the last window of a text ends with it. Shorter texts are one window.
WINDOW = 64
#: From this number of words on a measure is taken to vary as much as at it: documents differ, however long they are.
STEADY_WORDS = 300
LETTERS = bytes(c for c in ASCII if chr(c).isalpha())


def repeated_words(words: np.ndarray) -> int:
    """Positions in five-word windows that occur twice or more, of words given as numbers."""
    if len(words) < 6:
        return 0
    mixed = np.zeros(len(words) - 4, np.uint64)
    for i in range(5):
        mixed = (mixed + words[i: len(words) - 4 + i].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    if len(np.unique(mixed)) == len(mixed):  # equal windows have equal hashes
        return 0
    ids = np.unique(words, return_inverse=True)[1]
    two = np.unique(ids[:-1] * len(ids) + ids[1:], return_inverse=True)[1]
    four = np.unique(two[:-2] * len(ids) + two[2:], return_inverse=True)[1]
    _, five, times = np.unique(four[:-1] * len(ids) + ids[4:], return_inverse=True, return_counts=True)
    starts = np.flatnonzero(times[five] > 1)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + 5, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def script(raw: bytes) -> str:
    """Most frequent script among the letters of a UTF-8 text, by the first word of their Unicode names."""
    found = Counter(LATIN=len(raw) - len(raw.translate(None, LETTERS)))
    for c, n in Counter(raw.translate(None, ASCII).decode()).items():
        if c.isalpha():
            found[unicodedata.name(c, "UNKNOWN").split(" ")[0].split("-")[0]] += n
    best = min(found, key=lambda s: (-found[s], s))
    return best if found[best] else "NONE"


def _counts(raw: bytes, words: np.ndarray) -> tuple:
    lines = [line for line in raw.split(b"\n") if line.strip()]
    chars = len(raw.decode()) - sum(raw.count(c) for c in SPACES)
    return len(words), chars, sum(raw.count(c) for c in SYMBOLS), len(lines) - len(set(lines)), repeated_words(words), script(raw)


def _entropy(ids: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Mean entropy of each document's windows over its greatest possible value, of ids one document after the other."""
    n, width = len(tokens), np.minimum(tokens, WINDOW)
    windows = -(-tokens // WINDOW)
    doc = np.repeat(np.arange(n), windows)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(windows) - windows, windows)
    start = (np.cumsum(tokens) - tokens)[doc] + np.minimum(nth * WINDOW, (tokens - width)[doc])
    size = width[doc]
    at = np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())
    key, times = np.unique(np.repeat(np.arange(len(doc)), size) << 20 | ids[at], return_counts=True)
    surplus = np.bincount(key >> 20, weights=times * np.log2(times), minlength=len(doc))
    full = np.maximum(size, 2)
    share = np.where(size > 1, (np.log2(full) - surplus / full) / np.log2(full), 1.0)
    return np.where(windows > 0, np.bincount(doc, weights=share, minlength=n) / np.maximum(windows, 1), 1.0)


def _measures(slots: list[np.ndarray], pieces: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per document: byte-level tokens, byte-fallback share, token entropy of its windows."""
    n = len(slots)
    words = np.concatenate([*slots, np.empty(0, np.int64)])
    doc = np.repeat(np.arange(n), [len(s) for s in slots])
    sizes = pieces.counts(words)
    tokens = np.bincount(doc, weights=sizes, minlength=n)
    second, single = (np.bincount(doc, weights=pieces.more[words, i], minlength=n) for i in (0, 1))
    entropy = _entropy(pieces.ids(words).astype(np.int64), tokens.astype(np.int64))
    return tokens, single / np.maximum(second, 1), entropy


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "script")
_TYPES = [pa.int64()] * 5 + [pa.string()]


def _measure(bpe: str | None, piece: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = byte_bpe_ranks(bpe, extra=fallback_counts(piece), width=2, cap=200_000)
        for b in slices(batches):
            pieces.start()
            texts = [t or b"" for t in b.column("text").cast(pa.large_binary()).to_pylist()]
            slots = [pieces.of(t.split()) for t in texts]
            pieces.learn()
            counts = list(zip(*map(_counts, texts, slots), strict=True)) or [[]] * len(_COUNTS)
            tokens, share, entropy = _measures(slots, pieces)
            length = np.array(counts[1], np.float64) / np.maximum(tokens, 1)
            rest = [n for n in b.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*map(b.column, rest), *(pa.array(c, t) for c, t in zip(counts, _TYPES, strict=True)), *map(pa.array, (length, share, entropy))],
                [*rest, *_COUNTS, *MEASURES])
    return run


def judged(docs: DataFrame, scratch: Scratch, width: float = 3.5, least_words: int = 30, least_docs: int = 100,
           bpe: str | None = None, piece: str | None = None) -> DataFrame:
    """Counts, measures, band and verdict (base_failed, kept) for every row of ``docs`` (doc_id, text, lang, more).

    A measure is taken as its distance from the median, times the square root of the number of words (of at most
    ``STEADY_WORDS``), because short documents vary more; the quartiles of that distance make the band. Documents below
    ``least_words`` words do not shape a band; their distance counts the less the shorter they are, so
    the tolerance is up to ``sqrt(STEADY_WORDS / 10)`` times that of long ones. A NULL text has no words and fails the base rule. Rows
    are judged one by one, repeated ones too. Columns of ``docs`` that are named like a count or measure are
    replaced.
    """
    made = {*_COUNTS, *MEASURES, "base_failed", "kept", "band", "bands", "held"}
    rest = [c for c in docs.columns if c not in {"text", "lang", *made}]
    narrow = docs.select(*rest, F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    schema = narrow.drop("text").schema
    for name, kind in [*zip(_COUNTS, ["long"] * 5 + ["string"], strict=True), *((m, "double") for m in MEASURES)]:
        schema = schema.add(name, kind)
    rows = narrow.mapInArrow(_measure(bpe, piece), schema)
    rows = rows.withColumn("base_failed", F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words"))
    rows = scratch.keep(rows.withColumn("held", F.expr(f"not base_failed and n_words >= {least_words}")), "measures")

    # Languages with enough documents have a band of their own, all other documents that of their script or of all.
    held = rows.filter("held")
    sizes = held.filter("lang is not null").groupBy("lang").agg(F.count(F.lit(1)).alias("docs")).filter(f"docs >= {least_docs}")
    scripts = held.groupBy("script").agg(F.count(F.lit(1)).alias("script_docs")).filter(f"script_docs >= {least_docs}")
    total = rows.count()
    own = F.when(F.col("docs").isNotNull(), F.concat(F.lit("lang "), "lang"))
    of_script = F.when(F.col("script_docs").isNotNull(), F.concat(F.lit("script "), "script"))
    rows = hot_join(rows, scratch.keep(sizes, "sizes"), "lang", "docs", total, "left").join(
        F.broadcast(scripts), "script", "left")  # a row per script of Unicode at most
    rows = rows.withColumn("bands", F.array_compact(F.array(own, of_script, F.lit("all")))).withColumn("band", F.col("bands")[0])
    rows = scratch.keep(rows.drop("docs", "script_docs"), "banded")
    # Every document shapes the bands of its language, its script and all.
    held = rows.filter("held").select("n_words", *MEASURES, F.explode("bands").alias("band"))
    middle = held.groupBy("band").agg(
        F.count(F.lit(1)).alias("docs"), *[F.percentile_approx(m, 0.5, 10_000).alias(f"middle_{m}") for m in MEASURES])
    middle = scratch.keep(middle.filter(f"docs >= {least_docs}"), "middle")
    far = {m: f"({m} - middle_{m}) * sqrt(least(n_words, {STEADY_WORDS}))" for m in MEASURES}
    quartiles = hot_join(held, middle, "band", "docs", 3 * total).groupBy("band").agg(
        *[F.percentile_approx(F.expr(e), [0.25, 0.5, 0.75], 10_000).alias(f"far_{m}") for m, e in far.items()])
    bands = scratch.keep(middle.join(quartiles, "band"), "bands")
    # A measure that hardly varies, as the fallback share of languages without any, has a band of at least ``slack``.
    outside = F.lit(False)
    for m, e in far.items():
        q = [F.col(f"far_{m}")[i] for i in range(3)]
        reach = F.greatest(width * (q[2] - q[0]), F.lit(1.0))
        outside = outside | (F.abs(F.expr(e) - q[1]) > reach)
    judged_rows = hot_join(rows, bands, "band", "docs", total, "left").withColumn(
        "kept", ~F.col("base_failed") & ~F.coalesce(outside, F.lit(False)))
    return judged_rows.select(*rest, "lang", *_COUNTS, *MEASURES, "band", "base_failed", "kept")


def op4_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every document."""
    with Scratch(spark, "fertility") as scratch:
        rows = judged(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), scratch)
        return result(rows.drop("lang"), "op4")


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    lang = F.col("lang").cast("string")
    prints = docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash"), "text", lang.alias("lang"))
    with Scratch(docs.sparkSession, "fertility") as scratch:
        gone = judged(prints, scratch).filter("not kept").select("_id", "_hash", F.col("lang").alias("_lang")).distinct()
        gone = checked(result(gone, "rejected"))
    return docs.join(gone, same_text() & lang.eqNullSafe(F.col("_lang")), "left_anti")
