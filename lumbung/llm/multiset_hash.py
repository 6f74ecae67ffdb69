r"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A paragraph is a line (texts are split at ``\n``). Each paragraph is hashed to a wide vector; the fingerprint of a text is
the sum of its paragraphs' vectors, lane by lane, modulo powers of two. So it doesn't depend on the order of paragraphs, and
a paragraph is inserted or deleted by adding or subtracting its vector. A vector has three parts, little-endian:

    WIDE lanes modulo 2^64   from a 128-bit hash of the paragraph: equality
    NEAR lanes modulo 2^16   sum of +1 or -1 per lane over the three-word shingles of the paragraph: likeness
    one lane modulo 2^32     1: number of paragraphs

Likeness is the cosine of two texts' shingle counts, estimated from the NEAR lanes: the products of the lanes of two sums
are, on average, the product of the counts. It is within about 1 / sqrt(NEAR) of the cosine, 1 for equal fingerprints,
and cut to 0 ... 1. Words are what white space (``[\x20\x09-\x0D]``) divides; a paragraph of fewer words is one shingle.

NULL text is empty and has one empty paragraph. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumbung.llm.common import result, table

WIDE, NEAR = 8, 128
SHINGLE = 3
_STEPS = np.arange(1, WIDE + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
_LANE_STEPS = np.arange(1, NEAR // 64 + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)
_LINE = b"\xff"  # never part of UTF-8


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        self[word] = value = 0 if word == _LINE else xxhash.xxh3_64_intdigest(word) | 1
        return value


def _signs(h: np.ndarray) -> np.ndarray:
    """NEAR bits of each hash."""
    words = _mixed(h[:, None] + _LANE_STEPS[None, :])
    return np.unpackbits(words.view(np.uint8), axis=1)


def _sums(values: np.ndarray, owner: np.ndarray, size: int, slab: int = 1 << 14) -> np.ndarray:
    """Sum of +1 and -1 per lane over the hashes of each owner; owners ascend."""
    out = np.zeros((size, NEAR), np.int64)
    for s in range(0, len(values), slab):
        own = owner[s: s + slab]
        starts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        ones = np.add.reduceat(_signs(values[s: s + slab]), starts, axis=0, dtype=np.int32)
        many = np.diff(np.append(starts, len(own)))
        out[own[starts]] += 2 * ones - many[:, None]
    return out


def vectors(texts: list[bytes], memo: dict | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lanes of the fingerprints of texts: (WIDE as u64, NEAR as u16, paragraphs as u32)."""
    memo = _WordHash() if memo is None else memo
    lines = [t.split(b"\n") for t in texts]
    counts = np.fromiter(map(len, lines), np.int64, len(lines))
    flat = [x for own in lines for x in own]
    starts = np.cumsum(counts) - counts
    digests = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, flat)), np.uint64).reshape(-1, 2)
    wide = np.zeros((len(texts), WIDE), np.uint64)
    if len(texts):
        lanes = _mixed(digests[:, :1] + _mixed(digests[:, 1:] + _STEPS[None, :]))
        wide = np.add.reduceat(lanes, starts, axis=0)
    # Shingles of all lines at once: a mark stands between lines, and between texts.
    tokens, ends = [], []
    for t in texts:
        tokens += t.replace(b"\n", b" \xff ").split()
        tokens.append(_LINE)
        ends.append(len(tokens))
    h = np.fromiter(map(memo.__getitem__, tokens), np.uint64, len(tokens))
    ends, word = np.array(ends, np.int64), h != 0
    n = len(h)
    after = np.append(word, [False] * SHINGLE)
    first = word & ~np.append(False, word[:-1])
    whole = word.copy()
    for i in range(1, SHINGLE):
        whole &= after[i: n + i]
    at = np.flatnonzero(whole | first)  # full shingles, and the only one of a short line
    value = np.full(len(at), 1, np.uint64)
    inside = np.ones(len(at), bool)
    padded = np.append(h, np.zeros(SHINGLE, np.uint64))
    for i in range(SHINGLE):
        inside &= after[at + i]
        value = np.where(inside, _mixed(value * np.uint64(0x9E3779B97F4A7C15) + padded[at + i]), value)
    near = _sums(value, np.searchsorted(ends, at, "right"), len(texts)) if len(texts) else np.zeros((0, NEAR), np.int64)
    return wide, near.astype(np.uint16), counts.astype(np.uint32)


def packed_lanes(wide: np.ndarray, near: np.ndarray, counts: np.ndarray) -> list[bytes]:
    return [w.tobytes() + x.tobytes() + c.tobytes() for w, x, c in zip(wide.astype("<u8"), near.astype("<u2"), counts.astype("<u4"), strict=True)]


def lanes(fingerprint: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at = 8 * WIDE
    return (np.frombuffer(fingerprint, "<u8", WIDE), np.frombuffer(fingerprint, "<u2", NEAR, at),
            np.frombuffer(fingerprint, "<u4", 1, at + 2 * NEAR))


def fingerprint(text: str) -> bytes:
    return packed_lanes(*vectors([text.encode()]))[0]


def changed(old: bytes, inserted: list[str] = (), deleted: list[str] = ()) -> bytes:
    """The fingerprint after paragraphs are inserted and deleted, without the text."""
    parts = list(lanes(old))
    for sign, texts in ((1, inserted), (-1, deleted)):
        for text in texts:
            own = vectors([text.encode()])
            parts = [(p + x[0] if sign > 0 else p - x[0]).astype(p.dtype) for p, x in zip(parts, own, strict=True)]
    return packed_lanes(*(p[None, :] if len(p) > 1 else p for p in parts))[0]


def likeness(a: tuple, b: tuple) -> np.ndarray:
    """Likeness of the texts of two sets of lanes, row by row."""
    x, y = a[1].view(np.int16).astype(np.float64), b[1].view(np.int16).astype(np.float64)
    norm = np.sqrt((x * x).sum(1) * (y * y).sum(1))
    cosine = np.clip((x * y).sum(1) / np.where(norm > 0, norm, 1.0), 0.0, 1.0)
    same = (a[0] == b[0]).all(1) & (x == y).all(1) & (a[2] == b[2])
    return np.where(same, 1.0, cosine)


def edited(text: str, following: str) -> str:
    """The text with its last floor(n / 2) characters replaced by the first as many of the next one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_FIELDS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "part", "text", "is_first"]
_SCHEMA = ("doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, "
           "near_edited double, near_next double, part int, text string, is_first boolean")


def _rows(ids: list, texts: list[str], following: list[str], memo: dict) -> list[pa.Array]:
    """Columns of finished rows for texts and the ones that follow them."""
    new = [edited(t, f).encode() for t, f in zip(texts, following, strict=True)]
    n, plain = len(texts), [t.encode() for t in texts]
    chained = all(following[i] is texts[i + 1] for i in range(n - 1))
    wanted = [*plain, *([following[-1].encode()] if chained else [f.encode() for f in following]), *new]
    got = vectors(wanted, memo)
    own, changed_ = [x[:n] for x in got], [x[-n:] for x in got]
    then = [x[1: n + 1] if chained else x[n: 2 * n] for x in got]
    return [
        pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(x).digest() for x in new], pa.binary()), pa.array(packed_lanes(*own), pa.binary()),
        pa.array(packed_lanes(*changed_), pa.binary()), pa.array(likeness(own, changed_)), pa.array(likeness(own, then)),
    ]


def _inside(limit: int = 4 << 20):
    """Finished rows for all but the last row of a partition, and its first and last row as they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, part, ids, texts, size, begun = _WordHash(), None, [], [], 0, False

        def edge(first: bool) -> pa.RecordBatch:
            i = 0 if first else -1
            none = [pa.nulls(1, t) for t in (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64())]
            return pa.RecordBatch.from_arrays([
                pa.array([ids[i]], pa.int64()), *none, pa.array([part], pa.int32()), pa.array([texts[i]], pa.string()),
                pa.array([first], pa.bool_())], _FIELDS)

        def done() -> pa.RecordBatch:
            n = len(ids) - 1
            return pa.RecordBatch.from_arrays([
                *_rows(ids[:n], texts[:n], texts[1:], memo), pa.nulls(n, pa.int32()), pa.nulls(n, pa.string()), pa.nulls(n, pa.bool_())], _FIELDS)

        for b in batches:
            for p, i, t in zip(*(b.column(c).to_pylist() for c in ("part", "doc_id", "text")), strict=True):
                part = p
                ids.append(i)
                texts.append(t)
                size += len(t)
                if not begun:
                    begun = True
                    yield edge(True)
                if size > limit and len(ids) > 1:
                    yield done()
                    ids, texts, size = ids[-1:], texts[-1:], len(texts[-1])
        if begun:
            if len(ids) > 1:
                yield done()
            yield edge(False)
    return run


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memo = _WordHash()
    for b in batches:
        ids, texts, following = (b.column(c).to_pylist() for c in ("doc_id", "text", "following"))
        if ids:
            yield pa.RecordBatch.from_arrays(_rows(ids, texts, following, memo), _FIELDS[:7])


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row of ``docs`` (doc_id, text) and of its edited text, all binary.

    The next document is the one that follows in descending order of (doc_id, hash of the text), NULL ids last; the
    first one follows the last. Repeated rows follow each other. Partitions are ranges of that order, and equal rows may be
    cut as well. Only the first and last row of each partition are looked at again.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("row")).withColumn("tie", F.xxhash64("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("tie").desc(), F.col("row")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    held = result(ranged.withColumn("part", F.spark_partition_id()).mapInArrow(_inside(), _SCHEMA), "multiset")
    # Two rows per partition: of the parts that hold rows, each one's last row is followed by the next one's first row.
    edges = held.filter("part is not null").select("part", "is_first", "doc_id", "text")
    parts = edges.filter("is_first").select("part")
    after = parts.select("part", F.coalesce(
        F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy())).alias("next_part"))
    firsts = edges.filter("is_first").select(F.col("part").alias("next_part"), F.col("text").alias("following"))
    last = edges.filter("not is_first").join(after, "part").join(firsts, "next_part").select("doc_id", "text", "following")
    done = held.filter("part is null").select(*_FIELDS[:7])
    return done.unionByName(last.mapInArrow(_edges, done.schema))


def op12_multiset_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and its edited text; fingerprints in base64, digests in hex."""
    return fingerprints(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", F.lower(F.hex("edited_sha256")).alias("edited_sha256"), F.base64("fingerprint").alias("fingerprint"),
        F.base64("edited_fingerprint").alias("edited_fingerprint"), "near_edited", "near_next")
