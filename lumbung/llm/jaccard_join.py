"""Similarity join of documents by Jaccard similarity of word shingles, with signature trees.

A document's set holds its distinct ``words``-word shingles of lower-cased (A-Z) words; shorter
documents have their whole word sequence as the only shingle. Two sets link when
den * |intersection| >= num * |union|. The join loses no link:

1. Documents with equal sets form a class (digest of the set); one document stands for a class.
2. Every set is ordered by (how common, hash) and its first n - ceil(num n / den) + 1 shingles are its
   prefix. Linked sets share a prefix shingle whatever the total order, so a *block* per prefix shingle
   holds all links. "How common" comes from two tables of counts over all documents, CELLS for shingles and
   WORD_CELLS for words: shingles of widely shared passages come last, and before them those without any rare word,
   which unrelated texts share by chance. So prefixes are made of shingles that few texts have, and blocks stay small.
3. Every class is compared with the smallest of the first classes of its blocks. Verified links are contracted, so a
   large group of near copies mostly becomes one component with work linear in its size.
4. Blocks that still hold several components are joined by signature trees: a node holds the OR of its
   members' token bitmaps, their size range and the component if there is only one. A bitmap has at least one bit
   a shingle, so members of a block have a tree for each width, and a wider tree is folded to the width of the narrower
   one it meets. Two trees are traversed together; a pair of nodes is pruned when the sizes are too far apart, when both
   lie in one component, or when the largest possible overlap is too small for the threshold: by the bitmaps, and by the
   places of the block's shingle in the prefixes, as the shingles before the first common one can't be common. Blocks
   of more than ``block_rows`` members are cut into chunks of that size whose roots are joined first; only
   chunk pairs that survive are dealt out to tasks.
5. Surviving pairs are verified on the whole sets, a few of each class first; what these connect needs no further
   comparison. At last all pairs of classes that are still apart follow.

Shingles are compared by 64-bit hashes, sets by 128-bit digests. Documents without words or text have no
shingles and link with nothing. Rows are never merged: a repeated doc_id gives a row each time, and a NULL
doc_id is ignored in the smallest id (NULL only if its whole component has none).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.llm.common import Scratch, checked, connected, hot_join, result, same_text, slices, table
from lumbung.session import COMPRESSION, short_shuffles

CELLS = 1 << 16
WORD_CELLS = 1 << 17
SHARED = 4  # times the mean count that makes a cell one of widely shared shingles
LANES = 16  # 64-bit lanes of the narrowest bitmap: 1024 bits
FAN = 8  # children of a tree node
PAIRS = 1 << 16  # node pairs looked at in one step
PAIR_BYTES = 1 << 22  # bitmaps of either side of node pairs that are compared at once
ROWS = 1 << 15  # rows of small blocks taken together; one with a wide bitmap counts as several
ROW_BYTES = 256
FEW = (16,)  # pairs of a class that are verified in the first rounds, before all others


class _WordHash(dict):
    """Hash of a word, remembered for the most recent words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 100_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(text: bytes | None, memo: dict) -> np.ndarray:
    tokens = (text or b"").lower().split()
    return np.fromiter(map(memo.__getitem__, tokens), np.uint64, len(tokens))


def _all_shingles(h: np.ndarray, words: int) -> np.ndarray:
    """Hashes of the shingles at each place, from word hashes."""
    if not len(h):
        return h
    size = min(words, len(h))
    out = np.full(len(h) - size + 1, size, np.uint64)
    for i in range(size):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[i: len(h) - size + 1 + i])
    return out


def shingles(text: bytes | None, words: int, memo: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text."""
    return np.unique(_all_shingles(word_hashes(text, memo), words))


def _cells(h: np.ndarray, cells: int) -> np.ndarray:
    return (h & np.uint64(cells - 1)).astype(np.int64)


def _ranked(h: np.ndarray, words: int, common: np.ndarray, word_counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles from word hashes, sorted, and how common each is: a number that depends on the shingle alone."""
    places = _all_shingles(h, words)
    found, first = np.unique(places, return_index=True)
    size = min(words, len(h))
    counts = word_counts[_cells(h, WORD_CELLS)]
    rarest = np.minimum.reduce([counts[first + i] for i in range(size)]) if size else np.empty(0, np.int64)
    often = common[_cells(found, CELLS)]
    shared = often > SHARED * max(common.mean(), 1)
    return found, np.where(shared, (1 << 62) + often, rarest)


def _texts(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column("text").cast(pa.large_binary()).to_pylist()


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64)))


def _of_class(batch: pa.RecordBatch, words: int, memo: dict) -> tuple[pa.RecordBatch, list[np.ndarray]]:
    """The rows whose set is that of their class, and these sets."""
    return _matching(batch, [shingles(t, words, memo) for t in _texts(batch)])


def _matching(batch: pa.RecordBatch, sets: list[np.ndarray]) -> tuple[pa.RecordBatch, list[np.ndarray]]:
    right = [_digest(s) == d for s, d in zip(sets, batch.column("digest").to_pylist(), strict=True)]
    return batch.filter(pa.array(right, pa.bool_())), [s for s, ok in zip(sets, right, strict=True) if ok]


def _digest(shingle_set: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(shingle_set.tobytes()) if len(shingle_set) else None


def _digests(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row (doc_id, n, digest) per document; at the end rows (cell, times) of both tables of counts, that of words last."""
        memo, cells = _WordHash(), np.zeros(CELLS + WORD_CELLS, np.int64)
        for b in slices(batches):
            hashes = [word_hashes(t, memo) for t in _texts(b)]
            sets = [np.unique(_all_shingles(h, words)) for h in hashes]
            if sets:
                cells[:CELLS] += np.bincount(_cells(np.concatenate(sets), CELLS), minlength=CELLS)
                cells[CELLS:] += np.bincount(_cells(np.concatenate(hashes), WORD_CELLS), minlength=WORD_CELLS)
            none = pa.nulls(len(sets), pa.int64())
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), b.column("text_hash"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array(map(_digest, sets), pa.binary()), none, none,
            ], ["doc_id", "text_hash", "n", "digest", "cell", "times"])
        used = np.flatnonzero(cells)
        none = pa.nulls(len(used), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [none, none, none, pa.nulls(len(used), pa.binary()), pa.array(used), pa.array(cells[used])],
            ["doc_id", "text_hash", "n", "digest", "cell", "times"],
        )
    return run


def _prefixes(words: int, num: int, den: int, common: np.ndarray, word_counts: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Size, prefix and bitmap of each class, from the text of the document that stands for it."""
        memo = _WordHash()
        for b in slices(batches):
            sizes, prefixes, wide, bits_, maps = [], [], [], [], []
            ranked = [_ranked(word_hashes(t, memo), words, common, word_counts) for t in _texts(b)]
            rank = {id(s): often for s, often in ranked}
            b, sets = _matching(b, [s for s, _ in ranked])
            for s in sets:
                length = len(s) + (num * len(s)) // -den + 1  # n - ceil(num n / den) + 1
                often = rank[id(s)]
                sizes.append(len(s))
                prefixes.append(s[np.lexsort((s, often))[:length]])
                # The wide bitmap has at least two bits per shingle; folded it gives that of the trees and the lanes.
                bits = np.zeros(max(64 * LANES, 1 << int(2 * len(s) - 1).bit_length()), bool)
                bits[((s >> np.uint64(20)) & np.uint64(len(bits) - 1)).astype(np.int64)] = True
                wide.append(np.packbits(bits).tobytes())
                bits_.append(_folded(wide[-1], max(8 * LANES, (1 << int(len(s) - 1).bit_length()) // 8)).tobytes())
                maps.append(_folded(wide[-1], 8 * LANES).view(np.int64))
            lanes = np.array(maps, np.int64).reshape(-1, LANES)
            yield pa.RecordBatch.from_arrays(
                [b.column("cid"), pa.array(sizes, pa.int64()), _lists(prefixes), pa.array(wide, pa.binary()), pa.array(bits_, pa.binary()),
                 *[pa.array(np.ascontiguousarray(lanes[:, i])) for i in range(LANES)]],
                ["cid", "n", "prefix", "wide", "bits", *_LANES],
            )
    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _WordHash()
        for b in slices(batches):
            b, found = _of_class(b, words, memo)
            yield pa.RecordBatch.from_arrays([b.column("cid"), _lists(found)], ["cid", "shingles"])
    return run


_LANES = [f"b{i}" for i in range(LANES)]
_LEAST = [f"m{i}" for i in range(4)]
_LANE_TYPES = ", ".join(f"{c} long" for c in _LANES)


def _leaves(n: np.ndarray, comp: np.ndarray, bitmap: np.ndarray, room: np.ndarray) -> tuple:
    return bitmap, n, n, np.bitwise_count(bitmap).sum(1).astype(np.int64), comp, comp, room


class SignatureTree:
    """Tree over members sorted by size; level 0 is the root, the last level the members themselves.

    ``room`` is the most shingles a member can share with another one: its size, or less.
    """

    def __init__(self, rows, n, comp, bitmap, room=None):
        order = np.lexsort((comp, n))
        self.rows = rows[order]
        level = _leaves(n[order], comp[order], bitmap[order], (n if room is None else room)[order])
        self.levels = [level]
        while len(level[1]) > 1:
            at = np.arange(0, len(level[1]), FAN)
            ors, least, most, pop, low, high, room = level
            level = (np.bitwise_or.reduceat(ors, at, 0), np.minimum.reduceat(least, at), np.maximum.reduceat(most, at),
                     np.minimum.reduceat(pop, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at),
                     np.maximum.reduceat(room, at))
            self.levels.insert(0, level)


def _possible(a: tuple, i: np.ndarray, b: tuple, j: np.ndarray, num: int, den: int) -> np.ndarray:
    """Node pairs that may hold linked members of different components."""
    most = np.minimum(np.minimum(a[6][i], b[6][j]), np.minimum(a[2][i], b[2][j]))
    fits = (num + den) * most >= num * (a[1][i] + b[1][j])
    fits &= (den * a[2][i] >= num * b[1][j]) & (den * b[2][j] >= num * a[1][i])
    fits &= ~((a[4][i] == a[5][i]) & (b[4][j] == b[5][j]) & (a[4][i] == b[4][j]))
    # Bitmaps last, so many at once that their copies stay small however wide they are.
    left, step = np.flatnonzero(fits), max(1, PAIR_BYTES // (8 * a[0].shape[1]))
    for s in range(0, len(left), step):
        k = left[s: s + step]
        p, q = i[k], j[k]
        both = np.bitwise_count(a[0][p] & b[0][q]).sum(1).astype(np.int64)
        # A member has at least as many shingles outside the other node as it has bits outside its OR.
        rest = np.minimum(a[2][p] - np.maximum(a[3][p] - both, 0), b[2][q] - np.maximum(b[3][q] - both, 0))
        fits[k] = (num + den) * rest >= num * (a[1][p] + b[1][q])
    return fits


def tree_pairs(a: SignatureTree, b: SignatureTree, num: int, den: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Dual traversal, depth first in slices: rows of members that may link. ``b is a`` joins a tree with itself."""
    start = np.zeros(1, np.int64)
    stack = [(0, 0, start, start)]
    while stack:
        x, y, i, j = stack.pop()
        ok = _possible(a.levels[x], i, b.levels[y], j, num, den)
        i, j = i[ok], j[ok]
        ends = x == len(a.levels) - 1, y == len(b.levels) - 1
        if all(ends):
            if b is a:
                i, j = i[i < j], j[i < j]
            if len(i):
                yield a.rows[i], b.rows[j]
            continue
        down_a = not ends[0] and (ends[1] or len(a.levels) - x >= len(b.levels) - y)
        down_b = not ends[1] and (ends[0] or len(b.levels) - y >= len(a.levels) - x)
        for s in range(0, len(i), PAIRS // FAN**2):
            p, q = i[s: s + PAIRS // FAN**2], j[s: s + PAIRS // FAN**2]
            if down_a:
                p, q = (p[:, None] * FAN + np.arange(FAN)).ravel(), np.repeat(q, FAN)
                inside = p < len(a.levels[x + 1][1])
                p, q = p[inside], q[inside]
            if down_b:
                q, p = (q[:, None] * FAN + np.arange(FAN)).ravel(), np.repeat(p, FAN)
                inside = q < len(b.levels[y + 1][1])
                p, q = p[inside], q[inside]
            if b is a and down_a and down_b:
                p, q = p[p <= q], q[p <= q]
            if len(p):
                stack.append((x + down_a, y + down_b, p, q))


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray]]:
    """Rows of input sorted by ``keys``, many groups at a time, none of them cut; and where each group starts."""
    held, load, enough = [], 0, ROWS

    def joined() -> tuple[dict[str, np.ndarray], np.ndarray]:
        cols = {c: np.concatenate([h[c] for h in held]) for c in held[0]}
        new = np.zeros(len(cols[keys[0]]), bool)
        for k in keys:
            new[1:] |= cols[k][1:] != cols[k][:-1]
        return cols, np.append(0, np.flatnonzero(new))

    for b in batches:
        if not b.num_rows:
            continue
        held.append({c: b.column(c).to_numpy(zero_copy_only=False) for c in b.schema.names})
        load += max(b.num_rows, b.nbytes // ROW_BYTES)
        if load < enough:
            continue
        cols, starts = joined()
        last, size = int(starts[-1]), len(cols[keys[0]])
        if last:
            yield {c: v[:last] for c, v in cols.items()}, starts[:-1]
        held, load = [{c: v[last:] for c, v in cols.items()}], load * (size - last) // size
        enough = max(ROWS, 2 * load)
    if held:
        yield joined()


def _some(i: np.ndarray, j: np.ndarray, few: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``few`` of the pairs of each i."""
    order = np.argsort(i, kind="stable")
    i, j = i[order], j[order]
    starts = np.flatnonzero(np.append(True, i[1:] != i[:-1]))
    keep = np.arange(len(i)) - np.repeat(starts, np.diff(np.append(starts, len(i)))) < few
    return i[keep], j[keep]


def _stacked(bitmaps: np.ndarray, size: int) -> np.ndarray:
    """Bitmaps of one width as rows of 64-bit lanes, folded to ``size`` bytes."""
    lanes = np.frombuffer(b"".join(bitmaps), np.uint64).reshape(len(bitmaps), -1, size // 8)
    return np.bitwise_or.reduce(lanes, 1)


def _joined(keys: list[str], num: int, den: int, few: int):
    def pairs(g: dict[str, np.ndarray], starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows of one block that may link. Sets that link have bitmaps of one width or of widths next to each other."""
        block = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(g["cid"]))))
        width = np.fromiter(map(len, g["bits"]), np.int64, len(block))
        widths, side = np.unique(width), g["side"]  # side 0: joined with itself; 1 and 2: two chunks with each other
        for w in widths:
            # A set is larger than half its bitmap, unless that is the narrowest; so much wider ones can't link.
            for v in widths[(widths >= w) & (num * widths < 2 * den * w)]:
                for x, y in ((0, 0), (1, 2), (2, 1)):
                    left, right = np.flatnonzero((width == w) & (side == x)), np.flatnonzero((width == v) & (side == y))
                    if len(left) and len(right) and (v > w or x < 2):
                        yield from between(g, block, left, right, int(w), v == w and not x, len(starts))

    def between(g, block, left, right, size: int, same: bool, blocks: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of a left and a right row of one block that may link, on bitmaps of ``size`` bytes."""
        def leaves(rows: np.ndarray) -> tuple:
            return _leaves(g["n"][rows], g["comp"][rows], _stacked(g["bits"][rows], size), (g["n"] - g["pos"])[rows])

        a = leaves(left)
        b = a if same else leaves(right)
        many, more = np.bincount(block[left], minlength=blocks), np.bincount(block[right], minlength=blocks)
        at, to = np.cumsum(many) - many, np.cumsum(more) - more
        count = np.where(many > 1, many * more, 0) if same else many * more
        # Blocks that fit into one leaf have no inner nodes: many are done at once.
        small = np.flatnonzero((count > 0) & (count <= FAN * FAN))
        for s in range(0, len(small), PAIRS // FAN**2):
            some = small[s: s + PAIRS // FAN**2]
            of = np.repeat(some, count[some])
            nth = np.arange(len(of)) - np.repeat(np.cumsum(count[some]) - count[some], count[some])
            i, j = at[of] + nth // more[of], to[of] + nth % more[of]
            if same:
                i, j = i[i < j], j[i < j]
            ok = _possible(a, i, b, j, num, den)
            yield left[i[ok]], right[j[ok]]
        for k in np.flatnonzero(count > FAN * FAN):
            one, two = slice(at[k], at[k] + many[k]), slice(to[k], to[k] + more[k])
            tree = SignatureTree(left[one], a[1][one], a[4][one], a[0][one], a[6][one])
            yield from tree_pairs(tree, tree if same else SignatureTree(right[two], b[1][two], b[4][two], b[0][two], b[6][two]), num, den)

    def first_time(g: dict[str, np.ndarray]):
        """Whether no earlier block of two rows is known to hold both: among the first open blocks of either, in the order of prefixes."""
        here = np.stack([g[x] == g["token"] for x in _LEAST])
        place = np.where(here.any(0), here.argmax(0), len(_LEAST))

        def new(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            again = np.zeros(len(i), bool)
            for x, left in enumerate(_LEAST):
                for y, right in enumerate(_LEAST):
                    again |= (x < place[i]) & (y < place[j]) & (g[left][i] == g[right][j])
            return ~again
        return new

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g, starts in _whole_groups(batches, keys):
            is_new = first_time(g)
            for i, j in pairs(g, starts):
                new = is_new(i, j)
                i, j = _some(i[new], j[new], few) if few and new.any() else (i[new], j[new])
                u, v = g["cid"][i], g["cid"][j]
                yield pa.RecordBatch.from_arrays([pa.array(np.maximum(u, v)), pa.array(np.minimum(u, v))], ["u", "v"])
    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of blocks with two classes or more, beside the first class of the block; input sorted by token, cid."""
    for g, starts in _whole_groups(batches, ["token"]):
        sizes = np.diff(np.append(starts, len(g["token"])))
        many = np.repeat(sizes > 1, sizes)
        heads = (np.repeat(x, sizes) for x in (*(g[c][starts] for c in ("cid", "n", "pos")), sizes))
        columns = [*(g[c] for c in ("token", "pos", "cid", "n")), *heads]
        yield pa.RecordBatch.from_arrays([pa.array(c[many]) for c in columns], _MEMBER)


_MEMBER = ["token", "pos", "cid", "n", "first", "first_n", "first_pos", "members"]


def _folded(bitmap: bytes, size: int) -> np.ndarray:
    return np.bitwise_or.reduce(np.frombuffer(bitmap, np.uint64).reshape(-1, size // 8), 0)


def _overlapping(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The pairs whose wide bitmaps leave room for enough overlap."""
        for b in batches:
            ok = []
            for n, m, x, y in zip(*(b.column(c).to_pylist() for c in ("un", "vn", "a", "b")), strict=True):
                size = min(len(x), len(y))
                x, y = _folded(x, size), _folded(y, size)
                most = min(n - int(np.bitwise_count(x & ~y).sum()), m - int(np.bitwise_count(y & ~x).sum()))
                ok.append((num + den) * most >= num * (n + m))
            yield b.select(["u", "v"]).filter(pa.array(ok, pa.bool_()))
    return run


def _near(a: Column, b: Column, num: int, den: int) -> Column:
    return (den * F.least(a, b)) >= (num * F.greatest(a, b))


class _Join:
    def __init__(self, docs: DataFrame, scratch: Scratch, words: int, num: int, den: int, block_rows: int, cell_rows: int, small_rows: int):
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        self.scratch, self.words, self.num, self.den, self.block_rows = scratch, words, num, den, block_rows
        self.cell_rows, self.small_rows = cell_rows, small_rows
        self.spark = docs.sparkSession

    def run(self) -> DataFrame:
        keep, words, num, den = self.scratch.keep, self.words, self.num, self.den
        hashed = self.docs.withColumn("text_hash", F.xxhash64("text"))
        first = keep(hashed.mapInArrow(
            _digests(words), "doc_id long, text_hash long, n long, digest binary, cell long, times long"), "digests")
        rows = first.filter("cell is null").select("doc_id", "text_hash", "n", "digest")
        # At most CELLS + WORD_CELLS rows, whatever the input.
        cells = first.filter("cell is not null").groupBy("cell").agg(F.sum("times").alias("times")).toArrow()
        counts = np.zeros(CELLS + WORD_CELLS, np.int64)
        counts[cells.column("cell").to_numpy()] = cells.column("times").to_numpy()
        common, word_counts = counts[:CELLS], counts[CELLS:]

        self.classes = keep(
            rows.filter("digest is not null").groupBy("digest").agg(
                F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("doc"), F.count(F.lit(1)).alias("times"))
            .select("digest", "doc.doc_id", "doc.text_hash", "times").withColumn("cid", F.monotonically_increasing_id()), "classes",
        )
        self.cells = common
        signed = keep(self._texts(self.classes).mapInArrow(
            _prefixes(words, num, den, common, word_counts), f"cid long, n long, prefix array<long>, wide binary, bits binary, {_LANE_TYPES}"), "signed")
        members = self._members(signed)
        self.signed = keep(signed.drop("prefix"), "signs")
        self.scratch.drop("signed")

        # The first class of a block is its smallest, so every member is the larger side of its pairs.
        room = (num + den) * F.expr("least(n - pos, first_n - first_pos)") >= num * F.expr("n + first_n")
        near = (F.col("cid") != F.col("first")) & _near(F.col("n"), F.col("first_n"), num, den) & room
        stars = members.filter(near).groupBy(F.col("cid").alias("u")).agg(F.min("first").alias("v"))
        stars = keep(self._verified(keep(stars, "stars"), "star"), "star_links")
        roots = connected(stars, self.scratch, "stars")

        # A few pairs of each class first, then all that are still apart.
        self.scratch.drop("stars", "star_near", "star_wanted", "star_sets")
        links, done, taken = stars, None, 0
        for few in (*FEW, 0):
            taken += few
            pairs = keep(self._tree_join(members, roots, done, few, taken), f"pairs_{few}")
            if pairs.isEmpty():
                break
            self.scratch.drop(*(f"tree_{few}_{x}" for x in ("held", "mixed", "open", "chunks", "nodes", "live")))
            links = keep(links.unionByName(self._verified(pairs, f"tree_{few}")), f"links_{few}")
            self.scratch.drop(*(f"tree_{few}_{x}" for x in ("near", "wanted", "sets")))
            roots = connected(links, self.scratch, f"links_{few}")
            done = pairs if done is None else done.unionByName(pairs)

        ids = self.classes.join(roots, self.classes["cid"] == roots["node"], "left").select(
            "digest", "doc_id", "times", F.coalesce("root", "cid").alias("root"))
        ids = keep(ids, "ids")
        least = ids.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("size"))
        named = hot_join(ids, least, "root", "size", ids.count()).select("digest", "times", "component_id")
        full = rows.filter("digest is not null")
        found = hot_join(full, keep(named, "named"), "digest", "times", full.count()).select("doc_id", "text_hash", "n", "component_id")
        bare = rows.filter("digest is null").select("doc_id", "text_hash", "n", F.col("doc_id").alias("component_id"))
        return found.unionByName(bare).withColumnRenamed("n", "n_shingles")

    def _texts(self, wanted: DataFrame) -> DataFrame:
        """(cid, text) of the documents that stand for the wanted classes (cid, digest, doc_id).

        Rows are found again by id and text hash; ``_of_class`` leaves out others that happen to agree in these.
        """
        wanted = wanted.select("cid", "digest", F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
        return self.docs.join(checked(wanted, self.small_rows), same_text()).select("cid", "digest", "text")

    def _members(self, signed: DataFrame) -> DataFrame:
        """Rows (token, pos, cid, n, first, first_n, first_pos, members) of all blocks with two classes or more.

        A cell count bounds the members of its shingles' blocks. Blocks that may exceed ``cell_rows`` are counted
        by aggregation and joined as hot keys; of the others each meets in one task.
        """
        cells = self.spark.createDataFrame(
            [(int(i),) for i in np.flatnonzero(self.cells > self.cell_rows)], "cell int")  # at most CELLS rows
        posts = signed.select(F.posexplode("prefix").alias("pos", "token"), "cid", "n").withColumn("pos", F.col("pos").cast("long"))
        cell = F.col("token").bitwiseAND(F.lit(CELLS - 1)) == F.col("cell")
        usual = posts.join(F.broadcast(cells), cell, "left_anti").repartition("token").sortWithinPartitions("token", "cid").mapInArrow(
            _blocks, ", ".join(f"{c} long" for c in _MEMBER))
        hot = posts.join(F.broadcast(cells), cell, "left_semi")
        heads = hot.groupBy("token").agg(F.min(F.struct("cid", "n", "pos")).alias("head"), F.count(F.lit(1)).alias("members")).filter("members > 1")
        total = hot.count()
        if total:
            both = hot_join(hot, heads, "token", "members", total).select("token", "pos", "cid", "n", *[
                F.col(f"head.{c}").alias(name) for c, name in (("cid", "first"), ("n", "first_n"), ("pos", "first_pos"))], "members")
            usual = usual.unionByName(both)
        return self.scratch.keep(usual, "members")

    def _verified(self, pairs: DataFrame, name: str) -> DataFrame:
        """The pairs (u, v) whose sets reach the threshold: by wide bitmaps first, then by the sets."""
        a = self.signed.select(F.col("cid").alias("u"), F.col("n").alias("un"), F.col("wide").alias("a"))
        b = self.signed.select(F.col("cid").alias("v"), F.col("n").alias("vn"), F.col("wide").alias("b"))
        pairs = pairs.join(a, "u").join(b, "v").mapInArrow(_overlapping(self.num, self.den), "u long, v long")
        pairs = self.scratch.keep(pairs.distinct(), f"{name}_near")
        wanted = pairs.select(F.col("u").alias("cid")).union(pairs.select(F.col("v").alias("cid"))).distinct()
        wanted = self.scratch.keep(self.classes.join(wanted, "cid", "left_semi").select("cid", "digest", "doc_id", "text_hash"), f"{name}_wanted")
        sets = self.scratch.keep(self._texts(wanted).mapInArrow(_sets(self.words), "cid long, shingles array<long>"), f"{name}_sets")
        a = sets.select(F.col("cid").alias("u"), F.col("shingles").alias("a"))
        b = sets.select(F.col("cid").alias("v"), F.col("shingles").alias("b"))
        both = F.size(F.array_intersect("a", "b")).cast("long")
        return pairs.join(a, "u").join(b, "v").filter(
            (self.num + self.den) * both >= self.num * (F.size("a") + F.size("b"))).select("u", "v")

    def _tree_join(self, members: DataFrame, roots: DataFrame, done: DataFrame | None, few: int, taken: int) -> DataFrame:
        """Pairs of different components that the trees cannot rule out and that are not done yet.

        With ``few``, at most so many of each class, from at most ``taken`` per block.
        """
        name, taken = f"tree_{few}", taken if few else 0
        held = members.join(roots, members["cid"] == roots["node"], "left").select(
            "token", "pos", "cid", "members", F.coalesce("root", "cid").alias("comp"))
        held = self.scratch.keep(held, f"{name}_held")
        mixed = held.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.max("members").alias("members"))
        mixed = self.scratch.keep(mixed.filter("low <> high").select("token", F.col("members").alias("size")), f"{name}_mixed")
        total = mixed.agg(F.sum("size")).first()[0]
        if not total:
            return self.spark.createDataFrame([], "u long, v long")
        open_ = self.scratch.keep(hot_join(held.drop("members"), mixed, "token", "size", total), f"{name}_open")
        # The first open blocks of each class let a pair that shares many blocks be reported (almost) once.
        first = F.slice(F.sort_array(F.collect_list(F.struct("pos", "token"))), 1, len(_LEAST))
        least = open_.groupBy("cid").agg(first.getField("token").alias("least"))
        signs = self.signed.drop("wide", *_LANES).join(least, "cid").select(
            "cid", "n", "bits", *[F.coalesce(F.get("least", F.lit(i)), F.lit((1 << 63) - 1)).alias(m) for i, m in enumerate(_LEAST)])
        usual = open_.filter(F.col("size") <= self.block_rows).join(signs, "cid").withColumn("side", F.lit(0))
        pairs = usual.repartition("token").sortWithinPartitions("token").mapInArrow(
            _joined(["token"], self.num, self.den, taken), "u long, v long")
        large = open_.filter(F.col("size") > self.block_rows)
        count = large.count()
        if count:
            lanes = self.signed.select("cid", *_LANES)
            pairs = pairs.unionByName(self._large_blocks(large.join(signs, "cid").join(lanes, "cid"), count, name, taken))
        if done is not None:
            pairs = pairs.join(done, ["u", "v"], "left_anti")
        if few:
            least = F.slice(F.sort_array(F.collect_set("v")), 1, few)
            return pairs.groupBy("u").agg(least.alias("v")).select("u", F.explode("v").alias("v"))
        return pairs.distinct()

    def _large_blocks(self, large: DataFrame, count: int, name: str, taken: int) -> DataFrame:
        """Blocks cut into chunks by component and size; chunk roots are joined first, then what survives."""
        pieces = -(-count // self.block_rows)
        chunks = self.scratch.keep(
            large.repartitionByRange(pieces, "token", "comp", "n", "cid").withColumn("chunk", F.spark_partition_id().cast("long")), f"{name}_chunks")
        nodes = chunks.groupBy("token", "chunk").agg(
            F.min("n").alias("least"), F.max("n").alias("most"), F.min("comp").alias("low"), F.max("comp").alias("high"),
            F.min(sum((F.bit_count(c) for c in _LANES), F.lit(0))).alias("pop"), *[F.bit_or(c).alias(c) for c in _LANES])
        nodes = self.scratch.keep(nodes, f"{name}_nodes")
        a, b = nodes.alias("a"), nodes.alias("b")
        both = sum((F.bit_count(F.col(f"a.{c}").bitwiseAND(F.col(f"b.{c}"))) for c in _LANES), F.lit(0))
        most = F.least(*[F.col(f"{s}.most") - F.greatest(F.col(f"{s}.pop") - both, F.lit(0)) for s in "ab"])
        one = F.expr("a.low = a.high and b.low = b.high and a.low = b.low")
        live = a.join(b, F.expr("a.token = b.token and a.chunk <= b.chunk")).filter(
            ~one & ((self.num + self.den) * most >= self.num * F.expr("a.least + b.least"))
            & F.expr(f"{self.den} * a.most >= {self.num} * b.least and {self.den} * b.most >= {self.num} * a.least")
        ).select("a.token", F.col("a.chunk").alias("ca"), F.col("b.chunk").alias("cb"))
        live = self.scratch.keep(live, f"{name}_live")
        sides = live.select("token", "ca", "cb", F.col("ca").alias("chunk"), F.when(F.expr("ca = cb"), 0).otherwise(1).alias("side")).unionByName(
            live.filter("ca <> cb").select("token", "ca", "cb", F.col("cb").alias("chunk"), F.lit(2).alias("side")))
        return chunks.drop(*_LANES).join(sides, ["token", "chunk"]).repartition("token", "ca", "cb").sortWithinPartitions(
            "token", "ca", "cb").mapInArrow(_joined(["token", "ca", "cb"], self.num, self.den, taken), "u long, v long")


def jaccard_components(docs: DataFrame, scratch: Scratch, words: int = 5, num: int = 80, den: int = 100,
                       block_rows: int = 20_000, cell_rows: int = 2_000_000, small_rows: int = 500_000) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id) for every row of ``docs`` (doc_id, text).

    ``block_rows`` is the most members of a block that one tree holds, ``cell_rows`` the most (three numbers each)
    that one task collects; ``small_rows`` the most rows of ids that are broadcast after they were counted, beyond
    it the join shuffles.
    """
    return _Join(docs, scratch, words, num, den, block_rows, cell_rows, small_rows).run()


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents by links of 85 % on 4-word shingles."""
    with short_shuffles(spark), Scratch(spark, "jaccard", COMPRESSION) as scratch:
        rows = jaccard_components(table(spark, sf_dir, "documents"), scratch, words=4, num=85)
        return result(rows.drop("text_hash"), "op8")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The document with the smallest id of each component of 80 % on five-word shingles, all columns kept.

    Rows that repeat id and text are one document and stay or go together. Documents without an id stay.
    """
    with short_shuffles(docs.sparkSession), Scratch(docs.sparkSession, "jaccard", COMPRESSION) as scratch:
        rows = jaccard_components(docs.select("doc_id", "text"), scratch)
        gone = rows.filter("doc_id <> component_id").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
        gone = checked(result(gone.distinct(), "gone"))
    return docs.join(gone, same_text(), "left_anti")
