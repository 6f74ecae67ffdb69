"""Alignment of two tokenizers by diagonal run skipping.

Every text is encoded by a byte-level vocabulary (A, of space + text) and by one with byte fallback (B, which adds the space
itself). Their tokens are cut into groups at the byte offsets where tokens of both end. The arrays of end offsets are walked
along a diagonal: while A token i and B token i + shift end together, stretches of doubling length are compared at once
and a bisection finds where the last one stops being equal. Where it stops, the next common end is looked for token by
token, which gives one irregular group, and the shift becomes that of the tokens behind it.

Texts that are NULL or empty, or whose tokens' bytes differ from space + text on either side, have no tokens: all
counts are 0 and the groups are ''. Control strings inside texts are plain text. Repeated rows count as documents each.
Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumbung.llm.common import Scratch, result, slices, table
from lumbung.llm.pieces import BARE, BYTE_BPE, PIECE_BPE, WHOLE, Encoded, Pieces, byte_level

#: Ids of B are stored behind those of A.
SIDE = 1 << 16


def aligned(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """For ascending ends that finish together: how many tokens of a, and of b, each group ends behind."""
    to_a: list[int] = []
    to_b: list[int] = []
    i = shift = 0
    n = len(a)
    while i < n:
        j = i + shift
        if a[i] == b[j]:
            # Double the stretch while it is equal, then bisect the last one.
            size, step = 1, 1
            while a[i + size: i + size + step] == b[j + size: j + size + step]:
                size += step
                step += step
                if i + size >= n:
                    size = n - i
                    break
            else:
                step >>= 1
                while step:
                    if a[i + size: i + size + step] == b[j + size: j + size + step]:
                        size += step
                    step >>= 1
            to_a.extend(range(i + 1, i + size + 1))
            to_b.extend(range(j + 1, j + size + 1))
            i += size
            continue
        x, y = a[i], b[j]
        while x != y:
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        i += 1
        to_a.append(i)
        to_b.append(j + 1)
        shift = j + 1 - i
    return to_a, to_b


def _byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write visible Latin-1 bytes as themselves and the others, in order, as letters from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(seen)]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabularies:
    """Both vocabularies, and the bytes of their tokens."""

    def __init__(self, path_a: str | None = None, path_b: str | None = None):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a or public_tokenizers.path(BYTE_BPE))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b or public_tokenizers.path(PIECE_BPE))
        letters = _byte_of_letter()
        words = sorted((i, w) for w, i in self.a.get_vocab(with_added_tokens=True).items())
        self.bytes_a = [bytes(letters[c] for c in w) if all(c in letters for c in w) else w.encode() for _, w in words]
        if [i for i, _ in words] != list(range(len(words))) or len(words) > SIDE:
            raise ValueError("ids of the first vocabulary have gaps or pass 16 bits")
        self.bytes_b = [
            bytes([int(self.b.id_to_piece(i)[1:-1], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()
            for i in range(self.b.vocab_size())
        ]
        self.sizes = np.zeros(2 * SIDE, np.int64)
        self.sizes[: len(self.bytes_a)] = [len(x) for x in self.bytes_a]
        self.sizes[SIDE: SIDE + len(self.bytes_b)] = [len(x) for x in self.bytes_b]
        # A token with what follows it in the text form of the groups: more of its side, or the next side.
        self.words = np.array([*(f"{i}," for i in range(SIDE)), *(f"{i}," for i in range(SIDE)),
                               *(f"{i}|" for i in range(SIDE)), *(f"{i};" for i in range(SIDE))], object)
        self._encode_a = byte_level(lambda texts: (e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)))
        self.bare = len(self.b.encode("\n"))  # what stands before a word that follows a line break
        if self._bytes_b(self.b.encode("\nx")) != b" \nx":
            raise ValueError("the second vocabulary changes line breaks")

    def _bytes_b(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes_b[i] for i in ids])

    def _parts_b(self, parts: list[str]) -> tuple[list[list[int]], list[bool]]:
        """Ids of parts by B, and whether their bytes are those of the part."""
        texts, cuts, plain = [], [], []
        for p in parts:
            if p == "\n":
                texts.append("\n"), cuts.append(self.bare - 1), plain.append(b"\n")
            elif p[0] == WHOLE:  # a space stands before it, which B adds itself
                texts.append(p[2:]), cuts.append(0), plain.append(p[1:].encode())
            elif p[0] == BARE:
                texts.append("\n" + p[1:]), cuts.append(self.bare), plain.append(p[1:].encode())
            else:
                texts.append(p), cuts.append(0), plain.append(b" " + p.encode())
        ids = [x[c:] for x, c in zip(self.b.encode(texts, num_threads=1), cuts, strict=True)]
        return ids, [self._bytes_b(x) == t for x, t in zip(ids, plain, strict=True)]

    def encode(self, parts: list[str]) -> Encoded:
        """Ids by A and, behind them, ids by B + SIDE for each part."""
        flat, starts, sizes = self._encode_a(parts)
        other, right = self._parts_b(parts)
        self._right = np.zeros((len(parts), 1), np.int64)
        for k, (p, s, n) in enumerate(zip(parts, starts.tolist(), sizes.tolist(), strict=True)):
            plain = p if p == "\n" else p[1:] if p[0] in (BARE, WHOLE) else " " + p
            self._right[k] = right[k] and b"".join([self.bytes_a[i] for i in flat[s: s + n].tolist()]) == plain.encode()
        more = np.fromiter(chain.from_iterable(other), np.uint32) + np.uint32(SIDE)
        widths = np.fromiter(map(len, other), np.int64, len(other))
        at = np.concatenate([starts, len(flat) + np.cumsum(widths) - widths])
        width = np.concatenate([sizes, widths])
        order = np.arange(2 * len(parts)).reshape(2, -1).T.ravel()  # A and B of each part in turn
        at, width = at[order], width[order]
        ends = np.cumsum(width)
        both = np.concatenate([flat, more])
        out = both[np.repeat(at - ends + width, width) + np.arange(int(ends[-1]) if len(ends) else 0)]
        sums = width.reshape(-1, 2).sum(1)
        return out, np.cumsum(sums) - sums, sums

    def faithful(self, parts: list[str]) -> np.ndarray:
        """Per part that was encoded last: 1 if the bytes of both sides are those of the part."""
        return self._right


@cache
def vocabularies(path_a: str | None = None, path_b: str | None = None) -> tuple[Vocabularies, Pieces]:
    """A Python worker keeps the vocabularies, and the memory of recent parts, from task to task."""
    v = Vocabularies(path_a, path_b)
    return v, Pieces(v.encode, v.faithful, 1)


class Groups:
    """The groups of one text."""

    def __init__(self, v: Vocabularies, ids: np.ndarray):
        first = ids < SIDE
        self.v, self.a, self.b = v, ids[first].astype(np.int64), ids[~first].astype(np.int64) - SIDE
        to_a, to_b = aligned(np.cumsum(v.sizes[self.a]).tolist(), np.cumsum(v.sizes[self.b + SIDE]).tolist())
        self.to_a, self.to_b = np.array(to_a, np.int64), np.array(to_b, np.int64)
        self.n_a, self.n_b = np.diff(self.to_a, prepend=0), np.diff(self.to_b, prepend=0)

    def text(self) -> str:
        """``a1,a2|b1;a3|b2,b3``"""
        n, m = len(self.a), len(self.b)
        of_a, of_b = np.repeat(np.arange(len(self.n_a)), self.n_a), np.repeat(np.arange(len(self.n_b)), self.n_b)
        code = np.empty(n + m, np.int64)
        last_a, last_b = np.zeros(n, np.int64), np.zeros(m, np.int64)
        last_a[self.to_a - 1], last_b[self.to_b - 1] = 2 * SIDE, 2 * SIDE
        code[np.arange(n) + (self.to_b - self.n_b)[of_a]] = self.a + last_a
        code[np.arange(m) + self.to_a[of_b]] = self.b + SIDE + last_b
        return "".join(self.v.words[code].tolist())[:-1]

    def links(self) -> np.ndarray:
        """An A id * SIDE + B id for every pair of tokens within a group."""
        per = self.n_a * self.n_b
        group = np.repeat(np.arange(len(per)), per)
        nth = np.arange(int(per.sum())) - np.repeat(np.cumsum(per) - per, per)
        x, y = np.divmod(nth, self.n_b[group])
        return self.a[(self.to_a - self.n_a)[group] + x] * SIDE + self.b[(self.to_b - self.n_b)[group] + y]


def _slots(text: str, pieces: Pieces) -> np.ndarray:
    """Slots of the parts of space + text; words between single spaces and line breaks are parts of their own."""
    if not text:
        return np.empty(0, np.int64)
    if any(c in text for c in (BARE, WHOLE, "▁")) or text.split() != text.replace("\n", " ").split(" "):
        return np.array([pieces.slots.uncached(f"{WHOLE} {text}")])
    return pieces.of(text.replace("\n", f" \n {BARE}").split(" "))


def _align(path_a: str | None, path_b: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, pieces = vocabularies(path_a, path_b)
        for b in slices(batches, 200):
            pieces.start()
            texts = b.column("text").to_pylist()
            slots = [_slots(t or "", pieces) for t in texts]
            pieces.learn()
            rows, pairs, times = [], [], []
            for t, own in zip(texts, slots, strict=True):
                if not t or not pieces.more[own].all():
                    rows.append((0, 0, 0, 0, ""))
                    pairs.append(np.empty(0, np.int64))
                    times.append(np.empty(0, np.int64))
                    continue
                g = Groups(v, pieces.ids(own))
                links = g.links()
                distinct, n = np.unique(links, return_counts=True)
                rows.append((len(g.a), len(g.b), len(g.n_a), len(links), hashlib.sha256(g.text().encode()).hexdigest()))
                pairs.append(distinct)
                times.append(n)
            offsets = pa.array(np.cumsum([0, *map(len, pairs)]), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([*x, np.empty(0, np.int64)]).astype(k))) for x, k in ((pairs, np.int64), (times, np.int32))]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(),) * 4 + (pa.string(),), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *columns, *lists], [
                "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])
    return run


def groups(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) of each row of ``docs`` (doc_id, text).

    ``pairs`` holds the distinct linked ids as A id * 65,536 + B id, ``times`` how many links each has in the text.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_align(path_a, path_b), (
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"))


def pair_counts(aligned_docs: DataFrame) -> DataFrame:
    """(pair, n, best): documents that hold a pair linked, and whether no pair of its A id has more.

    The window is per A id, which has as many rows as B has ids, at most.
    """
    counts = aligned_docs.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    of_a = Window.partitionBy(F.shiftright("pair", 16))
    return counts.withColumn("best", F.col("n") == F.max("n").over(of_a))


def alignments(docs: DataFrame, scratch: Scratch, path_a: str | None = None, path_b: str | None = None, small: int = 300_000) -> DataFrame:
    """Groups and links of every row with the corpus-wide counts of its links.

    The pairs of most documents, at most ``small`` of them, are broadcast; all other pairs are joined by a shuffle.
    """
    held = scratch.keep(groups(docs, path_a, path_b).withColumn("row", F.monotonically_increasing_id()), "groups")
    counts = scratch.keep(pair_counts(held), "counts")
    # The smallest number of documents that at most ``small`` pairs reach.
    bars = counts.groupBy("n").agg(F.count(F.lit(1)).alias("pairs"))
    reach = bars.select("n", F.sum("pairs").over(Window.orderBy(F.desc("n"))).alias("reached")) if counts.count() > small else None
    least = 0 if reach is None else reach.filter(F.col("reached") <= small).agg(F.coalesce(F.min("n"), F.lit(1 << 62))).first()[0]
    head = F.broadcast(counts.filter(F.col("n") >= least).withColumnRenamed("n", "docs"))
    links = held.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", "x.pairs", "x.times")
    seen = links.join(head, F.col("pairs") == F.col("pair"), "left" if least else "inner")

    def sums(rows: DataFrame) -> DataFrame:
        best = F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best")
        return rows.groupBy("row").agg(best, F.sum(F.col("times") * F.col("docs")).alias("count_sum"))

    found = sums(seen.filter("pair is not null"))
    if least:
        tail = counts.filter(F.col("n") < least).withColumnRenamed("n", "docs")
        rest = seen.filter("pair is null").select("row", "pairs", "times").join(tail, F.col("pairs") == F.col("pair"))
        found = found.unionByName(sums(rest)).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    plain = held.select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return plain.join(found, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its groups, links and their corpus-wide counts."""
    with Scratch(spark, "alignment") as scratch:
        return result(alignments(table(spark, sf_dir, "documents"), scratch), "op13")
