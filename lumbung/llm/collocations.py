"""Phrase collocations, counted by prefix-free parsing.

Texts are lower-cased (A-Z), split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and these into words. A piece is parsed into
chunks: wherever the hash of two neighbouring words is a multiple of ``spacing``, a chunk ends with these two words and
the next one starts with them. What triggers a cut is content alone, so repeated passages give the same chunks
whatever surrounds them. Distinct chunks form the dictionary, with their number of occurrences in the parse.

Phrases of up to three words are counted inside distinct chunks, weighted by that number. Neighbouring chunks share two
words; a phrase belongs to the chunk in which it starts before the shared words, so it is counted once and lies
inside that chunk. Counting goes up by length: words first, then pairs of frequent words, then triples
of frequent pairs. Frequent ones are looked up in a bitmap of fixed size, which may let others pass but loses none.

Everything is per lang; NULL lang is ``und``. NULL text is empty, and a text without words adds nothing. Repeated rows
count each time. Chunks, phrases and words are spread by (lang, phrase) after partial sums, so a hot language or phrase
is summed before it is shuffled. Other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumbung.llm.common import Scratch, result, slices, table

SHARED = 2  # words that neighbouring chunks share: phrases have one word more at most
BITS = 1 << 25  # of the bitmap of frequent phrases
HELD = 200_000  # entries that a task sums before it hands them on
MARK = b"\xff"  # never part of UTF-8

_SPLIT = bytes(
    0xFF if c in b".,;:!?\n\x0b\x0c\r" else 0x20 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256)
)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _mixed(a * np.uint64(0x9E3779B97F4A7C15) + b)


class _WordHash(dict):
    """Hash of a word, remembered for recent words; 0 for the mark between pieces."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        self[word] = value = 0 if word == MARK else xxhash.xxh3_64_intdigest(word) | 1
        return value


def pieces(text: bytes) -> bytes:
    """The text in lower case with a mark for each separator; words are divided by spaces."""
    return text.translate(_SPLIT).replace(MARK, b" \xff ")


def chunks(texts: list[bytes], spacing: int, memo: _WordHash) -> Iterator[tuple[int, bool, bytes]]:
    """(text number, whether the chunk ends its piece, words joined by spaces) for all chunks of all texts."""
    tokens, ends = [], []
    for t in texts:
        tokens += pieces(t).split()
        tokens.append(MARK)
        ends.append(len(tokens))
    h = np.fromiter(map(memo.__getitem__, tokens), np.uint64, len(tokens))
    word = np.concatenate([[False], h != 0, [False, False]])  # word[i + 1]: token i is a word
    here, n = word[1:-2], len(tokens)
    first = here & ~word[:n]
    cut = np.zeros(n, bool)
    if n > 1:
        cut[:-1] = _paired(h[:-1], h[1:]) % np.uint64(spacing) == 0
    # Both words, the one before and the one after are in the piece: no chunk is empty or only shared words.
    cut &= here & word[:n] & word[2: n + 2] & word[3: n + 3]
    starts = np.flatnonzero(first | cut)
    stops = np.flatnonzero(here & ~word[2: n + 2]) + 1  # ends of pieces
    piece_end = stops[np.searchsorted(stops, starts, "right")] if len(starts) else starts
    following = np.append(starts[1:], n)
    last = following >= piece_end
    until = np.where(last, piece_end, following + SHARED)
    owner = np.searchsorted(np.array(ends), starts, "right")
    for o, e, s, u in zip(owner.tolist(), last.tolist(), starts.tolist(), until.tolist(), strict=True):
        yield o, e, b" ".join(tokens[s:u])


def _parse(spacing: int):
    def rows(sums: Counter) -> pa.RecordBatch:
        keys = [k.split(MARK, 2) for k in sums]
        return pa.RecordBatch.from_arrays([
            pa.array([k[0] for k in keys], pa.binary()).cast(pa.string()), pa.array([k[1] == b"1" for k in keys], pa.bool_()),
            pa.array([k[2] for k in keys], pa.binary()).cast(pa.string()), pa.array(list(sums.values()), pa.int64()),
        ], ["lang", "ends", "chunk", "times"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, sums = _WordHash(), Counter()
        for b in slices(batches, 200):
            langs = [x.encode() for x in b.column("lang").to_pylist()]
            heads = [(x + b"\xff0\xff", x + b"\xff1\xff") for x in langs]
            texts = b.column("text").cast(pa.large_binary()).to_pylist()
            sums.update([heads[o][e] + c for o, e, c in chunks(texts, spacing, memo)])
            if len(sums) >= HELD:
                yield rows(sums)
                sums = Counter()
        if sums:
            yield rows(sums)
    return run


def _bit(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(20)) & np.uint64(BITS - 1)


def _known(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = _bit(h)
    return (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _numbered(values: pa.Array | np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """A number per value, equal for equal values, and the distinct values in the order of their numbers."""
    encoded = (pa.array(values) if isinstance(values, np.ndarray) else values).dictionary_encode()
    return encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary


def phrase_counts(langs: pa.Array, ends: np.ndarray, texts: pa.Array, times: np.ndarray, size: int,
                  frequent: np.ndarray | None) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """(lang, phrase, occurrences) of the phrases of ``size`` words that start in the own part of the given chunks.

    ``frequent`` is the bitmap of the frequent phrases of one word less; phrases with a part outside of it are left out.
    Words are split, numbered and joined as Arrow columns: there is no Python object per word or phrase.
    """
    lang, known = _numbered(langs)
    parts = pc.split_pattern(texts, b" ")
    lengths = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    flat, words = _numbered(parts.flatten())
    own = lengths - np.where(ends, size - 1, SHARED)  # starts of phrases
    own = np.maximum(own, 0)
    chunk = np.repeat(np.arange(len(parts)), own)
    begins = np.cumsum(lengths) - lengths
    at = np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own) + begins[chunk]
    if frequent is not None:
        by_lang, by_word = _word_hashes(known.to_pylist()), _word_hashes(words.to_pylist())
        spread = _paired(np.repeat(by_lang[lang], lengths), by_word[flat])  # per word of the chunks
        if size == 2:
            good = _known(frequent, spread)
        else:
            good = np.append(_known(frequent, _paired(spread[:-1], spread[1:])), False)  # over the edge of a chunk: never looked at
        keep = good[at] & good[at + 1]
        at, chunk = at[keep], chunk[keep]
    code, room = lang[chunk], len(known)
    for i in range(size):
        if room * len(words) >= 1 << 62:  # number the distinct prefixes, so that codes stay small
            code, room = _numbered(code)[0], len(code)
        code, room = code * len(words) + flat[at + i], room * len(words)
    number, distinct = _numbered(code)
    where = np.empty(len(distinct), np.int64)
    where[number] = np.arange(len(number))  # one place of each phrase
    sums = np.zeros(len(where), np.int64)
    np.add.at(sums, number, times[chunk])
    spots = at[where]
    taken = [words.take(pa.array(flat[spots + i])) for i in range(size)]
    return known.take(pa.array(lang[chunk[where]])), taken[0] if size == 1 else pc.binary_join_element_wise(*taken, pa.scalar(b" ", words.type)), sums


def phrases(langs: list[bytes], ends: np.ndarray, texts: list[bytes], times: np.ndarray, size: int,
            frequent: np.ndarray | None) -> tuple[list[bytes], list[bytes], np.ndarray]:
    """``phrase_counts`` of chunks in lists."""
    known, names, sums = phrase_counts(pa.array(langs, pa.large_binary()), ends, pa.array(texts, pa.large_binary()), times, size, frequent)
    return known.to_pylist(), names.to_pylist(), sums


def _gathered(batches: Iterator[pa.RecordBatch], rows: int = 60_000, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Batches put together up to ``rows`` rows or ``size`` bytes, so that more occurrences are summed at once."""
    held, n, filled = [], 0, 0
    for b in batches:
        held.append(b)
        n, filled = n + b.num_rows, filled + b.nbytes
        if n >= rows or filled >= size:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n, filled = [], 0, 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _count(size: int, frequent: np.ndarray | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _gathered(batches):
            lang, phrase, f = phrase_counts(
                b.column("lang").cast(pa.large_binary()), b.column("ends").to_numpy(zero_copy_only=False),
                b.column("chunk").cast(pa.large_binary()), b.column("times").to_numpy(), size, frequent)
            yield pa.RecordBatch.from_arrays(
                [lang.cast(pa.binary()).cast(pa.string()), phrase.cast(pa.binary()).cast(pa.string()), pa.array(f, pa.int64())],
                ["lang", "phrase", "f"])
    return run


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cell, bits): the bits of phrases of one or two words, 64 to a cell."""
    for b in batches:
        lang = _word_hashes(b.column("lang").cast(pa.binary()).to_pylist())
        words = [p.split(b" ") for p in b.column("phrase").cast(pa.large_binary()).to_pylist()]
        h = [_paired(lang, _word_hashes([w[i] for w in words])) for i in range(len(words[0]) if words else 1)]
        h = h[0] if len(h) == 1 else _paired(*h)
        at = np.unique(_bit(h))
        cells = (at >> np.uint64(6)).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells), pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], ["cell", "bits"])


def bitmap(frequent: DataFrame) -> np.ndarray:
    """The bitmap of (lang, phrase): BITS / 64 cells at most come to the driver, whatever the input."""
    rows = frequent.select("lang", "phrase").mapInArrow(_bits, "cell long, bits long").groupBy("cell").agg(F.bit_or("bits").alias("bits"))
    got = rows.toArrow()
    out = np.zeros(BITS // 64, np.uint64)
    out[got.column("cell").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return out


def _lookup(cuts: DataFrame, counts: DataFrame, side: str, name: str) -> DataFrame:
    parts = counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name))
    return cuts.join(parts, ["lang", side])


def dictionary(docs: DataFrame, spacing: int = 12) -> DataFrame:
    """(lang, ends, chunk, times): the distinct chunks of ``docs`` (text, lang) and how often the parse has them."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    parsed = rows.mapInArrow(_parse(spacing), "lang string, ends boolean, chunk string, times long")
    return parsed.groupBy("lang", "ends", "chunk").agg(F.sum("times").alias("times"))


def collocations(docs: DataFrame, scratch: Scratch, least: int = 10, top: int = 2000, covered: int = 50) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    ``least``: occurrences of a candidate; ``covered``: a phrase is dropped when a longer candidate around it has this
    percentage of its occurrences.
    """
    spark, held = docs.sparkSession, f"{scratch.folder}/chunks"
    dictionary(docs).write.option("compression", "zstd").parquet(held)
    parse = spark.read.parquet(held)

    def counted(size: int, frequent: np.ndarray | None) -> DataFrame:
        parts = parse.mapInArrow(_count(size, frequent), "lang string, phrase string, f long")
        return parts.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))

    every = scratch.keep(counted(1, None), "words")
    totals = every.groupBy("lang").agg(F.sum("f").alias("n"))
    words = scratch.keep(every.filter(F.col("f") >= least), "frequent_words")
    pairs = scratch.keep(counted(2, bitmap(words)).filter(F.col("f") >= least), "pairs")
    triples = scratch.keep(counted(3, bitmap(pairs)).filter(F.col("f") >= least), "triples")

    w = F.split("phrase", " ")
    joined = lambda *i: F.concat_ws(" ", *(w[k] for k in i))
    cut = lambda k, left, right: F.struct(F.lit(k).alias("k"), joined(*left).alias("left"), joined(*right).alias("right"))
    two = pairs.select("lang", "phrase", F.col("f").alias("a"), cut(1, (0,), (1,)).alias("cut"))
    three = triples.select("lang", "phrase", F.col("f").alias("a"), F.explode(F.array(cut(1, (0,), (1, 2)), cut(2, (0, 1), (2,)))).alias("cut"))
    cuts = two.unionByName(three).select("lang", "phrase", "a", "cut.*")
    counts = words.unionByName(pairs)
    cuts = _lookup(_lookup(cuts, counts, "left", "l"), counts, "right", "r")
    wide = "decimal(38,0)"
    score = F.expr(f"cast((cast(a as {wide}) * a * 1000000) div (cast(l as {wide}) * r) as long)")
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("low"))

    around = triples.select("lang", F.explode(F.array(joined(0, 1), joined(1, 2))).alias("phrase"), "f").groupBy("lang", "phrase").agg(
        F.max("f").alias("longer"))
    left = scored.join(around, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(covered) * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("low.score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "low.l", "low.r", "n", "low.score")


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of each language."""
    with Scratch(spark, "phrases") as scratch:
        return result(collocations(table(spark, sf_dir, "documents"), scratch), "op11")


ORACLE_OP11 = r"""
with lowered as (
  select coalesce(lang, 'und') as lang, row_number() over () as doc,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents
), cut_ as (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) as piece from lowered),
worded as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from cut_),
f1 as (select lang, x as phrase, count(*) as f from (select lang, unnest(w) as x from worded) group by all),
f2 as (
  select lang, w[i] || ' ' || w[i + 1] as phrase, w[i] as p1, w[i + 1] as p2, count(*) as f
  from (select lang, w, unnest(range(1, len(w))) as i from worded) group by all having count(*) >= 10
), f3 as (
  select lang, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as phrase, w[i] as p1, w[i + 1] as p2, w[i + 2] as p3, count(*) as f
  from (select lang, w, unnest(range(1, len(w) - 1)) as i from worded) group by all having count(*) >= 10
), cuts as (
  select lang, phrase, f as a, 1 as k, p1 as lft, p2 as rgt from f2
  union all select lang, phrase, f, 1, p1, p2 || ' ' || p3 from f3
  union all select lang, phrase, f, 2, p1 || ' ' || p2, p3 from f3
), parts as (select lang, phrase, f from f1 union all select lang, phrase, f from f2),
scored as (
  select c.lang, c.phrase, c.a, c.k, l.f as l, r.f as r,
         ((1000000::hugeint * c.a * c.a) // (l.f::hugeint * r.f))::bigint as score
  from cuts c join parts l on l.lang = c.lang and l.phrase = c.lft join parts r on r.lang = c.lang and r.phrase = c.rgt
), best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
wider as (
  select lang, phrase, max(f) as f from (
    select lang, p1 || ' ' || p2 as phrase, f from f3 union all select lang, p2 || ' ' || p3, f from f3) group by all
), left_ as (
  select b.* from best b left join wider x on x.lang = b.lang and x.phrase = b.phrase where x.f is null or 100 * x.f < 50 * b.a
), total as (select lang, sum(f)::bigint as n from f1 group by lang)
select * from (
  select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
  from left_ join total using (lang)) where rank <= 2000
"""
