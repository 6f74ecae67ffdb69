"""Mixing, packing, token shards and the pipeline."""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from lumbung.llm.common import Scratch, table
from lumbung.llm.fertility import judged
from lumbung.llm.mixing import ROOM, class_runs, interleaved, period_of, schedule, shares
from lumbung.llm.packing import boundaries, by_mark, pack
from lumbung.llm.pieces import byte_bpe, byte_bpe_ranks, text_slots
from lumbung.llm.token_output import END_ID, Shard, expanded, grammar, payload, read_tokens, write_tokens
from lumbung.session import shared_folder
from .test_dedup import brute_components, norm

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def whole():
    import public_tokenizers
    from tokenizers import Tokenizer

    t, plain = (Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")) for _ in range(2))
    plain.encode_special_tokens = True  # as the rank file has no control strings
    assert t.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    return lambda text, v=t: (v or plain).encode(text or "", add_special_tokens=False).ids


def test_parts_give_the_ids_of_the_whole_text(whole, awkward):
    vocabularies = [(byte_bpe(), {}), (byte_bpe_ranks(), {"v": None})]

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.sampled_from([" ", "  ", "\n", "\t", "a", "Word", "don't", "12", "é", "漢", ".", "...", "\x01", "\x02x", "<|endoftext|>", "\u00a0", "\u3000", "\x1c", "\x85", "\u200b"]), max_size=14))
    def check(parts):
        text = "".join(parts)
        for v, how in vocabularies:
            assert v.ids(text_slots(text, v)).tolist() == whole(text, **how)

    check()
    for r in awkward.collect():
        for v, how in vocabularies:
            assert v.ids(text_slots(r.text or "", v)).tolist() == whole(r.text, **how)


def test_mixing_lag_and_windows(spark, awkward, empty):
    with Scratch(spark, "t") as s:
        rows = schedule(awkward, s, period=20, block_bytes=1000, chunk_rows=3).collect()
    assert len(rows) == awkward.count()
    blocks = {(r.source, r.block): r for r in rows}
    slots = [r.slot for r in blocks.values()]
    assert len(slots) == len(set(slots))  # one block per slot
    for r in rows:
        assert r.released <= r.slot < r.due
    # Positions of a source's texts follow each other without gaps.
    for source in {r.source for r in rows}:
        own = sorted((r.at, r.bytes) for r in rows if r.source == source)
        ends = [0]
        for at, n in own:
            assert at == ends[-1] or n == 0 or at in ends
            ends.append(max(ends[-1], at + n))
    with Scratch(spark, "t") as s:
        assert schedule(empty, s).count() == 0
    with Scratch(spark, "t") as s, pytest.raises(ValueError):
        schedule(awkward, s, period=2)
    mixed = interleaved(awkward)
    assert mixed.columns == awkward.columns and sorted(map(str, mixed.collect())) == sorted(map(str, awkward.collect()))


def test_grammar_goes_on_while_pairs_are_frequent():
    r = np.random.default_rng(1)
    passage, copies = r.permutation(40_000)[:4_096], 12
    ids = np.concatenate([np.append(passage, END_ID)] * copies)
    firsts = np.arange(copies + 1) * (len(passage) + 1)
    symbols, starts, rules = grammar(ids, firsts)
    assert list(np.diff(starts)) == [1] * copies
    assert (expanded(symbols, rules) == ids).all()


def test_mixing_of_many_sources(spark):
    """More sources than a period had slots: every row, one block a slot, every block inside its window."""
    rows = [(i, "x" * (10 + 3 * (i % 7)), f"host{i}") for i in range(1_200)] + [(5_000 + i, "y" * 40, f"big{i % 3}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    with Scratch(spark, "t") as s:
        got = schedule(docs, s, block_bytes=40).collect()
    assert len(got) == len(rows)
    blocks = {(r.source, r.block): r for r in got}
    assert len({r.slot for r in blocks.values()}) == len(blocks) and len({r.source for r in got}) == 1_203
    assert all(r.released <= r.slot < r.due for r in got)
    for sources in ({1: 40, 2: 5, 7: 10}, {1: 1, 19: 1}, {3: 30, 4: 5, 40: 1}, {1: 9}):
        period = sum(w * n for w, n in sources.items())
        taken = set()
        for w, nth, first, slot, count in class_runs(sources, period):
            assert nth * period // w <= slot and slot + count <= -(-(nth + 1) * period // w)
            taken.update((w, nth, first + k) for k in range(count))
        assert len(taken) == period


def test_one_period_never_deviates_by_a_block(spark):
    names = {"a": 70, "b": 20, "c": 9, "d": 1}
    docs = spark.createDataFrame([(i, "x" * 10, n) for n in names for i in range(100)], "doc_id long, text string, source string")
    with Scratch(spark, "t") as s:
        rows = schedule(docs, s, period=50, block_bytes=10, weights=names).collect()
    share = {r.source: r.share for r in rows}
    assert sum(share.values()) == 50 and all(share.values())
    slot = defaultdict(set)
    for r in rows:
        slot[r.source].add(r.slot)
    for t in range(1, 51):
        for n in names:
            assert abs(sum(x < t for x in slot[n]) - t * share[n] / 50) < 1


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 9), min_size=1, max_size=9), st.integers(1, 4))
def test_boundaries_are_optimal(bars, k):
    lengths = sorted(bars)

    def cost(ends):
        return sum(n * next(e for e in ends if e >= x) for x, n in bars.items())

    best = min(cost([*c, lengths[-1]]) for m in range(min(k, len(lengths))) for c in itertools.combinations(lengths[:-1], m))
    got = boundaries(np.array(lengths), np.array([bars[x] for x in lengths]), k)
    assert got == sorted(set(got)) and len(got) <= k and got[-1] == lengths[-1] and cost(got) == best


def check_packing(rows, sizes, longest, buckets, budget):
    """Every token once, best buckets, full batches within the budget."""
    for key, n in sizes.items():
        own = sorted((r.start, r.n_tokens) for r in rows if r.doc_id == key)
        assert sum(x for _, x in own) == sum(n)
    bars = Counter(r.n_tokens for r in rows)
    ends = boundaries(np.array(sorted(bars)), np.array([bars[x] for x in sorted(bars)]), buckets)
    place = defaultdict(list)
    for r in rows:
        assert r.n_tokens <= longest and r.padded == next(e for e in ends if e >= r.n_tokens) and ends[r.bucket] == r.padded
        place[r.bucket].append((r.batch, r.row))
    for b, places in place.items():
        n = max(1, budget // ends[b])
        assert sorted(places) == [(i // n, i % n) for i in range(len(places))]


def test_packing(spark, awkward, empty, whole):
    with Scratch(spark, "t") as s:
        rows = pack(by_mark(awkward, chunk_rows=2), s, longest=300, buckets=3, budget=1000).collect()
    sizes = defaultdict(list)
    for r in awkward.collect():
        sizes[r.doc_id].append(len(whole(r.text)) + 1)
    check_packing(rows, sizes, 300, 3, 1000)
    with Scratch(spark, "t") as s:
        assert pack(by_mark(empty), s).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3) | st.integers(0, 50_256), min_size=1, max_size=60), min_size=1, max_size=8), st.data())
def test_shards_round_trip(docs, data):
    docs = docs + [docs[0] * 6] * 3
    shard = Shard(payload(np.array([i for d in docs for i in d], np.uint32), np.array([len(d) for d in docs])))
    assert shard.all_ids().tolist() == [i for d in docs for i in d]
    k = data.draw(st.integers(0, len(docs) - 1))
    a = data.draw(st.integers(0, len(docs[k])))
    b = data.draw(st.integers(a, len(docs[k])))
    assert shard.ids_between(k, a, b).tolist() == docs[k][a:b]


def test_repetition_is_compressed():
    ids = np.tile(np.arange(50, dtype=np.uint32), 400)
    assert len(Shard(payload(ids, np.array([len(ids)]))).symbols) < len(ids) / 10


def test_tokens(spark, awkward, empty, whole):
    path = shared_folder(spark, "tokens")
    write_tokens(awkward.repartition(5), path, shard_ids=2000)
    got = read_tokens(spark, path).orderBy("start").collect()
    assert len(got) == awkward.count()
    expected = Counter()
    for r in awkward.collect():
        ids = [*whole(r.text), END_ID]
        expected[r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == expected
    assert [r.start for r in got] == [0, *itertools.accumulate(r.n_tokens for r in got)][:-1]
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in got), key=lambda d: -math.inf if d is None else d)
    path = shared_folder(spark, "tokens")
    write_tokens(empty, path)
    assert read_tokens(spark, path).count() == 0


def test_pipeline_against_brute_force(spark, whole):
    docs = table(spark, TESTDATA, "documents")
    with Scratch(spark, "t") as s:
        kept = {r.doc_id for r in judged(docs, s).filter("kept").collect()}
    rows = sorted((r.doc_id, r.text) for r in docs.collect() if r.doc_id in kept)
    first = {}
    for i, t in rows:
        first.setdefault(norm(t), i)
    rows = [(i, t) for i, t in rows if first[norm(t)] == i]
    alone = {d for d, _, c in brute_components(rows, 5, 80) if d == c}
    sizes = {i: [len(whole(t)) + 1] for i, t in rows if i in alone}
    got = corpus_pipeline.run(spark, TESTDATA).collect()
    assert {r.doc_id for r in got} == set(sizes)
    check_packing(got, sizes, 4096, 8, 65_536)
    # Batches fill in the order of the mixture.
    with Scratch(spark, "t") as s:
        places = {r.doc_id: (r.slot, r.at) for r in schedule(docs.filter(docs.doc_id.isin(list(sizes))), s).collect()}
    for bucket in {r.bucket for r in got}:
        order = [places[r.doc_id] for r in sorted((r for r in got if r.bucket == bucket), key=lambda r: (r.batch, r.row))]
        assert order == sorted(order)


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_awkward_and_empty_tables(spark, awkward, empty, stage):
    columns = ["doc_id", "text", "lang", "source", "n_chars", "cid", "slot"]
    for docs in (awkward.select(columns), empty.select(columns)):
        out = stage(spark, docs, TESTDATA)
        assert stage is corpus_pipeline.packing or out.columns == columns
        assert out.count() <= max(docs.count(), 200) and (docs.count() == 0) == (out.count() == 0)


def test_words_pattern_matches_split():
    text = "a\x0bb\x0c c\x1cd\x85e\u00a0f"
    assert re.findall(rb"[^\x20\x09-\x0D]+", text.encode()) == text.encode().split()


@pytest.mark.parametrize("sources", [1, 2, 300, 999, 1000, 1001, 20_000])
def test_shares_follow_the_weights_at_any_number_of_sources(spark, sources):
    # The first source has half of all weight.
    names = spark.range(sources).selectExpr("concat('s:', lpad(id, 6, '0')) as name", f"if(id = 0, {max(sources - 1, 1)}, 1) as root")
    sizes = names.selectExpr("name", "cast(root as bigint) * root * 1000000 as bytes")
    period = period_of(sources)
    got = {r["name"]: r["share"] for r in shares(sizes, period, None).collect()}
    assert sum(got.values()) == period and min(got.values()) >= 1
    assert abs(got["s:000000"] / period - (0.5 if sources > 1 else 1.0)) <= 1 / ROOM + 0.002
