"""Exact dedup and the similarity join against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lumbung.llm import common
from lumbung.llm.common import Scratch, connected, hot_join
from lumbung.llm.exact_dedup import DigestIndex, deduplicate, without_copies
from lumbung.llm.jaccard_join import _LEAST, SignatureTree, _joined, jaccard_components, one_of_each, tree_pairs
from lumbung.session import shared_folder


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_dedup(spark, awkward, empty):
    rows = awkward.select("doc_id", "text").collect()
    index = DigestIndex(spark, shared_folder(spark, "index"), 4)
    with Scratch(spark, "t") as s:
        got = deduplicate(awkward, index, "first", s).collect()
        assert len(got) == len(rows)
        groups = {}
        for r in rows:
            groups.setdefault(hashlib.sha256(norm(r.text).encode()).digest(), []).append(r.doc_id)
        for g in got:
            ids = groups[bytes(g.digest)]
            assert g.group_size == len(ids) and g.keep_id == min((i for i in ids if i is not None), default=None)
        assert Counter(bytes(g.digest) for g in got if g.kept) == Counter(groups.keys())
        assert index.read().count() == len(groups)
    with Scratch(spark, "t") as s:  # the same batch again changes nothing
        again = deduplicate(awkward, index, "first", s)
        assert sorted(map(str, again.drop("digest").collect())) == sorted(str(g) for g in spark.createDataFrame(got).drop("digest").collect())
    later = spark.createDataFrame([(1, awkward.first().text), (2, "brand new")], "doc_id long, text string")
    with Scratch(spark, "t") as s:
        assert sorted((g.doc_id, g.keep_id, g.kept) for g in deduplicate(later, index, "second", s).collect()) == [(1, 10, False), (2, 2, True)]
    assert DigestIndex(spark, spark.sql(f"describe formatted {index.name}").filter("col_name = 'Location'").first().data_type, 4).read().count() == len(groups) + 1
    with Scratch(spark, "t") as s:
        assert deduplicate(empty, index, "none", s).count() == 0


def test_without_copies(spark, awkward):
    kept = without_copies(awkward, DigestIndex(spark, shared_folder(spark, "index"), 4), "b")
    assert kept.columns == awkward.columns
    texts = [norm(r.text) for r in kept.collect()]
    assert sorted(texts) == sorted({norm(r.text) for r in awkward.collect()})


def shingle_set(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute_components(rows, k, num):
    sets = [shingle_set(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j]:
            both = len(sets[i] & sets[j])
            if 100 * both >= num * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return Counter((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("limits", [{}, {"cell_rows": 0, "block_rows": 3, "small_rows": 0}])
def test_jaccard_join(spark, awkward, limits):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    with Scratch(spark, "t") as s:
        got = jaccard_components(awkward, s, 4, 85, **limits).drop("text_hash").collect()
    assert Counter(map(tuple, got)) == brute_components(rows, 4, 85)


def test_jaccard_join_empty(spark, empty):
    with Scratch(spark, "t") as s:
        assert jaccard_components(empty, s).count() == 0


def test_one_of_each(spark, awkward):
    kept = one_of_each(awkward)
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    stays = Counter(d for (d, _, c), n in brute_components(rows, 5, 80).items() for _ in range(n) if d is None or d == c)
    assert kept.columns == awkward.columns and Counter(r.doc_id for r in kept.collect()) == stays


def test_tree_traversal_loses_no_pair():
    r = np.random.default_rng(3)
    sets = []
    for i in range(90):
        base = sets[r.integers(len(sets))] if sets and r.random() < 0.6 else set(r.integers(0, 2**62, r.integers(5, 300)).tolist())
        sets.append({x for x in base if r.random() > 0.04} | set(r.integers(0, 2**62, r.integers(0, 6)).tolist()))
    bits = np.zeros((len(sets), 1024), bool)
    for i, s in enumerate(sets):
        bits[i, [x % 1024 for x in s]] = True
    lanes = np.packbits(bits, 1).view(np.uint64)
    n, comp = np.array([len(s) for s in sets]), np.arange(len(sets))
    half = np.arange(len(sets)) < 40
    whole = SignatureTree(np.arange(len(sets)), n, comp, lanes)
    sides = [SignatureTree(np.flatnonzero(h), n[h], comp[h], lanes[h]) for h in (half, ~half)]
    for trees in ((whole, whole), (whole, sides[0]), tuple(sides)):
        found = {frozenset(p) for i, j in tree_pairs(*trees, 85, 100) for p in zip(i.tolist(), j.tolist(), strict=True)}
        for i, j in itertools.combinations(range(len(sets)), 2):
            if i in trees[0].rows and j in trees[1].rows and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                assert frozenset((i, j)) in found


def _block(sets, token, place):
    """Rows of one block as the trees get them; ``place`` tells the place of the block's token in each prefix."""
    rows = []
    for cid, x in enumerate(sets):
        x = np.fromiter(x, np.uint64, len(x))
        bits = np.zeros(max(1024, 1 << int(len(x) - 1).bit_length()), bool)
        bits[((x >> np.uint64(20)) & np.uint64(len(bits) - 1)).astype(np.int64)] = True
        rows.append({"token": token, "pos": place(cid), "cid": cid, "comp": cid, "n": len(x), "side": 0, "bits": np.packbits(bits).tobytes(),
                     _LEAST[0]: token, **dict.fromkeys(_LEAST[1:], (1 << 63) - 1)})
    return rows


def test_unrelated_long_sets_in_one_block_make_no_pair():
    """Every bit of 1,024 is set for 5,000 shingles; wider bitmaps rule all 19,900 pairs out."""
    r = np.random.default_rng(5)
    sets = [set(r.integers(0, 2**62, int(n)).tolist()) | {7} for n in r.integers(4_500, 5_500, 200)]
    found = list(_joined(["token"], 80, 100, 0)([pa.RecordBatch.from_pylist(_block(sets, 7, lambda _: 0))]))
    assert sum(b.num_rows for b in found) == 0


def test_widths_next_to_each_other_lose_no_pair():
    """Near copies on both sides of a width, in small and large blocks and between two chunks; linked sets are all found."""
    r = np.random.default_rng(6)
    blocks, linked = [], set()
    for token, many in enumerate((2, 3, 9, 40), 1):
        base = r.integers(0, 2**62, 2_080).tolist()
        sets = [set(base[:int(k)]) | set(r.integers(0, 2**62, int(r.integers(0, 120))).tolist()) for k in r.integers(1_900, 2_080, many)]
        sets += [set(r.integers(0, 2**62, 900).tolist()) for _ in range(3)]
        rows = [x | {"cid": x["cid"] + 100 * token, "comp": x["comp"] + 100 * token} for x in _block(sets, token, lambda _: 0)]
        linked |= {(100 * token + j, 100 * token + i) for i, j in itertools.combinations(range(len(sets)), 2)
                   if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
        blocks += rows
    for sides in (0, 1):
        batch = pa.RecordBatch.from_pylist([x | {"side": 1 + x["cid"] % 2 if sides else 0} for x in blocks])
        out = [p for b in _joined(["token"], 80, 100, 0)([batch]) for p in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        want = {p for p in linked if not sides or (p[0] + p[1]) % 2}
        assert set(out) >= want and len(want) > 100 and len(out) == len(set(out))


@pytest.mark.parametrize("few", [0, 100_000])
def test_connected_and_hot_join(spark, monkeypatch, few):
    monkeypatch.setattr(common, "FEW_ROWS", few)
    r = random.Random(4)
    edges = [(r.randrange(60), r.randrange(60)) for _ in range(35)] + [(200, i) for i in range(201, 230)]
    root = {x: x for e in edges for x in e}
    for _ in root:
        for u, v in edges:
            root[u] = root[v] = min(root[u], root[v])
    with Scratch(spark, "t") as s:
        got = {x.node: x.root for x in connected(spark.createDataFrame(edges, "u long, v long"), s, "c").collect()}
        assert got == {x: root[x] for x in got} and set(got) >= {u for u, v in edges if u != v}
    left = spark.createDataFrame([(i % 7 if i % 3 else 0, i) for i in range(3000)], "k long, v long")
    right = left.groupBy("k").count().filter("k <> 2")
    for few in (0, 10_000):  # split by heat, and broadcast whole
        monkeypatch.setattr(common, "FEW_ROWS", few)
        assert hot_join(left, right, "k", "count", 3000).count() == left.filter("k <> 2").count()
        assert hot_join(left, right, "k", "count", 3000, "left").count() == 3000


def test_indexes_stay_apart_and_keep_their_buckets(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(50)], "doc_id long, text string")
    for lang in ("en", "de"):
        with Scratch(spark, "t") as s:
            rows_ = deduplicate(docs, DigestIndex(spark, str(tmp_path / lang / "digests"), 4), "first", s).collect()
        assert len(rows_) == 50 and all(r.kept for r in rows_)
    index = DigestIndex(spark, str(tmp_path / "en" / "digests"))
    assert index.buckets == 4
    spark.sql(f"DROP TABLE {index.name}")  # as another session would find it
    index = DigestIndex(spark, str(tmp_path / "en" / "digests"), 7)
    with Scratch(spark, "t") as s:
        again = deduplicate(docs, index, "second", s).collect()
    assert index.buckets == 4 and not any(r.kept for r in again) and index.read().count() == 50


def test_long_unrelated_texts_make_no_blocks(spark):
    """Texts of 3,000 words over few words share many shingles by chance, but hardly one with a rare word."""
    import random

    r = random.Random(2)
    common = [f"c{i}" for i in range(12)]
    texts = [" ".join(f"rare{d}_{r.randrange(10**6)}" if r.random() < 0.15 else r.choice(common) for _ in range(3000)) for d in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    with Scratch(spark, "t") as s:
        rows_ = jaccard_components(docs, s).collect()
        members = spark.read.parquet(f"{s.folder}/members").count()
    assert all(x.component_id == x.doc_id for x in rows_)
    assert members < 60 * 20
