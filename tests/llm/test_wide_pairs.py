"""Node pairs with wide bitmaps: the same verdicts as plain arithmetic, in memory that does not follow their width."""

from __future__ import annotations

import tracemalloc

import numpy as np

from lumbung.llm import jaccard_join


def _plain(a, i, b, j, num, den):
    both = sum(bin(int(x & y)).count("1") for x, y in zip(a[0][i], b[0][j], strict=True))
    most = min(a[2][i] - max(a[3][i] - both, 0), b[2][j] - max(b[3][j] - both, 0), a[6][i], b[6][j])
    near = den * a[2][i] >= num * b[1][j] and den * b[2][j] >= num * a[1][i]
    one = a[4][i] == a[5][i] == b[4][j] == b[5][j]
    return bool((num + den) * most >= num * (a[1][i] + b[1][j]) and near and not one)


def _nodes(r, count, lanes, spread):
    common = r.integers(0, 1 << 63, lanes, np.uint64)
    own = r.integers(0, 1 << 63, (count, lanes), np.uint64) & r.integers(0, 1 << 63, (count, lanes), np.uint64)
    bits = np.where(r.random((count, lanes)) < 0.85, common, own)
    pop = np.bitwise_count(bits).sum(1).astype(np.int64)
    least = pop + r.integers(0, spread, count)
    comp = r.integers(0, 6, count)
    return bits, least, least + r.integers(0, spread, count), pop, comp, comp + r.integers(0, 2, count), least + r.integers(-spread, spread, count)


def test_verdicts_do_not_depend_on_how_many_pairs_are_taken_at_once(monkeypatch):
    r = np.random.default_rng(3)
    for lanes in (16, 64):
        a, b = _nodes(r, 40, lanes, 40), _nodes(r, 30, lanes, 40)
        a[0][:10], a[1][:10], a[2][:10], a[3][:10] = b[0][:10], b[1][:10], b[2][:10], b[3][:10]
        i, j = (x.ravel() for x in np.meshgrid(np.arange(40), np.arange(30)))
        want = [_plain(a, x, b, y, 80, 100) for x, y in zip(i, j, strict=True)]
        assert 0 < sum(want) < len(want)
        for size in (1, 1 << 12, 1 << 22):
            monkeypatch.setattr(jaccard_join, "PAIR_BYTES", size, raising=False)
            assert jaccard_join._possible(a, i, b, j, 80, 100).tolist() == want
        none = np.empty(0, np.int64)
        assert jaccard_join._possible(a, none, b, none, 80, 100).tolist() == []


def test_wide_bitmaps_are_not_copied_for_all_pairs_of_a_step():
    r = np.random.default_rng(4)
    a = _nodes(r, 256, 512, 10)  # 4 KB each, as of texts of 20,000 words
    a[4][:], a[5][:] = np.arange(256), np.arange(256)
    i, j = (x.ravel() for x in np.meshgrid(np.arange(256), np.arange(256)))
    assert len(i) == jaccard_join.PAIRS
    tracemalloc.start()
    jaccard_join._possible(a, i, a, j, 80, 100)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 64 << 20
