"""Collocations, multiset fingerprints and tokenizer alignment against brute force."""

from __future__ import annotations

import bisect
import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lumbung.llm import alignment, collocations, multiset_hash
from lumbung.llm.common import Scratch

from .conftest import CLASH, SCHEMA, prose


def brute_phrases(rows, least=10, top=2000):
    counts = defaultdict(Counter)
    for lang, text in rows:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", text):
            w = re.findall(r"[^ \t]+", piece)
            for k in (1, 2, 3):
                counts[lang or "und"].update((tuple(w[i: i + k])) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        kept = []
        for p, a in f.items():
            if len(p) < 2 or a < least:
                continue
            if len(p) == 2 and any(len(q) == 3 and m >= least and p in (q[:2], q[1:]) and 100 * m >= 50 * a for q, m in f.items()):
                continue
            score, _, l, r = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), l, r))
        n = sum(m for p, m in f.items() if len(p) == 1)
        out += [(lang, i + 1, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(kept)[:top])]
    return sorted(out)


def test_chunks_hold_every_phrase_once():
    r = random.Random(3)
    texts = ["", " , ", "a", "a b", ("tick " * 40).strip(), *(" ".join(r.choice(["a", "b", "c", "dd", "e.", "f,", "\n"]) for _ in range(r.randrange(60))) for _ in range(200))]
    for spacing in (1, 2, 7):
        seen = [Counter() for _ in range(3)]
        got = list(collocations.chunks([t.encode() for t in texts], spacing, collocations._WordHash()))
        for size in (1, 2, 3):
            langs, names, sums = collocations.phrases(
                [b"x"] * len(got), np.array([g[1] for g in got], bool), [g[2] for g in got], np.ones(len(got), np.int64), size, None)
            for p, n in zip(names, sums.tolist(), strict=True):
                seen[size - 1][p.decode()] += n
        want = [Counter() for _ in range(3)]
        for t in texts:
            for piece in re.split(r"[.,;:!?\x0a-\x0d]", t):
                w = piece.split()
                for k in (1, 2, 3):
                    want[k - 1].update(" ".join(w[i: i + k]) for i in range(len(w) - k + 1))
        assert seen == want
        if spacing == 2:
            assert len({g[1:] for g in got}) < len(got)


def test_phrases_are_counted_as_arrow_columns():
    """No Python object per word or phrase: op11's CPU seconds were above its budget."""
    langs = pa.array([b"en", b"de", b"en", b"en"], pa.large_binary())
    chunks = pa.array([b"a b c", b"a b c", b"a b a b", b""], pa.large_binary())
    ends, times = np.array([True, True, False, True]), np.array([2, 1 << 60, 3, 5])
    want = {
        1: {(b"en", b"a"): 5, (b"en", b"b"): 5, (b"en", b"c"): 2, (b"en", b""): 5,
            (b"de", b"a"): 1 << 60, (b"de", b"b"): 1 << 60, (b"de", b"c"): 1 << 60},
        2: {(b"en", b"a b"): 5, (b"en", b"b c"): 2, (b"en", b"b a"): 3, (b"de", b"a b"): 1 << 60, (b"de", b"b c"): 1 << 60},
        3: {(b"en", b"a b c"): 2, (b"en", b"a b a"): 3, (b"en", b"b a b"): 3, (b"de", b"a b c"): 1 << 60},
    }
    full, empty = np.full(collocations.BITS // 64, np.iinfo(np.uint64).max), np.zeros(collocations.BITS // 64, np.uint64)
    for size in (1, 2, 3):
        for frequent in (None, full):
            lang, phrase, f = collocations.phrase_counts(langs, ends, chunks, times, size, frequent if size > 1 else None)
            assert isinstance(lang, pa.Array) and isinstance(phrase, pa.Array)
            assert dict(zip(zip(lang.to_pylist(), phrase.to_pylist(), strict=True), f.tolist(), strict=True)) == want[size]
        if size > 1:
            assert len(collocations.phrase_counts(langs, ends, chunks, times, size, empty)[2]) == 0


def test_collocations_are_those_of_brute_force(spark, awkward, empty):
    r = random.Random(5)
    rows = [(i, " ".join(r.choice(["New", "york", "city", "the", "red", "fox,", "of", "é", "\x1c", "a\x00b", "x.\ty"]) for _ in range(60)), r.choice(["en", "und", None]), None, i) for i in range(60)]
    docs = spark.createDataFrame([(*x, *CLASH) for x in [*rows, *rows[:9]]], SCHEMA).unionByName(awkward)
    with Scratch(spark, "t") as s:
        got = sorted(map(tuple, collocations.collocations(docs, s).collect()))
    assert got == brute_phrases([(x.lang, x.text) for x in docs.collect()]) and len(got) > 20
    with Scratch(spark, "t") as s:
        few = sorted(map(tuple, collocations.collocations(docs, s, least=3, top=7).collect()))
    assert few == brute_phrases([(x.lang, x.text) for x in docs.collect()], 3, 7)
    with Scratch(spark, "t") as s:
        none = collocations.collocations(empty, s)
        assert none.count() == 0 and none.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["", "a", "a b c d", "é x y", "long line " * 9, "\x0b", "ÿ"]), min_size=1, max_size=8), st.randoms())
def test_a_fingerprint_is_the_sum_of_its_paragraphs(lines, r):
    whole = multiset_hash.fingerprint("\n".join(lines))
    mixed = lines[:]
    r.shuffle(mixed)
    assert multiset_hash.fingerprint("\n".join(mixed)) == whole
    assert multiset_hash.changed(whole, inserted=["new one"], deleted=[]) == multiset_hash.fingerprint("\n".join([*lines, "new one"]))
    if len(lines) > 1:
        assert multiset_hash.changed(whole, deleted=[lines[0]]) == multiset_hash.fingerprint("\n".join(lines[1:]))
    assert multiset_hash.changed(multiset_hash.changed(whole, deleted=lines), inserted=lines) == whole
    other = multiset_hash.fingerprint("\n".join([*lines, ""]))
    assert other != whole  # one paragraph more


def brute_cosine(a, b):
    def grams(t):
        out = Counter()
        for line in t.split("\n"):
            w = line.encode().split()
            out.update(tuple(w[i: i + 3]) for i in range(max(len(w) - 2, min(len(w), 1))))
        return out
    x, y = grams(a), grams(b)
    norm = (sum(v * v for v in x.values()) * sum(v * v for v in y.values())) ** 0.5
    return sum(v * y[k] for k, v in x.items()) / norm if norm else 0.0


def test_likeness_is_near_the_cosine_of_shingles():
    errors = []
    for seed in range(60):
        a = "\n".join(prose(seed * 10 + i, 20) for i in range(6))
        b = "\n".join(prose(seed * 10 + i, 20) for i in range(seed % 7, 6 + seed % 7))
        va, vb = multiset_hash.vectors([a.encode()]), multiset_hash.vectors([b.encode()])
        errors.append(float(multiset_hash.likeness(va, vb)[0]) - brute_cosine(a, b))
    assert max(map(abs, errors)) < 0.35 and np.sqrt(np.mean(np.square(errors))) < 0.1


def test_fingerprints_of_all_rows(spark, awkward, empty):
    def text_hash(rows):
        return {x.text: x.h for x in rows.selectExpr("coalesce(text, '') as text", "xxhash64(coalesce(text, '')) as h").collect()}

    for parts in ("1", "7", "200"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = multiset_hash.fingerprints(awkward).collect()
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        h = text_hash(awkward)
        rows = sorted(((x.doc_id, x.text or "") for x in awkward.collect()), key=lambda x: (x[0] is None, -(x[0] or 0), -h[x[1]]))
        want = []
        for i, (doc, t) in enumerate(rows):
            following = rows[(i + 1) % len(rows)][1]
            n = len(t) // 2
            e = t[: len(t) - n] + following[:n]
            want.append((doc, len(t), hashlib.sha256(e.encode()).digest(), multiset_hash.fingerprint(t), multiset_hash.fingerprint(e)))
        assert sorted(map(repr, want)) == sorted(repr((x.doc_id, x.n_chars, bytes(x.edited_sha256), bytes(x.fingerprint), bytes(x.edited_fingerprint))) for x in got)
        assert all(0 <= x.near_edited <= 1 and 0 <= x.near_next <= 1 for x in got)
        by_doc = {x.doc_id: x for x in got}
        assert by_doc[40].near_edited > 0.3 > by_doc[40].near_next
    assert multiset_hash.fingerprints(empty).count() == 0
    one = multiset_hash.fingerprints(awkward.filter("doc_id = 33")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


@pytest.fixture(scope="module")
def both():
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    v = alignment.Vocabularies()

    def run(text):
        """Groups of a whole text by sets of ends; None without tokens."""
        if not text:
            return None
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bx, by = [v.bytes_a[i] for i in x], [v.bytes_b[i] for i in y]
        if b"".join(bx) != (" " + text).encode() or b"".join(by) != (" " + text).encode():
            return None
        ends_x, ends_y = np.cumsum([len(k) for k in bx]).tolist(), np.cumsum([len(k) for k in by]).tolist()
        cuts = sorted(set(ends_x) & set(ends_y))
        out = [([], []) for _ in cuts]
        for side, (ids, ends) in enumerate(((x, ends_x), (y, ends_y))):
            for i, e in zip(ids, ends, strict=True):
                out[bisect.bisect_left(cuts, e)][side].append(i)
        return out
    return run


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 5), st.integers(1, 3)), min_size=1, max_size=60), st.integers(0, 9))
def test_run_skipping_finds_the_common_ends(steps, same):
    a = np.cumsum([1] * same + [x for x, _ in steps]).tolist()
    b = [e for e in np.cumsum([1] * same + [y for _, y in steps]).tolist() if e < a[-1]] + [a[-1]]
    common = sorted(set(a) & set(b))
    to_a, to_b = alignment.aligned(a, b)
    assert [a[i - 1] for i in to_a] == common and [b[j - 1] for j in to_b] == common


def brute_alignment(rows, run):
    found = {}
    for key, text in rows:
        g = run(text)
        links = Counter(p * 65536 + q for x, y in g or [] for p in x for q in y)
        found[key] = (g, links)
    docs = Counter(k for _, links in found.values() for k in links)
    best = defaultdict(int)
    for k, n in docs.items():
        best[k >> 16] = max(best[k >> 16], n)
    out = {}
    for key, (g, links) in found.items():
        t = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g) if g else ""
        out[key] = (
            sum(len(x) for x, _ in g or []), sum(len(y) for _, y in g or []), len(g or []), sum(links.values()),
            sum(n for k, n in links.items() if docs[k] == best[k >> 16]), sum(n * docs[k] for k, n in links.items()),
            hashlib.sha256(t.encode()).hexdigest() if g else "")
    return out


def test_alignment_of_all_rows(spark, awkward, empty, both):
    r = random.Random(8)
    bits = ["word", "naïve", "<|endoftext|>", "<s>", "</s>", "▁", "<0x41>", "  ", "\n", "\t", "日本", "🙂", "don't", "\x01", "\x02x", " ", "12345", "\x00", "é", "ﬁ"]
    texts = [" ".join(r.choice(bits) for _ in range(r.randrange(1, 12))) for _ in range(150)]
    texts += ["".join(r.choice([" ", *bits]) for _ in range(r.randrange(1, 12))) for _ in range(150)]
    docs = spark.createDataFrame([(1000 + i, t, "en", "s", 1, *CLASH) for i, t in enumerate(texts)], SCHEMA).unionByName(awkward)
    keyed = [((x.doc_id, x.text, i), x.text) for i, x in enumerate(docs.collect())]
    want = sorted((repr(k[0]), *v) for k, v in brute_alignment(keyed, both).items())
    for small in (300_000, 40, 0):
        with Scratch(spark, "t") as s:
            got = alignment.alignments(docs, s, small=small).collect()
        assert sorted((repr(x[0]), *x[1:]) for x in got) == want
    with Scratch(spark, "t") as s:
        none = alignment.alignments(empty, s)
        assert none.count() == 0 and none.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
