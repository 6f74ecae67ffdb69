"""Chat formatting, fertility, toxicity, urls and licences."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumbung.llm import license_scan, url_filter
from lumbung.llm.chat_format import escape, format_conversations, parse, read_back, render, unescape
from lumbung.llm.common import Scratch, table
from lumbung.llm.fertility import accepted, judged, repeated_words
from lumbung.llm.toxicity import Lexicon, Restorer, character_model, decode, folded, toxicity

TESTDATA = "/root/testdata/sf0.001"

hostile = st.lists(st.sampled_from([*"\\#</turn> :\nab", "</turn>", "### ", "\n</turn>\n", "### user:\n"]), max_size=12).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(hostile, hostile), max_size=4))
def test_render_round_trip(turns):
    assert all(unescape(escape(t)) == t for _, t in turns)
    formatted = "".join(render(r, t)[0] for r, t in turns)
    assert [t[:2] for t in parse(formatted)] == turns
    assert [unescape(formatted[a:b]) for _, _, a, b in parse(formatted)] == [t for _, t in turns]


@pytest.mark.parametrize("text", ["### user:\nhi", "### user:\n</turn>\n\n</turn>\n", "x"])
def test_parser_rejects(text):
    with pytest.raises(ValueError):
        list(parse(text))


def test_conversations(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", None), (1, 2, "assistant", "</turn> \\### "), (1, 2, "assistant", "b"), (2, None, None, "x"),
            (2, 0, "user", "y"), (None, 0, "assistant", "nobody"), (3, 0, "assistant", "long " * 500), (3, 0, "assistant", "long " * 500)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"block": F.lit(1), "part": F.lit("p")})
    got = {r.conv_id: r for r in read_back(format_conversations(df, block_chars=100)).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: tuple((x is not None, x or 0 if i < 2 else x or "") for i, x in enumerate(r)))
        own = [(r[2] or "", r[3] or "") for r in own]
        learned = "".join(t for r, t in own if r == "assistant")
        g = got[conv]
        assert (g.n_turns, g.loss_chars) == (len(own), len(learned))
        assert g.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest()
        assert g.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
    assert read_back(format_conversations(df.limit(0))).count() == 0


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def repeated(words):
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    return len({i + j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(5)})


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=40))
def test_repeated_words(words):
    import numpy as np

    assert repeated_words(np.array(words, np.int64)) == repeated(words)


def test_fertility(spark, awkward, empty):
    files = table(spark, TESTDATA, "documents")
    with Scratch(spark, "t") as s:
        rows = {r.doc_id: r for r in judged(files, s).collect()}
    for d in files.collect():
        w, lines = words_of(d.text), [x for x in d.text.split("\n") if words_of(x)]
        r = rows[d.doc_id]
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(lines) - len(set(lines)), repeated(w))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", d.text))
        assert r.base_failed == (len(w) < 10 or 100 * r.n_repeat_words > 20 * len(w)) and not (r.base_failed and r.kept)
    # A stretch of a script the vocabularies hardly know among plain ones is out of its band.
    plain = files.filter("lang = 'en'").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(-1, "ꙮ꧁꧂ " * 200 + "a b c d e f g h i j k l m n o p", "en")], plain.schema)
    with Scratch(spark, "t") as s:
        verdict = {r.doc_id: r for r in judged(plain.unionByName(odd), s, least_docs=20).collect()}
    assert not verdict[-1].kept and verdict[-1].byte_share > 0.5
    assert sum(r.kept for r in verdict.values()) > 0.7 * sum(not r.base_failed for r in verdict.values())
    with Scratch(spark, "t") as s:
        got = judged(awkward, s)
        assert got.count() == awkward.count() and not got.filter("text is null and kept").count() if "text" in got.columns else True
    with Scratch(spark, "t") as s:
        assert judged(empty, s).count() == 0
    kept = accepted(awkward)
    assert kept.columns == awkward.columns and 0 < kept.count() < awkward.count()


def test_fertility_keeps_clean_texts_of_any_length(spark):
    import random

    files = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text", "lang")
    words = {}
    for d in files.filter("lang is not null and n_chars between 300 and 4000").collect():
        words.setdefault(d.lang, []).extend(d.text.split())
    r = random.Random(1)
    sizes = (1_000, 3_000, 10_000, 30_000, 100_000)
    long = [(-1 - 10 * i - k, " ".join(r.choices(words[lang], k=n)), lang) for i, lang in enumerate(sorted(words)) for k, n in enumerate(sizes)]
    with Scratch(spark, "t") as s:
        rows = judged(files.unionByName(spark.createDataFrame(long, files.schema)), s).filter("doc_id < 0").collect()
    assert len(rows) == len(long) >= 15 and not [(r.lang, r.n_words) for r in rows if not r.base_failed and not r.kept]
    assert sum(not r.base_failed for r in rows) >= 0.8 * len(rows)


def test_fertility_judges_rare_languages_and_short_texts(spark):
    files = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text", "lang")
    odd = " ".join(f"ꙮ{chr(0xA980 + i)}꧁꧂{chr(0xA990 + i)}" for i in range(40))
    signs = " ".join(f"%$#{i}|{i * 7}<>&*" for i in range(60))
    bad = [(-1, odd, "en"), (-2, odd, None), (-3, odd, "rare"), (-4, signs, None), (-5, signs, "rare"), (-6, signs, "en"),
           (-7, " ".join(odd.split()[:14]), "en"), (-8, " ".join(odd.split()[:14]), None), (-9, " ".join(signs.split()[:20]), "rare")]
    with Scratch(spark, "t") as s:
        rows = {r.doc_id: r for r in judged(files.unionByName(spark.createDataFrame(bad, files.schema)), s).collect()}
    assert not [r.doc_id for r in rows.values() if r.doc_id is not None and r.doc_id < 0 and (r.kept or r.base_failed)]
    assert rows[-5].band == "script LATIN" or rows[-5].band == "all"
    short = [r for r in rows.values() if r.doc_id is not None and r.doc_id >= 0 and 10 <= r.n_words < 30 and not r.base_failed]
    assert short and sum(r.kept for r in short) >= 0.9 * len(short)
    # Prose of a rare language, and short prose, stays.
    some = [r for r in files.filter("lang = 'en' and n_chars between 300 and 2000").collect() if rows[r.doc_id].kept][:20]
    same = [(-10 - i, r.text, "rare" if i % 2 else None) for i, r in enumerate(some)]
    with Scratch(spark, "t") as s:
        kept = judged(files.unionByName(spark.createDataFrame(same, files.schema)), s).filter("doc_id <= -10 and kept").count()
    assert kept >= 18


def test_decoding_and_toxicity(spark, empty):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    model = character_model(docs)
    for hidden, word in [("tr4sh", "trash"), ("m0r0n", "moron"), ("traaaash", "trash"), ("i d i o t", "idiot"), ("s.t.u.p.i.d", "stupid"), ("p4th3t1c", "pathetic")]:
        assert decode(hidden, model) == word
    extra = spark.createDataFrame(
        [(10**6, "the and tr4sh of the m0r0n is s t u p i d and the"), (10**6 + 1, "the and of the is that and the in for"), (10**6 + 2, None), (10**6 + 3, "")],
        "doc_id long, text string")
    with Scratch(spark, "t") as s:
        rows = {r.doc_id: r for r in toxicity(docs.select("doc_id", "text").unionByName(extra), labels, s).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for i, r in rows.items())
    assert rows[10**6].predicted == 1 and not any(rows[10**6 + i].predicted for i in (1, 2, 3))
    held = [(x.toxic, rows[x.doc_id].predicted) for x in labels.collect() if rows[x.doc_id].held_out]
    assert sum(a == b for a, b in held) >= 0.93 * len(held)
    with Scratch(spark, "t") as s:
        assert toxicity(empty, labels, s).count() == 0
    with Scratch(spark, "t") as s:
        assert {r.score for r in toxicity(extra, labels.limit(0), s).collect()} == {0.0}
    assert Lexicon(0.1, {"a": 0.5}).score({"a"}) == pytest.approx(0.55)


def test_words_hidden_in_any_place(spark):
    restorer = Restorer(character_model(table(spark, "/root/testdata/sf0.01", "documents")))
    lexicon: dict[str, list[str]] = {}
    for w in ("idiot", "moron", "trash", "stupid", "worthless", "loser", "asshole"):
        lexicon.setdefault(folded(w), []).append(w)
    for hidden, word in [("worthle$$", "worthless"), ("worthle55", "worthless"), ("worrthle$$", "worthless"), ("idio7", "idiot"), ("@$$hole", "asshole"),
                         ("!!!diot", "idiot"), ('"!diot', "idiot"), ("mmoorroonn", "moron"), ("losserr", "loser"), ("ttrraasshh", "trash"), ("tr4sh", "trash")]:
        assert restorer.known(hidden, lexicon) == {word}
    assert not any(restorer.known(w, lexicon) for w in ("as!", "2020", "(the)", "letter", "12:30"))
    for hidden, word in [("i - d - i - o - t", "idiot"), ("t   r   a   s   h", "trash"), ("m\u00a0o\u00a0r\u00a0o\u00a0n", "moron"), ("m o r\no n", "moron"),
                         ("s\n\nt\n\nu\n\np\n\ni\n\nd", "stupid"), ("m\u2003o\u200br\u2013o\u2003n", "moron")]:
        assert restorer.spaced(hidden) == [word]


URLS = [
    (1, "https://www.Example.com/en/1?a=b&c=d#top"), (2, "http://example.com/en/2"), (3, "http://x.example.com/de/"), (4, "ftp://NET/es/"),
    (5, "http://a.net/fr/x"), (6, "http://a.net/en/x"), (7, None), (8, "no scheme"), (9, "://"), (10, "http://com"), (11, "http://x.com?u=/en/"),
    (12, "a://b://com/"), (13, "http://notexample.com/en/"), (14, ""), (15, "http://a.net/en/x"),
]


def test_urls(spark):
    pages = spark.createDataFrame([(*u, "h") for u in URLS], "page_id long, url string, host string")
    with Scratch(spark, "t") as s:
        got = {r.page_id: r for r in url_filter.judged(pages, s).collect()}
    assert len(got) == len(URLS) and {r.verdict for r in got.values()} == {"allow", "block"}
    rules = {1: "www.example.com/en/", 2: "example.com/en/", 3: "com/", 4: "net/es/", 5: "net/fr/", 13: "com/"}
    assert {i: r.rule for i, r in got.items() if r.rule} == rules
    assert (got[1].host, got[1].path, got[11].host, got[11].path, got[7].host, got[12].host) == ("www.example.com", "/en/1", "x.com", "", "", "b:")
    with Scratch(spark, "t") as s:
        assert url_filter.judged(pages.limit(0), s).count() == 0
    with Scratch(spark, "t") as s:
        assert {r.verdict for r in url_filter.judged(pages, s, rules=()).collect()} == {"allow"}


def test_url_trees_learn(spark):
    """Blocked urls have many digits; the trees find this for urls without rules, on hosts of one suffix."""
    def spam(i):
        return f"{i * 7919}{i * 104729}?q={i}"

    rows = [(i, f"http://h{i % 9}.org/b{spam(i)}") for i in range(1, 120)] + [(500 + i, f"http://h{i % 9}.org/good/about/us/{i % 8}") for i in range(120)]
    rows += [(1000 + i, f"http://h{i % 9}.org/x{spam(i)}") for i in range(1, 20)] + [(2000 + i, f"http://h{i % 9}.org/fine/about/us/{i % 8}") for i in range(20)]
    rules = (url_filter.Rule("block", "org", "/b"), url_filter.Rule("allow", "org", "/good/"))
    with Scratch(spark, "t") as s:
        got = url_filter.judged(spark.createDataFrame(rows, "page_id long, url string"), s, rules=rules).filter("rule is null").collect()
    assert len(got) == 39 and sum((r.verdict == "block") == (r.page_id < 2000) for r in got) >= 36


def bigrams(text):
    w = re.sub("[^a-z0-9]+", " ", text.lower()).split()
    return {(a, b) for a, b in zip(w, w[1:], strict=False)}


def test_licences(spark, awkward, empty):
    mit = license_scan.TEMPLATES["MIT-text"]
    texts = [
        "prose before\nReleased under the MIT License.\nprose after", "released UNDER the mit licence", mit, mit.replace(" and ", "\n and "),
        f"first\n\n{mit.replace(', ', ',' + chr(10))}\n\nlast", mit[: len(mit) // 2], "Licensed under CC BY-NC 4.0.\nLicensed under CC BY 4.0.", None, "",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("unit", F.lit(0))
    got = {(r.doc_id, r.unit, r.unit_no): (r.license, round(r.dice, 6), r.n_bigrams) for r in license_scan.scan(df).collect()}
    expected = {}
    for i, t in enumerate(texts):
        if not t:
            continue
        paragraphs = re.split(r"\n *(?:\n *)+", t)
        units = [("line", k, x) for k, x in enumerate(t.split("\n"))] + [("paragraph", k, p) for k, p in enumerate(paragraphs) if "\n" in p.strip()]
        units += [("document", 0, t)] if len(paragraphs) > 1 else []
        for kind, k, x in units:
            g = bigrams(x)
            best = max(((2 * len(g & bigrams(b)) / (len(g) + len(bigrams(b))), n) for n, b in sorted(license_scan.TEMPLATES.items(), reverse=True)), default=None)
            if best[0] >= 0.8:
                expected[i, kind, k] = (best[1], round(best[0], 6), len(g))
    assert got == expected
    assert license_scan.scan(awkward).count() == 0 and license_scan.scan(empty).count() == 0
