"""Toxicity of texts that hide words by leetspeak, spacing or repetition.

1. A character trigram model is counted over the words of all documents (letters a-z, any other letter, word end).
2. Every distinct word with a digit or sign that may stand for a letter, at any place, or with a repeated letter, and every
   stretch of single letters with separators between them (runs of any length, Unicode spaces and line breaks too)
   becomes a lattice: every observed character may stand for itself or for the letters it imitates, a repeated
   letter may be dropped, a separator may be dropped or end the word.
   Viterbi finds the likeliest path through the lattice under the trigram model and the costs of the channel. All
   states are kept. Any other word has one path, itself; so has a word of digits alone, which is a number.
3. Labelled documents outside the held-out third, restored in the same way, give a lexicon: words that are frequent in
   toxic documents and nearly absent from others. Support counts the different words before a word, so copies of
   one text count once. A text's score is a noisy-or of the words in its restored form.

Labels are learned from at most ``train_rows`` labelled documents (by a hash of their ids); all else covers all
documents. NULL and empty texts score as texts without any word of the lexicon. Without labels of both kinds the
score is the share of toxic labels (0 without any). Rows are scored one by one, repeated ones too.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.llm.common import Scratch, result, slices, table

LETTERS = 28  # 0: word end, 1-26: a-z, 27: any other letter
#: What a character may stand for besides itself. Fixed values.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "*": "aeiou", "#": "h",
}
#: Between spaced-out letters, besides all white space of Unicode; the last are invisible.
SEPARATORS = ".-_*,/~:;'\u2010\u2011\u2012\u2013\u2014\u00b7\u2022\u00ad\u200b\u200c\u200d\u2060\ufeff"
#: Costs of the channel, in nats: a look-alike; a sign or separator that ends a word; a dropped separator; a repeated
#: letter that is dropped or kept, in runs of two and in longer ones.
SWAP, END, DROP_SEPARATOR = 1.0, 8.0, 0.5
DROP_REPEAT, KEEP_REPEAT = {False: 3.0, True: 0.3}, {False: 0.0, True: 1.5}

_SIGN = "[" + re.escape("".join(LEET)) + "]"
_SINGLE = rf"(?:[a-z]|{_SIGN})"
_BETWEEN = rf"[\s{re.escape(SEPARATORS)}]"
#: Spaced-out letters, anywhere in a text.
SPACED = re.compile(rf"(?<![a-z0-9]){_SINGLE}(?:{_BETWEEN}+{_SINGLE}(?![a-z0-9])){{2,}}")
#: A run of separators that are no signs is one.
RUN = re.compile(rf"[\s{re.escape(SEPARATORS.replace('*', ''))}]+")
#: Words that are more than themselves: with a look-alike or a letter twice or more in a row.
ODD = re.compile(rf"{_SIGN}|([^\W\d_])\1")
WORD = re.compile(r"[^\W\d_]+")


def _alphabet() -> np.ndarray:
    """Letter number of each byte of lower-cased UTF-8; bytes after the first of a character count as nothing (255)."""
    t = np.zeros(256, np.uint8)
    for c in range(26):
        t[97 + c] = t[65 + c] = c + 1
    t[0xC3:0xF5] = 27
    t[0x80:0xC0] = 255
    return t


_OF_BYTE = _alphabet()


def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of letter trigrams of all texts a task reads; a word has two word ends before it and one behind it."""
    cells = np.zeros(LETTERS**3, np.int64)
    for b in slices(batches):
        raw = b"\n".join(t or b"" for t in b.column("text").cast(pa.large_binary()).to_pylist())
        x = _OF_BYTE[np.frombuffer(raw, np.uint8)]
        x = x[x != 255]
        # Word ends: one between words is read as the end of the last and both ends before the next.
        x = np.concatenate([[0], x[(x > 0) | np.append(x[1:] > 0, False)], [0]]).astype(np.int64)
        if len(x) < 3:
            continue
        two = np.where(x[1:-1] == 0, 0, x[:-2])  # nothing is remembered across a word end
        cells += np.bincount((two * LETTERS + x[1:-1]) * LETTERS + x[2:], minlength=LETTERS**3)
    used = np.flatnonzero(cells)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(cells[used])], ["cell", "times"])


def character_model(docs: DataFrame) -> np.ndarray:
    """Log-probabilities [two back, one back, letter], smoothed, from all documents."""
    counts = np.zeros(LETTERS**3)
    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_trigrams, "cell long, times long")
    for r in found.groupBy("cell").agg(F.sum("times").alias("times")).collect():  # at most LETTERS ** 3 rows
        counts[r["cell"]] = r["times"]
    counts = counts.reshape(LETTERS, LETTERS, LETTERS)
    pairs, single = counts.sum(0), counts.sum((0, 1)) + 1
    one = single / single.sum()
    two = (pairs + 5 * one) / (pairs.sum(1, keepdims=True) + 5)
    return np.log((counts + 5 * two) / (counts.sum(2, keepdims=True) + 5))


def _letter(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 27


def decode(stretch: str, model: np.ndarray | list, drop: bool = True) -> str:
    """Likeliest text behind a lower-cased stretch: Viterbi over the last two letters and the last character read.

    Without ``drop``, both letters of a double one stay.
    """
    # state: (two back, one back, last letter of the channel) -> (cost, text as linked pairs)
    states = {(0, 0, ""): (0.0, None)}
    for at, c in enumerate(stretch):
        if c.isalpha() and not any(state[2] == c for state in states):  # one way on from every state
            n, ahead = _letter(c), {}
            for (a, b, _), (cost, text) in states.items():
                cost -= model[a][b][n]
                state = (b, n, c)
                if state not in ahead or cost < ahead[state][0]:
                    ahead[state] = (cost, (text, c))
            states = ahead
            continue
        long = stretch[max(at - 2, 0): at + 1] == 3 * c or stretch[at - 1: at + 2] == 3 * c
        ways: list[tuple[str, float]] = []  # (letter, channel cost); "" ends the word
        if c.isalpha():
            ways.append((c, 0.0))
        ways += [(x, SWAP) for x in LEET.get(c, "")]
        if not c.isalpha():
            ways.append((" ", END))
        nxt: dict = {}

        def offer(state, cost, text, nxt=nxt):
            if state not in nxt or cost < nxt[state][0]:
                nxt[state] = (cost, text)

        for (a, b, last), (cost, text) in states.items():
            for letter, price in ways:
                if letter == " ":
                    # end of word (once), or a separator that is dropped
                    if b:
                        offer((0, 0, ""), cost + price - model[a][b][0], (text, " "))
                    else:
                        offer((a, b, ""), cost + price, text)
                    if c.isspace() or c in SEPARATORS:
                        offer((a, b, ""), cost + DROP_SEPARATOR, text)
                    continue
                n = _letter(letter)
                if letter == last:
                    if drop or long:
                        offer((a, b, last), cost + price + DROP_REPEAT[long], text)
                    price += KEEP_REPEAT[long]
                offer((b, n, letter), cost + price - model[a][b][n], (text, letter))
        states = nxt
    best, text = math.inf, None
    for (a, b, _), (cost, linked) in states.items():
        cost -= model[a][b][0] if b else 0.0
        if cost < best:
            best, text = cost, linked
    out = []
    while text:
        text, letter = text
        out.append(letter)
    return "".join(reversed(out))


class _Odd(dict):
    """Restored form of a word, or "" for an ordinary one; remembers recent words."""

    def __init__(self, decoded):
        super().__init__()
        self.decoded = decoded

    def __missing__(self, word: str) -> str:
        if len(self) > 200_000:
            self.clear()
        self[word] = form = " ".join(self.decoded(word)) if ODD.search(word) and not word.isdecimal() else ""
        return form


REPEAT = re.compile(r"(.)\1+")


def folded(word: str) -> str:
    """The word without repeated letters."""
    return REPEAT.sub(r"\1", word)


def _runs(word: str) -> list[int]:
    return [len(m[0]) for m in re.finditer(r"(.)\1*", word)]


class _Hidden(dict):
    """Words of a lexicon, given by their folded forms, that a word hides; remembers recent words."""

    def __init__(self, restorer: Restorer, words: dict[str, list[str]]):
        super().__init__()
        self.restorer, self.words = restorer, words

    def __missing__(self, word: str) -> frozenset[str]:
        if len(self) > 200_000:
            self.clear()
        self[word] = out = frozenset(self.restorer.known(word, self.words))
        return out


class Restorer:
    """Decodes the suspicious stretches of texts."""

    def __init__(self, model: np.ndarray, longest: int = 400):
        self.model, self.longest, self.odd = model.tolist(), longest, _Odd(self.decoded)

    def decoded(self, stretch: str, drop: bool = True) -> list[str]:
        """Restored form; of a long stretch in pieces that overlap by half, so that no short word is cut in all of them."""
        step = self.longest // 2
        return [decode(stretch[i: i + self.longest], self.model, drop) for i in range(0, max(len(stretch) - step, 1), step)]

    def hidden(self, lowered: str) -> list[str]:
        """Restored forms of the odd words of a lower-cased text."""
        return [form for w in set(lowered.split()) if (form := self.odd[w])]

    def known(self, word: str, words: dict[str, list[str]]) -> set[str]:
        """Which of ``words`` (by their folded form) an odd word hides.

        The likeliest path may drop one letter of a pair too many, or one too few. If it dropped any, all words count that
        are spelled alike but for repeated letters and repeat none more often than the word does.
        """
        out: set[str] = set()
        if not ODD.search(word):
            return out
        form = self.odd[word]
        for w in WORD.findall(form):
            if same := words.get(folded(w)):
                out.update({w}.intersection(same))
                for full in {x for part in self.decoded(word, False) for x in WORD.findall(part)}.difference(WORD.findall(form)):
                    if folded(full) == folded(w):
                        out.update(x for x in same if all(a <= b for a, b in zip(_runs(x), _runs(full), strict=True)))
        return out

    def spaced(self, lowered: str) -> list[str]:
        """Restored forms of its spaced-out stretches. Words may touch there, as nothing else divides them."""
        return [form for found in SPACED.finditer(lowered) for form in self.decoded(RUN.sub(" ", found[0]))]


def restored_words(text: str | None, restorer: Restorer) -> dict[str, str]:
    """Each word of the text and of its restored stretches, with the word before its first place."""
    lowered = (text or "").lower()
    out: dict[str, str] = {}
    for part in (lowered, *restorer.hidden(lowered), *restorer.spaced(lowered)):
        before = ""
        for w in WORD.findall(part):
            out.setdefault(w, before)
            before = w
    return out


def _training_words(model: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        for b in slices(batches, 100):
            words = [list(restored_words(t, restorer).items()) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("toxic"), pa.array([[{"word": w, "before": x} for w, x in found] for found in words],
                                             pa.list_(pa.struct([("word", pa.string()), ("before", pa.string())])))], ["toxic", "words"])
    return run


@dataclass
class Lexicon:
    """Noisy-or of a few words: how likely a text without any of them is toxic, and each word by itself."""

    base: float
    words: dict[str, float]

    def score(self, found: set[str]) -> float:
        return 1 - (1 - self.base) * math.prod(1 - self.words[w] for w in found)


def train(docs: DataFrame, labels: DataFrame, model: np.ndarray, scratch: Scratch, train_rows: int = 20_000, most_words: int = 2_000,
          doubt: float = 4.0) -> Lexicon:
    """Lexicon of at most ``most_words`` words from at most ``train_rows`` rows of ``labels`` (doc_id, toxic)."""
    chosen = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = scratch.keep(chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows), "labels")
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")  # train_rows at most
    rows = scratch.keep(
        texts.select("toxic", "text").mapInArrow(_training_words(model), "toxic int, words array<struct<word:string,before:string>>")
        .withColumn("toxic", (F.col("toxic") > 0).cast("int")), "words")
    yes, no = rows.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.coalesce(F.sum(1 - F.col("toxic")), F.lit(0))).first()
    if not yes or not no:
        return Lexicon(1.0 if yes else 0.0, {})
    least = max(4, yes // 100)
    words = rows.select("toxic", F.explode("words").alias("w")).select("toxic", "w.word", "w.before").groupBy("word").agg(
        F.sum("toxic").alias("yes"), F.sum(1 - F.col("toxic")).alias("no"),
        F.approx_count_distinct(F.when(F.col("toxic") == 1, F.col("before"))).alias("support"))
    # Were both kinds as frequent, nine of ten documents with the word would be toxic.
    words = words.filter((F.col("support") >= least) & (F.col("yes") * no > 9 * (F.col("no") + 0.5) * yes))
    # Few sightings are drawn towards the share of toxic documents by ``doubt`` more.
    share = yes / (yes + no)
    known = {r["word"]: (r["support"] + doubt * share) / (r["support"] + r["no"] + doubt)
             for r in words.orderBy(F.desc("support"), "word").limit(most_words).collect()}
    plain = rows.filter(~F.arrays_overlap("words.word", F.array(*map(F.lit, known)))) if known else rows
    missed, clean = plain.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count(F.lit(1))).first()
    return Lexicon((missed + share) / (clean + 1), known)


def _scores(model: np.ndarray, lexicon: Lexicon):
    def one(text: str | None, restorer: Restorer, hidden: _Hidden) -> float:
        lowered = (text or "").lower()
        found = {w for w in lexicon.words if w in lowered and whole[w].search(lowered)}
        found.update(*map(hidden.__getitem__, set(lowered.split())))
        for part in restorer.spaced(lowered):
            found |= {w for w in lexicon.words if len(w) > 3 and w in part}
        return lexicon.score(found)

    by_form: dict[str, list[str]] = {}
    for w in lexicon.words:
        by_form.setdefault(folded(w), []).append(w)
    whole = {w: re.compile(rf"(?<![^\W\d_]){re.escape(w)}(?![^\W\d_])") for w in lexicon.words}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        hidden = _Hidden(restorer, by_form)
        for b in slices(batches):
            rest = [n for n in b.schema.names if n != "text"]
            scores = pa.array([one(t, restorer, hidden) for t in b.column("text").to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*map(b.column, rest), scores], [*rest, "score"])
    return run


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, scratch: Scratch, train_rows: int = 20_000, threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs`` (doc_id, text).

    ``labels`` (doc_id, toxic) outside the held-out third are learned from. A row without id is not held out.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = character_model(rows)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    lexicon = train(rows, known.filter(~held_out(F.col("doc_id"))), model, scratch, train_rows)
    scored = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(
        _scores(model, lexicon), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op3_deobfuscated_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document."""
    with Scratch(spark, "toxicity") as scratch:
        rows = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), scratch)
        return result(rows, "op3")
