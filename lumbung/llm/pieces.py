"""Public vocabularies applied piece by piece, with a memory of recent pieces.

Byte-level BPE splits a text before its merges; a space that is followed by a visible character always
starts a new piece, and so do a line break between visible characters and what follows it. Encoding these
parts one by one gives the ids of the whole text, and most parts were seen before. Texts with any other
white space are encoded whole.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Callable, Iterable, Sequence
from functools import cache

import numpy as np
import public_tokenizers

BYTE_BPE = "byte_bpe_50k.json"
BYTE_BPE_RANKS = "byte_bpe_50k.tiktoken"
PIECE_BPE = "piece_bpe_32k.model"

#: Marks a part without a leading space.
BARE = "\x01"
#: Marks a text that is encoded whole.
WHOLE = "\x02"


class _Slots(dict):
    def __init__(self):
        super().__init__()
        self.new: list[str | bytes] = []
        self.used = 0

    def __missing__(self, part: str | bytes) -> int:
        self[part] = slot = self.uncached(part)
        return slot

    def uncached(self, part: str | bytes) -> int:
        self.new.append(part)
        self.used += 1
        return self.used - 1


#: Ids of parts one after the other, in any order; where each part starts; how many it has.
Encoded = tuple[np.ndarray, np.ndarray, np.ndarray]


class Pieces:
    """Ids of parts under one vocabulary, and numbers that ``extra`` has for each part.

    Texts with a string of ``apart``, to which the vocabulary gives an id of its own, are encoded whole.
    """

    def __init__(self, encode: Callable[[list], Encoded], extra: Callable[[list], np.ndarray] | None = None, width: int = 0,
                 cap: int = 600_000, apart: Sequence[str] = ()):
        self.encode, self.extra, self.width, self.cap, self.apart = encode, extra, width, cap, tuple(apart)
        self._clear()

    def _clear(self) -> None:
        self.slots, self.filled = _Slots(), 0
        self.lengths, self.starts = np.empty(1 << 12, np.int64), np.empty(1 << 12, np.int64)
        self.flat, self.more = np.empty(1 << 14, np.uint32), np.empty((1 << 12, self.width), np.int64)

    def start(self) -> None:
        """Forget the parts if there are too many; slots from before are then void."""
        if self.slots.used > self.cap or self.filled > 16 * self.cap:
            self._clear()

    def of(self, parts: Sequence) -> np.ndarray:
        return np.fromiter(map(self.slots.__getitem__, parts), np.int64, len(parts))

    def learn(self) -> None:
        new, known = self.slots.new, self.slots.used - len(self.slots.new)
        if not new:
            return
        flat, starts, sizes = self.encode(new)
        self.lengths, self.starts = _room(self.lengths, self.slots.used), _room(self.starts, self.slots.used)
        self.flat = _room(self.flat, self.filled + len(flat))
        self.lengths[known: self.slots.used] = sizes
        self.starts[known: self.slots.used] = self.filled + starts
        self.flat[self.filled: self.filled + len(flat)] = flat
        self.filled += len(flat)
        if self.extra:
            self.more = _room(self.more, self.slots.used)
            self.more[known: self.slots.used] = self.extra(new)
        new.clear()

    def counts(self, slots: np.ndarray) -> np.ndarray:
        self.learn()
        return self.lengths[slots]

    def ids(self, slots: np.ndarray) -> np.ndarray:
        """The ids of all parts, one after the other."""
        sizes = self.counts(slots)
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.starts[slots] - ends + sizes, sizes) + np.arange(total)]


def _room(a: np.ndarray, size: int) -> np.ndarray:
    if size <= len(a):
        return a
    wider = np.empty((max(size, 2 * len(a)), *a.shape[1:]), a.dtype)
    wider[: len(a)] = a
    return wider


def text_slots(text: str, pieces: Pieces) -> np.ndarray:
    """Slots of the parts of a whole text under a byte-level vocabulary."""
    if not text:
        return np.empty(0, np.int64)
    # Single spaces and line breaks between words without any white space inside.
    if BARE in text or WHOLE in text or any(x in text for x in pieces.apart) or text.split() != text.replace("\n", " ").split(" "):
        return np.array([pieces.slots.uncached(WHOLE + text)])
    return pieces.of((BARE + text.replace("\n", f" \n {BARE}")).split(" "))


def _plain(part: str | bytes) -> str:
    if isinstance(part, bytes):
        return " " + part.decode()
    return part[1:] if part[0] in (BARE, WHOLE) else part if part == "\n" else " " + part


def byte_level(encode: Callable[[list[str]], Iterable[Sequence[int]]], slab: int = 1000) -> Callable[[list], Encoded]:
    """Parts without white space are encoded many at a time: a line break between them is always one id of its own."""
    line = list(encode(["\n"]))[0][0]

    def run(parts: list) -> Encoded:
        starts, sizes = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
        alone = [i for i, p in enumerate(parts) if p == "\n" or p[0] == WHOLE]
        other = np.delete(np.arange(len(parts)), alone)
        done, at = [np.empty(0, np.uint32)], 0
        for s in range(0, len(other), slab):
            some = other[s: s + slab]
            ids = np.asarray(next(iter(encode(["\n".join([_plain(parts[i]) for i in some])]))), np.uint32)
            ends = np.append(np.flatnonzero(ids == line), len(ids))
            if len(ends) != len(some):
                raise ValueError("the vocabulary does not keep line breaks apart")
            starts[some] = at + np.append(0, ends[:-1] + 1)
            sizes[some] = at + ends - starts[some]
            done.append(ids)
            at += len(ids)
        for i, ids in zip(alone, encode([_plain(parts[i]) for i in alone]), strict=True):
            done.append(np.asarray(ids, np.uint32))
            starts[i], sizes[i] = at, len(ids)
            at += len(ids)
        return np.concatenate(done), starts, sizes

    return run


@cache
def byte_bpe(path: str | None = None) -> Pieces:
    """The byte-level vocabulary of the tokenizers library; a Python worker keeps it, and its memory, from task to task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path or public_tokenizers.path(BYTE_BPE))
    encode = byte_level(lambda texts: (e.ids for e in t.encode_batch_fast(texts, add_special_tokens=False)))
    return Pieces(encode, apart=[x.content for x in t.get_added_tokens_decoder().values()])


def byte_bpe_ranks(path: str | None = None, **more) -> Pieces:
    """The same vocabulary from its rank file, by tiktoken; takes bytes as words with a leading space, too."""
    import tiktoken

    with open(path or public_tokenizers.path(BYTE_BPE_RANKS), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    e = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return Pieces(byte_level(lambda texts: map(e.encode_ordinary, texts)), **more)


def fallback_counts(path: str | None = None) -> Callable[[list[bytes]], np.ndarray]:
    """For words: tokens under the vocabulary with byte fallback, and how many of these are single bytes."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path(PIECE_BPE))
    single = np.array([sp.is_byte(i) for i in range(sp.vocab_size())], np.int64)

    def run(words: list[bytes]) -> np.ndarray:
        ids = sp.encode([w.decode() for w in words], num_threads=1)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        owner = np.repeat(np.arange(len(ids)), sizes)
        flat = np.fromiter((i for x in ids for i in x), np.int64, int(sizes.sum()))
        return np.stack([sizes, np.bincount(owner, weights=single[flat], minlength=len(ids)).astype(np.int64)], 1)

    return run
