"""Token ids of whole texts, through a bounded memo of chunks.

The tokenizers library is slow for each word but natural text repeats its
words, so each worker remembers the ids of the chunks it met lately. Chunks are
cut where no tokenizer of the two kinds used here joins characters: before a
run of white space that follows something else. A chunk's ids then do not
depend on what stands around it, and a text's ids are those of its chunks in
order. A tokenizer that drops white space and case has words as its chunks,
with A-Z lowered. A text that holds the string of a special token is encoded
whole by the library, which gives it that token's id, unless special tokens are
to count as text. What the library itself returns for whole texts is the test's
standard.
"""

from __future__ import annotations

import itertools
import operator
import os
import re
import unicodedata
from array import array
from collections.abc import Iterable

import numpy as np
from tokenizers import Tokenizer, pre_tokenizers

from . import common

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a worker has one core

#: White space as the tokenizers' patterns mean it (Unicode White_Space).
WHITE = "\t-\r " + "".join(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_WHITE = frozenset(WHITE)
_CHUNKS = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
_ODD = ("  ", "\n\n", " \n", "\n ", "\0", *sorted(_WHITE - {" ", "\n"}))
_ODD_ASCII = tuple(x for x in _ODD if x.isascii())
#: Entries in each half of a worker's memo; about 200 bytes each.
MEMO = 1_000_000
#: Chunks encoded together, their greatest length, and what may follow a word's letters.
TOGETHER, LONG, MARKS = 128, 64, "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

#: Letters in every version of Unicode in use, in lower case too, and digits.
STEADY = frozenset(c for c in map(chr, range(0x530)) if c.isalpha() and c.lower().isalpha() or c in "0123456789")

_loaded: dict[tuple[str, bool], Encoder] = {}


def cut(text: str) -> list[str]:
    """White space with what follows it. A text in which single spaces and line feeds
    stand before something else, as most do, is split at them, which is faster."""
    if text[-1:] in _WHITE or any(c in text for c in (_ODD_ASCII if text.isascii() else _ODD)):
        return _CHUNKS.findall(text)
    parts = text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")
    return parts if parts[0] else parts[1:]


class Young(dict):
    """The young half of a memo: what is looked up and old gets young, and what is
    nowhere is noted and gives None."""

    def __init__(self, old: dict):
        self.old, self.unknown = old, set()

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            self.unknown.add(key)
        else:
            self[key] = value
        return value


class Memo(common.Generations):
    def __init__(self, size: int):
        super().__init__(size)
        self.clear()

    def clear(self) -> None:
        self.old = {}
        self.young = Young(self.old)

    def age(self) -> None:
        if len(self.young) > self.size:
            self.young.old, self.old = {}, self.young
            self.young = Young(self.old)

    def look_up(self, keys) -> tuple[list, set]:
        """Each key's value, None if unknown; and the distinct unknown keys."""
        self.use()
        self.young.unknown = set()
        return list(map(self.young.__getitem__, keys)), self.young.unknown


class Encoder:
    """``ids(texts)``: each text's ids as packed unsigned 32-bit integers.

    Unknown chunks are encoded many at a time, because a call costs as much as
    some words. Where a chunk's ids end is known without asking: byte-level
    tokens have the lengths of their bytes, and tokens with a word-end mark end
    the pieces that a word of letters with punctuation after it consists of.
    """

    def __init__(self, path: str, special_as_text: bool = False):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(t.normalized for t in added):
            raise ValueError("added tokens that are sought in normalised text aren't supported")
        self.special = [] if special_as_text else [t.content.encode() for t in added]
        self.memo = Memo(MEMO)
        a, b, both = (self.tokenizer.encode(x, add_special_tokens=False).ids for x in ("ab", "cd", " \tAB\n  Cd "))
        self.plain = both == a + b
        # chunks are of texts without the string of a special token, which lower case may make of others
        self.chunks = Tokenizer.from_file(path)
        self.chunks.encode_special_tokens = True
        self.letters = self.of_letters(path) if self.plain else self.chunks
        vocabulary = self.tokenizer.get_vocab()
        size = max(vocabulary.values()) + 1
        self.ends, self.bytes = np.zeros(size, bool), np.zeros(size, np.int64)
        for token, i in vocabulary.items():
            self.ends[i], self.bytes[i] = token.endswith("</w>"), len(token)

    def of_letters(self, path: str) -> Tokenizer:
        """The tokenizer for words of letters that normalisation leaves as they are, a line each."""
        out = Tokenizer.from_file(path)
        out.normalizer = None
        out.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split("\n", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        return out

    def cut(self, text: bytes) -> list:
        return text.lower().split() if self.plain else cut(text.decode("utf-8", "replace"))

    def simple(self, chunk: str) -> bool:
        """Whether a chunk may be encoded next to others."""
        if not self.plain:
            return chunk[0] in _WHITE and chunk[-1] not in _WHITE
        return chunk.isalpha() and (chunk.isascii() or STEADY.issuperset(chunk) and chunk == chunk.lower() and unicodedata.is_normalized("NFC", chunk))

    def together(self, chunks: list[str]) -> list[bytes] | None:
        """The ids of simple chunks; None if they don't fall apart as foreseen."""
        whole = ("\n" if self.plain else "").join(chunks)
        ids = np.array(self.letters.encode_batch_fast([whole], add_special_tokens=False)[0].ids, np.uint32)
        if self.plain:
            stop = np.flatnonzero(self.ends[ids]) + 1
            if len(stop) != len(chunks):
                return None
        else:
            at, want = np.cumsum(self.bytes[ids]), np.cumsum([len(c.encode()) for c in chunks])
            stop = np.searchsorted(at, want) + 1
            if len(ids) < stop[-1] or (at[stop - 1] != want).any():
                return None
        raw, edges = ids.tobytes(), [0, *(4 * stop).tolist()]
        return [raw[i:j] for i, j in zip(edges, edges[1:], strict=False)]

    def each(self, strings: list[str], tokenizer: Tokenizer) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in tokenizer.encode_batch_fast(strings, add_special_tokens=False)]

    def learn(self, new: Iterable) -> None:
        plain, halves, cores, ends, rest = self.plain, [], [], [], []  # lists of strings, which cost the garbage collector nothing
        for c in new:
            text = c.decode("utf-8", "replace") if plain else c
            if text[-1] in MARKS and (core := text.rstrip(MARKS)) and core[-1] in STEADY:
                n = len(core) - len(text)
                halves.append(c)
                cores.append(c[:n])
                ends.append(c[n:])
            else:
                rest.append(c)
        self.ask(rest)
        self.ask(self.memo.look_up({*cores, *ends})[1])
        known = self.memo.young.__getitem__
        self.memo.learn(zip(halves, map(operator.add, map(known, cores), map(known, ends)), strict=True))

    def ask(self, new: Iterable) -> None:
        """Learn chunks from the library."""
        plain, simple, run, alone, run_texts, alone_texts = self.plain, self.simple, [], [], [], []
        for c in new:
            text = c.decode("utf-8", "replace") if plain else c
            if len(text) <= LONG and simple(text):
                run.append(c)
                run_texts.append(text)
            else:
                alone.append(c)
                alone_texts.append(text)
        for i in range(0, len(run), TOGETHER):
            texts = run_texts[i : i + TOGETHER]
            self.memo.learn(zip(run[i : i + TOGETHER], self.together(texts) or self.each(texts, self.chunks), strict=True))
        for i in range(0, len(alone), 4096):
            self.memo.learn(zip(alone[i : i + 4096], self.each(alone_texts[i : i + 4096], self.chunks), strict=True))

    def ids(self, texts: list[bytes]) -> list[bytes]:
        whole = [any(s in t for s in self.special) for t in texts]
        cut = [[] if w else self.cut(t) for t, w in zip(texts, whole, strict=True)]
        chunks = list(itertools.chain.from_iterable(cut))
        ids, unknown = self.memo.look_up(chunks)
        self.learn(unknown)
        known = self.memo.young
        for i in [i for i, x in enumerate(ids) if x is None]:
            ids[i] = known[chunks[i]]
        edges = [0, *itertools.accumulate(map(len, cut))]
        out = [self.each([t.decode("utf-8", "replace")], self.tokenizer)[0] if w else b"".join(ids[a:b]) for t, w, a, b in zip(texts, whole, edges, edges[1:], strict=False)]
        self.memo.age()
        return out


def encoder(path: str, special_as_text: bool = False) -> Encoder:
    """This worker's encoder for a vocabulary file, kept until another operator runs."""
    common.working("tokens", _loaded.clear)
    if (path, special_as_text) not in _loaded:
        _loaded[path, special_as_text] = Encoder(path, special_as_text)
    return _loaded[path, special_as_text]
