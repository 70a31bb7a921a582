"""Token ids of a byte-level vocabulary, with a memo of arrays.

A byte-level tokenizer cuts a text by its own pattern before it merges bytes.
Chunks end here where that pattern ends a match whatever stands around it:
before white space that follows something else, and between a letter and ASCII
punctuation. Many texts are cut, and their chunks looked up, at once as arrays
of their bytes; a chunk of up to 15 bytes is its own key, so that equal keys
are equal chunks. What is unknown goes to the tokenizers library: chunks of
white space, letters, digits and punctuation many in one string without its
pattern, if no token of the vocabulary could join two of them or two matches of
the pattern; all others by the whole tokenizer.
"""

from __future__ import annotations

import json
import re
from itertools import pairwise

import numpy as np
from tokenizers import Tokenizer

from . import common, tokens

#: Chunks that a worker's memo holds, of up to about 45 bytes each; at most so many are looked up at once.
MEMO, BLOCK = 1 << 20, 1 << 18
#: Longer chunks have numbers as keys: up to NAMED bytes so many are remembered, beyond none.
KEY, NAMED, NAMES = 15, 64, 1 << 16
#: Bytes of chunks that are encoded in one string; strings, and other chunks, in one call.
TOGETHER, STRINGS, ALONE = 4096, 32, 4096

_WHITE = np.zeros(256, bool)
_WHITE[[*range(9, 14), 32]] = True
_MARK, _LETTER = np.zeros(256, bool), np.zeros(256, bool)
_MARK[list(tokens.MARKS.encode())] = True
_LETTER[[*range(65, 91), *range(97, 123)]] = True
#: The low bytes of a word, by how many.
_LOW = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Letters are those of Latin and Cyrillic blocks that hold nothing else; no apostrophe, which may join letters.
_SAFE = rb"[!-&(-~]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|[\xc4-\xc8\xd0\xd1][\x80-\xbf]|\xc9[\x80-\x8f]"
_RUN = re.compile(rb"[ \n](?:" + _SAFE + rb")+")
_SAFE_BYTES = frozenset([*b" \n", *range(33, 39), *range(40, 127), *range(0x80, 0xC0), *range(0xC3, 0xCA), 0xD0, 0xD1])
#: What a token must not hold: white space after something else, anything after a line feed, bytes of two classes.
_ACROSS = re.compile(rb"[^ \n][ \n]|\n[^\n]|[A-Za-z\x80-\xff][^A-Za-z\x80-\xff]|[0-9][^0-9]|[!-/:-@\[-`{-~][^!-/:-@\[-`{-~]")


def alphabet() -> np.ndarray:
    """The character that stands for each byte in a byte-level vocabulary."""
    own = [*range(33, 127), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in own]
    out = np.arange(256, dtype=np.uint16)
    out[other] = np.arange(256, 256 + len(other))
    return out


class Memo(common.Generations):
    """Ids by key. When it is full, what was not looked up since it last was full goes."""

    def __init__(self, size: int, kind: type):
        super().__init__(size)
        self.kind, self.serial = kind, 0
        self.clear()

    def clear(self) -> None:
        self.slots = np.full(1 << (2 * self.size - 1).bit_length(), -1, np.int32)
        self.keys, self.used = np.zeros((self.size, 2), np.uint64), np.zeros(self.size, bool)
        self.start, self.count = np.zeros(self.size, np.int64), np.zeros(self.size, np.int32)
        self.ids, self.n, self.filled = np.zeros(4 * self.size, self.kind), 0, 0
        self.names: dict[bytes, int] = {}

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return (common.mix(keys[:, 0] ^ common.mix(keys[:, 1])) & np.uint64(len(self.slots) - 1)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Each key's entry; -1 if unknown."""
        out, left, at = np.full(len(keys), -1, np.int32), np.arange(len(keys)), self.slot(keys)
        while len(left):
            e = self.slots[at]
            k = self.keys[e]
            same = (k[:, 0] == keys[:, 0]) & (k[:, 1] == keys[:, 1]) & (e >= 0)
            out[left[same]] = e[same]
            on = ~same & (e >= 0)
            left, keys, at = left[on], keys[on], at[on] + 1 & len(self.slots) - 1
        self.used[out[out >= 0]] = True
        return out

    def put(self, keys: np.ndarray, count: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """New entries for distinct unknown keys; ``ids`` are those of all of them in order."""
        e = np.arange(self.n, self.n + len(keys), dtype=np.int32)
        out, at = e, self.slot(keys)
        self.keys[e], self.count[e], self.used[e] = keys, count, False
        self.start[e] = self.filled + np.cumsum(count) - count
        if self.filled + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.filled], np.zeros(len(ids) + self.size, self.kind)])
        self.ids[self.filled : self.filled + len(ids)] = ids
        self.n, self.filled = self.n + len(keys), self.filled + len(ids)
        while len(e):
            free = self.slots[at] < 0
            self.slots[at[free]] = e[free]
            lost = self.slots[at] != e
            e, at = e[lost], at[lost] + 1 & len(self.slots) - 1
        return out

    def of(self, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each entry has, and the ids of all in order."""
        count = self.count[e].astype(np.int64)
        return count, self.ids[np.repeat(self.start[e] - np.cumsum(count) + count, count) + np.arange(count.sum())]

    def room(self, many: int) -> None:
        """Make sure that so many entries (``size`` at most) may come."""
        if self.n + many <= self.size and self.filled <= 8 * self.size:
            return
        keep = np.flatnonzero(self.used[: self.n])[-min(self.size // 2, self.size - many) or self.n :]
        keep = keep[np.cumsum(self.count[keep]) <= 2 * self.size]
        keys, (count, ids), names = self.keys[keep], self.of(keep), self.names
        self.clear()
        self.names = names
        self.put(keys, count, ids)

    def names_of(self, chunks: list[bytes]) -> list[int]:
        """Numbers as keys of long chunks, never given twice."""
        if len(self.names) > NAMES:
            self.names = {}
        out, once = [], {}
        for c in chunks:
            known = self.names if len(c) <= NAMED else once
            if c not in known:
                known[c] = self.serial
                self.serial += 1
            out.append(known[c])
        return out


class ByteEncoder(tokens.Encoder):
    """``ids(texts)`` as ``tokens.Encoder`` gives them, for byte-level vocabularies."""

    def __init__(self, path: str, special_as_text: bool = False):
        super().__init__(path, special_as_text)
        if not self.suits(self.tokenizer):
            raise ValueError("not a byte-level vocabulary with the pattern meant here")
        self.memo = Memo(MEMO, np.uint16 if len(self.bytes) <= 1 << 16 else np.uint32)
        self.alphabet = alphabet()
        byte = {chr(c): b for b, c in enumerate(self.alphabet)}
        whole = [bytes(byte[c] for c in t) for t in self.tokenizer.get_vocab(with_added_tokens=False)]
        self.bare = None
        if not any(_SAFE_BYTES.issuperset(t) and _ACROSS.search(t) for t in whole):
            self.bare = Tokenizer.from_file(path)
            self.bare.normalizer = self.bare.pre_tokenizer = None
            self.bare.encode_special_tokens = True

    @staticmethod
    def suits(tokenizer: Tokenizer) -> bool:
        spec = json.loads(tokenizer.to_str())
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        return spec["normalizer"] is None and (pre.get("type"), pre.get("use_regex"), pre.get("add_prefix_space")) == ("ByteLevel", True, False) and model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix"))

    def starts(self, b: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Where the chunks of texts start that stand from edge to edge."""
        white = _WHITE[b]
        lead = np.flatnonzero((b == 0xC2) | (b >= 0xE1) & (b <= 0xE3))
        for s in (c.encode() for c in tokens.WHITE if not c.isascii()) if len(lead) else ():
            at = lead[lead <= len(b) - len(s)]
            for k, x in enumerate(s):
                at = at[b[at + k] == x]
            for k in range(len(s)):
                white[at + k] = True
        letter = _LETTER[b]
        latin = np.flatnonzero(b[:-1] == 0xC3) + 1
        letter[latin] = (b[latin] != 0x97) & (b[latin] != 0xB7)
        start = white.copy()
        start[1:] &= ~white[:-1]
        start[1:] |= _MARK[b[1:]] & letter[:-1]
        start[edges[:-1][np.diff(edges) > 0]] = True
        return np.flatnonzero(start)

    def encoded(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each chunk has, and the ids of all in order, from the library."""
        safe = [self.bare is not None and len(c) <= NAMED and _RUN.fullmatch(c) is not None for c in chunks]
        run = [c for c, s in zip(chunks, safe, strict=True) if s]
        alone = [c.decode() for c, s in zip(chunks, safe, strict=True) if not s]
        rest = [x for i in range(0, len(alone), ALONE) for x in self.each(alone[i : i + ALONE], self.chunks)]
        if not run:
            return np.array([len(x) // 4 for x in rest], np.int64), np.frombuffer(b"".join(rest), np.uint32)
        stop = np.cumsum([len(c) for c in run])
        text = self.alphabet[np.frombuffer(b"".join(run), np.uint8)].tobytes().decode("utf-16-le")
        strings = [text[i:j] for i, j in pairwise([0, *stop[np.flatnonzero(np.diff(stop // TOGETHER))].tolist(), len(text)])]
        ids = np.concatenate([np.array(e.ids, np.uint32) for i in range(0, len(strings), STRINGS) for e in self.bare.encode_batch_fast(strings[i : i + STRINGS], add_special_tokens=False)])
        at = np.cumsum(self.bytes[ids])
        to = np.searchsorted(at, stop) + 1
        if to[-1] != len(ids) or (at[to - 1] != stop).any():
            raise ValueError("chunks were joined, which no token of this vocabulary does")
        if not rest:
            return np.diff(to, prepend=0), ids
        count, many = np.empty(len(chunks), np.int64), np.array(safe)
        count[many], count[~many] = np.diff(to, prepend=0), [len(x) // 4 for x in rest]
        out, mine = np.empty(count.sum(), np.uint32), np.repeat(many, count)
        out[mine], out[~mine] = ids, np.frombuffer(b"".join(rest), np.uint32)
        return count, out

    def block(self, raw: bytes, words: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each of some chunks has, and the ids of all in order."""
        memo = self.memo
        memo.room(len(start))
        keys = np.empty((len(start), 2), np.uint64)
        keys[:, 0] = words[start] & _LOW[np.minimum(length, 8)]
        keys[:, 1] = words[start + 8] & _LOW[np.clip(length - 8, 0, 7)] | length.astype(np.uint64) << np.uint64(56)
        long = np.flatnonzero(length > KEY)
        if len(long):
            keys[long, 0] = memo.names_of([raw[s : s + n] for s, n in zip(start[long].tolist(), length[long].tolist(), strict=True)])
            keys[long, 1] = np.uint64(255 << 56)
        e = memo.find(keys)
        new = np.flatnonzero(e < 0)
        if len(new):
            order = np.lexsort((keys[new, 0], keys[new, 1]))
            by = keys[new[order]]
            first = np.concatenate([[True], (by[1:] != by[:-1]).any(1)])
            own = new[order[first]]
            put = memo.put(keys[own], *self.encoded([raw[s : s + n] for s, n in zip(start[own].tolist(), length[own].tolist(), strict=True)]))
            e[new[order]] = put[np.cumsum(first) - 1]
        return memo.of(e)

    def ids(self, texts: list[bytes]) -> list[bytes]:
        self.memo.use()
        whole = {i: self.each([t.decode("utf-8", "replace")], self.tokenizer)[0] for i, t in enumerate(texts) if any(s in t for s in self.special)}
        texts = [b"" if i in whole else t for i, t in enumerate(texts)]
        raw = b"".join(texts)
        try:
            raw.decode()
        except UnicodeDecodeError:
            texts = [t.decode("utf-8", "replace").encode() for t in texts]
            raw = b"".join(texts)
        edges = np.cumsum([0, *map(len, texts)])
        start = self.starts(np.frombuffer(raw, np.uint8), edges)
        length = np.diff(start, append=len(raw))
        padded = raw + bytes(16)
        words = np.ndarray(len(raw) + 9, "<u8", padded, 0, (1,))  # eight bytes from each byte on
        size = min(BLOCK, self.memo.size)
        blocks = [self.block(raw, words, start[i : i + size], length[i : i + size]) for i in range(0, len(start), size)]
        count, flat = (np.concatenate(x) for x in zip(*blocks, strict=True)) if blocks else (np.zeros(0, np.int64),) * 2
        stop = np.concatenate([[0], np.cumsum(count)])[np.searchsorted(start, edges)].tolist()
        flat = flat.astype(np.uint32)
        return [whole[i] if i in whole else flat[a:b].tobytes() for i, (a, b) in enumerate(pairwise(stop))]


_loaded: dict[tuple[str, bool], ByteEncoder] = {}


def encoder(path: str, special_as_text: bool = False) -> tokens.Encoder:
    """This worker's encoder for a vocabulary file, kept until another operator runs."""
    common.working("bytelevel", _loaded.clear)
    if (path, special_as_text) not in _loaded:
        suits = ByteEncoder.suits(Tokenizer.from_file(path))
        _loaded[path, special_as_text] = (ByteEncoder if suits else tokens.Encoder)(path, special_as_text)
    return _loaded[path, special_as_text]
