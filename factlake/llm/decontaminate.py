"""Benchmark decontamination by template windows and slot consistency.

Words become a template: numbers, names and units turn into typed placeholders,
other words lose case and outer punctuation. Windows of WINDOW template words
of the benchmark are hash-joined with those of all documents. Where windows
meet, the values behind the placeholders are compared along the alignment: each
benchmark value must stand for one document value throughout, as it does when a
question was re-parameterised, and no two names for one name; windows that break
this don't count. A document is contaminated by an item when at least COVERAGE of
the item's windows count, or RUN of them in a row. A capitalised word that opens a
sentence may be a name or not: windows stand in both forms on both sides. A form with
too few literal words counts only where such words are the same. Windows with names
stand in a third form too, in which names are words without case: it finds copies in
upper case, lower case or title case, where names can't be told by their capitals.

The benchmark is the stated query set: it is sent to the workers in blocks of
at most BLOCK_BYTES of text, each of which meets all documents.

Defined cases: null and empty texts, of either side, match nothing; an item of
fewer words than a window is one window of all its words; windows with fewer
than half literal words are left out unless an item has no others; repeated
rows, and items that repeat a text, are judged each; words of punctuation alone are
skipped; empty tables find nothing; other columns are not read.
"""

from __future__ import annotations

import itertools
import re
import struct
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WINDOW, COVERAGE, RUN, BLOCK_BYTES = 8, 0.5, 13, 2 << 20
#: Windows whose forms are made at a time, and leading bits by which known ones are marked.
FORMS, MARKS = 1 << 14, 22
PUNCTUATION = b".,;:!?\"'()[]{}<>*#$%&|/\\~`^_=+-"
NUMBER = re.compile(rb"[+-]?\d[\d.,:/]*(?:st|nd|rd|th)?")
#: Words for numbers and units, lower case.
NUMBER_WORDS = frozenset(b"zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split())
UNITS = frozenset(
    b"mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg gram grams kilogram kilograms lb lbs pound pounds oz ounce ounces t ton tons tonne tonnes "
    b"ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    b"dollar dollars cent cents euro euros usd eur percent degree degrees c f k mph kmh kph w kw watt watts v volt volts hz khz mhz ghz kb mb gb tb".split()
)
NAME, NUM, UNIT = (np.uint64(xxhash.xxh3_64_intdigest(x)) for x in (b"\0name", b"\0number", b"\0unit"))
PACK = struct.Struct("<QQQ").pack
_memo = common.Generations(120_000)


def core_of(word: bytes) -> bytes:
    return word.strip(PUNCTUATION).lower()


def features(word: bytes) -> bytes:
    """Three 64-bit integers: hash at the start of a sentence, hash elsewhere,
    flags (1 ends a sentence, 2 number, 4 unit, 8 nothing but punctuation)."""
    core = word.strip(PUNCTUATION)
    ends = 1 if word.rstrip(b"\"')]}*#$%&|").endswith((b".", b"!", b"?")) else 0
    if not core:
        return PACK(0, 0, ends | 8)
    low = core.lower()
    if NUMBER.fullmatch(core) or low in NUMBER_WORDS:
        return PACK(int(NUM), int(NUM), ends | 2)
    text = core.decode("utf-8", "replace")
    folded = text.lower()
    h = xxhash.xxh3_64_intdigest(folded)
    name = len(text) > 1 and text[0].isupper() and text[1:] == folded[1:]
    return PACK(h, int(NAME) if name else h, ends | (4 if low in UNITS else 0))


class Template:
    """The template words of some texts: hashes, which text, and the words."""

    def __init__(self, texts: list[bytes]):
        cut = [t.split() for t in texts]
        new = _memo.missing(set().union(*cut))
        _memo.learn((w, features(w)) for w in new)
        ids: dict = defaultdict(itertools.count().__next__)
        n = np.array([len(c) for c in cut], np.int64)
        which = np.fromiter(map(ids.__getitem__, itertools.chain.from_iterable(cut)), np.int64, int(n.sum()))
        table = np.frombuffer(b"".join(map(_memo.young.__getitem__, ids)), np.uint64).reshape(-1, 3)
        _memo.age()
        first, later, flags = table[which, 0], table[which, 1], table[which, 2].astype(np.int64)
        doc = np.repeat(np.arange(len(texts)), n)
        starts = np.concatenate(([True], (flags[:-1] & 1).astype(bool) | (doc[1:] != doc[:-1])))[: len(doc)]
        hashes = np.where(starts, first, later)
        keep = flags & 8 == 0
        self.doc, self.hash, self.word = doc[keep], hashes[keep], which[keep]
        flags = flags[keep]
        unit = np.zeros(len(flags), bool)
        unit[1:] = (flags[1:] & 4 > 0) & (flags[:-1] & 2 > 0) & (self.doc[1:] == self.doc[:-1])
        self.hash[unit] = UNIT
        self.free = np.where(unit, UNIT, first[keep])
        self.names = np.concatenate(([0], np.cumsum(self.hash != self.free)))
        self.open = (starts & (first != later))[keep] & ~unit
        self.slot = (self.hash == NAME) | (self.hash == NUM) | (self.hash == UNIT)
        self.words = list(ids)
        self.opens = np.concatenate(([0], np.cumsum(self.open)))

    def forms(self, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Starts of windows, their hashes, and which words (a bit for each) are
        taken for names although they open a sentence: all forms."""
        at, raw = self.windows(size, False)
        for k in range(0, len(at), FORMS):
            a, h = at[k : k + FORMS], raw[k : k + FORMS]
            yield a, common.mix(h), np.zeros(len(a), np.int64)
            some = np.flatnonzero(self.opens[a + size] > self.opens[a])
            a, h, named = a[some], h[some], np.zeros(len(some), np.int64)
            if not len(a):
                continue
            factor = np.uint64(1)
            name = common.mix(np.array([NAME]))
            for i in reversed(range(size)):
                at_i = np.flatnonzero(self.open[a + i])
                b = a[at_i]
                a, h = np.concatenate((a, b)), np.concatenate((h, h[at_i] + factor * (name - common.mix(self.hash[b + i]))))
                named = np.concatenate((named, named[at_i] | 1 << i))
                factor = np.multiply(np.array([factor]), np.uint64(0x9E3779B97F4A7C15))[0]
            new = named > 0
            yield a[new], common.mix(h[new]), named[new]
        if self.names[-1]:  # names as words
            at, h = self.windows(size, hashes=self.free)
            some = self.names[at + size] > self.names[at]
            yield at[some], h[some], np.zeros(int(some.sum()), np.int64)

    def windows(self, size: int, final: bool = True, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Starts of windows within one text, and their hashes."""
        m = len(self.hash) - size + 1
        if m < 1:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.doc[:m] == self.doc[size - 1 :])
        mixed = common.mix(self.hash if hashes is None else hashes)
        h = np.full(m, size, np.uint64)
        for i in range(size):
            h *= np.uint64(0x9E3779B97F4A7C15)
            h += mixed[i : i + m]
        return at, common.mix(h[at]) if final else h[at]


class Matcher:
    """The windows of a block of benchmark items."""

    def __init__(self, items: list[tuple[object, bytes]]):
        self.ids = [i for i, _ in items]
        t = Template([x for _, x in items])
        self.words = [[] for _ in items]
        self.openers = [[] for _ in items]
        self.named: list[set[int]] = [set() for _ in items]
        for d, w, s, o, name in zip(t.doc.tolist(), t.word.tolist(), t.slot.tolist(), t.open.tolist(), (t.hash == NAME).tolist(), strict=True):
            if name:
                self.named[d].add(len(self.words[d]))
            self.words[d].append(core_of(t.words[w]) if s else None)
            self.openers[d].append(core_of(t.words[w]) if o else None)
        n = np.bincount(t.doc, minlength=len(items))
        first = np.cumsum(n) - n
        self.tables = {}
        self.total = np.zeros(len(items), np.int64)
        for size in {min(WINDOW, k) for k in n.tolist() if k}:
            at, h = t.windows(size)
            literal = np.add.reduce([~t.slot[at + i] for i in range(size)]) * 2 >= size if len(at) else np.zeros(0, bool)
            fits = np.minimum(WINDOW, n)[t.doc[at]] == size
            good = np.bincount(t.doc[at[literal & fits]], minlength=len(items))
            use = fits & (literal | (good[t.doc[at]] == 0))
            self.total += np.bincount(t.doc[at[use]], minlength=len(items))
            used = np.zeros(len(t.hash), bool)
            used[at[use]] = True
            at, h, named = (np.concatenate(x) for x in zip(*t.forms(size), strict=True)) if len(at) else (at, h, at)
            at, h, named = at[used[at]], h[used[at]], named[used[at]]
            literals = np.add.reduce([~t.slot[at + i] for i in range(size)], dtype=np.int64) - np.bitwise_count(named)
            weak = (named > 0) & (literals * 2 < size)
            order = np.argsort(h, kind="stable")
            marks = np.zeros(1 << MARKS, bool)
            marks[h >> np.uint64(64 - MARKS)] = True
            self.tables[size] = marks, h[order], t.doc[at[order]], (at - first[t.doc[at]])[order], named[order], weak[order]

    def hits(self, texts: list[bytes]) -> list[tuple[int, int, int, int, int]]:
        """(text, item, windows that count, slots compared, slots changed)."""
        t = Template(texts)
        found: dict[tuple[int, int], dict[int, dict[int, tuple[int, int, int]]]] = {}
        for size, (marks, known, item, place, named, weak) in self.tables.items():
            for at, h, _ in t.forms(size):
                near = np.flatnonzero(marks[h >> np.uint64(64 - MARKS)])  # all that are known, and few others
                at, h = at[near], h[near]
                low, high = np.searchsorted(known, h, "left"), np.searchsorted(known, h, "right")
                for i in np.flatnonzero(high > low).tolist():
                    for k in range(low[i], high[i]):
                        start, j, p, form = int(at[i]), int(item[k]), int(place[k]), int(named[k])
                        if weak[k] and any(form >> x & 1 and self.openers[j][p + x] != core_of(t.words[t.word[start + x]]) for x in range(size)):
                            continue
                        line = found.setdefault((int(t.doc[start]), j), {}).setdefault(start - p, {})
                        if p not in line or form < line[p][2]:
                            line[p] = start, size, form
        out = []
        for (doc, item), lines in found.items():
            counted, compared, changed, longest = set(), 0, 0, 0
            for windows in lines.values():
                ok, n, other = self.consistent(t, item, [(at, p, size, form) for p, (at, size, form) in windows.items()])
                counted |= ok
                compared, changed = compared + n, changed + other
                longest = max(longest, self.run(ok))
            if len(counted) >= COVERAGE * self.total[item] or longest >= RUN:
                out.append((doc, item, len(counted), compared, changed))
        return out

    @staticmethod
    def run(places: set[int]) -> int:
        """The most windows that follow one another."""
        best = n = 0
        for p in sorted(places):
            n = n + 1 if p - 1 in places else 1
            best = max(best, n)
        return best

    def consistent(self, t: Template, item: int, windows: list[tuple[int, int, int, int]]) -> tuple[set[int], int, int]:
        """Along one alignment: item windows without a broken slot, slots, changed slots."""
        values: dict[bytes, Counter] = defaultdict(Counter)
        names: dict[bytes, Counter] = defaultdict(Counter)
        slots: dict[int, tuple[bytes, bytes]] = {}
        for at, place, size, form in windows:
            for i in range(size):
                own = self.openers[item][place + i] if form >> i & 1 else self.words[item][place + i]
                if own is not None and place + i not in slots:
                    slots[place + i] = own, core_of(t.words[t.word[at + i]])
                    values[own][slots[place + i][1]] += 1
                    if form >> i & 1 or place + i in self.named[item]:
                        names[slots[place + i][1]][own] += 1
        best, back = ({k: c.most_common(1)[0][0] for k, c in of.items()} for of in (values, names))
        broken = {p for p, (own, other) in slots.items() if best[own] != other or back.get(other, own) != own}
        ok = {place for _, place, size, _ in windows if not any(p in broken for p in range(place, place + size))}
        return ok, len(slots), sum(own != other for own, other in slots.values())


def matchers(benchmark: DataFrame, text: str = "text", key: str = "item_id") -> Iterator[Matcher]:
    """The benchmark in blocks of at most about BLOCK_BYTES."""
    size = benchmark.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    blocks = max(1, -(-2 * size // BLOCK_BYTES))
    part = F.pmod(F.xxhash64(key, text), F.lit(blocks))
    for i in range(blocks):
        rows = benchmark.where(F.col(text).isNotNull() & (part == i)).select(key, text).collect()
        if rows:
            yield Matcher([(r[0], r[1].encode()) for r in rows])


def _find(batches: Iterator[pa.RecordBatch], shared, kinds: tuple[pa.DataType, pa.DataType]) -> Iterator[pa.RecordBatch]:
    common.working("decontaminate")
    m: Matcher = shared.value
    for batch in batches:
        texts = common.blobs(batch.column(1))
        for a, b in common.groups(texts):
            hits = m.hits(texts[a:b])
            cols = list(zip(*hits, strict=True)) or [()] * 5
            total = [int(m.total[i]) for i in cols[1]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array([a + d for d in cols[0]], pa.int64())), pa.array([m.ids[i] for i in cols[1]], kinds[1]), pa.array(total, pa.int64()), *(pa.array(c, pa.int64()) for c in cols[2:])],
                ["doc_id", "item_id", "n_windows", "n_matched", "n_slots", "n_changed"],
            )


def find(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, item_id) of contaminated documents with the counts behind it."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    common.ship(spark)
    own, other = docs.select(key).schema[0].dataType, benchmark.select("item_id").schema[0].dataType
    kinds = to_arrow_type(own), to_arrow_type(other)
    schema = f"doc_id {own.simpleString()}, item_id {other.simpleString()}, n_windows long, n_matched long, n_slots long, n_changed long"
    out = spark.createDataFrame([], schema)
    for m in matchers(benchmark):
        shared = spark.sparkContext.broadcast(m)
        out = out.union(docs.select(key, text).mapInArrow(lambda it, s=shared: _find(it, s, kinds), schema))
    return out.withColumnRenamed("doc_id", key)


def _cleaner(shared):
    def clean(column: pa.Array) -> pa.Array:
        common.working("decontaminate")
        texts = common.blobs(column)
        out = np.ones(len(texts), bool)
        for a, b in common.groups(texts):
            out[[a + h[0] for h in shared.value.hits(texts[a:b])]] = False
        return pa.array(out)

    return clean


def clean_only(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents that no item contaminates, with all their columns."""
    common.ship(docs.sparkSession)
    for m in matchers(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(m)
        docs = docs.where(F.arrow_udf(_cleaner(shared), "boolean")(F.col(text)))
    return docs
