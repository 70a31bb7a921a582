"""LM scoring from a log-frequency Bloom filter of quantised n-gram counts.

A bigram of count c >= LEAST enters the filter once for each level
1..1+floor(log_B c), hashed together with the level. Probing level after level until
one is missing gives the quantised count back; its mean c' stands for the count:

    P(w | h) = (c'(h w) + PRIOR * P(w)) / (C'(h) + PRIOR),   P(w) = (c(w) + 0.1) / (N + 0.1 (V + 1))

C'(h) is the sum of c'(h w) over the stored bigrams of h, so that the probabilities
of all words after h sum to 1 (V words and one for all others), but for false probes.
As LEAST has two levels, a bigram that is not there is found with a chance of
4**-PROBES at most. What the filter lacks, as
bigrams seen once, leaves its mass to the unigrams, whose counts are exact. LEAST is a
parameter of the model, the same at every size.

The filter is broadcast. Its size is bounded (2**FILTER_BITS bits); where the bigrams
outgrow it, those of the greatest counts are broadcast, and the others stay in blocks
by hash, which are built where they are probed: only probes that the broadcast filter
can't answer are sent there. So all bigrams are found at every size.

Exact counts and sums C' of words that make up 1/HEAVY of the corpus or more (at most
HEAVY words) are broadcast too; those of other words meet their occurrences by hash
bucket. A word stands once as token and once as context in a sequence that is closed by
the end token, so each occurrence adds log10(c' + PRIOR * P(w)) - log10(C'(w) + PRIOR).

N-grams are counted in packed columns: a shuffled row holds a bucket's sorted hashes
and counts of one stretch of text, pre-aggregated. Words are 64-bit hashes; the hash of
a bigram is 32 bits of its context and 32 of the whole. Contexts that share their bits
(0.1 % among ten million words) share C'.

Defined cases: a null text is empty and consists of the end token; the context of a
first word is the end token; repeated rows are scored, and learnt from, each; a null id
belongs to the fold of ''; without training rows every count is 0 and N is 0; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .neardup import word_codes

FOLDS, BASE, LEAST, PRIOR, HEAVY = 10, 1.5, 2, 100.0, 1 << 20
#: The broadcast filter: its bits, the blocks it is built in, and probes for a level.
FILTER_BITS, BLOCKS, PROBES = 29, 256, 8
#: Bits for a level that keep a false probe under about 0.4 %.
LEVEL_BITS = PROBES / 0.6931
#: Text bytes that a bucket of counts stands for, and n-grams merged before a shuffle.
BUCKET_BYTES, STRETCH = 16 << 20, 1 << 21
END = np.uint64(0x5EED0F0E4D000001)
WORD, PAIR = 0, 1
EDGES = np.ceil(BASE ** np.arange(1, 120) - 1e-9)


def levels(counts: np.ndarray) -> np.ndarray:
    """1 + floor(log_B c) of positive counts."""
    return np.searchsorted(EDGES, counts, "right") + 1


def of_level(level: np.ndarray) -> np.ndarray:
    """The mean of the counts that have a level; 0 for level 0."""
    low = np.concatenate(([0.0, 1.0], EDGES[:-1]))
    mean = (low + np.concatenate(([0.0], EDGES - 1))) / 2
    return mean[np.minimum(level, len(mean) - 1)]


def sequences(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens with the end of each text as numbers, their left neighbours, the
    numbers' hashes, and lengths."""
    codes, hashes, n = word_codes(texts)
    end = len(hashes)
    token = np.insert(codes, np.cumsum(n), end)
    before = np.concatenate(([end], token[:-1]))[: len(token)]
    return token, before, np.append(hashes, END), n + 1


def pairs_of(before: np.ndarray, token: np.ndarray, words: np.ndarray, **kinds: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct pairs, and what np.unique gives with them."""
    many = len(words)
    distinct, more = np.unique(before * many + token, **kinds)
    return pair_hash(words[distinct // many], words[distinct % many]), more


def context(words: np.ndarray) -> np.ndarray:
    """The 32 bits by which a word is known as a context."""
    return common.mix(words) >> np.uint64(32)


def pair_hash(before: np.ndarray, token: np.ndarray) -> np.ndarray:
    return context(before) << np.uint64(32) | common.mix(before * np.uint64(3) + common.mix(token)) >> np.uint64(32)


def bucket_of(kind: int, hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Pairs are dealt by all their bits, words by those that contexts have."""
    return ((context(hashes) if kind == WORD else common.mix(hashes)) % np.uint64(buckets)).astype(np.int64)


def by_bucket(bucket: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The parts of some columns that belong to each bucket."""
    order = np.argsort(bucket, kind="stable")
    bucket, columns = bucket[order], [c[order] for c in columns]
    at = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
    for i, j in zip(at, at[1:], strict=False):
        yield int(bucket[i]), [c[i:j] for c in columns]


def merged(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order with the sums of their counts."""
    order = np.argsort(hashes, kind="stable")
    h, c = hashes[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
    return h[first], np.add.reduceat(c, first) if len(first) else c


def pack(hashes: np.ndarray, counts: np.ndarray) -> bytes:
    """Hashes seen once, then those seen more often with their counts."""
    one = counts == 1
    return np.uint64(one.sum()).tobytes() + hashes[one].tobytes() + hashes[~one].tobytes() + counts[~one].astype(np.uint64).tobytes()


def unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    one = int(np.frombuffer(packed, np.uint64, 1)[0])
    rest = np.frombuffer(packed, np.uint64, offset=8 + 8 * one)
    more = len(rest) // 2
    return np.concatenate((np.frombuffer(packed, np.uint64, one, 8), rest[:more])), np.concatenate((np.ones(one, np.int64), rest[more:].astype(np.int64)))


def _count(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows (kind, bucket, packed) of a partition's words and pairs."""
    held: dict[int, list] = {WORD: [], PAIR: []}

    def flush(kind: int) -> pa.RecordBatch:
        h, c = merged(np.concatenate([x for x, _ in held[kind]]), np.concatenate([y for _, y in held[kind]]))
        held[kind].clear()
        parts = [(b, pack(*x)) for b, x in by_bucket(bucket_of(kind, h, buckets), h, c)]
        return pa.RecordBatch.from_arrays([pa.array([kind] * len(parts), pa.int32()), pa.array([b for b, _ in parts], pa.int64()), pa.array([x for _, x in parts], pa.binary())], ["kind", "bucket", "packed"])

    common.working("lm")
    for batch in batches:
        texts = common.blobs(batch.column(0))
        for a, b in common.groups(texts):
            token, before, words, _ = sequences(texts[a:b])
            for kind, found in ((WORD, (words, np.bincount(token, minlength=len(words)))), (PAIR, pairs_of(before, token, words, return_counts=True))):
                held[kind].append(found)
                if sum(len(x) for x, _ in held[kind]) > STRETCH:
                    yield flush(kind)
    for kind in held:
        if held[kind]:
            yield flush(kind)


_TOTALS = "kind int, bucket long, packed binary, n long, tokens long, by_level array<bigint>"


def _total(key: tuple, rows: pa.Table) -> pa.Table:
    """One bucket's counts: all words, and pairs from LEAST on."""
    got = [unpack(x) for x in rows["packed"].to_pylist()]
    h, c = merged(np.concatenate([x for x, _ in got]), np.concatenate([y for _, y in got]))
    n, tokens = len(h), int(c.sum())
    by_level = np.bincount(levels(c[c >= LEAST]), minlength=1)
    if key[0].as_py() == PAIR:
        h, c = h[c >= LEAST], c[c >= LEAST]
    return pa.table({"kind": pa.array([key[0].as_py()], pa.int32()), "bucket": pa.array([key[1].as_py()], pa.int64()), "packed": pa.array([pack(h, c)], pa.binary()), "n": [n], "tokens": [tokens], "by_level": pa.array([by_level.astype(np.int64)], pa.list_(pa.int64()))})


def _masses(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """(bucket, masses): sums of c' by context, of the pairs of some buckets."""
    for batch in batches:
        for packed in batch.column(0).to_pylist():
            h, c = unpack(packed)
            of, at = np.unique(h >> np.uint64(32), return_inverse=True)
            mass = np.bincount(at, of_level(levels(c)), len(of))
            parts = [(b, x.tobytes() + m.tobytes()) for b, (x, m) in by_bucket((of % np.uint64(buckets)).astype(np.int64), of, mass)]
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in parts], pa.int64()), pa.array([x for _, x in parts], pa.binary())], ["bucket", "masses"])


def _vocabulary(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """A bucket's words in order with their counts and masses, packed."""
    got = [np.frombuffer(x, np.uint64) for x in right["masses"].to_pylist()]
    of = np.concatenate([x[: len(x) // 2] for x in got]) if got else np.zeros(0, np.uint64)
    mass = np.concatenate([x[len(x) // 2 :].view(np.float64) for x in got]) if got else np.zeros(0)
    of, at = np.unique(of, return_inverse=True)
    mass = np.bincount(at, mass, len(of))
    h, c = unpack(left["packed"][0].as_py()) if len(left) else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    order = np.argsort(h)
    h, c = h[order], c[order]
    own = exact(of, mass, context(h), 0.0)
    return pa.table({"bucket": pa.array([key[0].as_py()], pa.int64()), "words": pa.array([h.tobytes() + c.tobytes() + own.tobytes()], pa.binary())})


def vocabulary(packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, counts and masses of a bucket."""
    n = len(packed) // 24
    return np.frombuffer(packed, np.uint64, n), np.frombuffer(packed, np.int64, n, 8 * n), np.frombuffer(packed, np.float64, n, 16 * n)


class Filter:
    """Bits in ``blocks`` blocks of ``size`` bits; both are powers of two. No n-gram
    in it has a level under ``lowest``: such a level is a false probe."""

    def __init__(self, bits: np.ndarray, blocks: int, size: int, lowest: int = 1):
        self.bits, self.blocks, self.size, self.lowest = bits, blocks, size, lowest

    @staticmethod
    def positions(hashes: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """First place in its block and stride of a level."""
        x = common.mix(hashes + np.uint64(0x632BE59BD9B4E019 * level & (1 << 64) - 1))
        return x & np.uint64((1 << 32) - 1), x >> np.uint64(32) | np.uint64(1)

    @staticmethod
    def block(hashes: np.ndarray, blocks: int) -> np.ndarray:
        return common.mix(hashes) & np.uint64(blocks - 1)

    @classmethod
    def filled(cls, size: int, hashes: np.ndarray, level: np.ndarray) -> np.ndarray:
        """One block's bits with all levels of its n-grams, packed."""
        bits = np.zeros(size, bool)
        for j in range(1, int(level.max(initial=0)) + 1):
            hashes, level = hashes[level >= j], level[level >= j]
            a, b = cls.positions(hashes, j)
            for i in range(PROBES):
                bits[(a + np.uint64(i) * b) & np.uint64(size - 1)] = True
        return np.packbits(bits, bitorder="little")

    @classmethod
    def of(cls, hashes: np.ndarray, level: np.ndarray) -> Filter:
        """A filter of one block for some n-grams, as large as they need."""
        size = 1 << max(6, int(np.ceil(np.log2(max(1, level.sum()) * LEVEL_BITS))))
        return cls(cls.filled(size, hashes, level), 1, size, int(level.min(initial=1 << 30)))

    def counts(self, hashes: np.ndarray) -> np.ndarray:
        """Quantised counts: level after level until a probe fails."""
        level = np.zeros(len(hashes), np.int64)
        live, j = np.arange(len(hashes)), 0
        first = self.block(hashes, self.blocks) * np.uint64(self.size)
        while len(live):
            j += 1
            at, stride = self.positions(hashes[live], j)
            for i in range(PROBES):
                place = first[live] + ((at + np.uint64(i) * stride) & np.uint64(self.size - 1))
                hit = np.flatnonzero(self.bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1)
                live, at, stride = live[hit], at[hit], stride[hit]
            level[live] = j
        return of_level(np.where(level < self.lowest, 0, level))


def _entries(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """(block, hashes and levels) of the n-grams that enter the broadcast filter."""
    for batch in batches:
        for packed in batch.column(0).to_pylist():
            h, c = unpack(packed)
            level = levels(c)
            h, level = h[level >= least], level[level >= least].astype(np.uint8)
            parts = [(b, x.tobytes() + y.tobytes()) for b, (x, y) in by_bucket(Filter.block(h, BLOCKS).astype(np.int64), h, level)]
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in parts], pa.int64()), pa.array([x for _, x in parts], pa.binary())], ["block", "entries"])


def _build(key: tuple, rows: pa.Table, size: int) -> pa.Table:
    got = rows["entries"].to_pylist()
    h = np.concatenate([np.frombuffer(x, np.uint64, len(x) // 9) for x in got])
    level = np.concatenate([np.frombuffer(x, np.uint8, len(x) // 9, len(x) // 9 * 8) for x in got])
    return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([Filter.filled(size, h, level).tobytes()], pa.binary())})


class Model:
    """What the workers get: totals, counts and masses of heavy words, the filter.
    ``beyond`` is the level from which on n-grams are in it; None: all are."""

    def __init__(self, tokens: int, distinct: int, words: np.ndarray, counts: np.ndarray, masses: np.ndarray, held: Filter, beyond: int | None):
        self.tokens, self.distinct, self.words, self.counts, self.masses, self.held, self.beyond = tokens, distinct, words, counts, masses, held, beyond
        self.total = tokens + 0.1 * (distinct + 1)

    def terms(self, count: np.ndarray, mass: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What occurrences add to the base score and to the score."""
        unigram = (count + 0.1) / self.total
        return np.log10(unigram), np.log10(pair + PRIOR * unigram) - np.log10(mass + PRIOR)


def learn(docs: DataFrame, folder: str, heavy_words: int = HEAVY, filter_bits: int = FILTER_BITS) -> tuple[Model, DataFrame, DataFrame, int]:
    """Count the texts (one column) and build the model; with the vocabulary and the
    pairs by bucket, and the number of buckets."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(docs.columns[0]))).first()[0] or 0
    buckets = max(16, -(-size // BUCKET_BYTES))
    rows = docs.mapInArrow(lambda it: _count(it, buckets), "kind int, bucket long, packed binary")
    totals = common.written(rows.groupBy("kind", "bucket").applyInArrow(_total, _TOTALS), f"{folder}/totals")
    words, pairs = totals.where(F.col("kind") == WORD), totals.where(F.col("kind") == PAIR)
    n = words.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    masses = pairs.select("packed").mapInArrow(lambda it: _masses(it, buckets), "bucket long, masses binary")
    known = words.select("bucket", "packed").groupBy("bucket").cogroup(masses.groupBy("bucket")).applyInArrow(_vocabulary, "bucket long, words binary")
    known = common.written(known, f"{folder}/vocabulary")
    # a row for each level: there are some sixty
    by_level = dict(pairs.select(F.posexplode("by_level")).groupBy("pos").agg(F.sum("col")).collect())
    least, wanted = 1, sum(k * v for k, v in by_level.items())
    bits = min(filter_bits, max(16, int(np.ceil(np.log2(max(1, wanted) * LEVEL_BITS)))))
    while wanted * LEVEL_BITS > 1 << bits:
        wanted -= least * by_level.get(least, 0)
        least += 1
    block = (1 << bits) // BLOCKS
    blocks = pairs.select("packed").mapInArrow(lambda it: _entries(it, least), "block long, entries binary").groupBy("block").applyInArrow(lambda k, t: _build(k, t, block), "block long, bits binary").toArrow()
    held = np.zeros((BLOCKS, block >> 3), np.uint8)
    for i, x in zip(blocks["block"].to_pylist(), blocks["bits"].to_pylist(), strict=True):
        held[i] = np.frombuffer(x, np.uint8)
    many = -(-n[0] // heavy_words)

    def heavy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                h, c, m = vocabulary(packed)
                keep = c >= many
                yield pa.RecordBatch.from_arrays([pa.array([h[keep].tobytes() + c[keep].tobytes() + m[keep].tobytes()], pa.binary())], ["words"])

    top = [vocabulary(x) for x in known.select("words").mapInArrow(heavy, "words binary").toArrow()["words"].to_pylist()]
    h, c, m = (np.concatenate([x[i] for x in top]) if top else np.zeros(0, kind) for i, kind in enumerate((np.uint64, np.int64, np.float64)))
    order = np.argsort(h)
    model = Model(n[0], n[1], h[order], c[order], m[order], Filter(held.ravel(), BLOCKS, block, max(least, int(levels(np.array([LEAST]))[0]))), least if least > 1 else None)
    return model, known, pairs.select("bucket", "packed"), buckets


def exact(words: np.ndarray, values: np.ndarray, sought: np.ndarray, absent: float = -1) -> np.ndarray:
    """The values of ``sought`` among sorted ``words``."""
    if not len(words):
        return np.full(len(sought), absent, values.dtype)
    i = np.minimum(np.searchsorted(words, sought), len(words) - 1)
    return np.where(words[i] == sought, values[i], absent)


def _score(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """Sums over what the broadcast model answers. Left are ``tail``, other words
    with the c' of their bigram, and ``open``, bigrams that the broadcast filter
    lacks, with their words."""
    common.working("lm")
    m: Model = shared.value
    row = TaskContext.get().partitionId() << 36
    for batch in batches:
        texts = common.blobs(batch.column(2))
        for a, b in common.groups(texts):
            token, before, words, n = sequences(texts[a:b])
            count, mass = exact(m.words, m.counts, words)[token], exact(m.words, m.masses, words, 0.0)[token]
            pairs, of = pairs_of(before, token, words, return_inverse=True)
            pair = m.held.counts(pairs)[of]
            unanswered = pair == 0 if m.beyond else np.zeros(len(token), bool)
            heavy = (count >= 0) & ~unanswered
            tail = (count < 0) & ~unanswered
            base, score = (np.where(heavy, x, 0.0) for x in m.terms(np.maximum(count, 0), mass, pair))
            first = np.cumsum(n) - n
            sums = [np.add.reduceat(x, first) for x in (np.where(heavy, count > 0, 0).astype(np.int64), base, score)]
            ends = np.cumsum(n)
            tails, opens = [], []
            for i, k in zip(first.tolist(), ends.tolist(), strict=True):
                left, left_open = np.flatnonzero(tail[i:k]) + i, np.flatnonzero(unanswered[i:k]) + i
                tails.append(words[token[left]].tobytes() + pair[left].astype(np.float32).tobytes())
                opens.append(pairs[of[left_open]].tobytes() + words[token[left_open]].tobytes())
            rows = b - a
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, rows), batch.column(1).slice(a, rows), pa.array(np.arange(row, row + rows)), pa.array(n), *map(pa.array, sums), pa.array(tails, pa.binary()), pa.array(opens, pa.binary())],
                ["doc_id", "held_out", "row", "n_tokens", "known", "base", "score", "tail", "open"],
            )
            row += rows


_SUMS = "row long, known long, base double, score double"


def summed(row: np.ndarray, count: np.ndarray, base: np.ndarray, score: np.ndarray) -> list[np.ndarray]:
    """The columns of _SUMS: occurrences added up by row."""
    rows, at = np.unique(row, return_inverse=True)
    added = lambda x: np.bincount(at, x, len(rows)).astype(np.float64)  # noqa: E731  (of nothing at all it would be of integers)
    return [rows, added(count > 0).astype(np.int64), added(base), added(score)]


def _sought(batches: Iterator[pa.RecordBatch], kind: int, buckets: int, width: int) -> Iterator[pa.RecordBatch]:
    """(bucket, sought): rows, hashes and what goes with them, by the hashes' bucket."""
    for batch in batches:
        parts, rows = batch.column(1).to_pylist(), batch.column(0).to_numpy()
        for a, b in common.groups(parts, 8 << 20):
            n = np.array([len(x) // (8 + width) for x in parts[a:b]])
            if not n.sum():
                continue
            h = np.concatenate([np.frombuffer(x, np.uint64, k) for x, k in zip(parts[a:b], n, strict=True)])
            more = np.concatenate([np.frombuffer(x, f"V{width}", k, 8 * k) for x, k in zip(parts[a:b], n, strict=True)])
            out = [(i, r.tobytes() + x.tobytes() + y.tobytes()) for i, (r, x, y) in by_bucket(bucket_of(kind, h, buckets), np.repeat(rows[a:b], n), h, more)]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in out], pa.int64()), pa.array([x for _, x in out], pa.binary())], ["bucket", "sought"])


def _met(table: pa.Table, kind: np.dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, hashes and what goes with them, of a bucket."""
    got, size = table["sought"].to_pylist(), 16 + kind.itemsize
    read = lambda t, at: np.concatenate([np.frombuffer(x, t, len(x) // size, len(x) // size * at) for x in got]) if got else np.zeros(0, t)
    return read(np.int64, 0), read(np.uint64, 8), read(kind, 16)


def _answered(left: pa.Table, right: pa.Table, m: Model) -> pa.Table:
    """Bigrams of one bucket through its part of the filter: heavy words are added up,
    other words go on as tails with the c' found."""
    row, pair, word = _met(left, np.dtype(np.uint64))
    h, c = unpack(right["packed"][0].as_py()) if len(right) else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    level = levels(c)
    c2 = Filter.of(h[level < m.beyond], level[level < m.beyond]).counts(pair)
    count = exact(m.words, m.counts, word)
    heavy = count >= 0
    sums = summed(row[heavy], count[heavy], *m.terms(count[heavy], exact(m.words, m.masses, word[heavy], 0.0), c2[heavy]))
    tails = [(r, w.tobytes() + k.astype(np.float32).tobytes()) for r, (w, k) in by_bucket(row[~heavy], word[~heavy], c2[~heavy])]
    n, t = len(sums[0]), len(tails)
    return pa.table({"row": pa.array(np.concatenate((sums[0], np.array([i for i, _ in tails], np.int64)))), "known": pa.array([*sums[1].tolist(), *[0] * t], pa.int64()), "base": pa.array([*sums[2].tolist(), *[0.0] * t], pa.float64()), "score": pa.array([*sums[3].tolist(), *[0.0] * t], pa.float64()), "tail": pa.array([*[None] * n, *[x for _, x in tails]], pa.binary())})


def _tails(left: pa.Table, right: pa.Table, m: Model) -> pa.Table:
    """Words of one bucket with their exact counts and masses, added up by row."""
    row, word, pair = _met(left, np.dtype(np.float32))
    h, c, mass = vocabulary(right["words"][0].as_py()) if len(right) else (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0))
    count = exact(h, c, word, 0)
    return pa.table(dict(zip(("row", "known", "base", "score"), summed(row, count, *m.terms(count, exact(h, mass, word, 0.0), pair.astype(np.float64))), strict=True)))


def score(docs: DataFrame, text: str = "text", key: str = "doc_id", folds: int = FOLDS, heavy_words: int = HEAVY, filter_bits: int = FILTER_BITS) -> DataFrame:
    """Every document's length, known tokens, base score and model score; the
    model learns from those outside fold 0."""
    spark = docs.sparkSession
    common.ship(spark)
    folder = common.scratch(spark)
    held = common.fold(F.col(key), folds) == 0
    model, words, pairs, buckets = learn(docs.where(~held).select(text), folder, heavy_words, filter_bits)
    shared, kind = spark.sparkContext.broadcast(model), docs.select(key).schema[0].dataType.simpleString()
    scored = docs.select(F.col(key).alias("doc_id"), held.alias("held_out"), F.col(text).alias("text")).mapInArrow(lambda it: _score(it, shared), f"doc_id {kind}, held_out boolean, row long, n_tokens long, known long, base double, score double, tail binary, open binary")
    scored = common.written(scored, f"{folder}/scored")
    tails, sums = scored.select("row", "tail"), None
    if model.beyond:
        sought = scored.select("row", "open").mapInArrow(lambda it: _sought(it, PAIR, buckets, 8), "bucket long, sought binary")
        found = sought.groupBy("bucket").cogroup(pairs.groupBy("bucket")).applyInArrow(lambda _, a, b: _answered(a, b, shared.value), f"{_SUMS}, tail binary")
        found = common.written(found, f"{folder}/answered")
        tails = tails.union(found.where("tail IS NOT NULL").select("row", "tail"))
        sums = found.where("tail IS NULL").drop("tail")
    sought = tails.mapInArrow(lambda it: _sought(it, WORD, buckets, 4), "bucket long, sought binary")
    rest = sought.groupBy("bucket").cogroup(words.groupBy("bucket")).applyInArrow(lambda _, a, b: _tails(a, b, shared.value), _SUMS)
    rest = rest if sums is None else rest.union(sums)
    rest = common.written(rest.groupBy("row").agg(F.sum("known").alias("k2"), F.sum("base").alias("b2"), F.sum("score").alias("s2")), f"{folder}/rest")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return scored.drop("tail", "open").join(rest, "row", "left").select(
        F.col("doc_id").alias(key), "held_out", "n_tokens", (F.col("known") + zero("k2")).alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + zero("b2")).alias("base_score"), (F.col("score") + zero("s2")).alias("score"),
    )
