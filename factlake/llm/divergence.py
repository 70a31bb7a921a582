"""How the sources of a language diverge: chi-square-like sums over term shares.

Terms are counted by length. In a task, terms of up to 8 bytes are one big-endian
unsigned 64-bit word and those of up to 16 bytes two, which are sorted by radix (16
bits at a time, together with the group's number) and counted as runs; longer
terms are sorted as bytes, by buckets of equal width. What leaves a task are runs
(lang, source, term, occurrences, documents); these meet by language and term, so
a frequent language, source or word is in no single task.

The terms of a language that stand in LEAST documents, with their counts by source,
are one row each. These are dealt to buckets of bounded size, in which a matrix of
terms by sources gives each bucket's share of every pair's sum and the best terms
of each source; Spark adds the shares up and ranks.

All arithmetic is exact: shares are whole billionths by floor division, in long
integers, for groups of up to 2.8e14 terms.

Defined cases: null text, language or source count as ''. A group without terms has
all shares from its count of 0; a language without kept terms gives pairs of value
0. Repeated rows are documents of their own. Empty tables give no rows. Extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Documents of a language that a term has to stand in; ranks of the terms' part.
LEAST, RANKS = 3, 200
#: Runs that a task gathers before it hands them on, and cells of a bucket's matrix.
HELD, CELLS = 1 << 20, 1 << 20
#: Buckets of a language at least, so that small tables are dealt out as well.
BUCKETS = 16

_BYTE = np.arange(256)
_UPPER = (_BYTE >= 65) & (_BYTE <= 90)
#: Bytes of terms: letters, and every byte of a character beyond ASCII.
TERM = _UPPER | (_BYTE >= 97) & (_BYTE <= 122) | (_BYTE >= 128)
LOWER = np.where(_UPPER, _BYTE + 32, _BYTE).astype(np.uint8)


def radix(*keys: np.ndarray) -> np.ndarray:
    """The stable order by unsigned ``keys``, the most significant first."""
    order = None
    for key in reversed(keys):
        for shift in range(0, key.dtype.itemsize * 8, 16):
            digit = (key >> key.dtype.type(shift)).astype(np.uint16)
            if len(digit) and digit.min() != digit.max():
                order = np.argsort(digit, kind="stable") if order is None else order[np.argsort(digit[order], kind="stable")]
    return np.arange(len(keys[0])) if order is None else order


def changes(*keys: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the row before."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new


def terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts' bytes in lower case with 16 zeros behind, and each term's start,
    length and text."""
    flat = np.frombuffer(b"\n".join([b"", *texts, bytes(16)]), np.uint8)
    inside = TERM[flat]
    start = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    length = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1 - start
    begins = np.cumsum([1, *[len(t) + 1 for t in texts]])
    return LOWER[flat], start, length, np.searchsorted(begins, start, "right") - 1


def word(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Up to 8 bytes from ``start`` on as one number that sorts as the bytes do."""
    at = np.ndarray(len(flat) - 7, ">u8", flat, strides=(1,))[start].astype(np.uint64)
    cut = (64 - 8 * np.clip(length, 1, 8)).astype(np.uint64)
    return np.where(length > 0, at >> cut << cut, np.uint64(0))


def added(group: np.ndarray, words: list[np.ndarray], n: np.ndarray, df: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """Runs of one group and term added up."""
    order = radix(group, *words)
    group, words = group[order], [w[order] for w in words]
    at = np.flatnonzero(changes(group, *words))
    return group[at], [w[at] for w in words], np.add.reduceat(n[order], at), np.add.reduceat(df[order], at)


def counted(group: np.ndarray, doc: np.ndarray, words: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """Runs of equal terms in each group with their occurrences and documents;
    occurrences come by ascending document."""
    order = radix(group, *words)
    group, doc, words = group[order], doc[order], [w[order] for w in words]
    new = changes(group, *words)
    at = np.flatnonzero(new)
    return group[at], [w[at] for w in words], np.diff(at, append=len(group)), np.add.reduceat((new | changes(doc)).astype(np.int64), at)


def counted_long(flat: np.ndarray, start: np.ndarray, length: np.ndarray, group: np.ndarray, doc: np.ndarray):
    """Runs of terms beyond 16 bytes, a bucket for each power of two of their length."""
    width = 1 << np.ceil(np.log2(length)).astype(np.int64)
    for w in np.unique(width).tolist():
        pick = np.flatnonzero(width == w)
        for i in range(0, len(pick), max(1, (8 << 20) // w)):
            rows = pick[i : i + max(1, (8 << 20) // w)]
            at = np.minimum(start[rows, None] + np.arange(w), len(flat) - 1)
            text = np.where(np.arange(w) < length[rows, None], flat[at], 0).astype(np.uint8).view(f"S{w}")[:, 0]
            order = np.argsort(text, kind="stable")
            order = order[radix(group[rows][order])]
            g, d, text = group[rows][order], doc[rows][order], text[order]
            new = changes(g, text)
            first = np.flatnonzero(new)
            yield g[first], text[first].tolist(), np.diff(first, append=len(g)), np.add.reduceat((new | changes(d)).astype(np.int64), first)


def spelled(words: list[np.ndarray]) -> pa.Array:
    """Packed terms as strings."""
    raw = np.stack(words, 1).astype(">u8").view(np.uint8).reshape(len(words[0]), -1)
    offsets = np.concatenate(([0], np.cumsum((raw != 0).sum(1)))).astype(np.int32)
    return pa.StringArray.from_buffers(len(raw), pa.py_buffer(offsets), pa.py_buffer(raw[raw != 0].tobytes()))


_RUNS = "lang string, source string, term string, n long, docs long"


class Runs:
    """The groups and runs that a task has gathered."""

    def __init__(self):
        self.groups: dict[tuple[str, str], int] = {}
        self.held: dict[int, list] = {1: [], 2: []}
        self.size = 0

    def number(self, lang: list[str | None], source: list[str | None]) -> np.ndarray:
        return np.array([self.groups.setdefault((a or "", b or ""), len(self.groups)) for a, b in zip(lang, source, strict=True)], np.uint32)

    def batch(self, group: np.ndarray, term: pa.Array, n: np.ndarray, df: np.ndarray) -> pa.RecordBatch:
        names = [pa.array([g[i] for g in self.groups], pa.string()).take(pa.array(group)) for i in range(2)]
        return pa.RecordBatch.from_arrays([*names, term, pa.array(n, pa.int64()), pa.array(df, pa.int64())], ["lang", "source", "term", "n", "docs"])

    def add(self, kind: int, runs: tuple) -> None:
        if len(runs[0]):
            self.held[kind].append(runs)
            self.size += len(runs[0])

    def merge(self) -> None:
        self.size = 0
        for kind, held in self.held.items():
            if held:
                runs = added(*[np.concatenate([h[i] for h in held]) if i != 1 else [np.concatenate([h[1][k] for h in held]) for k in range(kind)] for i in range(4)])
                self.held[kind] = [runs]
                self.size += len(runs[0])

    def flush(self) -> Iterator[pa.RecordBatch]:
        self.merge()
        for held in self.held.values():
            for group, words, n, df in held:
                yield self.batch(group, spelled(words), n, df)
        self.__init__()


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    common.working("divergence")
    runs = Runs()
    for batch in batches:
        texts, lang, source = common.blobs(batch.column(0)), batch.column(1).to_pylist(), batch.column(2).to_pylist()
        for a, b in common.groups(texts, 4 << 20):
            flat, start, length, doc = terms(texts[a:b])
            group = runs.number(lang[a:b], source[a:b])[doc]
            one, two = length <= 8, (length > 8) & (length <= 16)
            runs.add(1, counted(group[one], doc[one], [word(flat, start[one], length[one])]))
            runs.add(2, counted(group[two], doc[two], [word(flat, start[two], length[two]), word(flat, start[two] + 8, length[two] - 8)]))
            rest = length > 16
            for g, text, n, df in counted_long(flat, start[rest], length[rest], group[rest], doc[rest]):
                yield runs.batch(g, pa.array([t.decode() for t in text], pa.string()), n, df)
            if runs.size > 2 * HELD:
                runs.merge()
                if runs.size > HELD:
                    yield from runs.flush()
    yield from runs.flush()


def share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(10 ** 9 * (count + 1) / total), without leaving 64 bits."""
    whole, rest = np.divmod((count + 1) * 31_250, total)
    return 1 + whole * 32_000 + rest * 32_000 // total


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


_PARTS = "lang string, source string, part string, item string, value long"


def _parts(left: pa.Table, right: pa.Table, ranks: int) -> pa.Table:
    """A bucket of a language's terms with the language's groups (source, total,
    terms): its share of each pair's value, and each source's best terms."""
    right = right.sort_by("source")
    sources, size = right["source"].combine_chunks(), len(right)
    lang = right["lang"][0].as_py()
    v, totals = right["terms"].to_numpy(), right["total"].to_numpy()
    left = left.take(pa.array(np.argsort(np.array(left["term"].cast(pa.binary()).to_pylist(), object), kind="stable"))) if len(left) else left
    places = left["places"].combine_chunks()
    count = np.zeros((len(left), size), np.int64)
    row = np.repeat(np.arange(len(left)), places.value_lengths().to_numpy(zero_copy_only=False))
    flat = places.flatten()
    count[row, pc.index_in(flat.field("source"), sources).to_numpy(zero_copy_only=False)] = flat.field("n").to_numpy()
    p = share(count, np.maximum(totals + v, 1)[None, :])
    q = share(count.sum(1), np.maximum(totals.sum() + v[:1], 1))
    out = []
    for s in range(size):
        others = np.delete(np.arange(size), s)
        pair = distance(p[:, [s]], p[:, others]).sum(0)
        out.append(pa.table({"source": pa.repeat(sources[s], len(others)), "part": pa.repeat("pair", len(others)), "item": sources.take(pa.array(others)), "value": pair}))
        rise = np.flatnonzero((count[:, s] > 0) & (p[:, s] > q))
        f = distance(p[rise, s], q[rise])
        best = np.argsort(-f, kind="stable")[:ranks]  # terms come by their bytes, and so do equal ones
        out.append(pa.table({"source": pa.repeat(sources[s], len(best)), "part": pa.repeat("term", len(best)), "item": left["term"].combine_chunks().take(pa.array(rise[best])), "value": f[best]}))
    found = pa.concat_tables(out)
    return found.add_column(0, "lang", pa.repeat(pa.scalar(lang, pa.string()), len(found)))


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST, ranks: int = RANKS) -> DataFrame:
    """For every group (lang, source): ``pair`` rows, one for each other source of the
    language with the divergence from it, and ``term`` rows, the terms that stand out
    most against the language; (lang, source, part, item, value, rank)."""
    spark = docs.sparkSession
    common.ship(spark)
    folder = common.scratch(spark)
    named = lambda c, to: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(to)
    runs = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(source).alias("source")).mapInArrow(_runs, _RUNS)
    runs = runs.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    met = runs.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("places"))
    kept = common.written(met.where(F.col("docs") >= least).drop("docs"), f"{folder}/kept")
    totals = kept.select("lang", F.explode("places").alias("x")).groupBy("lang", F.col("x.source").alias("source")).agg(F.sum("x.n").alias("total"))
    groups = docs.select(named(lang, "lang"), named(source, "source")).distinct().join(totals, ["lang", "source"], "left").join(kept.groupBy("lang").agg(F.count("*").alias("terms")), "lang", "left")
    groups = common.written(groups.fillna(0, ["total", "terms"]), f"{folder}/groups")
    cells = groups.groupBy("lang").agg((F.count("*") * F.max("terms")).alias("cells")).agg(F.max("cells")).first()[0] or 0
    buckets = max(BUCKETS, -(-cells // CELLS))
    dealt = kept.withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(buckets)))
    beside = groups.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))))
    parts = dealt.groupBy("lang", "bucket").cogroup(beside.groupBy("lang", "bucket")).applyInArrow(lambda a, b: _parts(a, b, ranks), _PARTS)
    found = parts.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return found.withColumn("rank", rank).where((F.col("part") == "pair") | (F.col("rank") <= ranks))
