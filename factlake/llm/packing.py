"""Best-fit packing of token pieces into fixed-length sequences.

Lengths are whole numbers up to the capacity, so the instance is a histogram of
bounded size however many documents there are. The driver solves it on that
histogram: Martello and Toth's dominance reduction fixes small sets that beat
every alternative for the bin of one item (an item alone, a perfect pair, the
largest companion, a dominating triple), which shrinks the instance; best-fit
in decreasing order packs the remainder. Sizes of equal bins are kept as one
pattern with a multiplicity, so that the solution is small as well. Pieces then
take the slots of their length in the order of a rank, counted in salted groups
so that a common length is not one task's work.

Defined cases: a null text is empty and holds the end id alone; repeated rows
are packed each; an empty table gives an empty result; a text longer than a
sequence is cut into whole sequences, of which only the first may be shorter.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bytelevel, common

CAPACITY, END_ID = 2048, 0
#: Groups that pieces of one length are numbered in. At 10^11 pieces of one
#: length a group holds 10^8 small rows, which sort on disk.
SALTS = 1024

Bin = tuple[tuple[int, int], ...]  # (size, how many), in order


class Sizes:
    """A multiset of sizes with its distinct sizes in order."""

    def __init__(self, counts: dict[int, int]):
        self.n = {s: n for s, n in counts.items() if n > 0}
        self.order = sorted(self.n)

    def take(self, size: int, many: int) -> None:
        self.n[size] -= many
        if not self.n[size]:
            del self.n[size]
            self.order.pop(bisect.bisect_left(self.order, size))

    def largest(self, limit: int, without: tuple[int, ...] = ()) -> int:
        """The largest size up to ``limit`` beside the items in ``without``; 0 if none."""
        i = bisect.bisect_right(self.order, limit) - 1
        while i >= 0 and self.n[self.order[i]] <= without.count(self.order[i]):
            i -= 1
        return self.order[i] if i >= 0 else 0

    def smallest(self, many: int, without: int) -> list[int]:
        out: list[int] = []
        for s in self.order:
            out += [s] * min(many - len(out), self.n[s] - (s == without))
            if len(out) == many:
                break
        return out

    def pairs(self, limit: int, without: int) -> tuple[int, int]:
        """Of pairs that fit: the greatest sum, and the greatest smaller member."""
        best = second = 0
        for x in reversed(self.order):
            if x > limit or self.n[x] <= (x == without):
                continue
            y = self.largest(min(x, limit - x), (x, without) if without else (x,))
            if y:
                best, second = max(best, x + y), max(second, y)
        return best, second


def dominating(sizes: Sizes, item: int, capacity: int) -> tuple[int, ...] | None:
    """What may join ``item`` in its bin without ever costing a bin; None if unknown."""
    room = capacity - item
    k = sizes.largest(room, (item,))
    if not k:
        return ()
    if k == room:
        return (k,)
    low = sizes.smallest(3, item)
    if len(low) < 2 or low[0] + low[1] > room:
        return (k,)
    if len(low) < 3 or sum(low) > room:  # two companions at most
        best, second = sizes.pairs(room, item)
        if k >= best:
            return (k,)
        b = sizes.largest(room - k, (item, k))
        if b and b >= second:
            return (k, b)
    return None


def reduce_instance(sizes: Sizes, capacity: int) -> list[tuple[int, Bin]]:
    """Fix dominating sets, largest item first, until none is left."""
    fixed: list[tuple[int, Bin]] = []
    again = True
    while again:
        again = False
        for item in list(reversed(sizes.order)):
            while sizes.n.get(item):
                company = dominating(sizes, item, capacity)
                if company is None:
                    break
                again = True
                members = sorted((item, *company), reverse=True)
                need = {s: members.count(s) for s in members}
                many = min(sizes.n[s] // c for s, c in need.items())
                fixed.append((many, tuple(need.items())))
                for s, c in need.items():
                    sizes.take(s, many * c)
    return fixed


def best_fit(sizes: Sizes, capacity: int) -> list[tuple[int, Bin]]:
    """Best-fit decreasing; equal open bins are handled at once."""
    open_: dict[int, list[tuple[int, Bin]]] = {}
    rooms: list[int] = []

    def put(room: int, many: int, content: Bin) -> None:
        if many:
            if room not in open_:
                bisect.insort(rooms, room)
                open_[room] = []
            open_[room].append((many, content))

    for s in reversed(sizes.order):
        n = sizes.n[s]
        while n:
            i = bisect.bisect_left(rooms, s)
            if i == len(rooms):
                each = capacity // s
                put(capacity - each * s, n // each, ((s, each),))
                if n % each:
                    put(capacity - n % each * s, 1, ((s, n % each),))
                n = 0
                break
            room = rooms[i]
            many, content = open_[room].pop()
            if not open_[room]:
                del open_[room]
                rooms.pop(i)
            each = room // s
            whole = min(many, n // each)
            put(room - each * s, whole, (*content, (s, each)))
            n -= whole * each
            if whole < many:
                part = min(n, each)
                if part:
                    put(room - part * s, 1, (*content, (s, part)))
                    n -= part
                put(room, many - whole - (part > 0), content)
    return [g for room in rooms for g in open_[room]]


def solve(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, Bin]]:
    """Patterns with their multiplicities; together they hold every piece once."""
    sizes = Sizes(counts)
    fixed = reduce_instance(sizes, capacity)
    return fixed + best_fit(sizes, capacity)


def slots(patterns: list[tuple[int, Bin]], capacity: int) -> dict[str, np.ndarray]:
    """For each run of slots: length, first rank, first sequence, slots in a
    sequence, offset of the first. Sorted by length, then rank."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for many, content in patterns:
        at = 0
        for size, each in content:
            rank = used.get(size, 0)
            rows.append((size, rank, sequence, each, at))
            used[size] = rank + many * each
            at += size * each
        sequence += many
    rows.sort()
    a = np.array(rows, np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "sequence", "each", "offset"), a.T.copy(), strict=True))


def _pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int, end_id: int) -> Iterator[pa.RecordBatch]:
    end = np.array([end_id], np.uint32).tobytes()
    encoder = bytelevel.encoder(path)
    for batch in batches:
        texts, keys = batch.column(1), batch.column(0)
        for a, b in common.runs(pc.binary_length(texts).fill_null(0).to_pylist()):
            doc, cols = [], ([], [], [], [])
            for i, ids in zip(range(a, b), encoder.ids(common.blobs(texts.slice(a, b - a))), strict=True):
                ids += end
                n = len(ids) // 4
                cut = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
                for piece, (start, stop) in enumerate(zip(cut, cut[1:], strict=False)):
                    doc.append(i)
                    for col, x in zip(cols, (piece, start, stop - start, zlib.crc32(ids[4 * start : 4 * stop])), strict=True):
                        col.append(x)
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(doc, pa.int64())), pa.array(cols[0], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[1:])], ["doc_id", "piece", "start", "length", "ids_crc32"])


def pieces(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Each document's pieces: doc_id, piece, start, length, ids_crc32."""
    common.ship(docs.sparkSession)
    kind = docs.select(key).schema[0].dataType.simpleString()
    return docs.select(key, text).mapInArrow(lambda it: _pieces(it, path, capacity, end_id), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Each piece with its sequence and its offset there."""
    spark = docs.sparkSession
    folder = common.scratch(spark)
    p = pieces(docs, path, text, key, capacity, end_id)
    p = common.written(p.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(SALTS)).cast("int")), f"{folder}/pieces")
    counts = common.written(p.groupBy("length", "salt").agg(F.count("*").alias("n")), f"{folder}/counts")
    # at most one row for each length up to the capacity
    total = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = spark.sparkContext.broadcast(slots(solve(total, capacity), capacity))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = p.withColumn("rank", F.row_number().over(own) - 1).join(first, ["length", "salt"]).withColumn("rank", F.col("rank") + F.col("before"))

    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        t = plan.value
        length, rank = length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False)
        bound = np.int64(1) << np.int64(50)
        i = np.searchsorted(t["length"] * bound + t["rank"], length * bound + rank, "right") - 1
        k = rank - t["rank"][i]
        return pa.StructArray.from_arrays([pa.array(t["sequence"][i] + k // t["each"][i]), pa.array(t["offset"][i] + k % t["each"][i] * length)], ["sequence_id", "offset"])

    at = F.arrow_udf(place, "sequence_id long, offset long")
    return ranked.withColumn("at", at("length", "rank")).select(F.col("doc_id").alias(key), "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset")
