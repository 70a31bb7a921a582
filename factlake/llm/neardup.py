"""Near-duplicates by bottom-k sketches from one hash function.

A text's set of word shingles is hashed by one function; its sketch is the k
least hashes, of which the upper half is kept: their order stays, equal ones stay
equal, and where different ones become equal a pair is verified that needn't be. Texts with one and the same set are one class, whose least id
stands for it. Sketches are indexed in inverted lists: an entry is two values
that stand next to each other in the sketch. In the merged sketch of two sets
of similarity s, an entry is shared wherever two neighbours are both common, so
a similar pair misses all INDEXED - 1 lists with a chance of about 5e-10 at
s = 0.8 and never when the sets are small.

Each of a list's salted parts elects a member, and those elect one of them, by
an order that differs between lists; members are compared with the elected, by
the union sketch and then on full sets. The links of this round join most of
what belongs together. Then every list whose members are not yet in one component
is resolved. The members of a list of up to BLOCK rows meet, and all pairs of
different components are compared, each pair in the least list that it shares,
first by bitmaps of the sketches, then by the union sketch. A longer list comes
from what many texts share, such as a header: its members stand instead in a list
for each of their rarest sketch values, so many that any two that may reach the
threshold share one (prefix filtering: of two sketches that have half their values
in common, one common value is among the rarest half and one of either). What all
texts share is never among the rarest as long as it is less than about half of a
text, so these lists are short and hold texts that share more than that; those
that are long nevertheless are dealt to blocks, each pair of which meets. Members
that have a partner left meet once more, with their full sets, and all their pairs
are verified inside the block: only links that join components leave it, at most
one fewer than its members. So a pair that shares a list is left unverified only
where it is connected anyway or its union sketch is five standard deviations below
the threshold. What is shuffled grows with the members of lists, not with their
pairs; only rare-value lists of over BLOCK texts, whose sketches coincide by half
and more without a link, grow with their square.

Defined cases: a text without words (null, empty, white space) has an empty
set and is linked with nothing; with fewer words than a shingle, the sequence
is one shingle; repeated rows have one id and one class; rows of one id but of
different texts are searched, and judged, each by its text; a row with a null id
links others but is never the name of a component that has ids; an empty table
gives an empty result. The key is a whole number.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common, idsets

#: Values in a sketch, values that are indexed, parts of a list, election orders.
SKETCH, INDEXED, SALTS, ORDERS = 64, 32, 64, 8
FILL = np.uint64(2**64 - 1)
#: What a sketch's values are stored as: the upper half of a hash.
STORED, UPPER = np.uint32, np.uint64(32)
#: A pair is verified from this estimate on: over five standard deviations
#: below the threshold.
ESTIMATE = 0.5
#: Members of a list that meet as a block, bits of a sketch's bitmap, and pairs
#: that are compared at a time.
BLOCK, BITMAP, PAIRS = 1024, 1024, 1 << 16
#: Rows of wider tables that are handled at a time; bounds a worker's memory.
CHUNK = 4096
#: Counters of how often sketch values occur, by which the rarest are told; and the
#: most lists of one kind that a sketch stands in.
COUNTERS = 1 << 20
LISTS = max(INDEXED, SKETCH - int(SKETCH * ESTIMATE) + 1)
NO_LIST = np.iinfo(np.int64).max
#: Bytes of full sets that meet as a block, and shared values handled at a time.
BLOCK_BYTES, COLUMNS = 8 << 20, 2048
#: Numbers from here on stand for classes without an id of their own.
UNNAMED = 1 << 62


def word_codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words (A-Z lowered) one text after another as numbers, the hash of
    each number's word, and each text's count of words."""
    cut = [t.lower().split() for t in texts]
    n = np.array([len(c) for c in cut], np.int64)
    ids: dict = defaultdict(itertools.count().__next__)
    codes = np.fromiter(map(ids.__getitem__, itertools.chain.from_iterable(cut)), np.int64, int(n.sum()))
    return codes, np.fromiter(map(xxhash.xxh3_64_intdigest, ids), np.uint64, len(ids)), n


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words one text after another, and each text's count of words."""
    codes, hashes, n = word_codes(texts)
    return hashes[codes], n


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes."""
    hashes, n = word_hashes(texts)
    rolled = np.zeros(len(hashes), np.uint64)
    for i in range(min(words, len(hashes))):
        rolled[: len(hashes) - i] = rolled[: len(hashes) - i] * np.uint64(0x9E3779B97F4A7C15) + common.mix(hashes[i:] + np.uint64(1))
    rolled = common.mix(rolled)
    out, at = [], 0
    for m in n.tolist():
        if m >= words:
            out.append(np.unique(rolled[at : at + m - words + 1]))
        elif m:
            out.append(np.array([int.from_bytes(xxhash.xxh3_64_digest(b"%d " % m + hashes[at : at + m].tobytes()))], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
        at += m
    return out


def list_keys(values: np.ndarray) -> np.ndarray:
    """The inverted lists that a sketch stands in. A set of under four values
    reaches 0.8 only with its own class and stands in none."""
    if len(values) < 4:
        return np.zeros(0, np.int64)
    v = values[:INDEXED]
    return common.mix(v[:-1] * np.uint64(3) + v[1:]).view(np.int64)


def pair_lists(values: np.ndarray) -> np.ndarray:
    """``list_keys`` of padded sketches, a row each; NO_LIST fills up."""
    out = np.full((len(values), LISTS), NO_LIST)
    for row, v in zip(out, values, strict=True):
        own = list_keys(v[v != FILL])
        row[: len(own)] = own
    return out


def rare_lists(values: np.ndarray, n: np.ndarray, levels: np.ndarray, percent: int) -> np.ndarray:
    """The lists of the rarest values of padded sketches of sets of ``n`` values, a
    row each. Two that have ESTIMATE of their union sketch in common share one: of
    their common values the rarest is behind at most len - ESTIMATE * len others.
    Sets whose linked partners fit a sketch too have ``percent`` in common."""
    held = np.minimum(n, SKETCH)
    least = np.where(n * 100 <= SKETCH * percent, -(-held * percent // 100), np.ceil(held * ESTIMATE).astype(np.int64))
    rank = levels[(values % np.uint64(COUNTERS)).astype(np.int64)].astype(np.uint64) << np.uint64(56) | common.mix(values) >> np.uint64(8)
    rank[values == FILL] = FILL
    first = np.take_along_axis(values, np.argsort(rank, axis=1, kind="stable")[:, :LISTS], 1)
    out = common.mix(first ^ np.uint64(0x5851F42D4C957F2D)).view(np.int64)
    out[np.arange(first.shape[1]) >= (held - least + 1)[:, None]] = NO_LIST
    return out


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(slot, n): how many sketch values fall to each of COUNTERS counters."""
    n = np.zeros(COUNTERS, np.int64)
    for batch in batches:
        for x in batch.column(0).to_pylist():
            n[sketch_values(x) % np.uint64(COUNTERS)] += 1  # a sketch rarely meets a counter twice
    slot = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(slot, pa.int64()), pa.array(n[slot], pa.int64())], ["slot", "n"])


def _rare(batches: Iterator[pa.RecordBatch], levels: Broadcast, percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (id, n, sketch, label) with their ``rare_lists``."""
    common.working("neardup")
    for batch in batches:
        for at in range(0, len(batch), CHUNK):
            part = batch.slice(at, CHUNK)
            lists = rare_lists(padded(part.column(2).to_pylist(), STORED), part.column(1).to_numpy(), levels.value, percent)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array([x[x != NO_LIST] for x in lists], pa.list_(pa.int64()))], ["id", "n", "sketch", "label", "keys"])


def _sketches(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    common.working("neardup")
    for batch in batches:
        texts = common.blobs(batch.column(1))
        for a, b in common.groups(texts):
            sets = shingle_sets(texts[a:b], words)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(a, b - a),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([class_of(s) for s in sets], pa.binary()),
                    pa.array([stored(s) for s in sets], pa.binary()),
                ],
                ["id", "n", "class", "sketch"],
            )


def stored(members: np.ndarray) -> bytes:
    """The sketch of a sorted set."""
    return (members[:SKETCH] >> UPPER).astype(STORED).tobytes()


def sketch_values(sketch: bytes) -> np.ndarray:
    return np.frombuffer(sketch, STORED).astype(np.uint64)


def class_of(members: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(members.tobytes()) if len(members) else None


def _full(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    common.working("neardup")
    for batch in batches:
        texts = common.blobs(batch.column(1))
        for a, b in common.groups(texts):
            sets = shingle_sets(texts[a:b], words)
            yield pa.RecordBatch.from_arrays([pa.array([class_of(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], ["class", "members"])


def _classes(words: int):
    def classes(column: pa.Array) -> pa.Array:
        texts = common.blobs(column)
        return pa.array([class_of(s) for a, b in common.groups(texts) for s in shingle_sets(texts[a:b], words)], pa.binary())

    return classes


def _keys(sketch: pa.Array) -> pa.Array:
    return pa.array([list_keys(sketch_values(x)) for x in sketch.to_pylist()], pa.list_(pa.int64()))


def union_estimate(a: np.ndarray, b: np.ndarray) -> float:
    """The share of the union's least SKETCH values that both sketches hold."""
    union = np.union1d(a, b)[:SKETCH]
    return len(np.intersect1d(np.intersect1d(a, b), union, assume_unique=True)) / max(1, len(union))


def _estimate(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array([union_estimate(sketch_values(x), sketch_values(y)) for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)], pa.float64())


def _common(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array([len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True)) for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)], pa.int64())


def elected_pairs(entries: DataFrame) -> DataFrame:
    """From list entries (key, id): each member with the elected of its part, and
    those with the elected of the list. Distinct (a, b), a < b."""
    order = F.xxhash64("id", F.pmod(F.col("key"), F.lit(ORDERS)))
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS))
    # only key and id are shuffled: what follows from them is computed where they arrive
    e = entries.select("key", "id").repartition("key", salt).select("key", "id", salt.alias("salt"), order.alias("rank"))
    part = e.withColumn("first", F.first("id").over(Window.partitionBy("key", "salt").orderBy("rank", "id")))
    heads = part.where("id = first").select("key", "id").repartition("key").withColumn("rank", order).withColumn("head", F.first("id").over(Window.partitionBy("key").orderBy("rank", "id")))
    pairs = part.where("id <> first").select("id", "first").union(heads.where("id <> head").select("id", "head"))
    return pairs.select(F.least("id", "first").alias("a"), F.greatest("id", "first").alias("b")).distinct()


def padded(sketches: list[bytes], kind: type = np.uint64) -> np.ndarray:
    """Sketches of values of some kind as rows of SKETCH; the greatest number fills up."""
    out = np.full((len(sketches), SKETCH), FILL, np.uint64)
    for row, x in zip(out, sketches, strict=True):
        v = np.frombuffer(x, kind)
        row[: len(v)] = v
    return out


def bitmaps(values: np.ndarray) -> np.ndarray:
    """A row of BITMAP bits for each padded sketch: one for each value."""
    parts = []
    for i in range(0, max(1, len(values)), CHUNK):
        part = values[i : i + CHUNK]
        out = np.zeros((len(part), BITMAP), bool)
        row, at = np.nonzero(part != FILL)
        out[row, (part[row, at] % np.uint64(BITMAP)).astype(np.int64)] = True
        parts.append(np.packbits(out, axis=1))
    return np.concatenate(parts).view(np.uint64)


def may_link(n: np.ndarray, bits: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether pairs of rows may have an estimate of ESTIMATE or more: values of
    one sketch that share a bit are made up for."""
    least, most = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
    out = least * 100 >= most * percent
    a, b, most = a[out], b[out], most[out]
    shared = np.bitwise_count(bits[a] & bits[b]).sum(1, dtype=np.int64)
    lost = (np.minimum(n, SKETCH) - np.bitwise_count(bits).sum(1, dtype=np.int64))[a]
    out[out] = shared + lost >= ESTIMATE * np.minimum(most, SKETCH)
    return out


def estimates(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``union_estimate`` of rows of padded sketches."""
    if len(x) > CHUNK:
        return np.concatenate([estimates(x[i : i + CHUNK], y[i : i + CHUNK]) for i in range(0, len(x), CHUNK)])
    both = np.sort(np.concatenate((x, y), 1), 1)
    real = both != FILL
    again = np.zeros(both.shape, bool)
    again[:, 1:] = (both[:, 1:] == both[:, :-1]) & real[:, 1:]
    rank = np.cumsum(real & ~again, 1)
    return (again & (rank <= SKETCH)).sum(1) / np.maximum(1, np.minimum(rank[:, -1], SKETCH))


def likely(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether pairs of rows have an estimate of ESTIMATE or more."""
    parts = [estimates(values[a[i : i + CHUNK]], values[b[i : i + CHUNK]]) >= ESTIMATE for i in range(0, len(a), CHUNK)]
    return np.concatenate(parts) if parts else np.zeros(0, bool)


def first_shared(keys: np.ndarray, own: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the list ``own`` is the least that rows ``a`` and ``b`` share."""
    out = np.zeros(len(a), bool)
    for i in range(0, len(a), CHUNK):
        x, y, k = keys[a[i : i + CHUNK]], keys[b[i : i + CHUNK]], own[a[i : i + CHUNK], None]
        before = x < k  # keys fill up with the greatest number, which is never before
        out[i : i + CHUNK] = ~((x[:, :, None] == y[:, None, :]).any(2) & before).any(1)
    return out


def runs(batches: Iterator[pa.RecordBatch], by: tuple[str, ...]) -> Iterator[pa.Table]:
    """Ordered rows in tables that hold whole runs of equal ``by``, one or more."""
    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows])
        if not len(rows):
            continue
        last = len(rows) - 1
        same = np.logical_and.reduce([rows[c].to_numpy() == rows[c][last].as_py() for c in by])
        whole = len(rows) - int(same.sum())
        if whole:
            yield rows.slice(0, whole)
        rest = rows.slice(whole).combine_chunks()
    if rest is not None and len(rest):
        yield rest


def edges_of(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal rows begin, and the end."""
    change = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(np.concatenate(([True], change, [True])))


def _cross(batches: Iterator[pa.RecordBatch], percent: int, levels: Broadcast | None) -> Iterator[pa.RecordBatch]:
    """(key, id) of members that may link with one of another component there,
    from rows (key, i, j, block, id, label, n, sketch) in order of key, i and j. The
    lists are those of the rarest values if ``levels`` are given."""
    common.working("neardup")
    for rows in runs(batches, ("key", "i", "j")):
        key, i, j, block, ids, label, n = (rows[c].to_numpy() for c in ("key", "i", "j", "block", "id", "label", "n"))
        values = padded(rows["sketch"].to_pylist(), STORED)
        bits = bitmaps(values)
        lists = rare_lists(values, n, levels.value, percent) if levels else pair_lists(values)
        found = np.zeros(len(ids), bool)
        left, right, held = [], [], 0

        def compared() -> None:
            x, y = np.concatenate(left), np.concatenate(right)
            apart = (label[x] != label[y]) & ((i[x] == j[x]) | (block[x] != block[y]))
            x, y = x[apart], y[apart]
            for test in (lambda a, b: may_link(n, bits, a, b, percent), lambda a, b: first_shared(lists, key, a, b), lambda a, b: likely(values, a, b)):
                near = test(x, y)
                x, y = x[near], y[near]
            found[x] = found[y] = True

        at = edges_of(key, i, j)
        for start, end in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            for k in range(start, end - 1):
                left.append(np.full(end - k - 1, k))
                right.append(np.arange(k + 1, end))
                held += end - k - 1
                if held >= PAIRS:
                    compared()
                    left, right, held = [], [], 0
        if held:
            compared()
        yield pa.RecordBatch.from_arrays([pa.array(key[found]), pa.array(ids[found])], ["key", "id"])


def overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of ``left`` with ``right`` sets, exactly: a
    product of membership matrices over the values that several sets hold."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, which, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(n > 1) - 1
    several = n[which] > 1
    owner, column = owner[several], number[which[several]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(left), len(right)))
    for low in range(0, int(number[-1]) + 1 if len(number) else 0, COLUMNS):
        a, b = np.searchsorted(column, (low, low + COLUMNS))
        held = np.zeros((len(sets), COLUMNS), np.float32)
        held[owner[a:b], column[a:b] - low] = 1
        out += held[left] @ held[right].T
    return out.astype(np.int64)


def joining(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> list[tuple[int, int]]:
    """Of links between rows ``x`` and ``y``, pairs of labels that join them all."""
    parent: dict[int, int] = {}

    def root(a: int) -> int:
        while parent.get(a, a) != a:
            parent[a] = a = parent.get(parent[a], parent[a])
        return a

    out = []
    for a, b in zip(label[x].tolist(), label[y].tolist(), strict=True):
        p, q = root(a), root(b)
        if p != q:
            parent[max(p, q)] = min(p, q)
            out.append((a, b))
    return out


def _verify(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) of labels that links join, from rows (key, i, j, block, id,
    label, members) in order of key, i and j."""
    common.working("neardup")
    for rows in runs(batches, ("key", "i", "j")):
        key, i, j, block, label = (rows[c].to_numpy() for c in ("key", "i", "j", "block", "label"))
        sets = [np.frombuffer(x, np.uint64) for x in rows["members"].to_pylist()]
        n = np.array([len(s) for s in sets], np.int64)
        out = []
        at = edges_of(key, i, j)
        for start, end in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            left, right = start + np.flatnonzero(block[start:end] == i[start]), start + np.flatnonzero(block[start:end] == j[start])
            if len(left) * len(right) < 2 or (label[start:end] == label[start]).all():
                continue
            shared = overlaps(sets[start:end], left - start, right - start)
            linked = (shared * 100 >= (n[left][:, None] + n[right] - shared) * percent) & (label[left][:, None] != label[right])
            a, b = np.nonzero(linked)
            out += joining(label, left[a], right[b])
        a, b = zip(*out, strict=True) if out else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def in_blocks(rows: DataFrame) -> DataFrame:
    """Rows (key, id, blocks, ...) dealt out so that any two of a key meet in one
    (key, i, j): ``block`` is a row's own, i and j the two that meet."""
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    return rows.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("other", "blocks")


class Search:
    """The tables of a search. Nodes of the graph are classes, by number: the least
    id of the class; where that names another class too or is null, a hash."""

    def __init__(self, docs: DataFrame, text: str, key: str, words: int, percent: int):
        self.folder = common.scratch(docs.sparkSession)
        self.words, self.percent = words, percent
        self.docs = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text"))
        sketches = self.docs.mapInArrow(lambda it: _sketches(it, words), "id long, n long, class binary, sketch binary")
        self.sets = common.written(sketches, f"{self.folder}/sets")
        named = self.sets.where("class IS NOT NULL").groupBy("class").agg(F.min("id").alias("id"))
        apart = F.lit(UNNAMED) + F.shiftrightunsigned(F.xxhash64("class"), 2)
        own = F.row_number().over(Window.partitionBy("id").orderBy("class")) == 1
        # a null id would be one window's hot key
        some = named.where("id IS NOT NULL").withColumn("node", F.when(own, F.col("id")).otherwise(apart))
        self.classes = common.written(some.union(named.where("id IS NULL").withColumn("node", apart)), f"{self.folder}/classes")
        # one row of each class, dealt out by class and id, so that copies part and none is shuffled twice
        some_id = F.coalesce("id", F.lit(-1 << 63)).alias("_id")
        first = self.sets.where("n >= 4").select("class", some_id, "n", "sketch").join(self.classes.select("class", some_id, "node"), ["class", "_id"])
        first = first.groupBy("class", "_id").agg(F.first("node").alias("id"), F.first("n").alias("n"), F.first("sketch").alias("sketch")).drop("class", "_id")
        self.sketches = common.written(first, f"{self.folder}/sketches")

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more: what was made of them is written."""
        for name in names:
            common.drop(self.docs.sparkSession, f"{self.folder}/{name}")

    def candidates(self) -> DataFrame:
        keys = F.arrow_udf(_keys, "array<bigint>")
        return elected_pairs(self.sketches.select("id", F.explode(keys("sketch")).alias("key")))

    def near(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) that may reach the threshold."""
        pairs = common.written(pairs, f"{self.folder}/pairs")
        some = idsets.maybe_in(pairs.select(F.explode(F.array("a", "b")).alias("id")))(self.sketches, F.xxhash64("id")).where("_may")
        side = lambda s: some.select(F.col("id").alias(s), F.col("n").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}"))
        estimate = F.arrow_udf(_estimate, "double")
        near = pairs.join(side("a"), "a").join(side("b"), "b").where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * self.percent)
        return common.written(near.where(estimate("sketch_a", "sketch_b") >= ESTIMATE).select("a", "b", "n_a", "n_b"), f"{self.folder}/near")

    def full(self, nodes: DataFrame, name: str) -> DataFrame:
        """(id, members): the full sets of some nodes (one column ``id``)."""
        nodes = common.written(nodes, f"{self.folder}/ids{name}")
        words = self.words
        wanted = common.written(self.classes.join(nodes.withColumnRenamed("id", "node"), "node", "left_semi").select("class", "node"), f"{self.folder}/wanted{name}")
        # one row of each class: the set of rows that share an id is told apart by its class
        ids = self.classes.join(nodes.withColumnRenamed("id", "node"), "node", "left_semi").select("id").distinct()
        probe = idsets.maybe_in(ids.select(F.coalesce("id", F.lit(0)).alias("id")))
        some = probe(self.docs, F.xxhash64(F.coalesce("id", F.lit(0).cast("bigint")))).where("_may")
        sets = some.select("id", "text").mapInArrow(lambda it: _full(it, words), "class binary, members binary")
        return common.written(sets.join(wanted, "class").groupBy("class").agg(F.first("node").alias("id"), F.first("members").alias("members")).drop("class"), f"{self.folder}/full{name}")

    def links(self, near: DataFrame) -> DataFrame:
        """The pairs (a, b) that reach the threshold on full sets."""
        full = self.full(near.select(F.col("a").alias("id")).union(near.select("b")).distinct(), "1")
        both = near.join(full.select(F.col("id").alias("a"), F.col("members").alias("members_a")), "a").join(full.select(F.col("id").alias("b"), F.col("members").alias("members_b")), "b")
        inter = F.arrow_udf(_common, "bigint")
        found = both.select("a", "b", "n_a", "n_b", inter("members_a", "members_b").alias("inter")).withColumn("total", F.col("n_a") + F.col("n_b") - F.col("inter"))
        return common.written(found.where(F.col("inter") * 100 >= F.col("total") * self.percent).select("a", "b").distinct(), f"{self.folder}/links")

    def mixed(self, labelled: DataFrame, name: str) -> DataFrame:
        """(key, rows): lists whose members are not in one component."""
        size = labelled.select(F.explode("keys").alias("key"), "label").groupBy("key").agg(F.count("*").alias("rows"), F.min("label").alias("low"), F.max("label").alias("high"))
        return common.written(size.where("low <> high").select("key", "rows"), f"{self.folder}/{name}")

    def dealt(self, labelled: DataFrame, mixed: DataFrame) -> DataFrame:
        """The members of some lists, dealt to blocks of which any two meet."""
        probe = idsets.maybe_in(mixed.select("key"), "key")
        rows = labelled.select(F.explode("keys").alias("key"), "id", "label", "n", "sketch")
        rows = probe(rows, F.xxhash64("key")).where("_may").join(mixed.select("key", F.ceil(F.col("rows") / BLOCK).alias("blocks")), "key")
        return in_blocks(rows).select("key", "i", "j", "block", "id", "label", "n", "sketch")

    def met(self, rows: DataFrame, levels: Broadcast | None = None) -> DataFrame:
        """(key, id): members that may link with one of another component where they meet."""
        percent = self.percent
        rows = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
        return rows.mapInArrow(lambda it: _cross(it, percent, levels), "key long, id long").distinct()

    def by_rarest(self, labelled: DataFrame, long: DataFrame) -> tuple[DataFrame, Broadcast]:
        """Members of ``long`` lists (and by the bitmaps' chance few others) with the
        lists of their rarest values, and the levels of how frequent values are."""
        percent, spark = self.percent, labelled.sparkSession
        entries = labelled.select("id", F.explode("keys").alias("key"))
        ids = idsets.maybe_in(long.select("key"), "key")(entries, F.xxhash64("key")).where("_may").select("id")
        members = idsets.maybe_in(ids)(labelled, F.xxhash64("id")).where("_may").select("id", "n", "sketch", "label")
        counts = members.select("sketch").mapInArrow(_counts, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
        counts = counts.toArrow()  # at most COUNTERS rows
        n = np.zeros(COUNTERS, np.int64)
        n[counts["slot"].to_numpy()] = counts["n"].to_numpy()
        levels = spark.sparkContext.broadcast(np.frexp(n.astype(np.float64))[1].astype(np.uint8))
        rare = members.mapInArrow(lambda it: _rare(it, levels, percent), "id long, n long, sketch binary, label long, keys array<long>")
        return common.written(rare, f"{self.folder}/rare"), levels

    def unresolved(self, labels: DataFrame) -> DataFrame:
        """(key, id, label): members of lists that may link with one of another
        component there, each pair in one of the lists that it shares."""
        keys = F.arrow_udf(_keys, "array<bigint>")
        labelled = self.sketches.join(labels.withColumnRenamed("node", "id"), "id", "left").select("id", "n", "sketch", F.coalesce("label", "id").alias("label"))
        labelled = common.written(labelled.select("*", keys("sketch").alias("keys")), f"{self.folder}/labelled")
        mixed = self.mixed(labelled, "mixed")
        found, long = self.met(self.dealt(labelled, mixed.where(F.col("rows") <= BLOCK))), mixed.where(F.col("rows") > BLOCK)
        if not long.isEmpty():
            rare, levels = self.by_rarest(labelled, long)
            found = found.union(self.met(self.dealt(rare, self.mixed(rare, "mixed2")), levels))
        return common.written(found.join(labelled.select("id", "label", "n"), "id"), f"{self.folder}/unresolved")

    def joined(self, rest: DataFrame) -> DataFrame:
        """Pairs (a, b) of labels that links among the unresolved members join."""
        percent = self.percent
        blocks = rest.groupBy("key").agg(F.ceil(F.greatest(F.sum("n") * 8 / BLOCK_BYTES, F.count("*") / BLOCK)).alias("blocks"))
        full = self.full(rest.select("id").distinct(), "2")
        rows = in_blocks(rest.join(blocks, "key").select("key", "id", "label", "blocks"))
        rows = rows.join(full, "id").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").select("key", "i", "j", "block", "id", "label", "members")
        return common.written(rows.mapInArrow(lambda it: _verify(it, percent), "a long, b long").distinct(), f"{self.folder}/joined")

    def run(self) -> DataFrame:
        """(class, component): every class that has words, with the least id that
        it reaches; null where none has one."""
        links = self.links(self.near(self.candidates()))
        self.drop("pairs", "near", "ids1", "wanted1", "full1")
        labels = idsets.components(links, f"{self.folder}/c1")
        rest = self.unresolved(labels)
        self.drop("labelled", "mixed", "rare", "mixed2", "sketches")
        joined = self.joined(rest)
        self.drop("unresolved", "ids2", "wanted2", "full2")
        more = idsets.components(joined, f"{self.folder}/c2")
        first = self.classes.join(labels, "node", "left").select("class", "id", F.coalesce("label", "node").alias("label"))
        last = idsets.relabelled(first, more, "class")
        last = common.written(last, f"{self.folder}/labels")
        self.drop("links", "joined", "c1", "c2", "classes")
        # components without an id for a number are few: their least id, if any
        unnamed = last.where(F.col("label") >= UNNAMED).groupBy("label").agg(F.min("id").alias("least"))
        named = last.join(unnamed, "label", "left").select("class", F.when(F.col("label") < UNNAMED, F.col("label")).otherwise(F.col("least")).alias("component"))
        return common.written(named, f"{self.folder}/components")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: id, set size, the least id of its component, and
    whether it is that document."""
    common.ship(docs.sparkSession)
    search = Search(docs, text, key, words, percent)
    found = search.sets.select("id", "n", "class").join(search.run(), "class", "left")
    component = F.coalesce(F.col("component"), F.col("id"))
    kind = docs.select(key).schema[0].dataType
    return found.select(F.col("id").cast(kind).alias(key), F.col("n").alias("n_shingles"), component.cast(kind).alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def first_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = 5, percent: int = 80) -> DataFrame:
    """``docs``, all columns, without near-duplicates of a kept document: the one
    with the least id stays. Rows with one id are judged each by its text; of rows
    that stand for one component one stays, and rows with a null id, which name
    nothing, stay. Only rows that may go are shuffled."""
    spark = docs.sparkSession
    common.ship(spark)
    search = Search(docs, text, key, words, percent)
    components = search.run()
    found = search.sets.where("id IS NOT NULL").select("id", "class").join(components, "class", "left").select("id", (F.col("id") == F.coalesce("component", "id")).alias("kept"))
    ids = found.groupBy("id").agg(F.count("*").alias("rows"), F.min("kept").alias("kept"))
    touched = common.written(ids.where((F.col("rows") > 1) | ~F.col("kept")).select("id"), f"{search.folder}/touched")
    id_ = F.col(key).cast("bigint")
    marked = idsets.maybe_in(touched)(docs, F.xxhash64(id_))
    apart = marked.where(id_.isNull() | ~F.col("_may"))
    row = F.struct(*docs.columns)
    near = marked.where(id_.isNotNull() & F.col("_may")).select(id_.alias("_id"), row.alias("_row"), F.arrow_udf(_classes(words), "binary")(F.col(text)).alias("class"))
    near = near.join(components, "class", "left").where(F.col("_id") == F.coalesce("component", "_id"))
    # texts without words form no component: rows that repeat one id and nothing else are one
    near = near.groupBy("_id", F.col("component").isNull().alias("_alone")).agg(F.min_by("_row", F.xxhash64(F.to_json("_row"))).alias("_row")).select("_row.*")
    return apart.select(*docs.columns).union(near)
