"""Token ids on disk: canonical length-limited Huffman codes from global counts.

A file holds a run of documents in ascending key order. Each document's code
starts at a byte; every BLOCK ids its bit offset is kept as a checkpoint, so
blocks decode independently: all blocks of a stretch advance together, one id
each per step, through one table of 2^LIMIT entries.

Layout of a file, integers little-endian:
  magic (8 bytes) | code of all documents | index | footer
  index: keys int64[d], key present uint8[d], ids int64[d], block bit offsets uint64[b]
  footer: offset of the index uint64, d uint64, b uint64
The codebook is a file of its own: one code length (uint8) for each id.

Defined cases: a null text is empty and holds the end id alone; rows with a
null key come first; rows with one key are ordered by a hash of their ids; an
empty table gives no files and an empty result; other columns are not read. Keys
are whole numbers. Codes have up to LIMIT bits, or as many as so many different ids need.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, tokens

MAGIC, LIMIT, BLOCK, END_ID = b"TOKHUF01", 16, 256, 2
#: The most bits that a code may have: a window of 32 bits holds it from any bit of a byte on.
MOST = 25
#: Ids that a file should hold, and the fewest worth a file of their own.
FILE_IDS, LEAST_IDS = 1 << 26, 1 << 20
#: Blocks decoded together; bounds a reader's memory.
STRETCH = 1 << 13
FOOTER = struct.Struct("<QQQ")
WHOLE = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8()}


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths up to ``limit``, or as many bits as the number of ids needs,
    by package-merge; 0 for absent ids."""
    out = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    limit = max(limit, (len(used) - 1).bit_length() if len(used) else 1)
    if len(used) < 2:
        out[used] = 1
        return out
    used = used[np.argsort(counts[used], kind="stable")]
    coins = counts[used].astype(np.int64)
    n, row, own = len(used), coins, [np.ones(len(used), bool)]
    if limit > MOST:
        raise ValueError(f"{n} ids don't fit in codes of {MOST} bits")
    for _ in range(limit - 1):
        half = len(row) // 2
        row = np.concatenate((coins, row[: 2 * half : 2] + row[1 : 2 * half : 2]))
        order = np.argsort(row, kind="stable")
        row = row[order]
        own.append(order < n)
    take, lengths = 2 * n - 2, np.zeros(n, np.uint8)
    for mask in reversed(own):
        k = int(mask[:take].sum())
        lengths[:k] += 1
        take = 2 * (take - k)
    out[used] = lengths
    return out


def width(lengths: np.ndarray) -> int:
    """Bits by which the decoding table is looked up."""
    return max(LIMIT, int(lengths.max(initial=0)))


def codes(lengths: np.ndarray) -> np.ndarray:
    """Canonical codes: in order of length, then id."""
    limit = np.uint64(width(lengths))
    out = np.zeros(len(lengths), np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    span = np.uint64(1) << (limit - lengths[order].astype(np.uint64))
    left = np.cumsum(span) - span
    out[order] = left >> (limit - lengths[order].astype(np.uint64))
    return out


def table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window of ``width`` bits: the id it starts with and its length."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    span = 1 << (width(lengths) - lengths[order].astype(np.int64))
    size = 1 << width(lengths)
    ids, steps = np.zeros(size, np.uint32), np.ones(size, np.int64)
    ids[: span.sum()] = np.repeat(order, span)
    steps[: span.sum()] = np.repeat(lengths[order], span)
    return ids, steps


def encode(docs: list[np.ndarray], lengths: np.ndarray, book: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Some documents' code, each from a byte on: (bytes, bits of each document,
    bit offsets of all blocks from the first byte)."""
    n = np.array([len(d) for d in docs], np.int64)
    if not n.sum():
        return b"", np.zeros(len(docs), np.int64), np.zeros(0, np.int64)
    ids = np.concatenate(docs)
    size = lengths[ids].astype(np.int64)
    ends = np.concatenate(([0], np.cumsum(size)))
    first = np.cumsum(n) - n
    bits = ends[first + n] - ends[first]
    aligned = (bits + 7) // 8 * 8
    shift = np.cumsum(aligned) - aligned - ends[first]
    at = ends[:-1] + np.repeat(shift, n)
    word, off = at >> 5, at & 31
    value = book[ids] << (64 - off - size).astype(np.uint64)
    words = int(aligned.sum() + 31 >> 5) + 1
    high = np.bincount(word, (value >> np.uint64(32)).astype(np.float64), words)
    low = np.bincount(word + 1, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), words)
    packed = (high + low[:words]).astype(np.uint32).astype(">u4").tobytes()[: int(aligned.sum()) // 8]
    blocks = np.concatenate([np.arange(f, f + m, BLOCK) for f, m in zip(first.tolist(), n.tolist(), strict=True)])
    return packed, aligned, at[blocks.astype(np.int64)]


def decode(code: bytes, starts: np.ndarray, sizes: np.ndarray, ids: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """The ids of blocks one after another; ``starts``: bit offsets in ``code``."""
    raw = np.frombuffer(code + b"\0\0\0\0", np.uint8).astype(np.uint32)
    window = raw[:-3] << np.uint32(24) | raw[1:-2] << np.uint32(16) | raw[2:-1] << np.uint32(8) | raw[3:]
    bits = (len(ids) - 1).bit_length()
    mask, left = np.uint32(len(ids) - 1), 32 - bits
    out = np.zeros(int(sizes.sum()), np.uint32)
    order = np.argsort(-sizes, kind="stable")
    at, to, size = starts[order].copy(), (np.cumsum(sizes) - sizes)[order], sizes[order]
    live = np.searchsorted(-size, -np.arange(int(size[0]) if len(size) else 0), "left")
    for step, k in enumerate(live.tolist()):
        p = at[:k]
        v = window[p >> 3] >> (left - (p & 7)).astype(np.uint32) & mask
        out[to[:k] + step] = ids[v]
        at[:k] += steps[v]
    return out


def block_sizes(n: np.ndarray) -> np.ndarray:
    """The ids in each block of documents of ``n`` ids."""
    blocks = (n + BLOCK - 1) // BLOCK
    out = np.full(int(blocks.sum()), BLOCK, np.int64)
    full = blocks > 0
    out[np.cumsum(blocks)[full] - 1] = n[full] - (blocks[full] - 1) * BLOCK
    return out


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder)


def _save(batches: Iterator[pa.RecordBatch], folder: str, lengths: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Write one partition's documents, which come in order, as one file."""
    part, book = TaskContext.get().partitionId(), codes(lengths)
    store, root = _open(folder)
    temporary, final = f"{root}/.{uuid.uuid4().hex}", f"{root}/part-{part:07d}.huf"
    keys, present, sizes, offsets, at = [], [], [], [], len(MAGIC)
    with store.open_output_stream(temporary) as out:
        out.write(MAGIC)
        for batch in batches:
            key = batch.column(0)
            present.append(np.asarray(key.is_valid().to_numpy(zero_copy_only=False), np.uint8))
            keys.append(key.cast(pa.int64()).fill_null(0).to_numpy().astype(np.int64))
            packed = batch.column(1).to_pylist()
            for a, b in common.groups(packed):
                docs = [np.frombuffer(x, np.uint16 if x[:1] == b"\2" else np.uint32, offset=4) for x in packed[a:b]]
                code, _, starts = encode(docs, lengths, book)
                out.write(code)
                sizes.append(np.array([len(d) for d in docs], np.int64))
                offsets.append((starts + 8 * at).astype(np.uint64))
                at += len(code)
        n = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        blocks = np.concatenate(offsets) if offsets else np.zeros(0, np.uint64)
        for a in (*keys, *present, n, blocks):
            out.write(np.ascontiguousarray(a).tobytes())
        out.write(FOOTER.pack(at, len(n), len(blocks)))
    if len(n):
        store.move(temporary, final)
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([int(n.sum())], pa.int64())], ["part", "n_ids"])
    else:
        store.delete_file(temporary)


def _load(batches: Iterator[pa.RecordBatch], folder: str, lengths: np.ndarray, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Decode files: each document's key, start, ids and their crc32."""
    ids, steps = table(lengths)
    store, root = _open(folder)
    for batch in batches:
        for part, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            with store.open_input_file(f"{root}/part-{part:07d}.huf") as f:
                end = f.size()
                at, d, b = FOOTER.unpack(f.read_at(FOOTER.size, end - FOOTER.size))
                if f.read_at(len(MAGIC), 0) != MAGIC:
                    raise ValueError("not a token file")
                index = f.read_at(end - FOOTER.size - at, at)
                keys, n = np.frombuffer(index, np.int64, d), np.frombuffer(index, np.int64, d, 9 * d)
                present = np.frombuffer(index, np.uint8, d, 8 * d).astype(bool)
                offsets = np.frombuffer(index, np.uint64, b, 17 * d).astype(np.int64)
                sizes, crc, done = block_sizes(n), np.zeros(d, np.int64), 0
                owner = np.repeat(np.arange(d), (n + BLOCK - 1) // BLOCK)
                for i in range(0, b, STRETCH):
                    j = min(b, i + STRETCH)
                    low, high = int(offsets[i]) // 8, int(offsets[j]) // 8 + 4 if j < b else at
                    got = decode(f.read_at(min(high, at) - low, low), offsets[i:j] - 8 * low, sizes[i:j], ids, steps)
                    place = np.concatenate(([0], np.cumsum(sizes[i:j])))
                    edges = np.flatnonzero(np.diff(owner[i:j], prepend=-1, append=-1))
                    for x, y in zip(edges, edges[1:], strict=False):  # a document may go on in the next stretch
                        o = owner[i + x]
                        crc[o] = zlib.crc32(got[place[x] : place[y]].tobytes(), int(crc[o]))
                    done += len(got)
                start = base + np.cumsum(n) - n
                yield pa.RecordBatch.from_arrays([pa.array(keys, mask=~present).cast(kind), pa.array(start), pa.array(n), pa.array(crc)], ["doc_id", "start", "n_tokens", "ids_crc32"])


def _tokenise(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    encoder, end = tokens.encoder(path), np.array([end_id], np.uint32).tobytes()
    for batch in batches:
        texts = common.blobs(batch.column(1))
        for a, b in common.groups(texts):
            packed, n = [], []
            for x in encoder.ids(texts[a:b]):
                i = np.frombuffer(x + end, np.uint32)
                small = i.max() < 1 << 16
                packed.append((b"\2\0\0\0" if small else b"\4\0\0\0") + (i.astype(np.uint16) if small else i).tobytes())
                n.append(len(i))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(packed, pa.binary()), pa.array(n, pa.int64())], ["doc_id", "ids", "n"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        for x in batch.column(0).to_pylist():
            c = np.bincount(np.frombuffer(x, np.uint16 if x[:1] == b"\2" else np.uint32, offset=4))
            if len(c) > len(total):
                total = np.concatenate((total, np.zeros(len(c) - len(total), np.int64)))
            total[: len(c)] += c
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])


def store(docs: DataFrame, path: str, folder: str, text: str = "text", key: str = "doc_id", end_id: int = END_ID) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Tokenise and write files into ``folder``; their numbers with the ids before
    each, and the code lengths, which are also written as the codebook."""
    spark = docs.sparkSession
    common.ship(spark)
    kind = docs.select(key).schema[0].dataType.simpleString()
    if kind not in WHOLE:
        raise ValueError(f"the key has to be a whole number, not {kind}")
    ids = docs.select(key, text).mapInArrow(lambda it: _tokenise(it, path, end_id), f"doc_id {kind}, ids binary, n long")
    scratch = common.scratch(spark)
    ids = common.written(ids, f"{scratch}/ids")
    # a row for each id of the vocabulary at most
    counted = ids.select("ids").mapInArrow(_count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    which, n = counted["id"].to_numpy(), counted["n"].to_numpy()
    counts = np.zeros(int(which.max()) + 1 if len(which) else 1, np.int64)
    counts[which] = n
    lengths, total = code_lengths(counts), int(n.sum())
    target, root = _open(folder)
    target.create_dir(root)
    with target.open_output_stream(f"{root}/codebook.len") as f:
        f.write(lengths.tobytes())
    files = max(-(-total // FILE_IDS), min(2 * spark.sparkContext.defaultParallelism, -(-total // LEAST_IDS)), 1)
    ordered = ids.select("doc_id", "ids", F.xxhash64("ids").alias("tie")).repartitionByRange(files, F.asc_nulls_first("doc_id"), "tie").sortWithinPartitions(F.asc_nulls_first("doc_id"), "tie")
    done = ordered.select("doc_id", "ids").mapInArrow(lambda it: _save(it, folder, lengths), "part long, n_ids long").collect()  # a row for each file
    common.drop(spark, scratch)
    parts, before = [], 0
    for r in sorted(done):
        parts.append((r["part"], before))
        before += r["n_ids"]
    return parts, lengths


def load(spark, folder: str, parts: list[tuple[int, int]], lengths: np.ndarray, kind: str = "bigint", key: str = "doc_id") -> DataFrame:
    """Read the files back: a row for each document."""
    schema = f"doc_id {kind}, start long, n_tokens long, ids_crc32 long"
    arrow = WHOLE[kind]
    listed = spark.createDataFrame(parts, "part long, base long").repartitionByRange(max(1, len(parts)), "part")  # a file a task
    return listed.mapInArrow(lambda it: _load(it, folder, lengths, arrow), schema).withColumnRenamed("doc_id", key)


def round_trip(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", end_id: int = END_ID) -> DataFrame:
    """Write all documents' ids in key order and read them back from the files."""
    spark = docs.sparkSession
    folder = f"{common.scratch(spark)}/files"
    parts, lengths = store(docs, path, folder, text, key, end_id)
    return load(spark, folder, parts, lengths, docs.select(key).schema[0].dataType.simpleString(), key)
