"""Quality rules: compression bands over whole documents and fixed chunks.

A text that zstandard shrinks far more than prose of its length repeats itself;
one that it hardly shrinks is noise. Limits depend on the length because short
inputs compress worse. Long texts are also judged chunk by chunk, so that a
repetitive half cannot hide behind a normal one.

Defined cases: a null or empty text has no words and fails; repeated rows are
each judged by themselves; nothing but the text is read.
"""

from __future__ import annotations

import itertools
from collections import defaultdict

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Bytes of a chunk, and the compression level. Parameters of the method.
CHUNK, LEVEL = 4096, 3
#: (from this many bytes, least ratio, greatest ratio) of compressed to raw.
BANDS = ((0, 0.00, 9.00), (120, 0.40, 1.10), (200, 0.40, 0.95), (400, 0.44, 0.88), (800, 0.43, 0.80), (1600, 0.41, 0.74), (3200, 0.395, 0.70), (6400, 0.38, 0.68), (12800, 0.36, 0.66))
#: The same for a single full chunk, and the share of chunks that may fail.
CHUNK_BAND, CHUNK_SHARE = (0.33, 0.74), 0.4
#: The base rules.
MIN_WORDS, REPEAT_PERCENT, WINDOW = 20, 30, 8

FIELDS = [
    ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()),
    ("base_failed", pa.bool_()), ("ratio", pa.float64()), ("n_chunks", pa.int64()), ("n_bad_chunks", pa.int64()), ("kept", pa.bool_()),
]
SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, ratio double, n_chunks long, n_bad_chunks long, kept boolean"

_KINDS = np.zeros(256, np.int64)  # 1: continues a code point, 2: white space, 3: symbol
_KINDS[0x80:0xC0] = 1
_KINDS[[0x20, *range(0x09, 0x0E)]] = 2
_KINDS[list(b"#*$%&|<>")] = 3


def repeated_words(docs: list[list[bytes]]) -> np.ndarray:
    """For each text, how many words lie in 8-word windows found twice or more.

    A window can only repeat where all its word pairs repeat, so exact
    comparison is left for runs of repeated pairs.
    """
    out = np.zeros(len(docs), np.int64)
    lens = np.array([len(d) for d in docs], np.int64)
    ids = defaultdict(itertools.count().__next__)
    codes = np.fromiter(map(ids.__getitem__, itertools.chain.from_iterable(docs)), np.int64, int(lens.sum()))
    if len(codes) < WINDOW:
        return out
    doc = np.repeat(np.arange(len(docs)), lens)
    k = np.int64(len(ids))
    pairs = codes[:-1] * k + codes[1:]
    order = np.lexsort((pairs, doc[:-1]))
    same = (pairs[order][1:] == pairs[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    twice = np.zeros(len(pairs), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    runs = np.cumsum(np.concatenate(([0], twice)))
    at = np.flatnonzero(runs[WINDOW - 1 :] - runs[: -(WINDOW - 1)] == WINDOW - 1)
    at = at[doc[at] == doc[at + WINDOW - 1]]
    if not len(at):
        return out
    ranks = doc[at]
    for step in range(WINDOW):  # exact: the rank of (rank so far, next word)
        ranks = np.unique(ranks * k + codes[at + step], return_inverse=True)[1]
    at = at[np.bincount(ranks)[ranks] > 1]
    edges = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + WINDOW, -1)
    covered = np.cumsum(edges[:-1]) > 0
    return np.bincount(doc[covered], minlength=len(docs)).astype(np.int64)


def band(n_bytes: int) -> tuple[float, float]:
    return next((low, high) for least, low, high in reversed(BANDS) if n_bytes >= least)


def compression(text: bytes, packer: zstandard.ZstdCompressor) -> tuple[float, int, int, bool]:
    """(ratio of the whole, full chunks, chunks outside their band, verdict)."""
    if not text:
        return 0.0, 0, 0, False
    ratio = len(packer.compress(text)) / len(text)
    low, high = band(len(text))
    n = len(text) // CHUNK if len(text) >= 2 * CHUNK else 0
    view = memoryview(text)
    bad = sum(not CHUNK_BAND[0] <= len(packer.compress(view[i * CHUNK : (i + 1) * CHUNK])) / CHUNK <= CHUNK_BAND[1] for i in range(n))
    return ratio, n, bad, low <= ratio <= high and bad <= CHUNK_SHARE * n


def measured(texts: list[bytes]) -> list[np.ndarray | list]:
    """The columns of FIELDS for some texts."""
    cols: list[list] = [[] for _ in FIELDS]
    packer = zstandard.ZstdCompressor(level=LEVEL)
    for a, b in common.groups(texts):
        docs = [t.split() for t in texts[a:b]]
        repeats = repeated_words(docs)
        for text, words, repeat in zip(texts[a:b], docs, repeats.tolist(), strict=True):
            kinds = np.bincount(_KINDS[np.frombuffer(text, np.uint8)], minlength=4)
            lines = [x for x in text.split(b"\n") if x and not x.isspace()]
            ratio, n, bad, verdict = compression(text, packer)
            failed = len(words) < MIN_WORDS or 100 * repeat > REPEAT_PERCENT * len(words)
            row = (len(words), len(text) - int(kinds[1]) - int(kinds[2]), int(kinds[3]), len(lines) - len(set(lines)), repeat, failed, ratio, n, bad, not failed and verdict)
            for col, x in zip(cols, row, strict=True):
                col.append(x)
    return cols


def _measure(text: pa.Array) -> pa.Array:
    common.working("quality")
    cols = measured(common.blobs(text))
    return pa.StructArray.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, FIELDS, strict=True)], [n for n, _ in FIELDS])


def verdict(text: Column) -> Column:
    """A struct of all measures of a text and ``kept``."""
    return F.arrow_udf(_measure, SCHEMA)(text)


def quality_rules(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: its key, the base measures and the verdict."""
    common.ship(docs.sparkSession)
    return docs.select(F.col(key), verdict(F.col(text)).alias("_q")).select(key, "_q.*")


def kept_only(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that pass, with all their columns."""
    common.ship(docs.sparkSession)
    return docs.where(verdict(F.col(text))["kept"])
