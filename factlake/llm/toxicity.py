"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the mean of vectors of its character n-grams (and of itself), hashed
into a fixed table, so a misspelling shares most of a known word's vectors. A
window of about WINDOW words is the mean of its words; a linear softmax over
that decides, and a document counts as its most toxic window: an insult in a
long text is not averaged away. Vectors and softmax are trained jointly in
numpy on the driver, from a bounded sample of labelled rows: at most SAMPLE of
each label, those whose ids hash lowest, and at most SAMPLE_BYTES of text of each
(a text beyond ROW_BYTES is not learnt from and takes no room from others; it is
scored whole like any). Training starts at each bucket's own
evidence; what it adds is shown by a test that leaves it out. All documents are
scored on the workers, whole, from one number for each n-gram bucket.

Defined cases: a null or empty text has no words and gets the score of the bias
alone; rows with a null label or id are not learnt from; an id labelled twice
takes its greater label; repeated rows are scored each, and learnt from once; other
columns are not read; empty tables give empty results; without rows of both
labels every score is the share of label 1, or 0 without labels.
"""

from __future__ import annotations

import itertools
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Parameters: the sample's bound for each label, hash buckets, dimensions,
#: n-gram lengths in bytes, words in a window, and the training's course.
SAMPLE, BUCKETS, DIMENSIONS, GRAMS, WINDOW = 2000, 1 << 16, 8, (3, 4, 5, 6), 3
SAMPLE_BYTES, ROW_BYTES = 32 << 20, 1 << 20
EPOCHS, RATE, DECAY, SEED = 30, 0.01, 1e-5, 7
#: The start's scale, and the documents that count as half evidence.
START, SHRINK = 6.0, 8.0
FOLDS, HELD, LIMIT = 3, 1, 0.7
EDGE = b".,;:!?\"'()[]{}*#$%&|"

_memo = common.Generations(200_000)
_memo_of: list = [None]


def grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word's n-grams and of itself, word after word, and how many."""
    framed = [b"<" + w + b">" for w in words]
    size = np.array([len(w) for w in framed], np.int64)
    raw = np.frombuffer(b"".join(framed), np.uint8).astype(np.uint64)
    word = np.repeat(np.arange(len(words)), size)
    owners, buckets = [], []
    prefix = common.mix(raw + np.uint64(257))
    rolled = np.zeros(len(raw), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        if n > len(raw):
            break
        rolled[: len(raw) - n + 1] = rolled[: len(raw) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + prefix[n - 1 :]
        if n in GRAMS:
            at = np.flatnonzero(word[: len(raw) - n + 1] == word[n - 1 :])
            owners.append(word[at])
            buckets.append(common.mix(rolled[at] + np.uint64(n)) % np.uint64(BUCKETS))
    first = np.cumsum(size) - size
    weight = prefix * common.mix(np.arange(len(raw), dtype=np.uint64) - np.repeat(first, size).astype(np.uint64) + np.uint64(1))
    owners.append(np.arange(len(words)))
    buckets.append(common.mix(np.add.reduceat(weight, first)) % np.uint64(BUCKETS) if len(words) else np.zeros(0, np.uint64))
    owner, bucket = np.concatenate(owners), np.concatenate(buckets).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    return bucket[order], np.bincount(owner, minlength=len(words))


def split(text: bytes) -> list[bytes]:
    """Lower-case words without outer punctuation."""
    return [w for w in (x.strip(EDGE) for x in text.lower().split()) if w]


def windows(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the windows of texts of ``n`` words laid end to end, and the
    windows of each text: even parts of about WINDOW words."""
    many = np.maximum(1, (n + WINDOW // 2) // WINDOW) * (n > 0)
    first = np.repeat(np.cumsum(n) - n, many)
    step = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
    return first + step * np.repeat(n, many) // np.repeat(np.maximum(many, 1), many), many


def means(values: np.ndarray, starts: np.ndarray, end: int) -> np.ndarray:
    total = np.add.reduceat(values, starts, axis=0)
    size = np.diff(np.append(starts, end))
    return total / (size[:, None] if values.ndim > 1 else size)


def evidence(which: np.ndarray, label: np.ndarray, doc: np.ndarray, bucket: np.ndarray, per_word: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Where training starts: each bucket's smoothed log-odds from the number of
    documents of either label that hold it, shrunk where these are few."""
    pairs = np.unique(doc * np.int64(len(per_word)) + which)  # (document, word)
    doc, word = pairs // len(per_word), pairs % len(per_word)
    first = np.cumsum(per_word) - per_word
    found = [np.zeros(BUCKETS), np.zeros(BUCKETS)]
    for a in range(0, len(word), 1 << 15):
        d, w = doc[a : a + (1 << 15)], word[a : a + (1 << 15)]
        size = per_word[w]
        spots = np.repeat(first[w] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        held = np.unique(np.repeat(d, size) * np.int64(BUCKETS) + bucket[spots])
        one = y[held // BUCKETS] == 1
        for c in (0, 1):
            found[c] += np.bincount(held[one == c] % BUCKETS, minlength=BUCKETS)
    odds = np.log((found[1] + 1) / (y.sum() + 2)) - np.log((found[0] + 1) / (len(y) - y.sum() + 2))
    return (odds * (found[0] + found[1]) / (found[0] + found[1] + SHRINK)).astype(np.float32)


def train(texts: list[bytes], labels: np.ndarray) -> tuple[np.ndarray, float]:
    """A number for each bucket and the bias: the log-odds of a window are the
    bias and the mean of its words' means."""
    ids: dict = defaultdict(itertools.count().__next__)
    coded = [np.fromiter(map(ids.__getitem__, split(t)), np.int32) for t in texts]
    keep = [i for i, c in enumerate(coded) if len(c)]
    share = float(labels.mean()) if len(labels) else 0.0
    bias = float(np.log((share + 1e-9) / (1 - share + 1e-9)))
    if not keep or len(set(labels[keep].tolist())) < 2:
        return np.zeros(BUCKETS, np.float32), bias
    docs, y = [coded[i] for i in keep], labels[keep].astype(np.float64)
    n = np.array([len(d) for d in docs], np.int64)
    which = np.concatenate(docs)
    words, parts = list(ids), []
    for i in range(0, len(words), 20_000):
        bucket, many = grams(words[i : i + 20_000])
        parts.append((bucket.astype(np.int32), many))
    bucket, per_word = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    del coded, words, parts
    at = np.cumsum(per_word) - per_word
    starts, many = windows(n)
    ends = np.append(starts[1:], len(which))
    own = np.cumsum(many) - many
    random = np.random.default_rng(SEED)
    vectors = random.normal(0, 0.02, (BUCKETS, DIMENSIONS)).astype(np.float32)
    softmax = random.normal(0, 0.02, (DIMENSIONS, 2)).astype(np.float32)
    vectors[:, 0] = evidence(which, np.repeat(y, n), np.repeat(np.arange(len(docs)), n), bucket, per_word, y)
    softmax[0] = -START / 2, START / 2
    shift = np.zeros(2)
    moments = [[np.zeros_like(p), 0.0] for p in (vectors, softmax, shift)]
    doc_of = np.repeat(np.arange(len(docs)), many)
    class_weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    for epoch in range(EPOCHS):
        word = means((vectors @ (softmax[:, 1] - softmax[:, 0]))[bucket], at, len(bucket))
        logit = means(word[which], starts, len(which)) + shift[1] - shift[0]
        # the most toxic window of each document
        chosen = np.lexsort((logit, doc_of))[own + many - 1]
        p = 1 / (1 + np.exp(-logit[chosen]))
        slope = (p - y) * class_weight  # of the log-odds
        size = (ends - starts)[chosen]
        spots = np.concatenate([np.arange(a, b) for a, b in zip(starts[chosen], ends[chosen], strict=True)])
        to_word = np.bincount(which[spots], np.repeat(slope / size, size), len(ids)) / per_word
        to_bucket = np.bincount(bucket, np.repeat(to_word, per_word), BUCKETS).astype(np.float32)
        direction = softmax[:, 1] - softmax[:, 0]
        toward = vectors.T @ to_bucket
        steps = (to_bucket[:, None] * direction + DECAY * vectors, np.stack((-toward, toward), 1) + DECAY * softmax, np.array([-slope.sum(), slope.sum()]))
        for param, grad, moment in zip((vectors, softmax, shift), steps, moments, strict=True):
            # one second moment for a whole table: rare n-grams move less than frequent ones
            moment[0] += 0.1 * (grad - moment[0])
            moment[1] += 0.01 * (float(np.square(grad).mean()) - moment[1])
            size_ = np.sqrt(moment[1] / (1 - 0.99 ** (epoch + 1))) + 1e-12
            param -= (RATE * moment[0] / (1 - 0.9 ** (epoch + 1)) / size_).astype(param.dtype)
    return (vectors @ (softmax[:, 1] - softmax[:, 0])).astype(np.float32), float(shift[1] - shift[0])


def scores(texts: list[bytes], weights: np.ndarray, bias: float) -> np.ndarray:
    """Each text's probability of label 1."""
    if _memo_of[0] is not weights:  # another model: what was remembered is void
        _memo.young, _memo.old, _memo_of[0] = {}, {}, weights
    docs = [split(t) for t in texts]
    new = _memo.missing(set().union(*docs))
    for i in range(0, len(new), 20_000):
        part = new[i : i + 20_000]
        bucket, per_word = grams(part)
        _memo.learn(zip(part, means(weights[bucket].astype(np.float64), np.cumsum(per_word) - per_word, len(bucket)).tolist(), strict=True))
    n = np.array([len(d) for d in docs], np.int64)
    word = np.fromiter(map(_memo.young.__getitem__, itertools.chain.from_iterable(docs)), np.float64, int(n.sum()))
    _memo.age()
    out = np.full(len(texts), bias)
    starts, many = windows(n)
    if len(starts):
        logit = means(word, starts, len(word)) + bias
        full = many > 0
        out[full] = np.maximum.reduceat(logit, (np.cumsum(many) - many)[full])
    return 1 / (1 + np.exp(-np.clip(out, -500, 500)))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """Train on at most ``sample`` rows of each label outside the held fold."""
    use = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & (common.fold(F.col(key), FOLDS) != HELD)).groupBy(F.col(key).alias("_key")).agg(F.max(label).alias("_label"))
    some = [use.where(F.col("_label") == c).orderBy(F.xxhash64("_key"), "_key").limit(sample) for c in (0, 1)]
    chosen = F.broadcast(some[0].union(some[1]))  # 2 * sample rows at most
    found = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(chosen, "_key")
    # rows that repeat an id count once, by their least text
    found = common.written(found.groupBy("_key", "_label").agg(F.min("_text").alias("_text")).withColumn("_n", F.coalesce(F.octet_length("_text"), F.lit(0))), f"{common.scratch(docs.sparkSession)}/labelled")
    # a text beyond ROW_BYTES is left out by itself, and takes no room from the others
    held = F.sum("_n").over(Window.partitionBy("_label").orderBy(F.xxhash64("_key"), "_key"))
    rows = found.where(F.col("_n") <= ROW_BYTES).withColumn("_held", held).where(F.col("_held") <= SAMPLE_BYTES).select("_text", "_label", "_key").collect()
    rows.sort(key=lambda r: (r[2], r[0] or ""))
    return train([(r[0] or "").encode() for r in rows], np.array([r[1] for r in rows], np.int64))


def score(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """Every document with its fold, score and prediction."""
    spark = docs.sparkSession
    common.ship(spark)
    shared = spark.sparkContext.broadcast(fit(docs, labels, text, key, label, sample))

    def judge(column: pa.Array) -> pa.Array:
        common.working("toxicity")
        weights, bias = shared.value
        texts = common.blobs(column)
        return pa.array(np.concatenate([scores(texts[a:b], weights, bias) for a, b in common.groups(texts)] or [np.zeros(0)]))

    out = docs.select(F.col(key), (common.fold(F.col(key), FOLDS) == HELD).alias("held_out"), F.arrow_udf(judge, "double")(F.col(text)).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= LIMIT).cast("int"))
