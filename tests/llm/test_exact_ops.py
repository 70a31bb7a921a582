"""Exact dedup, Merkle manifest and source divergence against plain Python."""

import random
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from factlake.llm import divergence, exactdup, merkle
from factlake.llm.queries import QUERIES
from factlake.llm.sql import ORACLE_SQL

from ..conftest import DATA

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, part int, digest binary, tree string, key string"
TEXTS = [None, "", " ", "a  b", "a b", "a\tb\n", "A b", "a b " * 20000, "é" * 40000, "Straße Über straße", "xY9zÀ_b", "an incomprehensibilities incomprehensibilities", "twelvebytesx twelvebytesy"]
ODD = [(i, t, l, s, None, None, None, None, None, None) for i, t, l, s in [(k, t, "en", "s") for k, t in enumerate(TEXTS)] + [(None, "a b", None, None), (None, "a b", None, None), (3, "a  b", "en", "s"), (3, "a  b", "en", "s"), (50, "none", "zz", ""), (2**60 + 1, "a b", "en", None)]]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]


@pytest.mark.parametrize("name", ["op11_exact_dedup", "op12_merkle_manifest", "op13_source_divergence"])
def test_query_equals_sql(spark, name):
    c = duckdb.connect()
    c.sql(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    got, want = QUERIES[name](spark, DATA), c.sql(ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(repr, map(tuple, got.select(*want.columns).collect()))) == sorted(map(repr, want.fetchall()))


# -- exact duplicates


def smallest(ids):
    return min((i for i in ids if i is not None), default=None)


def plain_copies(rows):
    groups = defaultdict(list)
    for i, text, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(i)
    return sorted(repr((i, smallest(ids), len(ids), sha256(t.encode()).hexdigest())) for t, ids in groups.items() for i in ids)


def copies(found):
    rows = found.collect()
    # one row of each group stays, and it has the group's key
    assert all(n == 1 for n in Counter(r["text_sha256"] for r in rows if r["kept"]).values()) and all(r["doc_id"] == r["keep_id"] for r in rows if r["kept"])
    assert len({r["text_sha256"] for r in rows if r["kept"]}) == len({r["text_sha256"] for r in rows})
    return sorted(repr((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"])) for r in rows)


def test_copies(spark, odd, documents):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert copies(exactdup.exact_duplicates(docs)) == plain_copies(documents)
    assert copies(exactdup.exact_duplicates(odd)) == plain_copies(ODD)
    assert exactdup.exact_duplicates(odd.limit(0)).count() == 0


def test_copies_beyond_the_counters(spark):
    """With few counters only the frequent texts are winners, and nothing changes."""
    rng = random.Random(5)
    texts = ["hot"] * 3000 + ["warm"] * 900 + [f"t{rng.randrange(4000)}" for _ in range(6000)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert copies(exactdup.exact_duplicates(docs, counters=40, heavy=0.05)) == plain_copies(rows)
    won = exactdup.winners(exactdup.digests(docs, "text", "doc_id", "file:///tmp/checkpoints/test-winners"), "file:///tmp/checkpoints/test-winners", 40, 0.05)
    assert sorted(r["size"] for r in won.collect()) == [900, 3000]


def test_summaries_keep_what_is_frequent():
    import pyarrow as pa

    rng, k = random.Random(2), 20
    stream = [rng.choice("abc") if rng.random() < 0.4 else f"x{rng.randrange(3000)}" for _ in range(6000)]
    held = pa.table({"digest": pa.array([], pa.binary()), "n": pa.array([], pa.int64())})
    for i in range(0, len(stream), 500):
        met = Counter(stream[i : i + 500])
        held = exactdup.summary(pa.concat_tables([held, pa.table({"digest": pa.array([x.encode() for x in met], pa.binary()), "n": pa.array(list(met.values()), pa.int64())})]), k)
    shown, true = dict(zip(held["digest"].to_pylist(), held["n"].to_pylist(), strict=True)), Counter(stream)
    assert len(shown) <= k
    assert all(true[d.decode()] - len(stream) / (k + 1) <= n <= true[d.decode()] for d, n in shown.items())
    assert all(x.encode() in shown for x, n in true.items() if n > len(stream) / (k + 1))


def test_deduplicated_keeps_columns(spark, odd, documents):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = exactdup.deduplicated(docs)
    assert got.columns == docs.columns
    want = {smallest(ids) for ids in (lambda g: g.values())(by_text(documents))}
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(want)
    kept = exactdup.deduplicated(odd)
    assert kept.columns == odd.columns and kept.count() == len(by_text(ODD))
    assert exactdup.deduplicated(odd, counters=2, heavy=0.4).count() == len(by_text(ODD))


def by_text(rows):
    groups = defaultdict(list)
    for i, text, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(i)
    return groups


# -- manifest


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_leaf(values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_tree(nodes):
    """The root and each node's runs on the way: (left, right) by level."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for way, i in zip(ways, at, strict=True):
            run = nodes[i // 16 * 16 : i // 16 * 16 + 16]
            way.append(("".join(run[: i % 16]), "".join(run[i % 16 + 1 :])))
        nodes, at = [h(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)], [i // 16 for i in at]
    return nodes[0], ways


def plain_manifest(rows, lower=True):
    first = lambda x: (x is not None, x if x is not None else 0)
    sources = defaultdict(list)
    for i, text, lang, source, n in rows:
        leaf = plain_leaf((i, source, lang, n, text))
        bad = lower and i is not None and zlib.crc32(str(i).encode()) % 5 == 0
        changed = re.sub("[A-Z]", lambda m: m.group().lower(), text) if text is not None else None
        sources[source].append((first(i), leaf, i, plain_leaf((i, source, lang, n, changed)) if bad else leaf))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([x[1] for x in sorted(sources[s])]) for s in names}
    root, tops = plain_tree([trees[s][0] for s in names])
    out = []
    for s, top in zip(names, tops, strict=True):
        for (_, leaf, i, seen), way in zip(sorted(sources[s]), trees[s][1], strict=True):
            node = seen
            for left, right in way + top:
                node = h(left, node, right)
            out.append((i, leaf, trees[s][0], root, h(*[x for pair in way + top for x in pair]), node, node == root))
    return sorted(map(repr, out))


COLUMNS = "doc_id leaf subroot root proof_sha256 folded_root verified".split()


def manifest_of(docs, **more):
    got = merkle.manifest(docs, seen={"text": merkle.lowered(F.col("text"))}, changed=merkle.tampered(F.col("doc_id")), **more)
    return sorted(repr(tuple(r)) for r in got.select(*COLUMNS).collect())


def test_manifest(spark, odd, documents):
    assert sorted(repr(tuple(r)) for r in QUERIES["op12_merkle_manifest"](spark, DATA).select(*COLUMNS).collect()) == plain_manifest(documents)
    assert manifest_of(odd) == plain_manifest([r[:5] for r in ODD])
    assert manifest_of(odd.limit(0)) == []
    assert manifest_of(odd.where("doc_id = 50")) == plain_manifest([r[:5] for r in ODD if r[0] == 50])


def test_manifest_of_many_rounds(spark):
    """Sources of 1 to 66,000 rows (three rounds of superblocks), and 300 sources
    (two rounds above them)."""
    sizes = {"huge": 66_000, "one": 1, "full": 256, "over": 257, "run": 16, "runs": 17, None: 4097} | {f"s{i}": 1 + i % 3 for i in range(300)}
    rows, i = [], 0
    for s, n in sizes.items():
        for _ in range(n):
            i += 1
            rows.append((i * 7919 % 1_000_003, f"Text {i}", "en", s, 6))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(9)
    assert manifest_of(docs) == plain_manifest(rows)


def test_proofs_fold_to_the_root(odd):
    for r in merkle.manifest(odd, proofs=True).collect():
        assert merkle.folded(r["leaf"], r["before"], r["after"]) == r["root"] == r["folded_root"] and r["verified"]
        assert h(*[x for pair in zip(r["before"], r["after"], strict=True) for x in pair]) == r["proof_sha256"]


# -- divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain_audit(rows, least=3, ranks=200):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        found = TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        counts[lang, source].update(found)
        docs[lang].update(set(found))
    out = []
    for lang, sources in groups.items():
        kept = sorted((t for t, n in docs[lang].items() if n >= least), key=lambda t: t.encode())
        whole = sum((counts[lang, s] for s in sources), Counter())

        def shares(c, kept=kept):
            total = sum(c[t] for t in kept) + len(kept)
            return [1 + 10**9 * (c[t] + 1) // total for t in kept]

        p, q = {s: shares(counts[lang, s]) for s in sources}, shares(whole)
        for s in sources:
            pairs = [(sum((a - b) ** 2 // b for a, b in zip(p[s], p[o], strict=True)), o) for o in sources if o != s]
            terms = [((a - b) ** 2 // b, t) for a, b, t in zip(p[s], q, kept, strict=True) if counts[lang, s][t] and a > b]
            for part, items in (("pair", pairs), ("term", terms)):
                items = sorted(items, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(items, 1) if part == "pair" or i <= ranks]
    return sorted(map(repr, out))


def audited(docs, **more):
    return sorted(repr(tuple(r)) for r in divergence.audit(docs, **more).select("lang", "source", "part", "item", "value", "rank").collect())


def test_divergence(spark, odd, documents):
    assert audited(spark.read.parquet(f"{DATA}/documents.parquet")) == plain_audit(documents)
    assert audited(odd) == plain_audit(ODD)
    assert audited(odd, least=1) == plain_audit(ODD, least=1)
    assert audited(odd.limit(0)) == []


def test_divergence_in_many_buckets_and_flushes(spark, documents, monkeypatch):
    monkeypatch.setattr(divergence, "BUCKETS", 50)
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert audited(docs, ranks=5, least=2) == plain_audit(documents, ranks=5, least=2)
    # a task that hands its runs on again and again
    import pyarrow as pa

    monkeypatch.setattr(divergence, "HELD", 50)
    batch = pa.RecordBatch.from_arrays([pa.array([r[i] for r in documents], pa.string()) for i in (1, 2, 3)], ["text", "lang", "source"])
    got = Counter()
    for part in divergence._runs(iter([batch.slice(i, 7) for i in range(0, len(documents), 7)])):
        for r in part.to_pylist():
            got[r["lang"], r["source"], r["term"]] += r["n"]
    want = Counter()
    for _, text, lang, source, _ in documents:
        want.update((lang or "", source or "", t) for t in TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or "")))
    assert got == want


def test_shares_and_order():
    rng = random.Random(4)
    count = np.array([rng.randrange(10**13) for _ in range(2000)])
    total = np.array([c + 1 + rng.randrange(10**14) for c in count.tolist()])
    assert divergence.share(count, total).tolist() == [1 + 10**9 * (c + 1) // t for c, t in zip(count.tolist(), total.tolist(), strict=True)]
    keys = np.random.default_rng(1).integers(0, 2**64, 5000, np.uint64) >> np.random.default_rng(2).integers(0, 60, 5000).astype(np.uint64)
    group = np.random.default_rng(3).integers(0, 70_000, 5000).astype(np.uint32) % 5
    assert divergence.radix(group, keys).tolist() == np.lexsort((keys, group)).tolist()
