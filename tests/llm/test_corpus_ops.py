"""Operators over the whole corpus, against brute force on small tables."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from factlake.llm import huffman, idsets, neardup, packing, quality, secrets
from factlake.llm.queries import QUERIES, tokenizer

from ..conftest import DATA

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [(1, None), (1, None), (None, "x y"), (2, ""), (3, "a b"), (4, "A B"), (5, "word " * 6000), (6, "word " * 6000), (7, "\n")]


@pytest.fixture(scope="module")
def documents(spark):
    return [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "x", 1, None) for i, t in ODD], "doc_id long, text string, salt string, piece int, rank string")


def ids_of(name, texts):
    t = Tokenizer.from_file(tokenizer(name))
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def least_bins(items, capacity):
    best, items = [len(items)], sorted(items, reverse=True)

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for room in set(b for b in bins if b + items[i] <= capacity):
            j = bins.index(room)
            bins[j] += items[i]
            go(i + 1, bins)
            bins[j] -= items[i]
        bins.append(items[i])
        go(i + 1, bins)
        bins.pop()

    go(0, [])
    return best[0]


def test_reduction_keeps_the_optimum():
    rng = random.Random(1)
    for _ in range(300):
        c = rng.choice([10, 20, 30])
        items = [rng.randint(rng.choice([1, 2, 4]), c) for _ in range(rng.randint(1, 8))]
        sizes = packing.Sizes(Counter(items))
        fixed = packing.reduce_instance(sizes, c)
        rest = [s for s, n in sizes.n.items() for _ in range(n)]
        assert sum(m for m, _ in fixed) + least_bins(rest, c) == least_bins(items, c)
        whole = packing.solve(Counter(items), c)
        held = Counter()
        for many, content in whole:
            assert sum(s * n for s, n in content) <= c
            for s, n in content:
                held[s] += many * n
        assert held == Counter(items)


def packed(rows, texts, capacity=2048):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for i, ids in texts.items():
        parts, at = sorted(by_doc[i], key=lambda r: r["piece"]), 0
        for k, r in enumerate(parts):
            piece = np.array(ids[at : at + r["length"]], np.uint32)
            assert (r["piece"], r["start"], r["ids_crc32"]) == (k, at, zlib.crc32(piece.tobytes()))
            assert r["length"] == capacity or k == 0
            at += r["length"]
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return len(by_sequence)


def test_packing(spark, documents):
    rows = QUERIES["op3_best_fit_packing"](spark, DATA).collect()
    texts = {i: x + [0] for (i, _), x in zip(documents, ids_of("byte_bpe_50k.json", [t for _, t in documents]), strict=True)}
    assert packed(rows, texts) <= -(-sum(map(len, texts.values())) // 2048) + 1


def test_packing_odd_rows(odd):
    rows = packing.pack(odd, tokenizer("byte_bpe_50k.json")).collect()
    assert sum(r["doc_id"] == 1 for r in rows) == 2 and any(r["doc_id"] is None for r in rows)
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows)
    # every row's ids are placed, also of rows that repeat an id
    want = Counter((i, zlib.crc32(np.array([*ids, 0][: (len(ids) % 2048) + 1], np.uint32).tobytes())) for (i, _), ids in zip(ODD, ids_of("byte_bpe_50k.json", [t or "" for _, t in ODD]), strict=True))
    assert Counter((r["doc_id"], r["ids_crc32"]) for r in rows if r["piece"] == 0) == want
    assert sum(r["length"] for r in rows) == sum(len(x) + 1 for x in ids_of("byte_bpe_50k.json", [t or "" for _, t in ODD]))
    assert packing.pack(odd.limit(0), tokenizer("byte_bpe_50k.json")).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 50, 40_000, 70_000])
def test_huffman_round_trip(n):
    rng = np.random.default_rng(n)
    counts = np.append((1e6 / (1 + np.arange(n)) ** 1.3).astype(np.int64) + 1, [0, 0])
    lengths = huffman.code_lengths(counts)
    assert lengths.max() <= max(huffman.LIMIT, (n - 1).bit_length()) and (lengths[:n] > 0).all() and (lengths[n:] == 0).all()
    book, (ids, steps) = huffman.codes(lengths), huffman.table(lengths)
    docs = [rng.integers(0, n, k).astype(np.uint32) for k in (0, 1, 255, 256, 257, 3000, 0)]
    code, _, starts = huffman.encode(docs, lengths, book)
    assert (huffman.decode(code, starts, huffman.block_sizes(np.array([len(d) for d in docs])), ids, steps) == np.concatenate(docs)).all()


def test_huffman_is_optimal_without_the_limit():
    import heapq

    counts = np.random.default_rng(2).integers(1, 5000, 200)
    heap, cost = counts.tolist(), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    assert int((counts * huffman.code_lengths(counts)).sum()) == cost


def test_token_files(spark, documents):
    got = {r["doc_id"]: r for r in QUERIES["op7_token_files"](spark, DATA).collect()}
    at = 0
    for i, t in sorted(documents):
        ids = np.array([*ids_of("word_bpe_49k.json", [t])[0], 2], np.uint32)
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_token_files_odd_rows(odd):
    rows = huffman.round_trip(odd, tokenizer("word_bpe_49k.json")).collect()
    assert len(rows) == len(ODD)
    ends = sorted((r["start"], r["start"] + r["n_tokens"]) for r in rows)
    assert all(a[1] == b[0] for a, b in zip(ends, ends[1:], strict=False)) and min(rows, key=lambda r: r["start"])["doc_id"] is None
    assert huffman.round_trip(odd.limit(0), tokenizer("word_bpe_49k.json")).count() == 0
    with pytest.raises(ValueError, match="whole number"):
        huffman.round_trip(odd, tokenizer("word_bpe_49k.json"), key="salt")


def brute_components(texts, words, percent):
    sets = {}
    for i, t in texts:
        w = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = frozenset(tuple(w[k : k + words]) for k in range(len(w) - words + 1)) if len(w) >= words else frozenset([tuple(w)] if w else [])
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    lists = defaultdict(list)
    for i in sorted(sets):
        shared = Counter(j for s in sets[i] for j in lists[s])
        for s in sets[i]:
            lists[s].append(i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def near_family(rng, base, n, swaps):
    out = []
    for _ in range(n):
        w = base.split()
        for _ in range(rng.randint(0, swaps)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates_equal_brute_force(spark, documents, words):
    rng = random.Random(words)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [t for _, t in documents]
    for size, swaps in ((60, 12), (25, 30), (12, 40)):
        texts += near_family(rng, " ".join(rng.choice(vocabulary) for _ in range(300)), size, swaps)
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    texts += [" ".join(rng.choice(vocabulary) for _ in range(150)) + " " + passage for _ in range(40)] + ["a b c d", "a b c d e", "a b c d e f", "only", "Only"]
    rows = list(enumerate(texts))
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=words)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got.collect()} == brute_components(rows, words, 80)


def test_near_duplicates_of_a_star(spark):
    rng = random.Random(8)
    base = [f"w{rng.randrange(400)}" for _ in range(300)]
    rows = [(0, " ".join(base))]
    for i in range(1, 1001):
        w = list(base)
        for at in rng.sample(range(0, 300, 5), 6):
            w[at + 2] = f"new{i}x{at}"
        rows.append((i, " ".join(w)))
    rows = [((i * 7919) % 10007, t) for i, t in rows]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got.collect()} == brute_components(rows, 5, 80)


def test_near_duplicates_of_a_family_of_families(spark):
    """Documents of one block are similar, those of different blocks nearly so."""
    rng, rows = random.Random(3), []
    base = [f"w{i}" for i in range(300)]
    for block in range(14):
        for _ in range(60):
            w = list(base)
            w[20 * block : 20 * block + 20] = [f"u{len(rows)}x{k}" for k in range(20)]
            rows.append((rng.randrange(1 << 40), " ".join(w)))
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=2)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got.collect()}
    assert found == brute_components(rows, 2, 80) and len({c for _, c, _ in found.values()}) == 14


def with_header(rng, n, own=80, shared=40):
    """Texts of own words around words that all share; no two are near-duplicates."""
    header = " ".join(f"h{i}" for i in range(shared))
    return [" ".join(f"u{rng.randrange(10**9)}" for _ in range(own // 2)) + f" {header} " + " ".join(f"u{rng.randrange(10**9)}" for _ in range(own // 2)) for _ in range(n)]


def test_rows_dealt_grow_with_documents_that_share_a_header(spark, monkeypatch):
    dealt, met = [], neardup.Search.met

    def counted(self, rows, levels=None):
        dealt[-1] += rows.count()
        return met(self, rows, levels)

    monkeypatch.setattr(neardup.Search, "met", counted)
    for n in (3000, 6000):
        dealt.append(0)
        rows = list(enumerate(with_header(random.Random(n), n)))
        got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(8), words=2)
        assert got.where("kept").count() == n
    assert dealt[1] <= 2.3 * max(dealt[0], 3000), dealt


def test_long_lists_are_met_by_rarest_values(spark, monkeypatch):
    """Lists count as long from 17 members on: links among texts with one header
    are those of brute force."""
    monkeypatch.setattr(neardup, "BLOCK", 16)
    rng = random.Random(11)
    texts = with_header(rng, 150)
    texts += [t for base in texts[:20] for t in near_family(rng, base, 6, 9)]
    texts += with_header(rng, 60, 40, 80) + [t for base in with_header(rng, 4, 30, 30) for t in near_family(rng, base, 10, 5)]
    texts += [" ".join(f"h{i}" for i in range(k, k + m)) for k in range(0, 20, 2) for m in (6, 20, 33)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    for words in (2, 5):
        got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=words)
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got.collect()} == brute_components(rows, words, 80)


def test_linked_sets_share_a_list_of_rarest_values():
    rng = np.random.default_rng(9)
    levels = rng.integers(0, 9, neardup.COUNTERS).astype(np.uint8)
    for n in (4, 5, 17, 50, 51, 52, 64, 65, 80, 300):
        base = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        sets = [base] + [np.unique(np.concatenate((rng.permutation(base)[: -k or None], rng.integers(0, 2**63, k + extra).astype(np.uint64)))) for k in (0, n // 10, n // 5) for extra in (0, n // 9, n // 4) for _ in range(4)]
        rows, sizes = neardup.padded([s[: neardup.SKETCH].tobytes() for s in sets]), np.array([len(s) for s in sets])
        lists = neardup.rare_lists(rows, sizes, levels, 80)
        near = 0
        for i, j in ((i, j) for i in range(len(sets)) for j in range(i)):
            shared = len(np.intersect1d(sets[i], sets[j]))
            linked = 100 * shared >= 80 * (sizes[i] + sizes[j] - shared)
            if linked and neardup.union_estimate(sets[i][: neardup.SKETCH], sets[j][: neardup.SKETCH]) >= neardup.ESTIMATE:
                near += 1
                assert len(set(lists[i].tolist()) & set(lists[j].tolist()) - {neardup.NO_LIST})
        assert near


def test_in_block_verification_equals_sets():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 400, rng.integers(4, 300)).astype(np.uint64)) for _ in range(40)] + [np.arange(5000, dtype=np.uint64), np.arange(2500, 7500, dtype=np.uint64)]
    left, right = np.arange(0, 20), np.arange(20, 42)
    assert neardup.overlaps(sets, left, right).tolist() == [[len(np.intersect1d(sets[a], sets[b])) for b in right] for a in left]
    packed = neardup.padded([s[: neardup.SKETCH].tobytes() for s in sets])
    a, b = map(np.ravel, np.meshgrid(np.arange(42), np.arange(42)))
    want = [neardup.union_estimate(sets[i][: neardup.SKETCH], sets[j][: neardup.SKETCH]) for i, j in zip(a, b, strict=True)]
    assert neardup.estimates(packed[a], packed[b]).tolist() == want
    bits, n = neardup.bitmaps(packed), np.array([len(s) for s in sets])
    assert neardup.may_link(n, bits, a, b, 0)[np.array(want) >= neardup.ESTIMATE].all()


def test_rows_of_one_id_are_judged_by_their_texts(spark):
    text = [" ".join(f"{c}{i}" for i in range(40)) for c in "abc"]
    rows = [(1, text[0]), (2, text[0]), (2, text[1]), (3, text[1] + " more"), (4, text[2]), (4, text[2]), (None, text[2]), (None, "alone on its own here in a row")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["text"]) for r in neardup.first_of_each(df).collect()}
    assert got == {(1, text[0]), (2, text[1]), (4, text[2]), (None, text[2]), (None, rows[-1][1])}
    assert neardup.first_of_each(df).count() == 5 and neardup.first_of_each(df.limit(0)).count() == 0


def test_near_duplicates_odd_rows(odd):
    got = {r["doc_id"]: (r["component_id"], r["kept"]) for r in neardup.near_duplicates(odd, words=2).collect()}
    assert got == {1: (1, True), None: (None, True), 2: (2, True), 3: (3, True), 4: (3, False), 5: (5, True), 6: (5, False), 7: (7, True)}
    assert neardup.near_duplicates(odd.limit(0)).count() == 0
    assert sorted((r["doc_id"] or 0) for r in neardup.first_of_each(odd, words=2).collect()) == [0, 1, 2, 3, 5, 7]


def test_components_of_paths_and_stars(spark, tmp_path):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(150, 129)]
    got = {r["node"]: r["label"] for r in idsets.components(spark.createDataFrame(edges, "a long, b long"), str(tmp_path)).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 150: 100}


def test_pipeline_stages(spark, documents):
    docs, kept = spark.read.parquet(f"{DATA}/documents.parquet"), dict(documents)
    by = dict(corpus_pipeline.STAGES)
    one = by["quality_rules"](spark, docs, DATA)
    good = {r["doc_id"] for r in quality.quality_rules(docs).where("kept").collect()}
    assert one.columns == docs.columns and {r["doc_id"] for r in one.collect()} == good
    two = by["near_dedup"](spark, one, DATA)
    want = {i for i, (_, _, k) in brute_components([(i, kept[i]) for i in good], 5, 80).items() if k}
    assert two.columns == docs.columns and {r["doc_id"] for r in two.collect()} == want
    three = by["benchmark_decontamination"](spark, two, DATA)
    items = [r["text"] for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    assert {r["doc_id"] for r in three.collect()} == {i for i in want if not any(x in kept[i] for x in items)}
    four = by["secret_scan"](spark, three, DATA)
    assert four.columns == docs.columns and four.count() == three.count()
    assert secrets.secret_scan(four).where("n_assign + n_access + n_hex > 0").count() == 0
    assert all(r["n_chars"] == len(r["text"]) for r in four.collect())
    rows = by["best_fit_packing"](spark, four, DATA).collect()
    texts = {r["doc_id"]: x + [0] for r, x in zip(four.collect(), ids_of("byte_bpe_50k.json", [r["text"] for r in four.collect()]), strict=True)}
    assert packed(rows, texts) <= -(-sum(map(len, texts.values())) // 2048) + 1


def test_near_duplicates_shuffle_half_hashes_and_no_orders(spark, documents):
    """A sketch has four bytes a value, and the members of lists are dealt out by
    key and id alone, once by part and once by list."""
    search = neardup.Search(spark.createDataFrame(documents, "doc_id long, text string"), "text", "doc_id", 2, 80)
    assert {len(r["sketch"]) - 4 * min(r["n"], neardup.SKETCH) for r in search.sets.collect()} == {0}
    plan = search.candidates()._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(dealt) == len([line for line in dealt if "REPARTITION_BY_COL" in line]) + 1 and "rank" not in "".join(dealt)
