"""A Merkle manifest of a dataset: a tree a source, and one over the sources.

A row's leaf is the digest of its fields; FAN consecutive nodes become one. All
digests are SHA-256 in lower-case hex, of the inputs' concatenation.

Rows are numbered within their source by one range sort and the counts of its
parts, so no source is in one task however many rows it has. A superblock is
FAN ** LEVELS consecutive nodes of a tree:

1. upwards, superblocks are reduced to their top node, again and again until each
   tree has one; the sources' roots make a last tree in the same way.
2. downwards, the nodes of each round are cogrouped with what their superblock
   needs from outside: the siblings on the way from its top to the root.
3. with the leaves at the end: local reduction, joining the proof's local and
   outer parts and folding happen together, superblock by superblock.

A superblock and its outer nodes are what a task holds at a time. What crosses the
shuffle are digests, never texts; each round has FAN ** LEVELS times fewer rows.

Defined cases: a null field is `-`, so it differs from an empty one; null is a
source of its own and comes first, as a null key among its source's rows. Rows of
one key come by leaf; equal rows stand side by side. An empty table gives no rows.
Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

FAN, LEVELS = 16, 2
BLOCK = FAN**LEVELS
HEX = 64

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf(fields: Sequence[Column]) -> Column:
    """The 32 bytes of a row's leaf: each field as bytes' count, colon and value."""
    value = [f.cast("string") for f in fields]
    return F.unhex(F.sha2(F.concat(*[F.when(v.isNull(), "-").otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v)) for v in value]), 256))


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def reduced(nodes: list[str], whole: bool) -> list[list[str]]:
    """The levels above ``nodes``, these included: up to a single node if they are
    the whole tree, else LEVELS more, where even one node becomes another."""
    levels = [nodes]
    while len(levels[-1]) > 1 if whole else len(levels) <= LEVELS:
        below = levels[-1]
        levels.append([digest("".join(below[i : i + FAN])) for i in range(0, len(below), FAN)])
    return levels


class Siblings:
    """What stands left and right of a superblock's nodes on the way to its top."""

    def __init__(self, nodes: list[str], whole: bool):
        self.runs = [["".join(level[i : i + FAN]) for i in range(0, len(level), FAN)] for level in reduced(nodes, whole)[:-1]]

    def of(self, i: int) -> tuple[list[str], list[str]]:
        before, after = [], []
        for runs in self.runs:
            i, at = divmod(i, FAN)
            before.append(runs[i][: at * HEX])
            after.append(runs[i][(at + 1) * HEX :])
        return before, after


def folded(node: str, before: Sequence[str], after: Sequence[str]) -> str:
    for left, right in zip(before, after, strict=True):
        node = digest(left + node + right)
    return node


def _top(nodes: pd.DataFrame) -> pd.DataFrame:
    """A superblock's top node."""
    nodes = nodes.sort_values("at")
    n = int(nodes["n"].iloc[0])
    top = reduced([x.hex() for x in nodes["node"]], n <= BLOCK)[-1][0]
    return pd.DataFrame({"tree": nodes["tree"].iloc[:1], "at": nodes["at"].iloc[:1] // BLOCK, "n": [-(-n // BLOCK)], "node": [bytes.fromhex(top)]})


_OUTER = "tree long, at long, before array<string>, after array<string>, own string, root string, node string"


def _down(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """The way up of each node of a superblock, the outer part included."""
    nodes, out = nodes.sort_values("at"), outer.iloc[0]
    own = [x.hex() for x in nodes["node"]]
    near = Siblings(own, int(nodes["n"].iloc[0]) <= BLOCK)
    ways = [near.of(i) for i in range(len(own))]
    return pd.DataFrame({"tree": nodes["tree"], "at": nodes["at"], "before": [[*b, *out["before"]] for b, _ in ways], "after": [[*a, *out["after"]] for _, a in ways], "own": out["own"], "root": out["root"], "node": own})


def _proved(leaves: pd.DataFrame, outer: pd.DataFrame, proofs: bool) -> pd.DataFrame:
    """A superblock of leaves: each one's proof, and the root from what was seen."""
    leaves, out = leaves.sort_values("at"), outer.iloc[0]
    own = [x.hex() for x in leaves["node"]]
    near = Siblings(own, int(leaves["n"].iloc[0]) <= BLOCK)
    rows, befores, afters = [], [], []
    for i, (node, seen) in enumerate(zip(own, leaves["seen"], strict=True)):
        before, after = near.of(i)
        before, after = [*before, *out["before"]], [*after, *out["after"]]
        proof = "".join([x for pair in zip(before, after, strict=True) for x in pair])
        rows.append((node, out["own"], out["root"], digest(proof), folded(node if seen is None else seen.hex(), before, after)))
        if proofs:
            befores.append(before)
            afters.append(after)
    found = pd.DataFrame(rows, columns=["leaf", "subroot", "root", "proof_sha256", "folded_root"])
    if proofs:
        found["before"], found["after"] = befores, afters
    found.insert(0, "key", leaves["key"].reset_index(drop=True))
    return found


def _by_block(nodes: DataFrame):
    return nodes.withColumn("block", F.shiftright("at", 4 * LEVELS)).groupBy("tree", "block")


def climb(leaves: DataFrame, most: int, folder: str) -> tuple[list[DataFrame], DataFrame]:
    """The rounds of (tree, at, n, node), from the leaves on, and (tree, node, round)
    of each tree's root with the last round that it has a superblock in. ``most``:
    the leaves of the largest tree."""
    rounds, roots = [], None
    while not rounds or most > 1:
        rounds.append(leaves)
        tops = common.written(_by_block(leaves).applyInPandas(_top, "tree long, at long, n long, node binary"), f"{folder}/up{len(rounds)}")
        done = tops.where("n = 1").select("tree", "node", F.lit(len(rounds) - 1).alias("round"))
        roots = done if roots is None else roots.union(done)
        leaves, most = tops.where("n > 1"), -(-most // BLOCK)
    return rounds, roots


def descend(rounds: list[DataFrame], outer: DataFrame, least: int, folder: str) -> DataFrame:
    """The outer nodes of the superblocks of round ``least``, from those of the trees'
    tops (``outer``, with the round that each tree ends in, its root as ``own``)."""
    found = outer.where(F.col("round") == len(rounds) - 1).drop("round")
    for i in range(len(rounds) - 1, least, -1):
        ways = _by_block(rounds[i]).cogroup(found.withColumn("block", F.col("at")).groupBy("tree", "block")).applyInPandas(_down, _OUTER)
        found = common.written(ways.select(found.columns).union(outer.where(F.col("round") == i - 1).drop("round")), f"{folder}/down{i}")
    return found


def numbered(rows: DataFrame, by: Sequence[Column], path: str) -> DataFrame:
    """``rows`` sorted and written, with the part of the sort that each is in and its
    place there."""
    rows = rows.orderBy(*by).withColumn("_id", F.monotonically_increasing_id())
    return common.written(rows.withColumns({"part": F.shiftright("_id", 33), "place": F.col("_id").bitwiseAND(2**33 - 1)}).drop("_id"), path)


def placed(rows: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Rows (source, key, node, seen) with ``tree`` (the source's number), ``at`` (the
    place among its ``n`` rows), and the sources (tree, n)."""
    rows = numbered(rows, [F.col("source").asc_nulls_first(), F.col("key").asc_nulls_first(), F.col("node"), F.col("seen")], f"{folder}/sorted")
    spans = common.written(rows.groupBy("source", "part").agg(F.count("*").alias("rows"), F.min("place").alias("first")), f"{folder}/spans")
    names = numbered(spans.select("source").distinct(), [F.col("source").asc_nulls_first()], f"{folder}/sources")
    # one row a part of the sort: as many as there are shuffle partitions
    parts = names.groupBy("part").agg(F.count("*").alias("names")).withColumn("before", F.sum("names").over(Window.orderBy("part")) - F.col("names"))
    trees = names.join(parts, "part").select(F.col("source").alias("name"), (F.col("before") + F.col("place")).alias("tree"))
    spans = spans.join(trees, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    tree = Window.partitionBy("tree")
    spans = spans.withColumns({"start": F.sum("rows").over(tree.orderBy("part")) - F.col("rows"), "n": F.sum("rows").over(tree)})
    spans = common.written(spans.select(F.col("source").alias("name"), F.col("part").alias("in_part"), "tree", "first", "start", "n"), f"{folder}/trees")
    held = rows.join(spans, (F.col("part") == F.col("in_part")) & F.col("source").eqNullSafe(F.col("name")))
    leaves = held.select("tree", (F.col("place") - F.col("first") + F.col("start")).alias("at"), "n", F.col("key").cast("string").alias("key"), "node", "seen")
    return common.written(leaves, f"{folder}/leaves"), spans.groupBy("tree").agg(F.max("n").alias("n"))


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, source: str = "source", key: str = "doc_id", seen: Mapping[str, Column] | None = None, changed: Column | None = None, proofs: bool = False) -> DataFrame:
    """For every row: key, leaf, subroot, root, proof_sha256, folded_root and verified.

    ``seen`` gives the fields as found when verifying, for rows where ``changed``
    holds; elsewhere the fields themselves. ``folded_root`` is the root recomputed
    from that leaf and the original siblings. With ``proofs`` the siblings' digests
    left and right of the way, level by level, stand in ``before`` and ``after``.
    """
    spark = docs.sparkSession
    common.ship(spark)
    folder = common.scratch(spark)
    found = F.lit(None).cast("binary")
    if seen is not None:
        found = leaf([seen.get(f, F.col(f)) for f in fields])
        found = found if changed is None else F.when(changed, found)
    rows = docs.select(F.col(source).cast("string").alias("source"), F.col(key).alias("key"), leaf([F.col(f) for f in fields]).alias("node"), found.alias("seen"))
    # written first: the sort reads its rows twice, and texts are hashed once
    leaves, trees = placed(common.written(rows, f"{folder}/digests"), folder)
    size = trees.agg(F.max("n").alias("most"), F.count("*").alias("trees")).first()
    rounds, roots = climb(leaves.select("tree", "at", "n", "node"), size["most"] or 0, f"{folder}/rows")
    subroots = roots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("at"), F.lit(size["trees"]).cast("long").alias("n"), "node")
    tops, root = climb(subroots, size["trees"], f"{folder}/sources")
    none, hexed = F.array().cast("array<string>"), F.lower(F.hex("node"))
    outer = root.select("tree", F.lit(0).cast("long").alias("at"), none.alias("before"), none.alias("after"), hexed.alias("own"), hexed.alias("root"), "round")
    ways = descend(tops, outer, 0, f"{folder}/sources")
    ways = _by_block(tops[0]).cogroup(ways.withColumn("block", F.col("at")).groupBy("tree", "block")).applyInPandas(_down, _OUTER)
    ways = common.written(ways.select(F.col("at").alias("tree"), F.lit(0).cast("long").alias("at"), "before", "after", F.col("node").alias("own"), "root").join(roots.select("tree", "round"), "tree"), f"{folder}/ways")
    ways = descend(rounds, ways, 0, f"{folder}/rows")
    kind = docs.select(key).schema[0].dataType
    schema = "key string, leaf string, subroot string, root string, proof_sha256 string, folded_root string" + ", before array<string>, after array<string>" * proofs
    out = _by_block(leaves).cogroup(ways.withColumn("block", F.col("at")).groupBy("tree", "block")).applyInPandas(lambda a, b: _proved(a, b, proofs), schema)
    return out.withColumns({"key": F.col("key").cast(kind), "verified": F.col("folded_root") == F.col("root")}).withColumnRenamed("key", key)


def lowered(text: Column) -> Column:
    """A-Z in lower case, nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tampered(key: Column, parts: int = 5) -> Column:
    """Rows whose key's crc32 ``parts`` divides; not those without a key."""
    return key.isNotNull() & (common.fold(key, parts) == 0)
