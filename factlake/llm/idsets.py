"""Large sets of ids: which rows of a wide table to shuffle, and components."""

from __future__ import annotations

import itertools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Bits of the filter that spares certain non-members a shuffle. A fixed size:
#: when a set outgrows it more rows are shuffled, and results stay the same.
FILTER_BITS = 26


def maybe_in(ids: DataFrame, key: str = "id") -> Callable[[DataFrame, Column], DataFrame]:
    """A function that adds to a table a column ``_may`` from hashes (xxhash64) of
    longs: true for all of ``ids`` and for few other values. The bitmap of
    2**FILTER_BITS bits is a table of its words that aren't 0, at most
    2**(FILTER_BITS - 6) rows, which is broadcast: no Python worker runs beside
    another operator's."""
    at = F.shiftrightunsigned(F.xxhash64(key), 64 - FILTER_BITS)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), at.bitwiseAND(63).cast("int"))
    words = ids.select(F.shiftright(at, 6).alias("_bm_word"), bit.alias("bit")).groupBy("_bm_word").agg(F.bit_or("bit").alias("_bm_bits"))
    words = common.written(words, f"{common.scratch(ids.sparkSession)}/bitmap")

    def probe(df: DataFrame, hashes: Column) -> DataFrame:
        place = F.shiftrightunsigned(hashes, 64 - FILTER_BITS)
        held = F.call_function("shiftrightunsigned", F.col("_bm_bits"), place.bitwiseAND(63).cast("int")).bitwiseAND(1) == 1
        marked = df.withColumn("_bm_word", F.shiftright(place, 6)).join(F.broadcast(words), "_bm_word", "left")
        return marked.withColumn("_may", F.coalesce(held, F.lit(False))).drop("_bm_word", "_bm_bits")

    return probe


def relabelled(nodes: DataFrame, moved: DataFrame, by: str) -> DataFrame:
    """``nodes`` (label, ...) with labels replaced as ``moved`` (node, label) says."""
    to = moved.select(F.col("node").alias("label"), F.col("label").alias("_to"))
    return common.spread_join(nodes, to, ["label"], by, "left").withColumn("label", F.coalesce("_to", "label")).drop("_to")


def components(edges: DataFrame, folder: str) -> DataFrame:
    """(node, label): the least node reachable along ``edges`` (a, b).

    Every round takes the least label among neighbours, then the label's label,
    so rounds grow with the logarithm of a component's diameter. Each round's
    table is written; only its number of changes comes to the driver.
    """
    both = common.written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{folder}/edges")
    labels = common.written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")).select("node", F.least("node", "label").alias("label")), f"{folder}/labels0")
    for i in itertools.count(1):
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = common.written(labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")), f"{folder}/step{i}")
        used = step.select(F.col("label").alias("node")).distinct()
        moved = step.select("node", "label").where("node <> label").join(used, "node", "left_semi")
        labels = common.written(relabelled(step, moved, "node"), f"{folder}/labels{i}")
        changed = labels.where("old <> label").count()
        labels = labels.select("node", "label")
        if not changed:
            return labels
