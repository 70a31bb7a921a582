"""Exact duplicates: frequent texts are settled map-side, the others by one shuffle.

Texts count as equal when they are identical after each run of white space
(space, tab, line feed, vertical tab, form feed, carriage return) became one
space. Every row's digest is written once; from then on texts are not touched.

1. Each task keeps a Misra-Gries summary of its digests (batches are counted, and
   beyond COUNTERS digests the next largest count is taken from all). Summaries
   are added up by digest, so a digest of count c in all rows N shows at least
   c - N / (COUNTERS + 1) and at most c.
2. Digests that may stand for HEAVY of the rows are at most
   1 / (HEAVY - 1 / (COUNTERS + 1)), whatever the size of the table: they are
   counted exactly, and those that pass are the broadcast winners.
3. Rows of winners learn the row that stays map-side. No digest left has HEAVY of
   the rows, and these go through one shuffle and a window.

Defined cases: a null text counts as empty; empty texts are equal. Of equal texts
the smallest key stays, null last; where that key is repeated one of its rows.
Every row comes back, repeated ones too. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: A summary's counters, and the share of all rows from which a digest is frequent.
COUNTERS, HEAVY = 8192, 1 / 2048

SPACE = r"[\x20\x09-\x0D]+"


def digest(text: Column) -> Column:
    """The 32 bytes of SHA-256 of the normalised text."""
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACE, " "), 256))


def summary(held: pa.Table, counters: int) -> pa.Table:
    """Counts (digest, n) added up, and at most ``counters`` of them: what the next
    largest has is taken from all."""
    held = held.group_by("digest").aggregate([("n", "sum")]).rename_columns(["digest", "n"])
    if len(held) <= counters:
        return held
    n = held["n"].to_numpy()
    n = n - np.partition(n, -counters - 1)[-counters - 1]
    return pa.table({"digest": held["digest"].filter(pa.array(n > 0)), "n": n[n > 0]})


def _frequent(batches: Iterator[pa.RecordBatch], counters: int) -> Iterator[pa.RecordBatch]:
    """The Misra-Gries summary of a task's digests."""
    common.working("exactdup")
    held = pa.table({"digest": pa.array([], pa.binary()), "n": pa.array([], pa.int64())})
    for batch in batches:
        met = pc.value_counts(batch.column(0))
        held = summary(pa.concat_tables([held, pa.table({"digest": met.field(0), "n": met.field(1)})]), counters)
    yield from held.combine_chunks().to_batches()


def _least() -> Column:
    """Of rows (key, row): the smallest key, null last, then the first row."""
    return F.struct(F.col("key").isNull().alias("null"), "key", "row")


def digests(docs: DataFrame, text: str, key: str, folder: str) -> DataFrame:
    """(key, digest, row) of every row, written; ``row`` tells repeated rows apart."""
    made = docs.select(F.col(key).alias("key"), digest(F.col(text)).alias("digest"))
    return common.written(made.withColumn("row", F.monotonically_increasing_id()), f"{folder}/digests")


def winners(rows: DataFrame, folder: str, counters: int = COUNTERS, heavy: float = HEAVY) -> DataFrame:
    """(digest, least, size) of the frequent digests, counted exactly; at most
    1 / (heavy - 1 / (counters + 1)) rows."""
    total = rows.count()
    shown = rows.select("digest").mapInArrow(lambda it: _frequent(it, counters), "digest binary, n long").groupBy("digest").agg(F.sum("n").alias("n"))
    likely = common.written(shown.where(F.col("n") >= total * (heavy - 1 / (counters + 1))).select("digest"), f"{folder}/likely")
    exact = rows.join(F.broadcast(likely), "digest", "left_semi").groupBy("digest").agg(F.min(_least()).alias("least"), F.count("*").alias("size"))
    return common.written(exact.where((F.col("size") >= total * heavy) & (F.col("size") > 1)), f"{folder}/winners")


def exact_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", counters: int = COUNTERS, heavy: float = HEAVY) -> DataFrame:
    """For every row its key, ``keep_id`` (the key of the row that stays),
    ``group_size``, ``kept`` and ``text_sha256`` of the normalised text."""
    spark = docs.sparkSession
    common.ship(spark)
    folder = common.scratch(spark)
    rows = digests(docs, text, key, folder)
    won = F.broadcast(winners(rows, folder, counters, heavy))
    settled = rows.join(won, "digest")
    group = Window.partitionBy("digest")
    rest = rows.join(won, "digest", "left_anti").withColumns({"least": F.min(_least()).over(group), "size": F.count("*").over(group)})
    return settled.unionByName(rest).select(
        F.col("key").alias(key), F.col("least.key").alias("keep_id"), F.col("size").alias("group_size"),
        (F.col("row") == F.col("least.row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
    )


def deduplicated(docs: DataFrame, text: str = "text", key: str = "doc_id", counters: int = COUNTERS, heavy: float = HEAVY) -> DataFrame:
    """The rows that stay, with their columns. Copies of frequent texts go before the
    shuffle; the others meet by digest, where one row each is taken."""
    spark = docs.sparkSession
    common.ship(spark)
    folder = common.scratch(spark)
    rows = digests(docs, text, key, folder)
    won = winners(rows, folder, counters, heavy)
    whole = docs.select(F.struct("*").alias("doc"), F.col(key).alias("key"), digest(F.col(text)).alias("digest"))
    whole = whole.join(F.broadcast(won.select("digest", F.col("least.key").alias("least"), F.lit(True).alias("won"))), "digest", "left")
    whole = whole.where(F.col("won").isNull() | F.col("key").eqNullSafe(F.col("least")))
    once = Window.partitionBy("digest").orderBy(F.col("key").isNull(), "key")
    return whole.withColumn("nth", F.row_number().over(once)).where("nth = 1").select("doc.*")
