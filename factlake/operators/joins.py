"""Joins: windows around events, neighbours in time, pairs, evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def in_window(points: DataFrame, windows: DataFrame, keys: list[str], position: str, start: str, end: str, width: int) -> DataFrame:
    """Range join: points within [start, end]. Both sides are cut into cells of
    ``width``, so that the join has an equality and one hot key spreads out."""
    w = windows.withColumn("_cell", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width))))
    p = points.withColumn("_cell", F.floor(F.col(position) / width))
    return p.join(w, [*keys, "_cell"]).where(F.col(position).between(F.col(start), F.col(end))).drop("_cell")


def nearest(left: DataFrame, right: DataFrame, keys: list[str], at: str, other: str, tie: str, reach: int | None = None) -> DataFrame:
    """For each left row the right row nearest in position, the earlier, then the
    lesser ``tie``: the last at or before and the next one after, both by one sort of
    the union, so that no pairs are formed."""
    names = right.columns
    l = left.withColumn("_l", F.struct(*left.columns)).select(*keys, F.col(at).alias("_p"), F.lit(1).alias("_side"), "_l", F.lit(None).cast(right.select(F.struct(*names).alias("r")).schema["r"].dataType).alias("_r"), F.lit(None).cast("bigint").alias("_t"))  # noqa: E741
    one = right.groupBy(*keys, F.col(other).alias("_o")).agg(F.min_by(F.struct(*names), tie).alias("_r"))
    r = one.select(*keys, F.col("_o").alias("_p"), F.lit(0).alias("_side"), F.lit(None).cast(l.schema["_l"].dataType).alias("_l"), "_r", F.lit(0).cast("bigint").alias("_t"))
    both = l.unionByName(r)
    back = Window.partitionBy(*keys).orderBy("_p", "_side").rowsBetween(Window.unboundedPreceding, 0)
    ahead = F.expr(f"lead(_r, 1) IGNORE NULLS OVER (PARTITION BY {', '.join(f'`{k}`' for k in keys) or 'NULL'} ORDER BY _p, _side)")
    d = both.withColumns({"_b": F.last("_r", ignorenulls=True).over(back), "_a": ahead}).where("_side = 1")
    behind, before = F.col("_p") - F.col(f"_b.{other}"), F.col(f"_a.{other}") - F.col("_p")
    use_back = F.col("_a").isNull() | (F.col("_b").isNotNull() & (behind <= before))
    d = d.withColumn("_m", F.when(use_back, F.col("_b")).otherwise(F.col("_a"))).withColumn("distance", F.abs(F.col("_p") - F.col(f"_m.{other}")))
    if reach is not None:
        d = d.where(F.col("distance") <= reach)
    return d.select("_l.*", *[F.col(f"_m.{c}").alias(f"near_{c}") for c in names if c not in keys], "distance")


def pairs_at(df: DataFrame, keys: list[str], order: str, columns: list[str]) -> DataFrame:
    """Unordered pairs of rows that share ``keys``, the earlier as a, the later as b:
    one shuffle, and the pairs are formed inside a key's sorted array. Meant for keys
    such as one moment of one video, which few rows share; pairs are quadratic in these
    whatever the form."""
    row = F.struct(*[F.col(c) for c in [order, *columns]])
    d = df.groupBy(*keys).agg(F.array_sort(F.collect_list(row)).alias("_l")).where(F.size("_l") > 1)
    d = d.select(*keys, "_l", F.posexplode("_l").alias("_i", "_a")).select(*keys, "_a", F.explode(F.slice("_l", F.col("_i") + 2, F.size("_l"))).alias("_b"))
    d = d.where(F.col(f"_a.{order}") < F.col(f"_b.{order}"))
    return d.select(*keys, *[F.col(f"_{s}.{c}").alias(f"{c}_{s}") for s in "ab" for c in [order, *columns]])


def cited(evidence: DataFrame, known: DataFrame, on: list[str], there: bool = True) -> DataFrame:
    """Evidence whose ids are known (or are not)."""
    return evidence.join(known.select(*on).distinct(), on, "left_semi" if there else "left_anti")


def evaluate(results: DataFrame, labels: DataFrame, key: str, checks: dict[str, Column]) -> DataFrame:
    """Results with their label, one row each, and checks; unlabelled results stay."""
    return results.join(labels, key, "left").withColumns(checks)
