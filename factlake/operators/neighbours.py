"""Ordered-neighbour rules: steps, first against last, folds, running means."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_previous(df: DataFrame, keys: list[str], order: list[str], columns: dict[str, str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumns({new: F.lag(old).over(w) for old, new in columns.items()})


def jumps(df: DataFrame, keys: list[str], order: list[str], area: str, ratio: float, strong: float) -> DataFrame:
    """Steps where an area grows ``ratio`` times or more; medium from ``strong``."""
    d = with_previous(df, keys, order, {area: "previous"}).where((F.col("previous") > 0) & (F.col(area) >= ratio * F.col("previous")))
    return d.withColumn("confidence", F.when(F.col(area) >= strong * F.col("previous"), "medium").otherwise("low"))


def first_last(df: DataFrame, keys: list[str], order: str, columns: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"), *[f(c, order).alias(f"{name}_{c}") for c in columns for f, name in ((F.min_by, "first"), (F.max_by, "last"))])


def gaps(df: DataFrame, keys: list[str], position: str, limit: int) -> DataFrame:
    """Extent, greatest gap and gaps over ``limit``; score 1.5 max + 8 breaks, up to 100."""
    d = with_previous(df, keys, [position], {position: "_before"}).withColumn("_gap", F.col(position) - F.col("_before"))
    g = d.groupBy(*keys).agg(F.count("*").alias("n"), F.min(position).alias("first"), F.max(position).alias("last"), F.coalesce(F.max("_gap"), F.lit(0)).alias("max_gap"), F.count_if(F.col("_gap") > limit).alias("breaks"))
    score = F.least(F.lit(100), F.floor(1.5 * F.col("max_gap") + 8 * F.col("breaks")))
    return g.withColumn("score", score.cast("bigint")).withColumn("fragmented", F.col("score") >= 30)


def running_mean_flag(df: DataFrame, keys: list[str], order: list[str], value: str, low: float, high: float) -> DataFrame:
    """Mean and its class, and a flag that sticks once any prefix's mean was low."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    d = df.withColumn("_s", F.sum(value).over(w)).withColumn("_n", F.count(value).over(w))
    g = d.groupBy(*keys).agg(F.sum(value).alias("_t"), F.count(value).alias("n"), F.bool_or(F.col("_s") < low * F.col("_n")).alias("ever_low"))
    return g.withColumn("confidence", F.when(F.col("_t") >= high * F.col("n"), "high").when(F.col("_t") >= low * F.col("n"), "medium").otherwise("low")).drop("_t")


def _ordered(value: str, order: list[str]) -> Column:
    return F.transform(F.array_sort(F.collect_list(F.struct(*order, F.col(value).alias("_v")))), lambda x: x["_v"])


def jump_filter(df: DataFrame, keys: list[str], order: list[str], value: str, limit: float) -> DataFrame:
    """Keep a value when it is within ``limit`` of the last kept; a fold, not a lag."""
    kind = dict(df.dtypes)[value]
    start = F.expr(f"CAST(array() AS array<{kind}>)")
    fold = lambda acc, x: F.when((F.size(acc) == 0) | (F.abs(x - F.element_at(acc, -1)) <= limit), F.concat(acc, F.array(x))).otherwise(acc)
    return df.groupBy(*keys).agg(_ordered(value, order).alias("all")).select(*keys, F.size("all").cast("bigint").alias("n"), F.aggregate("all", start, fold).alias("kept"))


def clusters(df: DataFrame, keys: list[str], value: str, tolerance: int) -> DataFrame:
    """One-dimensional clusters of whole numbers: a value starts a new one when
    it is over ``tolerance`` from the mean of the last."""
    # equal values are in one cluster, and one over the tolerance from the value before is
    # as far from any mean of those before: each such stretch is folded by itself
    v = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("bigint").alias("_v")).agg(F.count("*").alias("_n"))
    at = Window.partitionBy(*keys).orderBy("_v")
    v = v.withColumn("_new", F.coalesce(F.col("_v") - F.lag("_v").over(at) > tolerance, F.lit(False)).cast("int"))
    v = v.withColumn("_stretch", F.sum("_new").over(at.rowsBetween(Window.unboundedPreceding, 0)))
    start = F.expr("CAST(array() AS array<struct<s:bigint,n:bigint>>)")

    def fold(acc: Column, x: Column) -> Column:
        last, one = F.element_at(acc, -1), F.struct((x["_v"] * x["_n"]).alias("s"), x["_n"].alias("n"))
        grown = F.struct((last["s"] + one["s"]).alias("s"), (last["n"] + one["n"]).alias("n"))
        near = F.abs(last["s"] - x["_v"] * last["n"]) <= tolerance * last["n"]
        return F.when(F.size(acc) == 0, F.array(one)).when(near, F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(grown))).otherwise(F.concat(acc, F.array(one)))

    g = v.groupBy(*keys, "_stretch").agg(F.array_sort(F.collect_list(F.struct("_v", "_n"))).alias("_l")).select(*keys, "_stretch", F.posexplode(F.aggregate("_l", start, fold)).alias("_i", "_x"))
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("_stretch", "_i")) - 1
    return g.select(*keys, number.cast("bigint").alias("cluster"), F.col("_x.s").alias("total"), F.col("_x.n").alias("n"))
