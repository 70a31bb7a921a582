"""Votes and robust summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_seen_mode(df: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """The most frequent value, the first seen on ties, with a class by its share."""
    g = df.groupBy(*keys, value).agg(F.count("*").alias("votes"), F.min(order).alias("_first"))
    w = Window.partitionBy(*keys)
    d = g.withColumn("total", F.sum("votes").over(w)).withColumn("_r", F.row_number().over(w.orderBy(F.desc("votes"), "_first"))).where("_r = 1")
    return d.withColumn("confidence", F.when(F.col("votes") * 4 >= F.col("total") * 3, "high").when(F.col("votes") * 2 >= F.col("total"), "medium").otherwise("low")).drop("_r", "_first")


def margins(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Votes of each value less those of the runner-up; a lone value keeps its own."""
    g = df.groupBy(*keys, value).agg(F.count("*").alias("votes"))
    w = Window.partitionBy(*keys)
    d = g.withColumn("_second", F.nth_value("votes", 2).over(w.orderBy(F.desc("votes"), value).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return d.withColumn("margin", F.col("votes") - F.coalesce("_second", F.lit(0))).drop("_second")


def score_vote(df: DataFrame, keys: list[str], state: str, score: str, order: str) -> DataFrame:
    """The state of the greatest score sum, its margin over the next, and a class."""
    g = df.groupBy(*keys, state).agg(F.sum(score).alias("score"), F.count("*").alias("votes"), F.min(order).alias("_first"))
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), "_first")
    d = g.withColumn("_next", F.lead("score").over(w)).withColumn("_r", F.row_number().over(w)).where("_r = 1").withColumn("margin", F.col("score") - F.coalesce("_next", F.lit(0)))
    c = F.when((F.col("votes") >= 3) & (F.col("margin") >= 20), "high").when((F.col("votes") >= 2) & (F.col("margin") >= 8), "medium").otherwise("low")
    return d.withColumn("confidence", c).drop("_next", "_r", "_first")


#: Two lamps that may be lit at once, and the state that they make.
TOGETHER = ("적색", "좌회전녹색", "적색+좌회전")


def signal_vote(df: DataFrame, keys: list[str], state: str, score: str, order: str) -> DataFrame:
    """``score_vote`` of lamp states. Where red and the green left arrow both were seen
    they are one state, whatever else was: the sum of their scores, its margin over the
    greatest single score, medium from two votes on. With (state, score, votes) of all."""
    g = df.groupBy(*keys, state).agg(F.sum(score).alias("score"), F.count("*").alias("votes"), F.min(order).alias("_first"))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("_first").alias("o"), F.col(state).alias("state"), F.col("votes").alias("n"))))
    d = g.groupBy(*keys).agg(ranked.alias("_r"))
    seen = lambda name: F.get(F.filter("_r", lambda x: x["state"] == name), F.lit(0))
    one, two = seen(TOGETHER[0]), seen(TOGETHER[1])
    top, nxt = F.get("_r", F.lit(0)), F.get("_r", F.lit(1))
    both = one.isNotNull() & two.isNotNull()
    total = -(one["s"] + two["s"])
    votes = F.when(both, one["n"] + two["n"]).otherwise(top["n"])
    margin = F.when(both, total + top["s"]).otherwise(-top["s"] + F.coalesce(nxt["s"], F.lit(0)))
    alone = F.when((votes >= 3) & (margin >= 20), "high").when((votes >= 2) & (margin >= 8), "medium").otherwise("low")
    confidence = F.when(both, F.when(votes >= 2, "medium").otherwise("low")).otherwise(alone)
    by_state = F.transform("_r", lambda x: F.struct(x["state"].alias("state"), (-x["s"]).alias("score"), x["n"].alias("votes")))
    return d.select(*keys, F.when(both, TOGETHER[2]).otherwise(top["state"]).alias(state), confidence.alias("confidence"), margin.alias("margin"), votes.alias("votes"), by_state.alias("by_state"))


def without_outliers(df: DataFrame, keys: list[str], value: str, low: float, high: float, far: float) -> DataFrame:
    """Plausible values only, then, of three or more, those near their median."""
    d = df.where(F.col(value).between(low, high))
    middle = d.groupBy(*keys).agg(F.count(value).alias("_n"), F.median(value).alias("_m"))
    return d.join(middle, keys).where((F.col("_n") < 3) | (F.abs(F.col(value) - F.col("_m")) <= far)).select(*df.columns)


def spread(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(value).alias("n"), F.median(value).alias("middle"), F.min(value).alias("least"), F.max(value).alias("greatest")).withColumn("spread", F.col("greatest") - F.col("least"))
