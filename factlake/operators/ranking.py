"""Top-k, suppression, quotas and sampling plans; all within groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int, name: str = "rank") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("bigint")).where(F.col(name) <= k)


def suppress(df: DataFrame, keys: list[str], score: str, position: str, order: str, gap: int, k: int) -> DataFrame:
    """Greedy suppression: best score first, skip what lies nearer than ``gap`` to a
    chosen position, stop at ``k``. (keys, position, score, order) Rows that are ``gap``
    or more from all others before them in position don't touch these, so the fold runs
    over each such stretch, and the best ``k`` of a key's stretches are what one greedy
    pass would choose. One shuffle, by the keys."""
    at = Window.partitionBy(*keys).orderBy(position)
    apart = F.coalesce(F.col(position) - F.lag(position).over(at) >= gap, F.lit(False)).cast("int")
    d = df.select(*keys, position, score, order).withColumn("_new", apart)
    d = d.withColumn("_stretch", F.sum("_new").over(at.rowsBetween(Window.unboundedPreceding, 0)))
    item = F.struct((-F.col(score)).alias("s"), F.col(order).alias("o"), F.col(position).alias("p"))
    kind = df.select(item.alias("i")).schema["i"].dataType.simpleString()
    keep = F.aggregate(F.col("_c"), F.expr(f"CAST(array() AS array<{kind}>)"), lambda acc, x: F.when((F.size(acc) < k) & ~F.exists(acc, lambda y: F.abs(y["p"] - x["p"]) < gap), F.concat(acc, F.array(x))).otherwise(acc))
    out = d.groupBy(*keys, "_stretch").agg(F.array_sort(F.collect_list(item)).alias("_c")).select(*keys, F.explode(keep).alias("_x"))
    out = out.select(*keys, F.col("_x.o").alias(order), F.col("_x.p").alias(position), (-F.col("_x.s")).alias(score))
    return top_k(out, keys, [-F.col(score), F.col(order), F.col(position)], k, "_rank").drop("_rank")


def capped(df: DataFrame, keys: list[str], purpose: str, order: list[Column], caps: dict[str, int], total: int) -> DataFrame:
    """Caps for some purposes, then an overall limit."""
    cap = F.coalesce(*[F.when(F.col(purpose) == p, n) for p, n in caps.items()], F.lit(total))
    own = F.row_number().over(Window.partitionBy(*keys, purpose).orderBy(*order))
    kept = df.withColumn("_own", own).where(F.col("_own") <= cap)
    return top_k(kept, keys, order, total).drop("_own")


def quota(df: DataFrame, keys: list[str], phase: str, order: list[Column], targets: dict[str, int], hard: dict[str, int], total: int) -> DataFrame:
    """Two passes: each phase's target, then the best of the rest up to hard
    limits of a phase and the overall limit."""
    pick = lambda m, other: F.coalesce(*[F.when(F.col(phase) == p, n) for p, n in m.items()], F.lit(other))
    d = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys, phase).orderBy(*order))).withColumn("_first", F.col("_rn") <= pick(targets, 0))
    d = d.withColumn("_n1", F.sum(F.col("_first").cast("int")).over(Window.partitionBy(*keys)))
    d = d.where(F.col("_first") | (F.col("_rn") <= pick(hard, total)))
    d = d.withColumn("_fill", F.row_number().over(Window.partitionBy(*keys, "_first").orderBy(*order)))
    return d.where(F.col("_first") | (F.col("_fill") <= total - F.col("_n1"))).withColumn("pass", F.when(F.col("_first"), 1).otherwise(2)).drop("_rn", "_first", "_n1", "_fill")


def even_sample(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """Rows at the rounded (half-even) positions of n even steps; all if fewer."""
    w = Window.partitionBy(*keys)
    d = df.withColumn("_i", F.row_number().over(w.orderBy(*order)) - 1).withColumn("_last", F.count("*").over(w) - 1)
    # i is wanted where some j of 0..n-1 has rint(j * last / (n - 1)) = i
    near = F.floor(F.col("_i") * (n - 1) / F.greatest(F.col("_last"), F.lit(1))).cast("int")
    hit = F.exists(F.array(near - 1, near, near + 1), lambda j: (j >= 0) & (j <= n - 1) & (F.rint(j * F.col("_last") / float(n - 1)) == F.col("_i")))
    return d.where((F.col("_last") < n) | hit).drop("_i", "_last")


def plan_frames(duration: Column, fps: Column, interval: float) -> Column:
    """Frames every ``interval`` seconds, rounded half-even, within the clip, ascending."""
    steps = F.sequence(F.lit(0), F.floor(duration / interval + 1e-9).cast("int"))
    frames = F.array_distinct(F.transform(steps, lambda s: F.rint(s * interval * fps).cast("bigint")))
    return F.filter(frames, lambda x: x <= F.floor(duration * fps + 1e-9))


def sampling_plan(df: DataFrame, duration: str, fps: str, interval: float) -> DataFrame:
    """A row for each frame of ``plan_frames``."""
    return df.select("*", F.explode(plan_frames(F.col(duration), F.col(fps), interval)).alias("frame_index"))
