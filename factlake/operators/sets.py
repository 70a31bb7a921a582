"""Set operations over plans, sections and id sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merge_by_key(plans: list[DataFrame], keys: list[str], purpose: str) -> DataFrame:
    """Union of plans; purposes of one key are joined by '+', in plan order, once each."""
    all_ = reduce(DataFrame.unionByName, [p.select(*keys, purpose).withColumn("_o", F.lit(i)) for i, p in enumerate(plans)])
    found = F.array_sort(F.collect_set(F.struct("_o", purpose)))
    return all_.groupBy(*keys).agg(found.alias("_p")).select(*keys, F.array_join(F.array_distinct(F.transform("_p", lambda x: x[purpose])), "+").alias(purpose))


def merged_in_row(plans: list[tuple[Column, str]]) -> Column:
    """Plans of one row (an array of frames and the plan's purpose) as a map from frame to
    its purposes joined by '+', in plan order, once each: no shuffle. Null frames and
    null arrays add nothing."""
    none = F.expr("CAST(array() AS array<string>)")

    def one(frames: Column, purpose: str) -> Column:
        keys = F.array_distinct(F.filter(F.coalesce(frames, F.expr("CAST(array() AS array<bigint>)")), lambda f: f.isNotNull()))
        return F.map_from_arrays(keys, F.transform(keys, lambda f: F.array(F.lit(purpose))))

    both = reduce(lambda a, b: F.map_zip_with(a, b, lambda k, x, y: F.array_distinct(F.concat(F.coalesce(x, none), F.coalesce(y, none)))), [one(*p) for p in plans])
    return F.transform_values(both, lambda k, v: F.array_join(v, "+"))


def first_section(sections: list[DataFrame], key: str) -> DataFrame:
    """Union; a key found in several sections keeps the first section's row."""
    all_ = reduce(DataFrame.unionByName, [s.withColumn("section", F.lit(i)) for i, s in enumerate(sections)])
    return all_.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy("section"))).where("_r = 1").drop("_r")


def compare_ids(df: DataFrame, keys: list[str], item: str, a: Column, b: Column) -> DataFrame:
    """Of two id sets in each group: common, only in a, only in b."""
    one = df.groupBy(*keys, item).agg(F.bool_or(a).alias("_a"), F.bool_or(b).alias("_b"))
    return one.groupBy(*keys).agg(F.count_if(F.col("_a") & F.col("_b")).alias("common"), F.count_if(F.col("_a") & ~F.col("_b")).alias("only_a"), F.count_if(~F.col("_a") & F.col("_b")).alias("only_b"))
