"""Evidence packages: the tables of a video's evidence as one record at the sink."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def assembled(videos: DataFrame, keys: list[str], sections: Mapping[str, tuple[DataFrame, str]], facts: Mapping[str, tuple[DataFrame, str]], single: Mapping[str, Column]) -> DataFrame:
    """``keys`` and ``package`` (JSON text) for each video: lists of the rows of
    ``sections`` and, below ``precomputed_facts``, of ``facts``, each a table with the keys
    and the column that orders it, and there too ``single`` structs of the video.

    All lists are made by one shuffle: rows of all tables travel as text under the name of
    their list. A video without rows has empty lists, a null struct is an empty object,
    null fields are left out, rows of unknown videos are dropped, and rows of equal order
    stand in order of their text. A package holds what one video has, so it belongs at the
    sink: give it selected frames, best events and the like."""
    lists = [*((n, *t) for n, t in sections.items()), *((n, *t) for n, t in facts.items())]

    def rows(i: int, df: DataFrame, order: str) -> DataFrame:
        fields = [c for c in df.columns if c not in keys]
        return df.select(*keys, F.lit(i).alias("_s"), F.struct(F.col(order).cast("double").alias("o"), F.to_json(F.struct(*fields)).alias("j")).alias("_r"))

    all_ = reduce(DataFrame.unionByName, [rows(i, df, order) for i, (_, df, order) in enumerate(lists)])
    g = all_.groupBy(*keys).agg(*[F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("_s") == i, F.col("_r")))), lambda r: r["j"]), ",").alias(f"_{i}") for i in range(len(lists))])

    def entry(name: str, value: Column) -> Column:
        return F.concat(F.lit(f'"{name}":'), value)

    def of(i: int) -> Column:
        return entry(lists[i][0], F.concat(F.lit("["), F.coalesce(f"_{i}", F.lit("")), F.lit("]")))

    here = [of(i) for i in range(len(sections))]
    below = [entry(n, F.coalesce(F.to_json(n), F.lit("{}"))) for n in single] + [of(i) for i in range(len(sections), len(lists))]
    v = videos.select(*keys, *[c.alias(n) for n, c in single.items()])
    inner = F.concat(F.lit("{"), F.concat_ws(",", *below), F.lit("}"))
    return v.join(g, keys, "left").select(*keys, F.concat(F.lit("{"), F.concat_ws(",", *here, entry("precomputed_facts", inner)), F.lit("}")).alias("package"))
