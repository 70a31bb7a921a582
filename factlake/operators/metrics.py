"""Measures of preprocessing results against manifest labels, one row for each video."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import share


def mean_of(value: Column, digits: int = 4) -> Column:
    """A mean of values with at most six decimals, from an exact sum; null without rows."""
    return F.rint(F.sum(value.cast("decimal(18,6)")).cast("double") / F.count(value) * 10.0**digits) / 10**digits


def recall_at(events: DataFrame, labels: DataFrame, k: int, reach: float = 0.75) -> DataFrame:
    """(video_id, recall): 1 where one of the ``k`` best events (t, score, ord) lies within
    ``reach`` of the label's time, 0 where none does, null without a time."""
    best = events.withColumn("_r", F.row_number().over(Window.partitionBy("video_id").orderBy(F.desc(F.coalesce("score", F.lit(0.0))), "ord"))).where(F.col("_r") <= k)
    d = labels.select("video_id", F.col("collision_t").alias("at")).join(best.select("video_id", "t"), "video_id", "left")
    hit = F.coalesce(F.max(F.when(F.abs(F.col("t") - F.col("at")) <= reach, 1.0)), F.lit(0.0))
    return d.groupBy("video_id").agg(F.when(F.count("at") > 0, hit).alias("recall"))


def actor_rates(tracks: DataFrame, labels: DataFrame) -> DataFrame:
    """Recall, miss rate and false positives of expected actors (an array, repeats count)."""
    seen = tracks.groupBy("video_id").agg(F.collect_set(F.col("track_id").cast("string")).alias("_seen"))
    d = labels.select("video_id", F.col("actors").alias("_want")).join(seen, "video_id", "left")
    none = F.expr("CAST(array() AS array<string>)")
    want, have = F.coalesce("_want", none), F.coalesce("_seen", none)
    recall = share(F.size(F.filter(want, lambda a: F.array_contains(have, a))), F.size(want))
    false = F.when(F.size(have) == 0, F.when(F.size(want) == 0, 0.0)).otherwise(share(F.size(F.array_except(have, want)), F.size(have)))
    return d.select("video_id", recall.alias("actor_recall"), (F.rint((1.0 - recall) * 10000.0) / 10000).alias("actor_miss_rate"), false.alias("actor_false_positive_rate"))


def continuity(tracks: DataFrame) -> DataFrame:
    """Mean continuity and fragmentation of tracks; a track without a score has 0."""
    f = F.coalesce(F.col("fragmentation"), F.lit(0)) / 100.0
    return tracks.groupBy("video_id").agg(mean_of(F.greatest(F.lit(0.0), 1.0 - F.least(f, F.lit(1.0)))).alias("tracking_continuity"), mean_of(F.least(F.lit(1.0), f)).alias("track_fragmentation_rate"))


def agreement(expected: Column, found: Column, within: float = 0.0) -> Column:
    """1 where what was found is what was expected (numbers: within a reach), 0 where it
    isn't or nothing was found, null where nothing is expected."""
    same = F.abs(expected - found) <= within if within else expected == found
    return F.when(expected.isNotNull(), F.coalesce(same, F.lit(False)).cast("double"))


def appropriateness(fields: Column) -> Column:
    """The share of fields (an array of value and confidence) that are known or say that
    they aren't; null without fields."""
    from ..functions.facts import is_known
    from ..functions.scalar import UNKNOWN

    right = F.filter(fields, lambda x: is_known(x["value"]) | F.coalesce(x["value"] == UNKNOWN, F.lit(False)) | F.coalesce(x["confidence"] == "unknown", F.lit(False)))
    return share(F.size(right), F.size(fields))


def preprocessing_metrics(labels: DataFrame, events: DataFrame, tracks: DataFrame, results: DataFrame) -> DataFrame:
    """Twelve measures for each labelled video. Labels: collision_t, actors, signal,
    lanes, speed; results: signal, lanes, speed, fields, uncertainties."""
    at3 = recall_at(events, labels, 3)
    d = labels.join(at3, "video_id", "left").join(actor_rates(tracks, labels), "video_id", "left").join(continuity(tracks), "video_id", "left")
    d = d.join(results.select("video_id", *[F.col(c).alias(f"_{c}") for c in ("signal", "lanes", "speed", "fields", "uncertainties")]), "video_id", "left")
    return d.select(
        "video_id", F.col("recall").alias("frame_recall"), F.col("recall").alias("collision_recall_at_3"), "actor_recall", "actor_miss_rate", "actor_false_positive_rate", "tracking_continuity", "track_fragmentation_rate",
        agreement(F.when(F.col("signal") != "", F.col("signal")), F.col("_signal")).alias("signal_accuracy"), agreement(F.col("lanes"), F.col("_lanes")).alias("lane_count_accuracy"), agreement(F.col("speed"), F.col("_speed"), 3.0).alias("ocr_speed_accuracy"),
        appropriateness(F.col("_fields")).alias("insurance_known_unknown_appropriateness"), F.when(F.coalesce(F.size("_uncertainties"), F.lit(0)) > 0, 1.0).otherwise(0.0).alias("uncertainty_presence"),
    )
