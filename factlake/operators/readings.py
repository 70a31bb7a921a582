"""Readings of overlay text, summed up by video: votes, speeds without outliers and
jumps, positions, and how each field fared.

Observations come as (video_id, ord, frame_id, confidence, target_field, status, moment,
speed_kmh, lat, lon). A video's readings are one array: they are few, and filters that
depend on what was kept before are folds over it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import UNKNOWN, clamp, rint

FIELDS = {"datetime": "moment", "speed": "speed_kmh", "gps": "lat"}


def middle(values: Column) -> Column:
    """The median of a sorted array of numbers."""
    n = F.size(values)
    return (F.get(values, F.floor((n - 1) / 2).cast("int")) + F.get(values, F.floor(n / 2).cast("int"))) / 2


def final_score(samples: Column, confidence: Column, consistency: Column) -> Column:
    """0.45 for confidence, 0.35 for consistency, 0.20 for up to three samples; three decimals."""
    return rint(clamp(confidence * 0.45 + consistency * 0.35 + F.least(F.lit(1.0), samples / 3.0) * 0.20, 0.0, 1.0), 3)


def target_only(parsed: Column, target: Column) -> Column:
    """What a pass for one field keeps of a struct (moment, speed_kmh, lat, lon)."""
    keep = lambda field, name: F.when(target.isin(*(f for f in FIELDS if f != field)), None).otherwise(parsed[name]).alias(name)
    return F.struct(keep("datetime", "moment"), keep("speed", "speed_kmh"), keep("gps", "lat"), keep("gps", "lon"))


def _values(items: Column) -> Column:
    return F.array_sort(F.transform(items, lambda x: x["v"]))


def _mean(items: Column, field: str) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda acc, x: acc + x[field]) / F.size(items)


def speeds(observations: DataFrame) -> DataFrame:
    """Each video's speed: its median after values outside 0 to 180, those over 35 from
    the median of three or more, and steps of over 45 from the last kept one are left out
    (a filter that would leave nothing, or one value of the steps, doesn't count)."""
    o = observations.where("speed_kmh IS NOT NULL")
    row = F.struct("ord", F.col("speed_kmh").cast("double").alias("v"), F.coalesce(F.col("confidence").cast("double"), F.lit(0.0)).alias("c"), "frame_id")
    d = o.groupBy("video_id").agg(F.array_sort(F.collect_list(row)).alias("_a"))
    d = d.withColumn("_p", F.filter("_a", lambda x: (x["v"] >= 0) & (x["v"] <= 180)))
    d = d.withColumn("_m", middle(_values(F.col("_p")))).withColumn("_n", F.filter("_p", lambda x: F.abs(x["v"] - F.col("_m")) <= 35))
    some = F.when(F.size("_p") > 0, F.col("_p")).otherwise(F.col("_a"))
    d = d.withColumn("_f", F.when(F.size("_p") < 3, some).when(F.size("_n") > 0, F.col("_n")).otherwise(F.col("_p")))
    # the first stays; then each within reach of the last that stayed
    kept = F.aggregate(F.slice("_f", 2, F.size("_f")), F.slice("_f", 1, 1), lambda acc, x: F.when(F.abs(x["v"] - F.element_at(acc, -1)["v"]) <= 45, F.concat(acc, F.array(x))).otherwise(acc))
    d = d.withColumn("_k", kept).withColumn("_s", F.when((F.size("_f") >= 3) & (F.size("_k") >= 2), F.col("_k")).otherwise(F.col("_f")))
    d = d.withColumns({"low": F.array_min(_values(F.col("_s"))), "high": F.array_max(_values(F.col("_s"))), "sample_count": F.size("_s")}).withColumn("_w", F.col("high") - F.col("low"))
    rejected = F.size("_a") - F.size("_p") + F.when((F.size("_p") >= 3), F.size("_p") - F.size("_n")).otherwise(0) + F.when(F.size("_f") >= 3, F.size("_f") - F.size("_k")).otherwise(0)
    return d.select(
        "video_id", middle(_values(F.col("_s"))).alias("numeric_kmh"), "low", "high", F.when((F.size("_a") >= 3) & (F.col("_w") <= 3), "high").when(F.col("_w") <= 8, "medium").otherwise("low").alias("confidence"),
        F.when((F.col("_w") <= 3) & (F.size("_s") >= 3), "stable").otherwise("variable").alias("temporal_consistency"), "sample_count", rejected.alias("rejected_count"), F.transform("_s", lambda x: x["frame_id"]).alias("evidence"),
        final_score(F.col("sample_count"), _mean(F.col("_s"), "c"), F.greatest(F.lit(0.0), 1.0 - F.least(F.col("_w"), F.lit(30.0)) / 30.0)).alias("final_confidence_score"),
    )


def positions(observations: DataFrame) -> DataFrame:
    """Each video's position: the medians of latitudes and of longitudes."""
    g = observations.where("lat IS NOT NULL AND lon IS NOT NULL").groupBy("video_id").agg(F.median("lat").alias("lat"), F.median("lon").alias("lon"), F.count("*").alias("sample_count"), (F.sum(F.coalesce("confidence", F.lit(0)).cast("decimal(18,6)")).cast("double") / F.count("*")).alias("_c"))
    several = F.col("sample_count") >= 2
    return g.select("video_id", "lat", "lon", F.when(several, "medium").otherwise("low").alias("confidence"), "sample_count", final_score(F.col("sample_count"), F.col("_c"), F.when(several, 0.8).otherwise(0.45)).alias("final_confidence_score"))


def field_votes(observations: DataFrame) -> DataFrame:
    """For each video and field: readings and failures of passes for the field or for
    all, and the readings' mean confidence."""
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(c).isNotNull().alias("has")) for f, c in FIELDS.items()])).alias("_x")
    d = observations.select("video_id", "target_field", F.coalesce("status", F.lit("observed")).alias("status"), F.coalesce(F.col("confidence"), F.lit(0)).cast("decimal(18,6)").alias("c"), each).select("*", "_x.*")
    d = d.where(F.col("target_field").isNull() | F.col("target_field").isin("general") | (F.col("target_field") == F.col("field")))
    seen = (F.col("status") == "observed") & F.col("has")
    mean = F.sum(F.when(seen, F.col("c"))).cast("double") / F.count_if(seen)
    return d.groupBy("video_id", "field").agg(F.count_if(seen).alias("observed_count"), F.count_if(F.col("status") == "failed").alias("failure_count"), F.coalesce(rint(mean, 3), F.lit(0.0)).alias("mean_confidence"))


def summary(observations: DataFrame) -> DataFrame:
    """A row for each video: its time by vote, speed and position, with the number of observations."""
    from .votes import first_seen_mode

    n = observations.groupBy("video_id").agg(F.count("*").alias("observation_count"))
    when = first_seen_mode(observations.where("moment IS NOT NULL"), ["video_id"], "moment", "ord").select("video_id", "moment", F.col("confidence").alias("moment_confidence"))
    fast = speeds(observations).select("video_id", "numeric_kmh", F.col("confidence").alias("speed_confidence"))
    where = positions(observations).select("video_id", "lat", "lon", F.col("confidence").alias("gps_confidence"))
    d = n.join(when, "video_id", "left").join(fast, "video_id", "left").join(where, "video_id", "left")
    return d.withColumns({c: F.coalesce(c, F.lit("unknown")) for c in ("moment_confidence", "speed_confidence", "gps_confidence")})


def flashing(frames: DataFrame, keys: list[str], status: str, lit: str = "lit") -> DataFrame:
    """Frames of a lamp that are lit, off and missing, and whether it flashes: three
    frames or more, two of them lit and one not."""
    on, n = F.count_if(F.col(status) == lit), F.count("*")
    g = frames.groupBy(*keys).agg(on.alias("lit"), F.count_if(F.col(status) == "off").alias("off"), F.count_if(F.col(status) == "missing").alias("missing"), ((n >= 3) & (on >= 2) & (n - on >= 1)).alias("_f"))
    return g.withColumn("state", F.when(F.col("_f"), "점멸").otherwise(UNKNOWN)).drop("_f")
