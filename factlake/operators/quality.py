"""Frame measures summed up by clip and by event window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.media import reliability
from ..functions.scalar import bucket
from .joins import in_window


def mean(value: str, digits: int = 3) -> Column:
    """The mean of values with at most six decimals: sums are exact, so that the order
    of rows changes nothing. Rounded half-even."""
    x = F.sum(F.col(value).cast("decimal(18,6)")).cast("double") / F.count(value)
    return F.rint(x * 10.0**digits) / 10**digits


def clip_quality(df: DataFrame, keys: list[str], order: str, time: str) -> DataFrame:
    """Means of blur, brightness, noise and motion, their classes, the moment of the
    greatest motion (the first on ties) and the reliability, for each clip. ``motion``
    is null where a frame has none before it."""
    peak = F.max_by(F.struct(time, "motion"), F.struct("motion", -F.col(order)))
    d = df.groupBy(*keys).agg(*[mean(c).alias(f"{c}_mean") for c in ("blur", "brightness", "noise", "motion")], F.when(F.count("motion") > 0, peak).alias("_peak"))
    d = d.withColumn("motion_mean", F.coalesce("motion_mean", F.lit(0.0)))
    classes = {
        "blur": bucket(F.col("blur_mean"), 80, 300, ("high", "medium", "low")), "brightness": bucket(F.col("brightness_mean"), 65, 205, ("dark", "normal", "overexposed")),
        "night_noise": bucket(F.col("noise_mean"), 35, 75, ("low", "medium", "high")), "camera_shake": bucket(F.col("motion_mean"), 0.8, 4, ("low", "medium", "high")),
    }
    d = d.withColumns(classes)
    weak = (F.col("blur") == "high").cast("int") + (F.col("brightness") != "normal").cast("int") + (F.col("night_noise") == "high").cast("int")
    return d.withColumn("analysis_reliability", reliability(weak)).withColumn("peak_time", F.col(f"_peak.{time}")).withColumn("peak_motion", F.coalesce("_peak.motion", F.lit(0.0))).drop("_peak")


#: Conditions of a clip, and the frame flag that shows each.
CONDITIONS = {
    "glare_candidate": "glare", "overexposure_candidate": "overexposure", "low_light_candidate": "low_light", "rain_snow_fog_candidate": "low_contrast_fog_or_dirty_lens_candidate",
    "rain_snow_fog_or_dirty_lens_candidate": "low_contrast_fog_or_dirty_lens_candidate", "windshield_occlusion_candidate": "dark_occlusion_candidate", "occlusion_candidate": "dark_occlusion_candidate",
}


def visibility(df: DataFrame, keys: list[str], flags: str) -> DataFrame:
    """Whether any frame of a clip shows each condition."""
    return df.groupBy(*keys).agg(*[F.bool_or(F.array_contains(flags, flag)).alias(name) for name, flag in CONDITIONS.items()])


def segment_quality(timeline: DataFrame, windows: DataFrame, keys: list[str], event: str, position: str, width: int) -> DataFrame:
    """Means and reliability of the frames inside each event's window [w0, w1]; windows
    without frames are left out. A frame with any flag is weak; half of them make low."""
    hit = in_window(timeline, windows.select(*keys, event, "w0", "w1"), keys, position, "w0", "w1", width)
    g = hit.groupBy(*keys, event).agg(F.count("*").alias("frame_count"), F.count_if(F.size("flags") > 0).alias("weak_frame_count"), *[mean(c).alias(f"mean_{c}") for c in ("blur", "brightness", "noise")])
    weak = F.col("weak_frame_count")
    return g.withColumn("analysis_reliability", F.when(weak * 2 >= F.col("frame_count"), "low").when(weak > 0, "medium").otherwise("high"))
