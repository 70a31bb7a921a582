"""Measures between neighbouring frames of a video, as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.motion import frame_motion
from ..functions.scalar import bucket, clamp, rint
from .events import scan_score
from .ranking import suppress

#: The shake classes' limits, and what grown boxes add to a scan score.
SHAKE, GROWTH, MOST_GROWTH = (0.8, 4.0), 10.0, 25.0


def steps(frames: DataFrame, keys: list[str], order: list[str], pixels: str = "pixels", width: str = "width", area_change: Column | None = None, clip: bool = True) -> DataFrame:
    """Each grey frame with ``motion`` (the struct of ``frame_motion``) against the one
    before of its video; null for the first and where shapes differ. Without ``clip`` the
    measures of a clip's quality stay null, for those who don't read them. Flow costs far
    more than the bytes of a frame tell, so the parts are as many as set and stay so."""
    parts = int(frames.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    w = Window.partitionBy(*keys).orderBy(*order)
    paired = frames.repartition(parts, *keys).withColumn("_before", F.lag(pixels).over(w))
    return paired.withColumn("motion", frame_motion(F.col("_before"), F.col(pixels), F.col(width), area_change, clip)).drop("_before")


def scan_events(stepped: DataFrame, keys: list[str], time: str, order: str, area_change: Column | None = None, least: float = 8.0, gap: float = 1.0, most: int = 5) -> DataFrame:
    """Peaks of a video's scan score: those of at least ``least``, greedily ``gap`` apart
    in time, at most ``most``."""
    m = F.col("motion")
    score = scan_score(m["frame_diff"], m["flow_peak"], m["flow_mean"], m["histogram_change"])
    if area_change is not None:
        score = F.when(F.coalesce(area_change, F.lit(0)) != 0, clamp(rint(score + F.least(F.lit(MOST_GROWTH), area_change * GROWTH)), 0, 100).cast("int")).otherwise(score)
    scored = stepped.where("motion IS NOT NULL").withColumn("event_score", score).where(F.col("event_score") >= least)
    return suppress(scored, keys, "event_score", time, order, gap, most)


def camera_shake(stepped: DataFrame, keys: list[str], frame: str = "frame_id", time: str = "t") -> DataFrame:
    """A clip's motion: the means over its steps (the first frame is none), the class of
    the mean flow, and the step with the greatest flow, the earliest of equal ones."""
    m = F.col("motion")
    before = F.lag(frame).over(Window.partitionBy(*keys).orderBy(time, frame))
    seen = stepped.withColumn("_before", before).where(m.isNotNull())
    at = F.struct(m["motion_score"].alias("v"), (-F.col(time)).alias("t"))
    peak = F.max_by(F.struct(m["motion_score"].alias("value"), m["compensated"].alias("compensated"), F.col(time).alias("time"), F.array_compact(F.array("_before", frame)).alias("evidence")), at)
    g = seen.groupBy(*keys).agg(F.avg(m["motion_score"]).alias("motion_mean"), F.avg(m["compensated"]).alias("compensated_mean"), peak.alias("peak"))
    return g.withColumn("camera_shake", bucket(F.col("motion_mean"), *SHAKE, ("low", "medium", "high")))
