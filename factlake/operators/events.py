"""Event rules, scores and evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import clamp, rint

#: Weights of the scan score.
SCAN = (1.4, 7.0, 3.0, 0.9)
#: What a purpose of an evidence image counts (others 50), and its source.
PURPOSES = {
    "traffic_light_crop": 96, "sign_crop": 94, "event_segment": 92, "event_candidate_overlay": 92, "event_scan_impact_candidate": 91, "impact_candidate": 90, "actor_crop": 88, "pre_impact": 86,
    "event_scan_pre_impact": 86, "tracking_overlay": 84, "track_overlay": 84, "post_impact": 80, "event_scan_post_impact": 80, "bev_overlay": 78, "lane_segmentation_overlay": 74, "motion_keyframe": 70,
    "event_window_context": 68, "pre_context": 66, "event_scan_pre_context": 66, "frame_selection_contact_sheet": 64, "regular_context": 58, "failure_case": 52,
}
SOURCES = {"traffic_control": 8, "visual_evidence": 6, "tracking_overlay": 6, "actor_crop": 6, "road_geometry": 4, "selected_frame": 2, "ocr_roi": -8}
#: Purposes whose images aren't judged for quality.
UNJUDGED = ("frame_selection_contact_sheet", "lane_segmentation_overlay", "bev_overlay", "tracking_overlay", "track_overlay", "failure_case")


def scan_score(diff: Column, peak: Column, mean: Column, change: Column) -> Column:
    """clamp(rint(1.4 d + 7 p + 3 m + 0.9 h), 0, 100)."""
    return clamp(rint(SCAN[0] * diff + SCAN[1] * peak + SCAN[2] * mean + SCAN[3] * change), 0, 100).cast("int")


def steps(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Absolute change against the previous row; the first row gives none."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("change", F.abs(F.col(value) - F.lag(value).over(w))).where("change IS NOT NULL")


def rule_union(df: DataFrame, rules: dict[str, tuple[Column, Column]]) -> DataFrame:
    """A row for every rule (condition, score) that a row meets; one scan."""
    hit = [F.when(cond, F.struct(F.lit(name).alias("rule"), score.alias("score"))) for name, (cond, score) in rules.items()]
    return df.withColumn("_h", F.explode(F.array_compact(F.array(*hit)))).select(*df.columns, "_h.rule", "_h.score")


#: What a signal, a class and a kind add to an event's score.
SIGNALS = {
    "bbox_overlap": 35, "speed_drop": 30, "bbox_area_increase": 28, "bbox_area_frame_to_frame_increase": 24, "event_scan_optical_flow": 22, "track_lateral_motion": 18, "object_speed_change": 18,
    "bbox_aspect_ratio_change": 18, "object_direction_change": 16, "relative_motion": 14, "camera_shake": 12,
}
CONFIDENCE = {"high": 30, "medium": 20, "low": 10}
CONTACTS = ("접촉", "충격후보")


def event_score(confidence: Column, signals: Column, evidence: Column, supporting: Column, event_type: Column, candidate_class: Column) -> Column:
    """Additive score, 0 to 100: class, signals, up to 10 for evidence that isn't empty
    and for the number of supporting measures, contact or impact, direct contact."""
    points = looked_up(confidence, CONFIDENCE, 0) + F.aggregate(signals, F.lit(0), lambda acc, s: acc + looked_up(s, SIGNALS, 0))
    points = points + F.least(F.lit(10), 3 * F.size(F.filter(evidence, lambda e: F.coalesce(e, F.lit("")) != ""))) + F.least(F.lit(10), 2 * supporting)
    points = points + F.when(event_type.isin(*CONTACTS), 12).otherwise(0) + F.when(candidate_class == "direct_contact_candidate", 8).otherwise(0)
    return clamp(points, 0, 100).cast("int")


def looked_up(key: Column, table: dict[str, int], other: int) -> Column:
    """A value of a small fixed table."""
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key), F.lit(other))


def evidence_score(purpose: Column, source: Column, frame_id: Column, track_id: Column, bbox: Column, quality: Column) -> Column:
    """Struct of a score, 0 to 100, and its reasons: purpose, source, links, and a
    penalty for poor quality (not judged for some purposes unless it is given)."""
    purpose, source = F.coalesce(purpose, F.lit("")), F.coalesce(source, F.lit(""))
    framed, tracked = (F.coalesce(x.cast("string"), F.lit("")) != "" for x in (frame_id, track_id))
    boxed = F.coalesce(F.size(bbox), F.lit(0)) > 0
    points = looked_up(purpose, PURPOSES, 50) + looked_up(source, SOURCES, 0)
    for condition, n in ((framed, 2), (tracked, 4), (boxed, 3), (quality == "low", -12), (quality == "medium", -4)):
        points = points + F.when(condition, n).otherwise(0)
    named = lambda what, x: F.concat(F.lit(what), F.when(x == "", "unknown").otherwise(x))
    reasons = F.array_compact(F.array(named("purpose:", purpose), named("source:", source), F.when(framed, "frame-linked"), F.when(tracked, "actor-linked"), F.when(boxed, "localized"), F.when(quality == "low", "quality_penalty").when(quality == "medium", "quality_caution")))
    return F.struct(clamp(points, 0, 100).cast("int").alias("score"), reasons.alias("reasons"))


def judged(purpose: Column) -> Column:
    """Whether an image's quality is assessed."""
    return ~purpose.isin(*UNJUDGED)


def supported(fact: Column, evidence: Column, confidence: Column, unknown: str) -> Column:
    """A fact without evidence or of low confidence becomes unknown."""
    return F.when((F.size(evidence) > 0) & (confidence != "low"), fact).otherwise(F.lit(unknown))
