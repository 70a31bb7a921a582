"""Contracts of records as columns: what a row breaks, and the rows that keep or break
them. Every rule is a condition of one row, so that a check is part of the scan.

Defined cases: a condition that is null counts as broken; a column that may be absent says
so in its rule. Text counts without the white space around it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The closed sets of the records, and the settings with their limits.
CONFIDENCES = ("high", "medium", "low", "unknown")
STATUSES = ("observed", "computed", "inferred", "unknown")
SCENES = ("교차로", "횡단보도", "일반도로", "고속도로", "자동차전용도로", "주차장", "골목길", "이면도로", "회전교차로", "터널", "교량", "램프구간", "합류구간", "분기구간", "확인불가")
ACCIDENTS = ("차대차", "차대보행자", "차대자전거", "차대이륜차", "차대전동킥보드", "차대시설물", "단독사고", "비접촉사고", "다중추돌", "확인불가")
TIME = r"^\d{2,}:[0-5]\d\.\d{3}$"
POSITIVE = (
    "regular_frame_interval_sec", "max_selected_frames", "pre_event_window_sec", "post_event_window_sec", "lane_width_m", "motion_sample_interval_sec", "max_motion_keyframes",
    "segment_tracking_stride_frames", "max_segment_tracking_frames", "vlm_frame_budget", "event_scan_sample_fps", "event_scan_top_k", "precision_event_fps", "min_impact_frames", "max_event_candidates",
)
NOT_NEGATIVE = ("min_motion_change_score", "event_scan_min_score")

Rules = Mapping[str, Column]


def trimmed(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def filled(text: Column) -> Column:
    return F.length(trimmed(text)) > 0


def finite(number: Column) -> Column:
    """Not null, NaN or infinite."""
    return number.isNotNull() & ~F.isnan(number.cast("double")) & (F.abs(number.cast("double")) != float("inf"))


def metadata_rules(duration: Column, fps: Column, resolution: Column, frames: Column, audio: Column) -> Rules:
    return {
        "duration_sec must be finite and not negative": finite(duration) & (duration >= 0),
        "fps must be finite and positive": finite(fps) & (fps > 0),
        "resolution cannot be blank": filled(resolution),
        "frame_count must not be negative": frames >= 0,
        "has_audio is required": audio.isNotNull(),
    }


def frame_rules(id_: Column, time: Column, index: Column, purpose: Column) -> Rules:
    """A selected frame; its time is MM:SS.mmm without white space around it."""
    return {
        "id cannot be blank": filled(id_),
        "time must be MM:SS.mmm": F.rlike(time, F.lit(TIME)),
        "frame_index must not be negative": index >= 0,
        "purpose cannot be blank": filled(purpose),
    }


def cell_rules(status: Column, confidence: Column, source: Column, evidence: Column) -> Rules:
    """A fact with its evidence; absent lists are empty ones. What is not unknown has a source."""
    whole = lambda items: items.isNull() | F.forall(items, lambda x: F.coalesce(filled(x), F.lit(False)))
    return {
        "status is not known": status.isin(*STATUSES),
        "confidence is not known": confidence.isin(*CONFIDENCES),
        "source and evidence items cannot be blank": whole(source) & whole(evidence),
        "source is required when status is not unknown": (status == "unknown") | (F.coalesce(F.size(source), F.lit(0)) > 0),
    }


def type_rules(scene: Column, accident: Column) -> Rules:
    return {"scene type is not known": scene.isin(*SCENES), "accident type is not known": accident.isin(*ACCIDENTS)}


def setting_rules(settings: Mapping[str, Column]) -> Rules:
    """The limits of those settings that are given."""
    rules = {f"{n} must be positive": settings[n] > 0 for n in POSITIVE if n in settings}
    return rules | {f"{n} must be non-negative": settings[n] >= 0 for n in NOT_NEGATIVE if n in settings}


def broken(rules: Rules) -> Column:
    """The names of the rules that a row breaks, in their order."""
    return F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]))


def accepted(df: DataFrame, rules: Rules) -> DataFrame:
    """The rows that break nothing."""
    return df.where(F.size(broken(rules)) == 0)


def rejected(df: DataFrame, rules: Rules) -> DataFrame:
    """The other rows, with ``faults``."""
    return df.withColumn("faults", broken(rules)).where(F.size("faults") > 0)


def required(df: DataFrame, rules: Rules) -> DataFrame:
    """``df``; a row that breaks a rule ends the job with the rules' names."""
    faults = broken(rules)
    return df.where(F.when(F.size(faults) == 0, True).otherwise(F.raise_error(F.array_join(faults, "; ")).cast("boolean")))
