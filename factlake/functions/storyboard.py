"""Fields of storyboard entries: phases, roles, reasons, captions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The phase that a purpose belongs to (others: scene_context), in the
#: phases' order their targets, hard limits and roles.
PHASES = {
    "regular_context": "scene_context", "event_window_context": "scene_context", "event_scan_pre_context": "scene_context", "pre_context": "pre_event", "event_scan_pre_impact": "approach", "motion_keyframe": "approach", "pre_impact": "approach",
    "event_scan_impact_candidate": "impact_candidate", "impact_candidate": "impact_candidate", "event_segment": "impact_candidate", "event_scan_post_impact": "post_event", "post_impact": "post_event", "actor_crop": "detail",
    "tracking_overlay": "detail", "track_overlay": "detail", "frame_selection_contact_sheet": "detail", "traffic_light_crop": "insurance_context", "sign_crop": "insurance_context", "bev_overlay": "insurance_context", "lane_segmentation_overlay": "insurance_context",
}
TARGETS = {"insurance_context": 3, "scene_context": 2, "pre_event": 3, "approach": 3, "impact_candidate": 4, "post_event": 3, "detail": 2}
LIMITS = {"insurance_context": 3, "detail": 4}
ROLES = {
    "insurance_context": "보험/RAG 핵심 항목인 신호, 표지, 차로 수, 도로 형태, 진행방향 확인", "scene_context": "도로 구조, 차로, 시야, 날씨/조명 등 사고 전 배경 확인", "pre_event": "사고 전 객체 배치와 새 객체 등장 여부 확인",
    "approach": "객체 간 거리 변화, 접근, 차로 변화, 위험 증가 확인", "impact_candidate": "접촉/충돌 후보 순간과 직전·직후 변화 확인", "post_event": "충돌 후 정지, 이탈, 낙상, 파편, 후속 상태 확인", "detail": "원본 프레임에서 작게 보이는 객체, 표지, 신호, tracking 근거 확대 확인",
}


def _of(table: dict[str, str | int], key: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def phase_of(purpose: Column) -> Column:
    return F.coalesce(_of(PHASES, F.coalesce(purpose, F.lit(""))), F.lit("scene_context"))


def role_of(phase: Column) -> Column:
    return _of(ROLES, phase)


def phase_order(phase: Column) -> Column:
    return F.coalesce(_of({p: i for i, p in enumerate(TARGETS)}, phase), F.lit(99))


def why_selected(phase: Column, purpose: Column, importance: Column, frame_id: Column, linked: Column) -> Column:
    """The reasons for an entry, as text."""
    parts = F.concat(F.lit("phase:"), phase), F.concat(F.lit("purpose:"), F.coalesce(purpose, F.lit("unknown"))), F.concat(F.lit("importance:"), importance.cast("string")), F.when(frame_id != "", F.concat(F.lit("frame:"), frame_id)), F.when(linked, "actor-linked")
    return F.concat_ws(", ", *parts)


def caption(slot: Column, path: Column, phase: Column, why: Column) -> Column:
    """Lines that go with an image."""
    return F.concat_ws("\n", F.format_string("[slot %02d] %s", slot, phase), F.concat(F.lit("path: "), path), F.concat(F.lit("why: "), why))


def linked_actors(records: DataFrame, positions: DataFrame, keys: list[str]) -> DataFrame:
    """Records (track_id, frame_id and perhaps an array ``tracks``) with the ids of their
    actors: their own, else all whose tracks are in their frame, sorted; and the types seen there, first seen first."""
    g = positions.groupBy(*keys, "frame_id").agg(F.array_sort(F.collect_set(F.col("track_id").cast("string"))).alias("_ids"), F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("ord", "type"))), lambda x: x["type"])).alias("_types"))
    d = records.join(g, [*keys, "frame_id"], "left")
    none = F.expr("CAST(array() AS array<string>)")
    own = F.array(F.col("track_id").cast("string"))
    if "tracks" in records.columns:
        own = F.concat(own, F.coalesce(F.col("tracks").cast("array<string>"), none))
    own = F.array_sort(F.array_distinct(F.filter(own, lambda t: t.isNotNull() & (t != ""))))
    own = F.when(F.size(own) > 0, own)
    return d.withColumns({"linked_actor_ids": F.coalesce(own, "_ids", none), "visible_actor_candidates": F.coalesce(F.filter("_types", lambda t: t != ""), none)}).drop("_ids", "_types")
