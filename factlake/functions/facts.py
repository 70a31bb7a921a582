"""Columns over final records: gates that let no fact stand without evidence, the
verification against preprocessing, and what an evaluation counts.

A field is a struct of value, status, confidence, source and evidence (arrays of
strings). Each gate gives the repaired column and the messages of what it changed; a
record's messages are appended in the order of the gates, each once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .media import rank_of
from .scalar import UNKNOWN, found_terms, redact

#: Texts of the gates.
ADJUSTED = "근거 없는 값이 확인불가로 조정됨: "
NO_EVENT, NO_SPEED = "근거 부족으로 세부 사건 확인불가", "모름"
#: Fields of a claim, and kinds of accidents with their labels.
CLAIM_FIELDS = ("accident_datetime", "location", "road_shape", "lane_count", "ego_direction", "other_direction", "police_report_visible")
ACCIDENTS = {
    "vehicle_to_pedestrian": "차대보행자", "vehicle_to_vehicle": "차대차", "vehicle_to_motorcycle": "차대이륜차", "vehicle_to_bicycle": "차대자전거", "vehicle_to_kickboard": "차대전동킥보드", "vehicle_to_facility": "차대시설물",
    "single_vehicle": "단독사고", "non_contact": "비접촉사고", "multi_collision": "다중추돌",
}
#: The object codes of labels.
OBJECTS = {1: "차대보행자", 2: "차대차", 3: "차대이륜차", 4: "차대자전거"}
_NONE = "CAST(array() AS array<string>)"
Gated = tuple[Column, Column]


def some(items: Column) -> Column:
    """Whether a list has an element; false for null."""
    return F.coalesce(F.size(items), F.lit(0)) > 0


def supported(x: Column, *fields: str) -> Column:
    """Whether a struct has evidence or a source, or another list named."""
    out = some(x["evidence"]) | some(x["source"])
    for f in fields:
        out = out | some(x[f])
    return out


def changed(x: Column, **fields: Column | str | None) -> Column:
    for name, value in fields.items():
        x = x.withField(name, value if isinstance(value, Column) else F.lit(value))
    return x


def when_bad(x: Column, bad: Column, message: str, **fields: Column | str | None) -> Gated:
    return F.when(bad, changed(x, **fields)).otherwise(x), F.when(bad, F.array(F.lit(message))).otherwise(F.expr(_NONE))


def each_bad(items: Column, bad: Callable[[Column], Column], path: str, end: str = "", **fields: Column | str | None) -> Gated:
    """The same for every element of a list; messages count from 0."""
    out = F.transform(items, lambda x: F.when(bad(x), changed(x, **fields)).otherwise(x))
    said = F.array_compact(F.transform(items, lambda x, i: F.when(bad(x), F.concat(F.lit(f"{ADJUSTED}{path}["), i.cast("string"), F.lit(f"]{end}")))))
    return out, F.coalesce(said, F.expr(_NONE))


def named_value(value: Column) -> Column:
    """Whether a value claims something."""
    return value.isNotNull() & (value != UNKNOWN)


def gate_scene(field: Column, name: str = "scene_type") -> Gated:
    """Needs a source and evidence both, unless its status is unknown."""
    bad = F.coalesce(field["status"] != "unknown", F.lit(True)) & ~(some(field["source"]) & some(field["evidence"]))
    return when_bad(field, bad, ADJUSTED + name, value=UNKNOWN, status="unknown", confidence="unknown", source=F.expr(_NONE), evidence=F.expr(_NONE))


def gate_signal(signal: Column) -> Gated:
    bad = named_value(signal["value"]) & ~some(signal["evidence"]) & ~some(signal["crops"])
    return when_bad(signal, bad, f"{ADJUSTED}traffic_control.signal", value=UNKNOWN, status="unknown", confidence="unknown")


def gate_speeds(items: Column) -> Gated:
    return each_bad(items, lambda x: x["numeric_kmh"].isNotNull() & ~supported(x), "speed_and_distance.speed_estimates", value=NO_SPEED, numeric_kmh=None, confidence="unknown")


def gate_collision(collision: Column) -> Gated:
    return when_bad(collision, collision.isNotNull() & ~supported(collision), f"{ADJUSTED}collision", impact_type=UNKNOWN, impact_location=UNKNOWN, damage_or_injury=UNKNOWN, confidence="unknown")


def gate_timeline(items: Column) -> Gated:
    return each_bad(items, lambda x: ~supported(x), "timeline", event=NO_EVENT, confidence="unknown")


def gate_actors(items: Column) -> Gated:
    return each_bad(items, lambda x: named_value(x["movement"]) & ~supported(x), "actors", ".movement", movement=UNKNOWN, confidence="unknown")


def gate_map(fields: Column, path: str) -> Gated:
    """Every field of a map, in the order of its keys."""
    bad = lambda x: F.coalesce(x["status"] != "unknown", F.lit(True)) & ~supported(x)
    unknown = {"value": UNKNOWN, "status": "unknown", "confidence": "unknown", "source": F.expr(_NONE), "evidence": F.expr(_NONE)}
    out = F.transform_values(fields, lambda _, x: F.when(bad(x), changed(x, **unknown)).otherwise(x))
    said = F.array_compact(F.transform(F.map_entries(fields), lambda e: F.when(bad(e["value"]), F.concat(F.lit(f"{ADJUSTED}{path}."), e["key"]))))
    return out, F.coalesce(said, F.expr(_NONE))


def with_defaults(fields: Column, defaults: dict[str, str]) -> Column:
    """A map of fields with an unknown field for each key that it lacks (deep merge of
    the defaults); null becomes the defaults."""
    none = F.expr(_NONE)
    unknown = lambda value: F.struct(F.lit(value).alias("value"), F.lit("unknown").alias("status"), F.lit("unknown").alias("confidence"), none.alias("source"), none.alias("evidence"))
    all_ = F.create_map(*[x for k, v in defaults.items() for x in (F.lit(k), unknown(v))])
    return F.when(fields.isNull(), all_).otherwise(F.map_concat(fields, F.map_filter(all_, lambda k, _: ~F.array_contains(F.map_keys(fields), k))))


def plain_messages(messages: Column) -> Column:
    """Trimmed, not blank, each once, in order; null becomes none."""
    return F.array_distinct(F.filter(F.transform(F.coalesce(messages, F.expr(_NONE)), lambda m: F.trim(m)), lambda m: m != ""))


def appended(messages: Column, *more: Column) -> Column:
    """Messages with those that they don't hold yet."""
    return F.array_distinct(F.concat(messages, *more))


def repaired(record: dict[str, Column]) -> dict[str, Column]:
    """A record's sections (scene_type, signal, speed_estimates, collision, timeline,
    actors, insurance, candidates, uncertainties) with defaults and through all gates."""
    insurance = with_defaults(record["insurance"], dict.fromkeys(CLAIM_FIELDS, UNKNOWN))
    candidates = with_defaults(record["candidates"], ACCIDENTS)
    gates = {
        "scene_type": gate_scene(record["scene_type"]), "signal": gate_signal(record["signal"]), "speed_estimates": gate_speeds(record["speed_estimates"]), "collision": gate_collision(record["collision"]),
        "timeline": gate_timeline(record["timeline"]), "actors": gate_actors(record["actors"]), "insurance": gate_map(insurance, "insurance_claim_fields"), "candidates": gate_map(candidates, "accident_type_candidates"),
    }
    return {name: column for name, (column, _) in gates.items()} | {"uncertainties": appended(plain_messages(record["uncertainties"]), *[said for _, said in gates.values()])}


def summarised(summary: Column, uncertainties: Column) -> tuple[Column, Column]:
    """A summary without terms of legal judgement, and the note of what was removed."""
    terms = found_terms(summary)
    note = F.concat(F.lit("법적 판단 표현이 제거됨: "), F.array_join(terms, ", "))
    return redact(summary), F.when(F.size(terms) > 0, F.concat(uncertainties, F.array(note))).otherwise(uncertainties)


def valid_evidence(evidence: Column, ids: Column) -> Column:
    """Cited ids that are known, in order."""
    return F.filter(F.coalesce(evidence, F.expr(_NONE)), lambda e: F.array_contains(ids, e))


def below_medium(x: Column) -> Column:
    return rank_of(x["confidence"]) < 2


def _cited(items: Column, ids: Column) -> Column:
    return F.transform(items, lambda x: changed(x, evidence=valid_evidence(x["evidence"], ids)))


def _said(condition: Column, message: str) -> Column:
    return F.when(condition, F.array(F.lit(message))).otherwise(F.expr(_NONE))


def _downgraded(items: Column, bad: Callable[[Column], Column], message: str, **fields: Column | str | None) -> Gated:
    return F.transform(items, lambda x: F.when(bad(x), changed(x, **fields)).otherwise(x)), _said(F.coalesce(F.exists(items, bad), F.lit(False)), message)


def _checked_signal(signal: Column, detected: Column, name: str) -> Gated:
    """A signal as it was detected; unknown where none was, or with low confidence."""
    none, low = F.coalesce(~named_value(detected["value"]), F.lit(True)), rank_of(detected["confidence"]) < 2
    unknown = changed(signal, value=UNKNOWN, confidence="unknown")
    seen = changed(signal, value=detected["value"], confidence=detected["confidence"], evidence=F.coalesce(detected["evidence"], signal["evidence"]))
    held = F.when(signal.isNull(), signal).when(none, unknown).when(low, changed(unknown, evidence=F.expr(_NONE))).otherwise(seen)
    told = lambda why: F.array(F.lit(f"traffic_control.{name} 값이 {why} 강등됨"))
    return held, F.when(signal.isNull(), F.expr(_NONE)).when(none, told("전처리 근거 부족으로")).when(low, told("low confidence로")).otherwise(F.expr(_NONE))


def verified(record: dict[str, Column], ids: Column, contact_scores: Column, detected: Column) -> dict[str, Column]:
    """A record checked against preprocessing: known evidence ids, the scores of contact
    and impact events, and the signal that was detected (value, confidence, evidence).
    Sections: timeline, actors (movement, lane, lane_or_position), collision, signal and
    perhaps traffic_light, speed_estimates (value, numeric_kmh, range_kmh), accident_type.
    Without a known score of 35 or more, as with a null list, no collision is confirmed."""
    unsure = lambda x: ~some(x["evidence"]) | below_medium(x)
    timeline = _downgraded(_cited(record["timeline"], ids), unsure, "timeline 사건이 근거 부족으로 강등됨", confidence="unknown", event=NO_EVENT)
    actors = _downgraded(_cited(record["actors"], ids), unsure, "actor 세부 정보가 high-precision 정책으로 강등됨", confidence="unknown", movement=UNKNOWN, lane=UNKNOWN, lane_or_position=UNKNOWN)
    collision = changed(record["collision"], evidence=valid_evidence(record["collision"]["evidence"], ids))
    hit = F.coalesce(F.exists(contact_scores, lambda s: s >= 35), F.lit(False))
    lost = (collision["detected"] == F.lit(True)) & (~hit | below_medium(collision))
    lost = F.coalesce(lost, F.lit(False))
    collision = F.when(lost, changed(collision, detected=F.lit(False), confidence="unknown", note="전처리 충돌 후보 근거가 부족하여 충돌 확인 불가")).otherwise(collision)
    signals = {name: _checked_signal(record[name], detected, name) for name in ("signal", "traffic_light") if name in record}
    speeds = _downgraded(record["speed_estimates"], lambda x: x["numeric_kmh"].isNotNull() & below_medium(x), "speed estimate가 high-precision 정책으로 강등됨", value=NO_SPEED, numeric_kmh=None, range_kmh=None, confidence="unknown")
    sure = F.exists(actors[0], lambda x: some(x["evidence"]) & ~below_medium(x))
    hit = F.coalesce((collision["detected"] == F.lit(True)) | named_value(collision["impact_type"]), F.lit(False))
    reset = named_value(record["accident_type"]) & ~F.coalesce(sure, F.lit(False)) & ~hit
    said = [timeline[1], actors[1], _said(lost, "collision detected 값이 전처리 근거 부족으로 강등됨"), *[said for _, said in signals.values()], speeds[1], _said(F.coalesce(reset, F.lit(False)), "rag_hints.accident_type이 high-precision 정책으로 강등됨")]
    return {
        "timeline": timeline[0], "actors": actors[0], "collision": collision, **{name: column for name, (column, _) in signals.items()}, "speed_estimates": speeds[0],
        "accident_type": F.when(reset, UNKNOWN).otherwise(record["accident_type"]), "uncertainties": appended(F.coalesce(record["uncertainties"], F.expr(_NONE)), *said), "precision_policy": precision_policy(),
    }


def precision_policy() -> Column:
    """The policy that a verified record states."""
    policy = {"target_precision": ">=90% estimated for retained facts", "strategy": "unsupported_or_low_confidence_facts_downgraded_to_unknown", "recall_tradeoff": "ambiguous facts may remain 확인불가"}
    return F.create_map(*[F.lit(x) for pair in policy.items() for x in pair])


def is_known(value: Column) -> Column:
    """Neither null, blank nor one of the words for unknown; 0 and false are known."""
    return F.coalesce(~value.cast("string").isin("", UNKNOWN, "unknown", "Unknown", "UNKNOWN"), F.lit(False))


def result_quality(record: dict[str, Column]) -> Column:
    """Struct of what a final record states: summary, scene, signal, actors, timeline,
    collision (map of values), insurance (map of values), damage_parts, candidates
    (array of status, evidence, source), uncertainties."""
    aside = ("confidence", "source", "evidence", "note")
    told = F.exists(F.map_entries(record["collision"]), lambda e: ~e["key"].isin(*aside) & is_known(e["value"]))
    fields = F.map_filter(record["insurance"], lambda k, v: k.isin(*CLAIM_FIELDS) & is_known(v))
    n = F.coalesce(F.size(F.map_keys(fields)), F.lit(0)) + some(record["damage_parts"]).cast("int")
    candidate = F.exists(record["candidates"], lambda c: F.lower(c["status"]).isin("observed", "computed", "inferred", "candidate") & supported(c))
    count = lambda x: F.coalesce(F.size(x), F.lit(0))
    summary = F.coalesce(record["summary"], F.lit(""))
    return F.struct(
        (summary != "").alias("has_objective_summary"), is_known(record["scene"]).alias("scene_type_known"), is_known(record["signal"]).alias("traffic_signal_known"), count(record["actors"]).alias("actor_count"), count(record["timeline"]).alias("timeline_count"),
        F.coalesce(told, F.lit(False)).alias("collision_known"), count(record["uncertainties"]).alias("uncertainty_count"), F.length(summary).alias("objective_summary_chars"), n.alias("insurance_fields_known_count"), F.lit(len(CLAIM_FIELDS) + 1).alias("insurance_fields_total"),
        F.coalesce(candidate, F.lit(False)).alias("accident_type_candidate_known"),
    )


def predicted_accident(hint: Column, types: Column) -> Column:
    """The hint if it claims something, else what the actors' types make likely."""
    any_ = lambda *words: F.coalesce(F.exists(types, lambda t: F.greatest(*[t.contains(w).cast("int") for w in words], F.lit(0)) > 0), F.lit(False))
    person = any_("보행") | F.coalesce(F.array_contains(types, "person"), F.lit(False))
    by_type = F.when(person, "차대보행자").when(any_("자전거"), "차대자전거").when(any_("이륜", "오토바이"), "차대이륜차").when(F.size(F.array_distinct(types)) >= 2, "차대차")
    return F.when(named_value(hint) & (hint != ""), hint).otherwise(by_type)


def evaluated(record: dict[str, Column], object_code: Column, hint: Column, types: Column) -> Column:
    """Struct of five checks of a record against its label, their sum and its class."""
    expected = F.element_at(F.create_map(*[F.lit(x) for pair in OBJECTS.items() for x in pair]), object_code.try_cast("int"))
    predicted = predicted_accident(hint, types)
    checks = {
        "has_objective_summary": F.coalesce(record["summary"], F.lit("")) != "", "has_timeline": some(record["timeline"]), "has_traffic_control": some(record["traffic_control"]), "has_uncertainties": some(record["uncertainties"]),
        "accident_object_match": F.coalesce(expected == predicted, F.lit(False)),
    }
    score = sum((c.cast("int") for c in checks.values()), F.lit(0))
    return F.struct(expected.alias("expected"), predicted.alias("predicted"), *[c.alias(n) for n, c in checks.items()], score.alias("score"), F.when(score >= 4, "high").when(score >= 3, "medium").otherwise("low").alias("quality_bucket"))
