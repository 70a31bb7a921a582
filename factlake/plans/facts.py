"""Queries of final records: gates, verification, evaluation and metrics.

The records are made of events by arithmetic on their ids, in Spark as typed columns;
the SQL states what each gate has to give."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import facts as FA
from ..functions.scalar import UNKNOWN
from ..operators import metrics as M
from ..sources.tables import events, table
from .catalogue import EV_SQL, HOUR, query

_NONE = "CAST(array() AS array<string>)"


def _i() -> Column:
    return F.col("event_id")


def _list(when: Column, value: str = "e") -> Column:
    return F.when(when, F.array(F.lit(value))).otherwise(F.expr(_NONE))


def _field(value: str, status: Column, source: Column, evidence: Column) -> Column:
    return F.struct(F.lit(value).alias("value"), status.alias("status"), F.lit("low").alias("confidence"), _list(source).alias("source"), _list(evidence).alias("evidence"))


def _items(n: Column, item) -> Column:
    return F.transform(F.when(n > 0, F.sequence(F.lit(1).cast("bigint"), n)).otherwise(F.expr("CAST(array() AS array<bigint>)")), item)


def _record() -> dict[str, Column]:
    known = F.when(_i() % 3 == 0, "unknown").otherwise("observed")
    item = lambda j, *more: F.struct(*more, _list((_i() + j) % 3 == 0).alias("source"), _list((_i() + j) % 2 == 0).alias("evidence"))
    moved = lambda j: F.when((_i() + j) % 3 == 1, UNKNOWN).when((_i() + j) % 3 == 2, "접근")
    return {
        "scene_type": _field("교차로", known, _i() % 2 == 0, _i() % 5 < 3),
        "signal": F.struct(F.when(_i() % 4 == 1, UNKNOWN).when(_i() % 4 > 1, "적색").alias("value"), F.lit("observed").alias("status"), F.lit("low").alias("confidence"), _list(_i() % 3 == 0).alias("evidence"), _list(_i() % 7 == 0, "c").alias("crops")),
        "speed_estimates": _items(_i() % 3, lambda j: item(j, F.lit("v").alias("value"), F.when((_i() + j) % 5 > 0, (_i() % 100).cast("double")).alias("numeric_kmh"), F.lit("low").alias("confidence"))),
        "collision": F.when(_i() % 6 > 0, F.struct(F.lit("정면").alias("impact_type"), F.lit("앞").alias("impact_location"), F.lit("x").alias("damage_or_injury"), F.lit("low").alias("confidence"), _list(_i() % 2 == 0).alias("source"), _list(_i() % 5 == 0).alias("evidence"))),
        "timeline": _items(_i() % 4, lambda j: item(j, F.lit("충돌").alias("event"), F.lit("low").alias("confidence"))),
        "actors": _items(_i() % 5, lambda j: item(j, moved(j).alias("movement"), F.lit("low").alias("confidence"))),
        "insurance": F.when(_i() % 8 > 0, F.create_map(F.lit("location"), _field("서울", known, _i() % 4 == 0, _i() % 9 == 0), F.lit("lane_count"), _field("2", F.lit("unknown"), F.lit(False), F.lit(False)))),
        "candidates": F.create_map(F.lit("single_vehicle"), _field("단독사고", known, F.lit(False), _i() % 2 == 0)),
        "uncertainties": F.when(_i() % 2 == 0, F.array(F.lit(" 흐림 "), F.lit(""), F.lit("흐림"))),
    }


_A = FA.ADJUSTED
_S = "(event_id + j) % 3 = 0 OR (event_id + j) % 2 = 0"  # an item with a source or evidence
_SEQ = "range(1, event_id % {0} + 1)"
_BAD = {
    "scene": "event_id % 3 > 0 AND NOT (event_id % 2 = 0 AND event_id % 5 < 3)", "signal": "event_id % 4 > 1 AND event_id % 3 > 0 AND event_id % 7 > 0", "collision": "event_id % 6 > 0 AND event_id % 2 > 0 AND event_id % 5 > 0",
    "speed": f"(event_id + j) % 5 > 0 AND NOT ({_S})", "timeline": f"NOT ({_S})", "actor": f"(event_id + j) % 3 = 2 AND NOT ({_S})", "location": "event_id % 8 > 0 AND event_id % 3 > 0 AND event_id % 4 > 0 AND event_id % 9 > 0", "single": "event_id % 3 > 0 AND event_id % 2 > 0",
}


def _message(bad: str, text: str) -> str:
    return f"CASE WHEN {_BAD[bad]} THEN ['{_A}{text}'] ELSE [] END"


def _messages(bad: str, n: int, path: str, end: str = "") -> str:
    return f"['{_A}{path}[' || (j - 1) || ']{end}' FOR j IN {_SEQ.format(n)} IF {_BAD[bad]}]"


_SAID = (
    f"flatten([CASE WHEN event_id % 2 = 0 THEN ['흐림'] ELSE [] END, {_message('scene', 'scene_type')}, {_message('signal', 'traffic_control.signal')}, {_messages('speed', 3, 'speed_and_distance.speed_estimates')}, {_message('collision', 'collision')}, "
    f"{_messages('timeline', 4, 'timeline')}, {_messages('actor', 5, 'actors', '.movement')}, {_message('location', 'insurance_claim_fields.location')}, {_message('single', 'accident_type_candidates.single_vehicle')}])"
)


@query(
    f"SELECT event_id, CASE WHEN {_BAD['scene']} THEN '{UNKNOWN}|unknown|unknown|0' ELSE '교차로|' || CASE WHEN event_id % 3 = 0 THEN 'unknown' ELSE 'observed' END || '|low|' || CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END END AS scene, "
    f"CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 4 = 1 OR {_BAD['signal']} THEN '{UNKNOWN}' ELSE '적색' END AS signal, array_to_string([CASE WHEN {_BAD['speed']} THEN '모름/-/unknown' WHEN (event_id + j) % 5 = 0 THEN 'v/-/low' ELSE 'v/' || event_id % 100 || '/low' END FOR j IN {_SEQ.format(3)}], ',') AS speeds, "
    f"CASE WHEN event_id % 6 = 0 THEN NULL WHEN {_BAD['collision']} THEN '{UNKNOWN}|unknown' ELSE '정면|low' END AS collision, array_to_string([CASE WHEN {_BAD['timeline']} THEN '{FA.NO_EVENT}/unknown' ELSE '충돌/low' END FOR j IN {_SEQ.format(4)}], ',') AS timeline, "
    f"array_to_string([CASE WHEN (event_id + j) % 3 = 0 THEN '-' WHEN (event_id + j) % 3 = 1 OR {_BAD['actor']} THEN '{UNKNOWN}' ELSE '접근' END FOR j IN {_SEQ.format(5)}], ',') AS actors, "
    f"CASE WHEN event_id % 8 = 0 OR {_BAD['location']} THEN '{UNKNOWN}' ELSE '서울' END AS location, 7 AS insurance, 9 AS candidates, array_to_string({_SAID}, ';') AS uncertainties FROM events"
)
def payload_repair(spark: SparkSession, d: str) -> DataFrame:
    r = FA.repaired(_record())
    text = lambda x: F.coalesce(x.cast("string"), F.lit("-"))
    e = table(spark, d, "events").select("event_id", *[c.alias(n) for n, c in r.items()])
    return e.select(
        "event_id", F.concat_ws("|", "scene_type.value", "scene_type.status", "scene_type.confidence", F.size("scene_type.source").cast("string")).alias("scene"), F.col("signal.value").alias("signal"),
        F.array_join(F.transform("speed_estimates", lambda x: F.concat_ws("/", x["value"], text(x["numeric_kmh"].cast("int")), x["confidence"])), ",").alias("speeds"), F.when(F.col("collision").isNotNull(), F.concat_ws("|", "collision.impact_type", "collision.confidence")).alias("collision"),
        F.array_join(F.transform("timeline", lambda x: F.concat_ws("/", x["event"], x["confidence"])), ",").alias("timeline"), F.array_join(F.transform("actors", lambda x: text(x["movement"])), ",").alias("actors"),
        F.element_at("insurance", "location")["value"].alias("location"), F.size(F.map_keys("insurance")).alias("insurance"), F.size(F.map_keys("candidates")).alias("candidates"), F.array_join("uncertainties", ";").alias("uncertainties"),
    )


#: Verification: an item's evidence is known where its number is even.
_EV = "(event_id + j) % 2 = 0"
_MED = "(event_id + j) % 3 > 0"
#: Scores of contact events: a null list, none, only null, a null and a low one, a null and one of 35.
_LOST = "event_id % 2 = 0 AND (event_id % 5 < 4 OR event_id % 3 = 0)"
_SURE = f"len([j FOR j IN {_SEQ.format(4)} IF {_EV} AND {_MED}]) > 0"


@query(
    f"WITH x AS (SELECT event_id, ({_LOST}) AS lost, event_id % 7 > 0 AND event_id % 4 > 0 AND NOT ({_SURE}) AND NOT (event_id % 2 = 0 AND NOT ({_LOST})) AND event_id % 11 > 0 AS reset FROM events) SELECT event_id, array_to_string([CASE WHEN {_EV} AND {_MED} THEN '충돌/medium' ELSE '{FA.NO_EVENT}/unknown' END || CASE WHEN {_EV} THEN '/1' ELSE '/0' END FOR j IN {_SEQ.format(4)}], ',') AS timeline, "
    f"array_to_string([CASE WHEN {_EV} AND {_MED} THEN '접근/1차로/우측/medium' ELSE '{UNKNOWN}/{UNKNOWN}/{UNKNOWN}/unknown' END FOR j IN {_SEQ.format(4)}], ',') AS actors, event_id % 2 = 0 AND NOT lost AS detected, CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 5 = 0 OR event_id % 3 = 0 THEN '{UNKNOWN}' ELSE '녹색' END AS light, CASE WHEN event_id % 5 = 0 OR event_id % 3 = 0 THEN '{UNKNOWN}' ELSE '녹색' END AS signal, "
    f"array_to_string([CASE WHEN {_MED} THEN 'v:48-52' ELSE '모름:-' END FOR j IN {_SEQ.format(3)}], ',') AS speeds, CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 4 = 0 OR reset THEN '{UNKNOWN}' ELSE '차대차' END AS accident, "
    f"array_to_string(flatten([CASE WHEN len([j FOR j IN {_SEQ.format(4)} IF NOT ({_EV} AND {_MED})]) > 0 THEN ['timeline 사건이 근거 부족으로 강등됨', 'actor 세부 정보가 high-precision 정책으로 강등됨'] ELSE [] END, CASE WHEN lost THEN ['collision detected 값이 전처리 근거 부족으로 강등됨'] ELSE [] END, "
    f"CASE WHEN event_id % 5 = 0 THEN ['traffic_control.signal 값이 전처리 근거 부족으로 강등됨'] WHEN event_id % 3 = 0 THEN ['traffic_control.signal 값이 low confidence로 강등됨'] ELSE [] END, CASE WHEN event_id % 13 = 0 THEN [] WHEN event_id % 5 = 0 THEN ['traffic_control.traffic_light 값이 전처리 근거 부족으로 강등됨'] WHEN event_id % 3 = 0 THEN ['traffic_control.traffic_light 값이 low confidence로 강등됨'] ELSE [] END, CASE WHEN len([j FOR j IN {_SEQ.format(3)} IF NOT ({_MED})]) > 0 THEN ['speed estimate가 high-precision 정책으로 강등됨'] ELSE [] END, CASE WHEN reset THEN ['rag_hints.accident_type이 high-precision 정책으로 강등됨'] ELSE [] END]), ';') AS uncertainties FROM x"
)
def payload_verify(spark: SparkSession, d: str) -> DataFrame:
    item = lambda j, *more: F.struct(*more, F.when((_i() + j) % 3 == 0, "low").otherwise("medium").alias("confidence"), F.array(F.lit("made up"), F.when((_i() + j) % 2 == 0, "f1").otherwise("f9")).alias("evidence"))
    record = {
        "timeline": _items(_i() % 4, lambda j: item(j, F.lit("충돌").alias("event"))), "actors": _items(_i() % 4, lambda j: item(j, F.lit("접근").alias("movement"), F.lit("1차로").alias("lane"), F.lit("우측").alias("lane_or_position"))),
        "collision": F.struct((_i() % 2 == 0).alias("detected"), F.when(_i() % 11 == 0, "정면").alias("impact_type"), F.when(_i() % 3 == 0, "low").otherwise("high").alias("confidence"), F.array(F.lit("f1")).alias("evidence"), F.lit("").alias("note")),
        "signal": F.struct(F.lit("적색").alias("value"), F.lit("low").alias("confidence"), F.array(F.lit("f1")).alias("evidence")), "speed_estimates": _items(_i() % 3, lambda j: item(j, F.lit("v").alias("value"), F.lit(50.0).alias("numeric_kmh"), F.lit("48-52").alias("range_kmh"))),
        "traffic_light": F.when(_i() % 13 > 0, F.struct(F.lit("황색").alias("value"), F.lit("low").alias("confidence"), F.array(F.lit("f1")).alias("evidence"))),
        "accident_type": F.when(_i() % 7 > 0, F.when(_i() % 4 == 0, UNKNOWN).otherwise("차대차")), "uncertainties": F.lit(None).cast("array<string>"),
    }
    detected = F.struct(F.when(_i() % 5 > 0, "녹색").alias("value"), F.when(_i() % 3 == 0, "low").otherwise("high").alias("confidence"), F.array(F.lit("f2")).alias("evidence"))
    none = F.lit(None).cast("int")
    scores = F.when(_i() % 5 == 1, F.array().cast("array<int>")).when(_i() % 5 == 2, F.array(none)).when(_i() % 5 == 3, F.array(none, F.lit(34))).when(_i() % 5 == 4, F.array(none, F.lit(35)))
    v = FA.verified(record, F.array(F.lit("f1"), F.lit("f2")), scores, detected)
    e = table(spark, d, "events").select("event_id", *[c.alias(n) for n, c in v.items()])
    return e.select(
        "event_id", F.array_join(F.transform("timeline", lambda x: F.concat_ws("/", x["event"], x["confidence"], F.size(x["evidence"]).cast("string"))), ",").alias("timeline"), F.array_join(F.transform("actors", lambda x: F.concat_ws("/", x["movement"], x["lane"], x["lane_or_position"], x["confidence"])), ",").alias("actors"),
        F.col("traffic_light.value").alias("light"), F.col("collision.detected").alias("detected"), F.col("signal.value").alias("signal"), F.array_join(F.transform("speed_estimates", lambda x: F.concat(x["value"], F.lit(":"), F.coalesce(x["range_kmh"], F.lit("-")))), ",").alias("speeds"), F.col("accident_type").alias("accident"), F.array_join("uncertainties", ";").alias("uncertainties"),
    )


_SUMMARY = "CASE event_id % 4 WHEN 0 THEN '차량의 신호위반이 있었음' WHEN 1 THEN '과실과 책임' WHEN 2 THEN '객관 사실' ELSE '위반, 신호위반' END"


@query(f"SELECT event_id, CASE event_id % 4 WHEN 0 THEN '차량의 [법적 판단 표현 제거]이 있었음' WHEN 1 THEN '[법적 판단 표현 제거]과 [법적 판단 표현 제거]' WHEN 2 THEN '객관 사실' ELSE '[법적 판단 표현 제거], [법적 판단 표현 제거]' END AS summary, CASE event_id % 4 WHEN 0 THEN 'u;법적 판단 표현이 제거됨: 신호위반' WHEN 1 THEN 'u;법적 판단 표현이 제거됨: 과실, 책임' WHEN 2 THEN 'u' ELSE 'u;법적 판단 표현이 제거됨: 위반, 신호위반' END AS uncertainties FROM events")
def summary_terms(spark: SparkSession, d: str) -> DataFrame:
    summary, notes = FA.summarised(F.expr(_SUMMARY), F.array(F.lit("u")))
    return table(spark, d, "events").select("event_id", summary.alias("summary"), F.array_join(notes, ";").alias("uncertainties"))


@query(
    f"SELECT event_id, event_id % 3 > 0 AS has_objective_summary, event_id % 4 > 1 AS scene_type_known, event_id % 5 > 0 AS traffic_signal_known, CAST(event_id % 3 AS INTEGER) AS actor_count, CAST(event_id % 4 AS INTEGER) AS timeline_count, event_id % 2 = 0 AS collision_known, 0 AS uncertainty_count, CASE WHEN event_id % 3 > 0 THEN 2 ELSE 0 END AS objective_summary_chars, "
    "1 + CAST(event_id % 4 > 0 AS INTEGER) + CAST(event_id % 6 = 0 AS INTEGER) AS insurance_fields_known_count, 8 AS insurance_fields_total, event_id % 3 > 0 AND event_id % 2 = 0 AS accident_type_candidate_known FROM events"
)
def result_quality(spark: SparkSession, d: str) -> DataFrame:
    some = lambda n: _items(_i() % n, lambda j: j)
    word = F.when(_i() % 2 == 0, "0").otherwise(UNKNOWN)
    record = {
        "summary": F.when(_i() % 3 > 0, "요약"), "scene": F.when(_i() % 4 == 1, "unknown").when(_i() % 4 > 1, "도로"), "signal": F.when(_i() % 5 > 0, "false").otherwise(""), "actors": some(3), "timeline": some(4),
        "collision": F.create_map(F.lit("note"), F.lit("x"), F.lit("impact_type"), word), "insurance": F.create_map(F.lit("location"), F.lit("서울"), F.lit("lane_count"), F.when(_i() % 4 > 0, "2").otherwise(UNKNOWN), F.lit("another"), F.lit("x")),
        "damage_parts": _list(_i() % 6 == 0), "candidates": F.array(F.struct(F.when(_i() % 3 > 0, "Observed").otherwise("unknown").alias("status"), _list(_i() % 2 == 0).alias("evidence"), F.expr(_NONE).alias("source"))), "uncertainties": F.lit(None).cast("array<string>"),
    }
    return table(spark, d, "events").select("event_id", FA.result_quality(record).alias("q")).select("event_id", "q.*")


@query(
    f"WITH x AS (SELECT event_id, CASE event_id % 6 WHEN 1 THEN '차대보행자' WHEN 2 THEN '차대차' WHEN 3 THEN '차대이륜차' WHEN 4 THEN '차대자전거' END AS expected, CASE event_id % 5 WHEN 0 THEN '차대차' ELSE CASE event_id % 4 WHEN 0 THEN '차대보행자' WHEN 1 THEN '차대자전거' WHEN 2 THEN '차대차' END END AS predicted FROM events), "
    "y AS (SELECT *, event_id % 3 > 0 AS a, event_id % 2 = 0 AS b, event_id % 4 > 0 AS c, event_id % 5 < 3 AS d, coalesce(expected = predicted, false) AS e FROM x), z AS (SELECT *, CAST(a AS INTEGER) + CAST(b AS INTEGER) + CAST(c AS INTEGER) + CAST(d AS INTEGER) + CAST(e AS INTEGER) AS score FROM y) "
    "SELECT event_id, expected, predicted, a AS has_objective_summary, b AS has_timeline, c AS has_traffic_control, d AS has_uncertainties, e AS accident_object_match, score, CASE WHEN score >= 4 THEN 'high' WHEN score >= 3 THEN 'medium' ELSE 'low' END AS quality_bucket FROM z"
)
def label_eval(spark: SparkSession, d: str) -> DataFrame:
    types = F.when(_i() % 4 == 0, F.array(F.lit("보행자"), F.lit("car"))).when(_i() % 4 == 1, F.array(F.lit("자전거"))).when(_i() % 4 == 2, F.array(F.lit("car"), F.lit("truck"))).otherwise(F.array(F.lit("car"), F.lit("car")))
    record = {"summary": F.when(_i() % 3 > 0, "x"), "timeline": _list(_i() % 2 == 0), "traffic_control": _list(_i() % 4 > 0), "uncertainties": _list(_i() % 5 < 3)}
    e = FA.evaluated(record, (_i() % 6).cast("string"), F.when(_i() % 5 == 0, "차대차").when(_i() % 5 == 1, UNKNOWN), types)
    return table(spark, d, "events").select("event_id", e.alias("x")).select("event_id", "x.*")


_MANIFEST = (
    f"{EV_SQL}, l AS (SELECT DISTINCT user_id AS video_id, CASE WHEN user_id % 4 > 0 THEN {12 * HOUR} END AS moment, CASE user_id % 3 WHEN 0 THEN [] ELSE ['click', 'view', 'other', 'view'] END AS actors FROM ev), "
    f"b AS (SELECT user_id AS video_id, us % {24 * HOUR} AS t FROM ev QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY k DESC, event_id) <= 3), r AS (SELECT l.video_id, CASE WHEN max(moment) IS NOT NULL THEN CAST(coalesce(max(CASE WHEN abs(t - moment) <= {6 * HOUR} THEN 1.0 END), 0.0) AS DOUBLE) END AS recall FROM l JOIN b ON b.video_id = l.video_id GROUP BY 1), "
    "s AS (SELECT user_id AS video_id, list(DISTINCT event_type) AS seen FROM ev GROUP BY 1), a AS (SELECT l.video_id, CASE WHEN len(actors) > 0 THEN round_even(len([x FOR x IN actors IF list_contains(seen, x)]) * 10000.0 / len(actors), 0) / 10000 END AS recall, CASE WHEN len(seen) = 0 THEN 0.0 ELSE round_even(len([x FOR x IN seen IF NOT list_contains(actors, x)]) * 10000.0 / len(seen), 0) / 10000 END AS false FROM l JOIN s ON s.video_id = l.video_id), "
    "c AS (SELECT user_id AS video_id, round_even(CAST(sum(CAST(1.0::DOUBLE - least(coalesce(CASE WHEN k > 20 THEN k END, 0) / 100.0::DOUBLE, 1.0::DOUBLE) AS DECIMAL(18,6))) AS DOUBLE) / count(*) * 10000, 0) / 10000 AS cont, round_even(CAST(sum(CAST(coalesce(CASE WHEN k > 20 THEN k END, 0) / 100.0::DOUBLE AS DECIMAL(18,6))) AS DOUBLE) / count(*) * 10000, 0) / 10000 AS frag FROM ev GROUP BY 1)"
)


@query(
    f"WITH {_MANIFEST} SELECT l.video_id, r.recall AS frame_recall, r.recall AS collision_recall_at_3, a.recall AS actor_recall, round_even((1.0::DOUBLE - a.recall) * 10000.0, 0) / 10000 AS actor_miss_rate, a.false AS actor_false_positive_rate, cont AS tracking_continuity, frag AS track_fragmentation_rate, "
    "CASE WHEN l.video_id % 5 > 0 THEN CASE WHEN l.video_id % 2 = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END END AS signal_accuracy, CASE WHEN l.video_id % 6 > 0 THEN CASE WHEN l.video_id % 7 = 2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END END AS lane_count_accuracy, CASE WHEN l.video_id % 8 > 0 THEN CASE WHEN l.video_id % 3 > 0 AND l.video_id % 10 <= 3 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END END AS ocr_speed_accuracy, "
    "CASE WHEN l.video_id % 4 = 0 THEN 1.0::DOUBLE ELSE 0.6667::DOUBLE END AS insurance_known_unknown_appropriateness, CASE WHEN l.video_id % 3 = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS uncertainty_presence FROM l JOIN r ON r.video_id = l.video_id JOIN a ON a.video_id = l.video_id JOIN c ON c.video_id = l.video_id"
)
def preprocessing_metrics(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d).withColumn("video_id", F.col("user_id"))
    v = F.col("video_id")
    actors = F.when(v % 3 == 0, F.expr(_NONE)).otherwise(F.array(*[F.lit(x) for x in ("click", "view", "other", "view")]))
    hours = 0.75 / (6 * HOUR)  # the reach of six hours in the measure's seconds
    labels = e.select("video_id").distinct().select("video_id", F.when(v % 4 > 0, 12 * HOUR * hours).alias("collision_t"), actors.alias("actors"), F.when(v % 5 > 0, "적색").alias("signal"), F.when(v % 6 > 0, 2).alias("lanes"), F.when(v % 8 > 0, 50.0).alias("speed"))
    best = e.select("video_id", (F.col("us") % (24 * HOUR) * hours).alias("t"), F.col("k").alias("score"), F.col("event_id").alias("ord"))
    tracks = e.select("video_id", F.col("event_type").alias("track_id"), F.when(F.col("k") > 20, F.col("k")).alias("fragmentation"))
    field = lambda value, confidence: F.struct(value.cast("string").alias("value"), confidence.cast("string").alias("confidence"))
    fields = F.array(field(F.lit(UNKNOWN), F.lit("low")), field(F.lit("0"), F.lit("low")), field(F.lit(""), F.when(v % 4 == 0, "unknown").otherwise("low")))
    results = labels.select("video_id", F.when(v % 2 == 0, "적색").otherwise("녹색").alias("signal"), (v % 7).cast("int").alias("lanes"), F.when(v % 3 > 0, 50.0 + v % 10).alias("speed"), fields.alias("fields"), _list(v % 3 == 0).alias("uncertainties"))
    return M.preprocessing_metrics(labels, best, tracks, results)
