"""Queries of event rules, with DuckDB SQL written from the rules' conditions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import rules as R
from ..sources.tables import events, table
from .catalogue import EV_SQL, query

#: Tracks made of order lines: a video is a supplier, a moment an order number's remainder.
_B = (
    "b AS (SELECT l_suppkey AS video_id, l_returnflag || CAST(l_linenumber % 3 AS VARCHAR) AS track_id, CAST(l_orderkey % 12 AS DOUBLE) AS t, max(l_partkey % 600) AS x1, max(l_orderkey % 300) AS y1, max(l_partkey % 600) + 10 + CAST(max(l_quantity) AS BIGINT) AS x2, max(l_orderkey % 300) + 10 + CAST(min(l_quantity) AS BIGINT) AS y2 FROM lineitem GROUP BY 1, 2, 3), "
    "p AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY track_id, t) AS ord, (x2 - x1) * (y2 - y1) AS area, CAST(y2 - y1 AS DOUBLE) / (x2 - x1) AS ratio, (x1 + x2) / 2.0::DOUBLE AS cx, (y1 + y2) / 2.0::DOUBLE AS cy, count(*) OVER (PARTITION BY video_id, track_id) AS n FROM b), "
    "q AS (SELECT *, lag(area) OVER w AS area0, lag(cx) OVER w AS cx0, lag(cy) OVER w AS cy0, lag(t) OVER w AS t0 FROM p WINDOW w AS (PARTITION BY video_id, track_id ORDER BY t)), "
    "m AS (SELECT *, sqrt((cx - cx0) * (cx - cx0) + (cy - cy0) * (cy - cy0)) / (t - t0) AS speed, degrees(atan2(cy - cy0, cx - cx0)) AS a FROM q WHERE t0 IS NOT NULL AND n >= 3), "
    "m2 AS (SELECT *, lag(speed) OVER w AS s0, abs(lag(a) OVER w - a) AS d FROM m WINDOW w AS (PARTITION BY video_id, track_id ORDER BY t)), "
    "g AS (SELECT video_id, track_id, count(*) AS n, arg_min(area, t) AS a0, arg_max(area, t) AS a1, arg_min(ratio, t) AS r0, arg_max(ratio, t) AS r1, max(t) AS t FROM p GROUP BY ALL), "
    "i AS (SELECT a.video_id, a.t, a.track_id AS ta, b.track_id AS tb, CAST(greatest(0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0, least(a.y2, b.y2) - greatest(a.y1, b.y1)) AS DOUBLE) AS o, a.area + b.area AS s FROM p a JOIN p b ON a.video_id = b.video_id AND a.t = b.t AND a.ord < b.ord), "
    "v AS (SELECT *, o / (s - o) AS iou, row_number() OVER (PARTITION BY video_id, ta, tb ORDER BY t) AS k FROM i)"
)
_E = (
    "e AS (SELECT video_id, t, '급접근' AS event_type, track_id AS actors, a1 >= 4 * a0 AS strong, 28 AS signal, 6 AS seen, 6 AS more FROM g WHERE n >= 2 AND a0 > 0 AND a1 >= 2.5 * a0 "
    "UNION ALL SELECT video_id, t, '급접근후보', track_id, area >= 2.8 * area0, 24, 6, 6 FROM q WHERE area0 > 0 AND area >= 1.8 * area0 "
    "UNION ALL SELECT video_id, t, '사고후정지후보', track_id, s0 >= 35, 18, 6, 6 FROM m2 WHERE s0 >= 20 AND speed <= 0.35 * s0 "
    "UNION ALL SELECT video_id, t, '방향변화후보', track_id, least(d % 360, 360 - d % 360) >= 90, 16, 6, 6 FROM m2 WHERE least(d % 360, 360 - d % 360) >= 60 AND s0 >= 10 AND speed >= 10 "
    "UNION ALL SELECT video_id, t, '낙상후보', track_id, r1 <= 0.45 * r0, 18, 6, 6 FROM g WHERE n >= 3 AND left(track_id, 1) IN ('A', 'R') AND r1 < 0.65 * r0 "
    "UNION ALL SELECT video_id, t, '접촉', ta || '+' || tb, iou >= 0.12, 35 + 12 + 8, 6, CASE WHEN k > 1 THEN 4 ELSE 2 END FROM v WHERE iou >= 0.05)"
)


def _positions(spark: SparkSession, d: str) -> DataFrame:
    li, q = table(spark, d, "lineitem"), F.col("l_quantity")
    x, y = F.max(F.col("l_partkey") % 600), F.max(F.col("l_orderkey") % 300)
    track = F.concat("l_returnflag", (F.col("l_linenumber") % 3).cast("string")).alias("track_id")
    p = li.groupBy(F.col("l_suppkey").alias("video_id"), track, (F.col("l_orderkey") % 12).cast("double").alias("t")).agg(x.alias("x1"), y.alias("y1"), (x + 10 + F.max(q).cast("bigint")).alias("x2"), (y + 10 + F.min(q).cast("bigint")).alias("y2"))
    first = F.left("track_id", F.lit(1))
    p = p.withColumn("type", F.when(first == "A", "Person").when(first == "R", "자전거").otherwise("car"))
    p = p.withColumn("ord", F.row_number().over(Window.partitionBy("video_id").orderBy("track_id", "t")))
    return p.withColumn("frame_id", F.concat_ws("_", "track_id", F.col("t").cast("string")))


@query(f"WITH {_B}, {_E} SELECT video_id, t, event_type, actors, CASE WHEN strong THEN 'medium' ELSE 'low' END AS confidence, CAST(least(100, CASE WHEN strong THEN 20 ELSE 10 END + signal + seen + more) AS INTEGER) AS event_score FROM e")
def event_candidates(spark: SparkSession, d: str) -> DataFrame:
    e = R.event_candidates(_positions(spark, d))
    return e.select("video_id", "t", "event_type", F.array_join("actors", "+").alias("actors"), "confidence", "event_score")


#: Clip measures made of events: shakes, own speeds, motion and scan peaks of a user.
_C = (
    f"{EV_SQL}, s AS (SELECT user_id AS video_id, max(value) AS value, arg_max(us, (value, -event_id)) / 1e6::DOUBLE AS t, max(event_id) AS shown FROM ev WHERE event_type = 'error' GROUP BY 1), "
    "d AS (SELECT user_id AS video_id, count(*) AS n, arg_min(k, event_id) - arg_max(k, event_id) AS down, max_by(us, event_id) / 1e6::DOUBLE AS t FROM ev WHERE event_type = 'view' GROUP BY 1), "
    "c AS (SELECT user_id AS video_id, us / 1e6::DOUBLE AS t, CASE WHEN k >= 70 THEN 'high' WHEN k >= 40 THEN 'medium' ELSE 'low' END AS confidence, value / 20.0 AS flow FROM ev WHERE event_type = 'click'), "
    "a AS (SELECT user_id AS video_id, us / 1e6::DOUBLE AS t, CASE WHEN k >= 50 THEN 'medium' END AS confidence FROM ev WHERE event_type = 'signup' AND value > 30) "
)


@query(
    f"WITH {_C} SELECT video_id, t, '충격후보' AS event_type, 'low' AS confidence, 10 + 12 + 12 + CASE WHEN shown % 2 = 0 THEN 3 ELSE 0 END + CASE WHEN shown % 3 = 0 THEN 4 ELSE 2 END AS event_score FROM s WHERE value >= 20 "
    "UNION ALL SELECT video_id, t, '급감속', CASE WHEN down >= 30 THEN 'medium' ELSE 'low' END, CASE WHEN down >= 30 THEN 20 ELSE 10 END + 30 + 6 + 6 FROM d WHERE n >= 2 AND down >= 20 "
    "UNION ALL SELECT video_id, t, '광류급변후보', confidence, CASE confidence WHEN 'high' THEN 30 WHEN 'medium' THEN 20 ELSE 10 END + 22 + 3 + 6 FROM c WHERE flow >= 1.2 "
    "UNION ALL SELECT video_id, t, x, coalesce(confidence, 'low'), CASE confidence WHEN 'medium' THEN 20 ELSE 10 END + 14 + 2 FROM a, (VALUES ('접근'), ('비접촉후보')) AS y(x)"
)
def clip_events(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d).withColumns({"video_id": F.col("user_id"), "t": F.col("us") / 1e6})
    of = lambda kind: e.where(F.col("event_type") == kind)
    shakes = of("error").groupBy("video_id").agg(F.max("value").alias("value"), F.max_by("t", F.struct("value", -F.col("event_id"))).alias("t"), F.max("event_id").alias("shown"))
    shakes = shakes.withColumns({"compensated": F.when(F.col("shown") % 3 == 0, 1.0), "evidence": F.array(F.when(F.col("shown") % 2 == 0, F.col("shown").cast("string")).otherwise(""))})
    speeds = of("view").select("video_id", F.col("event_id").alias("ord"), F.col("k").alias("kmh"), "t", F.array(F.col("event_id").cast("string")).alias("evidence"))
    scans = of("click").select("video_id", "t", F.when(F.col("k") >= 70, "high").when(F.col("k") >= 40, "medium").otherwise("low").alias("confidence"), (F.col("value") / 20).alias("flow_peak"), F.array(F.lit("f")).alias("evidence"))
    motion = of("signup").select("video_id", F.lit("x").alias("actor_id"), F.when(F.col("value") > 30, "접근").otherwise("유지").alias("trend"), F.when(F.col("k") >= 50, "medium").alias("confidence"), "t")
    empty = spark.createDataFrame([], "video_id long, track_id string, type string, ord long, t double, frame_id string, x1 long, y1 long, x2 long, y2 long")
    found = R.event_candidates(empty, speeds=speeds, motion=motion, shakes=shakes, scans=scans)
    return found.select("video_id", "t", "event_type", "confidence", "event_score")


@query(f"WITH {_B}, {_E}, f AS (SELECT *, CASE WHEN strong THEN 20 ELSE 10 END + signal + seen + more AS x, CASE event_type WHEN '급접근' THEN 2 WHEN '급접근후보' THEN 3 WHEN '사고후정지후보' THEN 4 WHEN '방향변화후보' THEN 5 WHEN '낙상후보' THEN 6 ELSE 7 END AS r FROM e), k AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY least(100, x) DESC, t, r, string_split(actors, '+')) AS ord FROM f QUALIFY ord <= 24) SELECT video_id, 'seg_event_' || lpad(CAST(ord AS VARCHAR), 3, '0') AS id, event_type, greatest(0.0, t - 6) AS start, least(11.0, t + 4) AS \"end\" FROM k")
def event_segments(spark: SparkSession, d: str) -> DataFrame:
    best = R.best_events(R.event_candidates(_positions(spark, d))).withColumn("ord", F.col("rank")).withColumn("duration", F.lit(11.0))
    return R.segments(best, "duration").select("video_id", "id", "event_type", "start", "end")

