"""Queries of sampling plans, jobs, roads and storyboards, with DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import storyboard as SB
from ..operators import jobs, roads, sampling
from ..sources.tables import events, table
from .catalogue import EV_SQL, query
from .frames import dealt

#: Clips made of parts: length, rate, frames, and an event's time (none each seventh).
_CLIPS = "c AS (SELECT p_partkey, CAST(p_size + p_partkey % 3 * 0.5 AS DOUBLE) AS dur, CAST(floor((p_size + p_partkey % 3 * 0.5) * 10.0) AS BIGINT) AS n, CASE WHEN p_partkey % 7 > 0 THEN CAST(p_partkey % 23 * p_size / 23.0::DOUBLE AS DOUBLE) END AS center FROM part)"
_FRAME = "CAST(greatest(0, least(n - 1, round_even({0} * 10.0, 0))) AS BIGINT)"


def _clips(spark: SparkSession, d: str) -> DataFrame:
    i, size = F.col("p_partkey"), F.col("p_size")
    dur = (size + i % 3 * 0.5).cast("double")
    return table(spark, d, "part").select("p_partkey", dur.alias("dur"), F.lit(10.0).alias("fps"), F.floor(dur * 10.0).cast("bigint").alias("n"), F.when(i % 7 > 0, i % 23 * size / 23.0).alias("center"))


def _windows(reach: float) -> str:
    return f"w AS (SELECT *, greatest(0.0, center - 6) AS a, least(dur, center + 4) AS b, greatest(greatest(0.0, center - 6), center - {reach}) AS i0, least(least(dur, center + 4), center + {reach}) AS i1, greatest(greatest(0.0, center - 6), center - 2.5) AS p0 FROM c WHERE center IS NOT NULL)"


def _limit(source: str, most: int) -> str:
    """Even rows of each part, by frame."""
    return f"SELECT p_partkey, frame, purpose FROM (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY frame) - 1 AS i, count(*) OVER (PARTITION BY p_partkey) - 1 AS l FROM {source}) WHERE l < {most} OR i IN (SELECT CAST(round_even(j * l / {most - 1}.0, 0) AS BIGINT) FROM generate_series(0, {most - 1}) AS t(j))"


def _named(kinds: tuple[str, ...]) -> str:
    bounds = (("a", "greatest(a, p0)"), ("p0", "center"), ("i0", "i1"), ("least(b, i1)", "b"))
    return "g AS (" + " UNION ALL ".join(f"SELECT p_partkey, n, a, b, {o} AS o, '{kind}' AS purpose, {x} AS s0, {y} AS s1, {k} AS k FROM w" for o, (kind, (x, y), k) in enumerate(zip(kinds, bounds, (5, 6, 5, 4), strict=True))) + ")"


_MERGE = "SELECT p_partkey, frame, string_agg(purpose, '+' ORDER BY o) AS purpose FROM (SELECT p_partkey, frame, purpose, min(o) AS o FROM {0} GROUP BY ALL) GROUP BY p_partkey, frame"


@query(
    f"WITH {_CLIPS}, {_windows(0.75)}, {_named(('pre_context', 'pre_impact', 'impact_candidate', 'post_impact'))}, "
    f"s AS (SELECT p_partkey, o, purpose, {_FRAME.format('(CASE WHEN s1 <= s0 THEN s0 ELSE s0 + j * ((s1 - s0) / (k - 1)) END)')} AS frame FROM g, generate_series(0, 5) AS t(j) WHERE j = 0 OR j < k AND s1 > s0), m AS ({_MERGE.format('s')}), "
    f"few AS (SELECT p_partkey FROM m GROUP BY 1 HAVING count(*) < 20), x AS (SELECT p_partkey, frame, purpose, 0 AS o FROM m UNION ALL SELECT w.p_partkey, {_FRAME.format('(CASE WHEN b <= a THEN a ELSE a + j * ((b - a) / 19) END)')}, 'event_window_context', 1 FROM w JOIN few ON few.p_partkey = w.p_partkey, generate_series(0, 19) AS t(j) WHERE j = 0 OR b > a), "
    f"y AS ({_MERGE.format('x')}), r AS (SELECT DISTINCT p_partkey, CAST(round_even(j * greatest(dur / 19, 0.001) * 10.0, 0) AS BIGINT) AS frame, 'regular_context' AS purpose FROM c, generate_series(0, 40) AS t(j) WHERE center IS NULL AND j <= floor(dur / greatest(dur / 19, 0.001) + 1e-9) AND round_even(j * greatest(dur / 19, 0.001) * 10.0, 0) <= floor(dur * 10.0 + 1e-9)), z AS (SELECT * FROM y UNION ALL SELECT * FROM r) {_limit('z', 20)}"
)
def event_window_plan(spark: SparkSession, d: str) -> DataFrame:
    return sampling.window_plan(_clips(spark, d), "center", "dur", "fps", "n").select("p_partkey", "frame", "purpose")


@query(
    f"WITH {_CLIPS}, {_windows(0.35)}, {_named(('event_scan_pre_context', 'event_scan_pre_impact', 'event_scan_impact_candidate', 'event_scan_post_impact'))}, q AS (SELECT *, CAST(floor((s1 - s0 + 1e-9) * 15) AS BIGINT) AS m FROM g), "
    f"s AS (SELECT p_partkey, o, purpose, {_FRAME.format('(CASE WHEN s1 <= s0 THEN s0 WHEN m + 1 < k THEN s0 + j * ((s1 - s0) / (k - 1)) ELSE s0 + j / 15.0 END)')} AS frame FROM q, generate_series(0, 120) AS t(j) WHERE j = 0 OR s1 > s0 AND j <= CASE WHEN m + 1 < k THEN k - 1 ELSE m END), "
    f"m AS ({_MERGE.format('s')}), h AS (SELECT *, contains(purpose, 'impact_candidate') AS hit, count(*) OVER (PARTITION BY p_partkey) AS l FROM m), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY p_partkey, hit ORDER BY frame) - 1 AS i, count(*) OVER (PARTITION BY p_partkey, hit) - 1 AS last, least(5, count(*) FILTER (hit) OVER (PARTITION BY p_partkey)) AS kept FROM h), "
    "k AS (SELECT *, CASE WHEN hit THEN kept ELSE 20 - kept END AS most FROM r) SELECT p_partkey, frame, purpose, l <= 20 OR last < most OR i IN (SELECT CAST(round_even(j * last / CAST(most - 1 AS DOUBLE), 0) AS BIGINT) FROM generate_series(0, most - 1) AS t(j)) AS selected FROM k"
)
def precision_plan(spark: SparkSession, d: str) -> DataFrame:
    return sampling.precision_plan(dealt(_clips(spark, d), "p_partkey"), "center", "dur", "fps", "n").select("p_partkey", "frame", "purpose", "selected")


@query(f"WITH {EV_SQL}, s AS (SELECT user_id, event_id, least(20, k // 3 + 1) AS n FROM ev), t AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM s) SELECT user_id, event_id, event_id + 3 * j AS frame FROM t, generate_series(0, 19) AS g(j) WHERE j < least(n, 300 - before)")
def dense_frames(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d).withColumn("end", F.col("event_id") + F.col("k"))
    return sampling.dense_frames(e.withColumn("start", F.col("event_id")), "user_id", "event_id", "start", "end", 3, 20, 300)


@query("SELECT p_partkey, CAST(i AS BIGINT) AS frame_index FROM part, generate_series(0, 60) AS t(i) WHERE i < p_size AND i % 7 = 0")
def strided_scan(spark: SparkSession, d: str) -> DataFrame:
    return sampling.strided(table(spark, d, "part").select("p_partkey", "p_size"), "p_size", 7).select("p_partkey", "frame_index")


@query(f"WITH {EV_SQL} SELECT user_id, arg_max(us, (value, -event_id)) AS center FROM ev WHERE k >= 20 GROUP BY user_id")
def primary_event(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d).withColumn("t", F.when(F.col("k") >= 20, F.col("us")))
    return sampling.primary_event(e, ["user_id"], "value", "t", "event_id")


#: Job updates made of events.
_STATES = {"signup": "queued", "view": "running", "click": "running", "purchase": "succeeded", "error": "failed"}
_STATE = "CASE event_type " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in _STATES.items()) + " END"


def _updates(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d)
    state = F.coalesce(*[F.when(F.col("event_type") == a, b) for a, b in _STATES.items()])
    return e.select("user_id", F.col("event_id").alias("seq"), state.alias("status"), F.when(F.col("k") > 50, F.col("k")).alias("progress"))


@query(f"WITH {EV_SQL} SELECT user_id, max(event_id) AS seq, arg_max({_STATE}, event_id) AS status, max_by(k, event_id) FILTER (k > 50) AS progress FROM ev GROUP BY user_id")
def job_states(spark: SparkSession, d: str) -> DataFrame:
    return jobs.latest(_updates(spark, d), "user_id")


@query(f"WITH {EV_SQL}, s AS (SELECT user_id, event_id AS seq, {_STATE} AS status, lag({_STATE}) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM ev) SELECT user_id, seq, before, status FROM s WHERE before IN ('succeeded', 'failed') OR before = 'queued' AND status NOT IN ('running', 'failed') OR before = 'running' AND status = 'queued'")
def job_faults(spark: SparkSession, d: str) -> DataFrame:
    return jobs.wrong_steps(_updates(spark, d), "user_id").select("user_id", "seq", "before", "status")


#: Speed estimates made of orders.
_METHOD = {"1-URGENT": "gps", "2-HIGH": "ocr_overlay", "3-MEDIUM": "bev_tracking_estimate", "4-NOT SPECIFIED": "relative_motion_only"}


@query(
    "WITH p AS (SELECT o_custkey, o_orderkey, o_totalprice, CASE o_orderpriority " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in _METHOD.items()) + " ELSE 'guess' END AS method FROM orders), b AS (SELECT *, CASE method WHEN 'gps' THEN 1 WHEN 'ocr_overlay' THEN 3 WHEN 'bev_tracking_estimate' THEN 4 ELSE 5 END AS r FROM p WHERE method <> 'guess' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY r, o_orderkey) = 1) "
    "SELECT c_custkey AS o_custkey, coalesce(method, 'not_available') AS method, o_totalprice, CASE WHEN o_totalprice IS NOT NULL THEN round_even(greatest(0.0, 50000.0 - o_totalprice) * 1000.0, 0) / 1000 END AS low, CASE WHEN o_totalprice IS NOT NULL THEN round_even((50000.0 + o_totalprice) * 1000.0, 0) / 1000 END AS high FROM customer LEFT JOIN b ON c_custkey = o_custkey"
)
def best_speed(spark: SparkSession, d: str) -> DataFrame:
    method = F.coalesce(*[F.when(F.col("o_orderpriority") == a, b) for a, b in _METHOD.items()], F.lit("guess"))
    e = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice", method.alias("method"))
    b = roads.best_speed(e, table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "method", "o_orderkey")
    b = b.withColumn("r", F.when(F.col("o_totalprice").isNotNull(), roads.speed_range(F.col("o_totalprice"), F.lit(50000.0))))
    return b.select("o_custkey", "method", "o_totalprice", "r.low", "r.high")


@query("WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 5 > 0 THEN p_size % 6 END AS a, CASE WHEN p_partkey % 4 > 0 THEN CAST(p_partkey % 6 AS INTEGER) END AS b, p_size % 7 AS n, p_partkey % 3 > 0 AS m, p_partkey % 2 = 0 AS w FROM part) SELECT p_partkey, CASE WHEN a IS NULL THEN b WHEN b IS NULL THEN a WHEN abs(a - b) <= 1 THEN CAST(round_even((a + b) / 2.0::DOUBLE, 0) AS INTEGER) ELSE a END AS lanes, CASE WHEN m THEN round_even((0.55::DOUBLE * least(1.0::DOUBLE, n / 3.0::DOUBLE) + 0.45::DOUBLE * CASE WHEN w THEN 1.0::DOUBLE ELSE 0.4::DOUBLE END) * 1000, 0) / 1000 ELSE 0.0 END AS score FROM p")
def lane_votes(spark: SparkSession, d: str) -> DataFrame:
    i, size = F.col("p_partkey"), F.col("p_size")
    lines, mask = F.when(i % 5 > 0, size % 6), F.when(i % 4 > 0, (i % 6).cast("int"))
    return table(spark, d, "part").select("p_partkey", roads.lane_vote(lines, mask).alias("lanes"), roads.geometry_score(size % 7, i % 3 > 0, i % 2 == 0).alias("score"))


_LINES = "l AS (SELECT l_orderkey, l_linenumber AS o, l_linenumber * 10.0::DOUBLE AS x1, l_quantity AS y1, CAST(l_suppkey % 40 AS DOUBLE) AS x2, CAST(l_partkey % 90 AS DOUBLE) AS y2 FROM lineitem)"


@query(f"WITH {_LINES}, p AS (SELECT a.l_orderkey, a.x1, a.y1, a.x2, a.y2, b.x1 AS x3, b.y1 AS y3, b.x2 AS x4, b.y2 AS y4, (a.x1 - a.x2) * (b.y1 - b.y2) - (a.y1 - a.y2) * (b.x1 - b.x2) AS d FROM l a JOIN l b ON a.l_orderkey = b.l_orderkey AND (a.o, a.x2, a.y2, a.y1) < (b.o, b.x2, b.y2, b.y1)), q AS (SELECT l_orderkey, ((x1 * y2 - y1 * x2) * (x3 - x4) - (x1 - x2) * (x3 * y4 - y3 * x4)) / d AS px, ((x1 * y2 - y1 * x2) * (y3 - y4) - (y1 - y2) * (x3 * y4 - y3 * x4)) / d AS py FROM p WHERE abs(d) >= 1e-6) SELECT l_orderkey, round_even(median(px) * 1000, 0) / 1000 AS x, round_even(median(py) * 1000, 0) / 1000 AS y FROM q GROUP BY 1")
def vanishing_points(spark: SparkSession, d: str) -> DataFrame:
    # the order of two lines with one number is that of their places, as in the SQL
    n = F.col("l_linenumber")
    l = table(spark, d, "lineitem").select("l_orderkey", F.struct(n.alias("n"), (F.col("l_suppkey") % 40).cast("double").alias("x2"), (F.col("l_partkey") % 90).cast("double").alias("y2"), F.col("l_quantity").alias("y1")).alias("o"), (n * 10.0).alias("x1"), F.col("l_quantity").alias("y1"), (F.col("l_suppkey") % 40).cast("double").alias("x2"), (F.col("l_partkey") % 90).cast("double").alias("y2"))  # noqa: E741
    return roads.vanishing_points(l, ["l_orderkey"], "o")


@query("WITH l AS (SELECT l_suppkey, list(CAST(l_partkey % 640 AS DOUBLE) ORDER BY l_partkey % 640) AS x FROM lineitem GROUP BY 1), g AS (SELECT l_suppkey, median(CAST(d AS DOUBLE)) AS gap FROM (SELECT l_suppkey, l_partkey % 640 - lag(l_partkey % 640) OVER (PARTITION BY l_suppkey ORDER BY l_partkey % 640) AS d FROM lineitem) GROUP BY 1) SELECT l.l_suppkey, CAST(len(list_reduce([[v] FOR v IN x], lambda a, v: CASE WHEN v[1] - a[-1] > 0.08 * 640 THEN list_concat(a, v) ELSE a END)) AS INTEGER) AS boundaries, gap FROM l JOIN g ON g.l_suppkey = l.l_suppkey")
def lane_boundaries(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "lineitem").select("l_suppkey", (F.col("l_partkey") % 640).alias("x"), F.lit(640).alias("w"))
    return roads.lane_boundaries(p, ["l_suppkey"], "x", "w")


@query("WITH m AS (SELECT l_suppkey, median(l_quantity) AS a, median(l_discount) AS b, median(l_tax) AS c, median(CAST(l_linenumber AS DOUBLE)) AS e FROM lineitem GROUP BY 1) SELECT l_suppkey, round_even(a * 1000000, 0) / 1000000 AS m00, round_even(b * 1000000, 0) / 1000000 AS m01, round_even(c * 1000000, 0) / 1000000 AS m10, round_even(e * 1000000, 0) / 1000000 AS m11 FROM m")
def median_matrix(spark: SparkSession, d: str) -> DataFrame:
    rows = F.array(F.array("l_quantity", "l_discount"), F.array(F.col("l_tax"), F.col("l_linenumber").cast("double")))
    m = roads.median_matrix(table(spark, d, "lineitem").select("l_suppkey", rows.alias("m")), ["l_suppkey"], "m")
    return m.select("l_suppkey", *[F.col("m")[i][j].alias(f"m{i}{j}") for i in (0, 1) for j in (0, 1)])


@query(
    "WITH p AS (SELECT p_partkey, p_partkey % 4 = 0 AS c, p_partkey % 5 = 0 AS s, p_size % 4 AS l, CASE p_partkey % 6 WHEN 0 THEN ['crosswalk'] WHEN 1 THEN ['stop_line', 'other', 'centerline_yellow'] ELSE [] END AS m FROM part), "
    "q AS (SELECT p_partkey, list_concat(list_concat(CASE WHEN c THEN ['횡단보도:medium:traffic_control'] ELSE [] END, CASE WHEN s THEN ['교차로:low:traffic_signal_presence'] ELSE [] END), list_concat(CASE WHEN l >= 2 THEN ['일반도로:high:road_geometry'] ELSE [] END, CASE p_partkey % 6 WHEN 0 THEN ['횡단보도:medium:road_marking_candidate'] WHEN 1 THEN ['정지선:medium:road_marking_candidate', '중앙선:medium:road_marking_candidate'] ELSE [] END)) AS x FROM p) SELECT p_partkey, CASE WHEN len(x) = 0 THEN '확인불가:unknown:not_available' ELSE array_to_string(x, ',') END AS scenes FROM q"
)
def scene_candidates(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("p_partkey")
    seen = lambda c: F.struct(c.alias("visible"), F.lit(None).cast("string").alias("confidence"))
    kinds = F.when(i % 6 == 0, F.array(F.lit("crosswalk"))).when(i % 6 == 1, F.array(F.lit("stop_line"), F.lit("other"), F.lit("centerline_yellow")))
    marks = F.transform(kinds, lambda t: F.struct(t.alias("type"), F.lit(None).cast("string").alias("confidence")))
    lanes = F.struct((F.col("p_size") % 4).alias("value"), F.lit("high").alias("confidence"))
    found = roads.scenes(seen(i % 4 == 0), seen(i % 5 == 0), lanes, marks, F.array())
    return table(spark, d, "part").select("p_partkey", F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["value"], x["confidence"], x["source"])), ",").alias("scenes"))


_PURPOSES = ("sign_crop", "pre_context", "motion_keyframe", "impact_candidate", "post_impact", "actor_crop", "failure_case")
_PHASES = ("insurance_context", "pre_event", "approach", "impact_candidate", "post_event", "detail", "scene_context")


@query(
    f"WITH {EV_SQL}, x AS (SELECT event_id, user_id, {list(_PHASES)}[event_id % 7 + 1] AS phase, {list(_PURPOSES)}[event_id % 7 + 1] AS purpose, k FROM ev) SELECT event_id, phase, CASE phase WHEN 'scene_context' THEN 1 WHEN 'insurance_context' THEN 0 WHEN 'pre_event' THEN 2 WHEN 'approach' THEN 3 WHEN 'impact_candidate' THEN 4 WHEN 'post_event' THEN 5 ELSE 6 END AS phase_order, "
    "'[slot ' || lpad(CAST(k AS VARCHAR), 2, '0') || '] ' || phase || chr(10) || 'path: f' || event_id || chr(10) || 'why: phase:' || phase || ', purpose:' || purpose || CASE WHEN k > 10 THEN ', importance:' || k ELSE '' END || ', frame:f' || event_id || CASE WHEN user_id % 2 = 0 THEN ', actor-linked' ELSE '' END AS caption FROM x"
)
def storyboard_fields(spark: SparkSession, d: str) -> DataFrame:
    e, i, k = events(spark, d), F.col("event_id"), F.col("k")
    purpose = F.get(F.array(*[F.lit(p) for p in _PURPOSES]), (i % 7).cast("int"))
    path = F.concat(F.lit("f"), i.cast("string"))
    phase = SB.phase_of(purpose)
    why = SB.why_selected(phase, purpose, F.when(k > 10, k), path, F.col("user_id") % 2 == 0)
    return e.select("event_id", phase.alias("phase"), SB.phase_order(phase).alias("phase_order"), SB.caption(k, path, phase, why).alias("caption"))


@query("WITH g AS (SELECT l_orderkey, list(DISTINCT CAST(l_suppkey AS VARCHAR)) AS ids, list(l_returnflag ORDER BY l_linenumber, l_returnflag) AS types FROM lineitem GROUP BY 1), t AS (SELECT l_orderkey, array_to_string(list_sort(ids), ',') AS ids, array_to_string([types[i] FOR i IN range(1, len(types) + 1) IF list_position(types, types[i]) = i], ',') AS types FROM g) SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS VARCHAR) ELSE coalesce(ids, '') END AS ids, coalesce(types, '') AS types FROM orders LEFT JOIN t ON l_orderkey = o_orderkey")
def linked_actors(spark: SparkSession, d: str) -> DataFrame:
    records = table(spark, d, "orders").select("o_orderkey", F.col("o_orderkey").alias("frame_id"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey")).alias("track_id"))
    positions = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("frame_id"), F.col("l_suppkey").alias("track_id"), F.col("l_returnflag").alias("type"), F.col("l_linenumber").alias("ord"))
    out = SB.linked_actors(records, positions, [])
    return out.select("o_orderkey", F.array_join("linked_actor_ids", ",").alias("ids"), F.array_join("visible_actor_candidates", ",").alias("types"))
