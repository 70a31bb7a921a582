"""The registered queries of the library's own operators, with DuckDB SQL for each."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import documents as DOC
from ..functions import scalar as S
from ..operators import events as EV
from ..operators import joins as J
from ..operators import neighbours as N
from ..operators import ranking as R
from ..operators import readings as RE
from ..operators import sets as SE
from ..operators import tracks as TR
from ..operators import votes as V
from ..sources.tables import events, micros, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
HOUR = 3_600_000_000
#: The events with micros and confidence, as every SQL below uses them.
EV_SQL = "ev AS (SELECT event_id, user_id, event_type, value, epoch_us(ts) AS us, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


PEAKS = f"""{EV_SQL}, s AS (SELECT user_id, list({{'s': -value, 'o': event_id, 'p': us}} ORDER BY -value, event_id) AS l FROM ev WHERE value >= 20 GROUP BY user_id),
f AS (SELECT user_id, list_reduce(list_prepend([l[1]], [[x] FOR x IN l[2:]]), lambda a, x: CASE WHEN len(a) < 5 AND len([y FOR y IN a IF abs(y.p - x[1].p) < {12 * HOUR}]) = 0 THEN list_concat(a, x) ELSE a END) AS kept FROM s),
pk AS (SELECT user_id, u.o AS event_id, u.p AS us, -u.s AS value FROM (SELECT user_id, unnest(kept) AS u FROM f))"""


@query(f"WITH {PEAKS} SELECT user_id, event_id, us, value FROM pk")
def peak_suppression(spark: SparkSession, d: str) -> DataFrame:
    return R.suppress(events(spark, d).where("value >= 20"), ["user_id"], "value", "us", "event_id", 12 * HOUR, 5)


@query(f"WITH {PEAKS} SELECT pk.user_id, pk.event_id AS peak_id, count(*) AS n, sum(CAST(ev.value AS DECIMAL(18,2))) AS total FROM pk JOIN ev ON ev.user_id = pk.user_id AND ev.us BETWEEN pk.us - {6 * HOUR} AND pk.us + {4 * HOUR} GROUP BY ALL")
def event_window_join(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d)
    w = peak_suppression(spark, d).select("user_id", F.col("event_id").alias("peak_id"), (F.col("us") - 6 * HOUR).alias("w0"), (F.col("us") + 4 * HOUR).alias("w1"))
    hit = J.in_window(e.select("user_id", "us", "value"), w, ["user_id"], "us", "w0", "w1", 12 * HOUR)
    return hit.groupBy("user_id", "peak_id").agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).cast("decimal(38,2)").alias("total"))


@query(f"WITH {EV_SQL}, x AS (SELECT *, abs(value - lag(value) OVER (PARTITION BY user_id ORDER BY us, event_id)) AS change FROM ev) SELECT user_id, event_id, CAST(least(100, greatest(0, round_even(1.4 * change + 7.0 * (k / 100.0) + 3.0 * (k / 200.0) + 0.9 * (value / 10.0), 0))) AS INTEGER) AS score FROM x WHERE change IS NOT NULL")
def scan_score(spark: SparkSession, d: str) -> DataFrame:
    x = EV.steps(events(spark, d), ["user_id"], ["us", "event_id"], "value")
    k = F.col("k")
    return x.select("user_id", "event_id", EV.scan_score(F.col("change"), k / 100.0, k / 200.0, F.col("value") / 10.0).alias("score"))


@query(f"WITH {EV_SQL}, p AS (SELECT e.event_id, e.user_id, n.event_id AS near_id, row_number() OVER (PARTITION BY e.event_id ORDER BY abs(n.us - e.us), n.event_id) AS rank FROM ev e JOIN ev n ON e.user_id = n.user_id AND e.event_id <> n.event_id AND abs(n.us - e.us) <= {HOUR * 3 // 2} WHERE e.event_type = 'purchase') SELECT user_id, event_id, near_id, rank FROM p WHERE rank <= 3")
def nearby_top3(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d)
    reach = HOUR * 3 // 2
    w = e.where("event_type = 'purchase'").select("user_id", "event_id", F.col("us").alias("t"), (F.col("us") - reach).alias("w0"), (F.col("us") + reach).alias("w1"))
    near = J.in_window(e.select("user_id", F.col("event_id").alias("near_id"), "us"), w, ["user_id"], "us", "w0", "w1", 2 * reach).where("near_id <> event_id")
    return R.top_k(near, ["event_id"], [F.abs(F.col("us") - F.col("t")), F.col("near_id")], 3).select("user_id", "event_id", "near_id", "rank")


@query(f"WITH {EV_SQL}, p AS (SELECT a.event_id, a.user_id, b.event_id AS near_event_id, abs(a.us - b.us) AS distance, row_number() OVER (PARTITION BY a.event_id ORDER BY abs(a.us - b.us), b.us, b.event_id) AS r FROM ev a JOIN ev b ON a.user_id = b.user_id AND b.event_type = 'click' WHERE a.event_type = 'purchase') SELECT event_id, user_id, near_event_id, distance FROM p WHERE r = 1")
def nearest_frame(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d)
    left = e.where("event_type = 'purchase'").select("event_id", "user_id", "us")
    right = e.where("event_type = 'click'").select("user_id", "event_id", "us")
    return J.nearest(left, right, ["user_id"], "us", "us", "event_id").select("event_id", "user_id", "near_event_id", "distance")


@query("WITH p AS (SELECT l_suppkey AS a, l_partkey AS b, l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS q FROM lineitem) SELECT a, b, l_orderkey, l_linenumber, q, lag(q) OVER (PARTITION BY a, b ORDER BY l_orderkey, l_linenumber) AS previous FROM p")
def prev_pair_asof(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("a"), F.col("l_partkey").alias("b"), "l_orderkey", "l_linenumber", F.col("l_quantity").cast("bigint").alias("q"))
    return N.with_previous(p, ["a", "b"], ["l_orderkey", "l_linenumber"], {"q": "previous"})


BOX = "l_linenumber * 10 AS x1, CAST(l_quantity AS BIGINT) AS y1, l_linenumber * 10 + 40 AS x2, CAST(l_quantity AS BIGINT) + 30 AS y2"


@query(
    f"WITH b AS (SELECT l_orderkey, l_linenumber, {BOX} FROM lineitem), p AS (SELECT a.l_orderkey, a.l_linenumber AS l_linenumber_a, b.l_linenumber AS l_linenumber_b, greatest(0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0, least(a.y2, b.y2) - greatest(a.y1, b.y1)) AS i FROM b a JOIN b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber < b.l_linenumber) "
    "SELECT l_orderkey, l_linenumber_a, l_linenumber_b, round_even(CAST(i AS DOUBLE) / (2400 - i) * 10000, 0) / 10000 AS iou, CASE WHEN CAST(i AS DOUBLE) / (2400 - i) >= 0.12 THEN 'medium' ELSE 'low' END AS confidence FROM p WHERE i > 0"
)
def pairs_same_time(spark: SparkSession, d: str) -> DataFrame:
    n, q = F.col("l_linenumber"), F.col("l_quantity").cast("bigint")
    b = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (n * 10).alias("x1"), q.alias("y1"), (n * 10 + 40).alias("x2"), (q + 30).alias("y2"))
    p = J.pairs_at(b, ["l_orderkey"], "l_linenumber", ["x1", "y1", "x2", "y2"])
    v = S.iou(*[[F.col(f"{c}_{s}") for c in ("x1", "y1", "x2", "y2")] for s in "ab"])
    return p.withColumn("v", v).where("v > 0").select("l_orderkey", "l_linenumber_a", "l_linenumber_b", S.rint(F.col("v"), 4).alias("iou"), F.when(F.col("v") >= 0.12, "medium").otherwise("low").alias("confidence"))


def _cited(spark: SparkSession, d: str, there: bool) -> DataFrame:
    e = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), "l_linenumber")
    return J.cited(e, table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("id")), ["id"], there)


@query("SELECT l_orderkey AS id, l_linenumber FROM lineitem WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F')")
def evidence_semi(spark: SparkSession, d: str) -> DataFrame:
    return _cited(spark, d, True)


@query("SELECT l_orderkey AS id, l_linenumber FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F')")
def reuse_anti(spark: SparkSession, d: str) -> DataFrame:
    return _cited(spark, d, False)


LABELLED = "SELECT d.doc_id, d.n_chars, l.quality, CASE WHEN l.quality IS NULL THEN NULL ELSE (d.n_chars >= 400) = (l.quality = 1) END AS matches FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"


@query(LABELLED)
def left_label(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "n_chars")
    labels = table(spark, d, "labels").select("doc_id", "quality")
    return J.evaluate(docs, labels, "doc_id", {"matches": (F.col("n_chars") >= 400) == (F.col("quality") == 1)})


@query(f"SELECT count(*) AS items, count(quality) AS labelled, count(*) FILTER (matches) AS matched, round_even(count(*) FILTER (matches) * 10000.0 / count(quality), 0) / 10000 AS match_rate, CAST(round_even(100.0 * count(*) FILTER (n_chars >= 2000) / count(*), 0) AS BIGINT) AS usable_per_100 FROM ({LABELLED})")
def label_eval_summary(spark: SparkSession, d: str) -> DataFrame:
    x = left_label(spark, d)
    rate = F.count_if("matches") * 10000.0 / F.count("quality")
    return x.agg(F.count("*").alias("items"), F.count("quality").alias("labelled"), F.count_if("matches").alias("matched"), (F.rint(rate) / 10000).alias("match_rate"), F.rint(100.0 * F.count_if(F.col("n_chars") >= 2000) / F.count("*")).cast("bigint").alias("usable_per_100"))


@query(f"WITH {EV_SQL}, g AS (SELECT user_id, event_type, count(*) AS votes, min(event_id) AS o FROM ev GROUP BY ALL), r AS (SELECT *, CAST(sum(votes) OVER (PARTITION BY user_id) AS BIGINT) AS total, row_number() OVER (PARTITION BY user_id ORDER BY votes DESC, o) AS rn FROM g) SELECT user_id, event_type, votes, total, CASE WHEN votes * 4 >= total * 3 THEN 'high' WHEN votes * 2 >= total THEN 'medium' ELSE 'low' END AS confidence FROM r WHERE rn = 1")
def vote_first_seen(spark: SparkSession, d: str) -> DataFrame:
    return V.first_seen_mode(events(spark, d), ["user_id"], "event_type", "event_id")


@query(f"WITH {EV_SQL}, g AS (SELECT user_id, event_type, count(*) AS votes FROM ev GROUP BY ALL), r AS (SELECT *, nth_value(votes, 2) OVER (PARTITION BY user_id ORDER BY votes DESC, event_type ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS s FROM g) SELECT user_id, event_type, votes, votes - coalesce(s, 0) AS margin FROM r")
def vote_margin(spark: SparkSession, d: str) -> DataFrame:
    return V.margins(events(spark, d), ["user_id"], "event_type")


@query(f"WITH {EV_SQL}, g AS (SELECT user_id, event_type, CAST(sum(k) AS BIGINT) AS score, count(*) AS votes, min(event_id) AS o FROM ev GROUP BY ALL), r AS (SELECT *, lead(score) OVER w AS nx, row_number() OVER w AS rn FROM g WINDOW w AS (PARTITION BY user_id ORDER BY score DESC, o)) SELECT user_id, event_type, score, votes, score - coalesce(nx, 0) AS margin, CASE WHEN votes >= 3 AND score - coalesce(nx, 0) >= 20 THEN 'high' WHEN votes >= 2 AND score - coalesce(nx, 0) >= 8 THEN 'medium' ELSE 'low' END AS confidence FROM r WHERE rn = 1")
def score_vote(spark: SparkSession, d: str) -> DataFrame:
    return V.score_vote(events(spark, d), ["user_id"], "event_type", "k", "event_id")


#: Lamp states by event type; each third user never shows the left arrow.
_LAMPS = {"click": "적색", "view": "좌회전녹색", "purchase": "녹색", "signup": "황색", "error": "소등"}
SIGNALS = (
    f"WITH {EV_SQL}, x AS (SELECT user_id, event_id, k, CASE event_type " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in _LAMPS.items()) + " END AS state FROM ev), y AS (SELECT * FROM x WHERE user_id % 3 > 0 OR state <> '좌회전녹색'), "
    "g AS (SELECT user_id, state, CAST(sum(k) AS BIGINT) AS score, count(*) AS votes, min(event_id) AS o FROM y GROUP BY ALL), "
    "r AS (SELECT *, row_number() OVER w AS rn, lead(score) OVER w AS nx, max(score) OVER (PARTITION BY user_id) AS top FROM g WINDOW w AS (PARTITION BY user_id ORDER BY score DESC, o)), "
    "m AS (SELECT user_id, sum(score) AS s, sum(votes) AS n, max(top) AS top FROM r WHERE state IN ('적색', '좌회전녹색') GROUP BY 1 HAVING count(*) = 2) "
    "SELECT r.user_id, CASE WHEN m.s IS NULL THEN r.state ELSE '적색+좌회전' END AS state, CASE WHEN m.s IS NOT NULL THEN CASE WHEN m.n >= 2 THEN 'medium' ELSE 'low' END WHEN r.votes >= 3 AND r.score - coalesce(r.nx, 0) >= 20 THEN 'high' WHEN r.votes >= 2 AND r.score - coalesce(r.nx, 0) >= 8 THEN 'medium' ELSE 'low' END AS confidence, "
    "CAST(CASE WHEN m.s IS NULL THEN r.score - coalesce(r.nx, 0) ELSE m.s - m.top END AS BIGINT) AS margin, CAST(CASE WHEN m.s IS NULL THEN r.votes ELSE m.n END AS BIGINT) AS votes FROM r LEFT JOIN m ON m.user_id = r.user_id WHERE r.rn = 1"
)


@query(SIGNALS)
def signal_vote(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d)
    state = F.coalesce(*[F.when(F.col("event_type") == a, b) for a, b in _LAMPS.items()])
    x = e.withColumn("state", state).where((F.col("user_id") % 3 > 0) | (F.col("state") != "좌회전녹색"))
    return V.signal_vote(x, ["user_id"], "state", "k", "event_id").drop("by_state")


@query(f"WITH {EV_SQL}, p AS (SELECT *, count(value) OVER w AS n, median(value) OVER w AS m FROM ev WHERE value BETWEEN 0 AND 180 WINDOW w AS (PARTITION BY user_id)), q AS (SELECT * FROM p WHERE n < 3 OR abs(value - m) <= 35) SELECT user_id, count(value) AS n, median(value) AS middle, min(value) AS least, max(value) AS greatest, max(value) - min(value) AS spread FROM q GROUP BY user_id")
def median_outlier(spark: SparkSession, d: str) -> DataFrame:
    return V.spread(V.without_outliers(events(spark, d), ["user_id"], "value", 0, 180, 35), ["user_id"], "value")


@query(f"WITH {EV_SQL}, l AS (SELECT user_id, list(value ORDER BY us, event_id) AS l FROM ev GROUP BY user_id) SELECT user_id, CAST(len(l) AS BIGINT) AS n, list_reduce([[x] FOR x IN l], lambda a, x: CASE WHEN abs(x[1] - a[-1]) <= 45 THEN list_concat(a, x) ELSE a END) AS kept FROM l")
def jump_filter(spark: SparkSession, d: str) -> DataFrame:
    return N.jump_filter(events(spark, d), ["user_id"], ["us", "event_id"], "value", 45)


CLUSTERS = f"WITH {EV_SQL}, l AS (SELECT user_id, list({{'s': CAST(k AS BIGINT), 'n': CAST(1 AS BIGINT)}} ORDER BY k) AS l FROM ev GROUP BY user_id), c AS (SELECT user_id, list_reduce([[x] FOR x IN l], lambda a, x: CASE WHEN abs(a[-1].s - x[1].s * a[-1].n) <= 5 * a[-1].n THEN list_concat(a[1:len(a) - 1], [{{'s': a[-1].s + x[1].s, 'n': a[-1].n + 1}}]) ELSE list_concat(a, x) END) AS c FROM l) SELECT user_id, CAST(i - 1 AS BIGINT) AS cluster, c[i].s AS total, c[i].n AS n FROM c, generate_series(1, len(c)) AS t(i)"


@query(CLUSTERS)
def cluster_1d(spark: SparkSession, d: str) -> DataFrame:
    return N.clusters(events(spark, d), ["user_id"], "k", 5)


@query(CLUSTERS)
def cluster_1d_whole(spark: SparkSession, d: str) -> DataFrame:
    """The name that ``cluster_1d`` had while it left rows out."""
    return cluster_1d(spark, d)


@query(f"WITH {EV_SQL}, x AS (SELECT *, sum(k) OVER w AS s, count(k) OVER w AS n FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING)) SELECT user_id, count(k) AS n, bool_or(s < 0.35 * 100 * n) AS ever_low, CASE WHEN sum(k) >= 0.7 * 100 * count(k) THEN 'high' WHEN sum(k) >= 0.35 * 100 * count(k) THEN 'medium' ELSE 'low' END AS confidence FROM x GROUP BY user_id")
def running_conf(spark: SparkSession, d: str) -> DataFrame:
    return N.running_mean_flag(events(spark, d), ["user_id"], ["us", "event_id"], "k", 35.0, 70.0)


GAPS = f"{EV_SQL}, x AS (SELECT user_id, event_id, event_id - lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS gap FROM ev), g AS (SELECT user_id, count(*) AS n, min(event_id) AS first, max(event_id) AS last, coalesce(max(gap), 0) AS max_gap, count(*) FILTER (gap > 150) AS breaks FROM x GROUP BY user_id)"


@query(f"WITH {GAPS} SELECT *, CAST(least(100, floor(1.5 * max_gap + 8 * breaks)) AS BIGINT) AS score, least(100, floor(1.5 * max_gap + 8 * breaks)) >= 30 AS fragmented FROM g")
def track_quality(spark: SparkSession, d: str) -> DataFrame:
    return N.gaps(events(spark, d), ["user_id"], "event_id", 150)


AREA = "SELECT o_custkey, o_orderkey, epoch_us(o_orderdate) AS us, o_totalprice FROM orders"


@query(f"WITH o AS ({AREA}), x AS (SELECT *, lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY us, o_orderkey) AS previous FROM o) SELECT o_custkey, o_orderkey, CASE WHEN o_totalprice >= 2.8 * previous THEN 'medium' ELSE 'low' END AS confidence FROM x WHERE previous > 0 AND o_totalprice >= 1.8 * previous")
def area_jump(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", micros(F.col("o_orderdate")).alias("us"), "o_totalprice")
    return N.jumps(o, ["o_custkey"], ["us", "o_orderkey"], "o_totalprice", 1.8, 2.8).select("o_custkey", "o_orderkey", "confidence")


@query("SELECT o_custkey, count(*) AS n, arg_min(o_totalprice, o_orderkey) AS first_o_totalprice, arg_max(o_totalprice, o_orderkey) AS last_o_totalprice, arg_max(o_totalprice, o_orderkey) >= 2.5 * arg_min(o_totalprice, o_orderkey) AS grew FROM orders GROUP BY o_custkey HAVING count(*) >= 2")
def first_last_ratio(spark: SparkSession, d: str) -> DataFrame:
    g = N.first_last(table(spark, d, "orders"), ["o_custkey"], "o_orderkey", ["o_totalprice"]).where("n >= 2")
    return g.withColumn("grew", F.col("last_o_totalprice") >= 2.5 * F.col("first_o_totalprice"))


@query(f"WITH {EV_SQL}, m AS (SELECT *, lag(us) OVER w AS u0, lag(value) OVER w AS v0 FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)), s AS (SELECT user_id, event_id, us, abs(value - v0) / ((us - u0) / 3600000000.0) AS speed FROM m WHERE us > u0), t AS (SELECT *, lag(speed) OVER (PARTITION BY user_id ORDER BY us, event_id) AS before FROM s) SELECT user_id, event_id, CASE WHEN before >= 35 THEN 'medium' ELSE 'low' END AS confidence FROM t WHERE before >= 20 AND speed <= 0.35 * before")
def motion_stop_turn(spark: SparkSession, d: str) -> DataFrame:
    m = N.with_previous(events(spark, d), ["user_id"], ["us", "event_id"], {"us": "u0", "value": "v0"}).where("us > u0")
    s = m.withColumn("speed", F.abs(F.col("value") - F.col("v0")) / ((F.col("us") - F.col("u0")) / 3600000000.0))
    t = N.with_previous(s, ["user_id"], ["us", "event_id"], {"speed": "before"}).where("before >= 20 AND speed <= 0.35 * before")
    return t.select("user_id", "event_id", F.when(F.col("before") >= 35, "medium").otherwise("low").alias("confidence"))


@query(f"WITH {EV_SQL}, g AS (SELECT user_id, arg_min(value, event_id) AS a, arg_max(value, event_id) AS b FROM ev GROUP BY user_id HAVING count(*) >= 2) SELECT user_id, CASE WHEN b - a > 20 THEN '접근' WHEN b - a < -20 THEN '이탈' ELSE '유지' END AS trend FROM g")
def relative_motion(spark: SparkSession, d: str) -> DataFrame:
    g = N.first_last(events(spark, d), ["user_id"], "event_id", ["value"]).where("n >= 2")
    delta = F.col("last_value") - F.col("first_value")
    return g.select("user_id", F.when(delta > 20, "접근").when(delta < -20, "이탈").otherwise("유지").alias("trend"))


MATRIX = [[1.2, 0.1, 3.0], [0.05, 1.1, -2.0], [0.0001, 0.0002, 1.0]]


@query(
    "WITH b AS (SELECT l_orderkey, l_linenumber AS t, CAST(l_linenumber * 12 AS DOUBLE) AS x, max(l_quantity) AS y FROM lineitem GROUP BY ALL), h AS (SELECT l_orderkey, t, (1.2 * x + 0.1 * y + 3.0) / (0.0001 * x + 0.0002 * y + 1.0) AS hx, (0.05 * x + 1.1 * y - 2.0) / (0.0001 * x + 0.0002 * y + 1.0) AS hy FROM b), "
    "g AS (SELECT l_orderkey, min(t) AS t0, max(t) AS t1, arg_min(hx, t) AS x0, arg_max(hx, t) AS x1, arg_min(hy, t) AS y0, arg_max(hy, t) AS y1 FROM h GROUP BY 1) SELECT l_orderkey, round_even(sqrt((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)) / 10.0 / (t1 - t0) * 3.6 * 1000, 0) / 1000 AS kmh FROM g WHERE t1 > t0"
)
def bev_speed(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "lineitem").groupBy("l_orderkey", F.col("l_linenumber").alias("t")).agg(F.max("l_quantity").alias("y")).withColumn("x", F.col("t") * 12.0)
    hx, hy = S.homography(F.col("x"), F.col("y"), MATRIX)
    g = N.first_last(b.select("l_orderkey", "t", hx.alias("hx"), hy.alias("hy")), ["l_orderkey"], "t", ["hx", "hy", "t"]).where("last_t > first_t")
    dx, dy = F.col("last_hx") - F.col("first_hx"), F.col("last_hy") - F.col("first_hy")
    return g.select("l_orderkey", S.rint(F.sqrt(dx * dx + dy * dy) / 10.0 / (F.col("last_t") - F.col("first_t")) * 3.6, 3).alias("kmh"))


@query("WITH p AS (SELECT o_custkey, o_orderkey, o_totalprice, CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2 END AS prio FROM orders), b AS (SELECT * FROM p WHERE prio IS NOT NULL QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY prio, o_orderkey) = 1) SELECT c_custkey, b.o_orderkey, coalesce(b.prio, -1) AS priority FROM customer LEFT JOIN b ON c_custkey = o_custkey")
def speed_choice(spark: SparkSession, d: str) -> DataFrame:
    methods = {"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 2}
    prio = F.coalesce(*[F.when(F.col("o_orderpriority") == m, i) for m, i in methods.items()])
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", prio.alias("prio")).where("prio IS NOT NULL")
    best = o.groupBy("o_custkey").agg(F.min(F.struct("prio", "o_orderkey")).alias("b"))
    return table(spark, d, "customer").select("c_custkey").join(best, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.col("b.o_orderkey").alias("o_orderkey"), F.coalesce("b.prio", F.lit(-1)).alias("priority"))


@query(f"WITH {EV_SQL} SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, us, event_id) AS rank FROM ev QUALIFY rank <= 24")
def topk_events(spark: SparkSession, d: str) -> DataFrame:
    return R.top_k(events(spark, d), ["user_id"], [F.desc("value"), F.col("us"), F.col("event_id")], 24).select("user_id", "event_id", "value", "rank")


@query(f"WITH {EV_SQL}, a AS (SELECT * FROM ev QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY k DESC, event_id) <= CASE event_type WHEN 'click' THEN 4 WHEN 'view' THEN 3 ELSE 12 END) SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY k DESC, event_id) AS rank FROM a QUALIFY rank <= 12")
def purpose_caps(spark: SparkSession, d: str) -> DataFrame:
    return R.capped(events(spark, d), ["user_id"], "event_type", [F.desc("k"), F.col("event_id")], {"click": 4, "view": 3}, 12).select("user_id", "event_id", "event_type", "rank")


@query(
    f"WITH {EV_SQL}, a AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY k DESC, event_id) AS rn FROM ev), b AS (SELECT *, rn <= CASE event_type WHEN 'click' THEN 3 WHEN 'view' THEN 2 ELSE 0 END AS f FROM a), "
    "c AS (SELECT *, sum(CAST(f AS INTEGER)) OVER (PARTITION BY user_id) AS n1 FROM b), e AS (SELECT * FROM c WHERE f OR rn <= CASE event_type WHEN 'purchase' THEN 2 ELSE 8 END), g AS (SELECT *, row_number() OVER (PARTITION BY user_id, f ORDER BY k DESC, event_id) AS fill FROM e) SELECT user_id, event_id, event_type, CASE WHEN f THEN 1 ELSE 2 END AS pass FROM g WHERE f OR fill <= 8 - n1"
)
def phase_quota(spark: SparkSession, d: str) -> DataFrame:
    q = R.quota(events(spark, d), ["user_id"], "event_type", [F.desc("k"), F.col("event_id")], {"click": 3, "view": 2}, {"purchase": 2}, 8)
    return q.select("user_id", "event_id", "event_type", "pass")


@query(f"WITH {EV_SQL}, a AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) - 1 AS l FROM ev) SELECT user_id, event_id FROM a WHERE l < 10 OR i IN (SELECT CAST(round_even(j * l / 9.0, 0) AS BIGINT) FROM generate_series(0, 9) AS t(j))")
def even_sample(spark: SparkSession, d: str) -> DataFrame:
    return R.even_sample(events(spark, d), ["user_id"], [F.col("us"), F.col("event_id")], 10).select("user_id", "event_id")


PLAN = "SELECT DISTINCT p_partkey, CAST(round_even(s * 0.5 * 30.0, 0) AS BIGINT) AS frame_index FROM (SELECT p_partkey, CAST(p_size AS DOUBLE) AS dur FROM part), generate_series(0, 100) AS t(s) WHERE s <= floor(dur / 0.5 + 1e-9) AND round_even(s * 0.5 * 30.0, 0) <= floor(dur * 30.0 + 1e-9)"


def _plan(spark: SparkSession, d: str, interval: float) -> DataFrame:
    p = table(spark, d, "part").select("p_partkey", F.col("p_size").cast("double").alias("dur"), F.lit(30.0).alias("fps"))
    return R.sampling_plan(p, "dur", "fps", interval).select("p_partkey", "frame_index")


@query(PLAN)
def window_plan(spark: SparkSession, d: str) -> DataFrame:
    return _plan(spark, d, 0.5)


@query(f"WITH a AS (SELECT p_partkey, frame_index, 'regular' AS purpose, 0 AS o FROM ({PLAN}) UNION ALL SELECT p_partkey, frame_index, 'impact' AS purpose, 1 AS o FROM ({PLAN.replace('s * 0.5', 's * 0.75').replace('/ 0.5', '/ 0.75')})) SELECT p_partkey, frame_index, string_agg(purpose, '+' ORDER BY o) AS purpose FROM a GROUP BY ALL")
def merge_union(spark: SparkSession, d: str) -> DataFrame:
    duration, fps = F.col("p_size").cast("double"), F.lit(30.0)
    plans = [(R.plan_frames(duration, fps, s), p) for s, p in ((0.5, "regular"), (0.75, "impact"))]
    return table(spark, d, "part").select("p_partkey", F.explode(SE.merged_in_row(plans)).alias("frame_index", "purpose"))


@query("WITH s AS (SELECT l_suppkey, l_partkey, bool_or(l_returnflag = 'R') AS a, bool_or(l_returnflag = 'A') AS b FROM lineitem GROUP BY ALL) SELECT l_suppkey, count(*) FILTER (a AND b) AS common, count(*) FILTER (a AND NOT b) AS only_a, count(*) FILTER (NOT a AND b) AS only_b FROM s GROUP BY 1")
def tracker_compare(spark: SparkSession, d: str) -> DataFrame:
    return SE.compare_ids(table(spark, d, "lineitem"), ["l_suppkey"], "l_partkey", F.col("l_returnflag") == "R", F.col("l_returnflag") == "A")


@query("WITH u AS (SELECT o_custkey AS id, 0 AS section FROM orders WHERE o_totalprice > 300000 GROUP BY 1 UNION ALL SELECT c_custkey, 1 FROM customer WHERE c_acctbal > 5000 UNION ALL SELECT s_suppkey, 2 FROM supplier) SELECT id, CAST(min(section) AS INTEGER) AS section FROM u GROUP BY id")
def first_section_wins(spark: SparkSession, d: str) -> DataFrame:
    parts = [table(spark, d, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("id")).distinct(), table(spark, d, "customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("id")), table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"))]
    return SE.first_section(parts, "id")


@query("SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS n FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), (l_linenumber))")
def summary_groupings(spark: SparkSession, d: str) -> DataFrame:
    c = ["l_returnflag", "l_linestatus", "l_linenumber"]
    return table(spark, d, "lineitem").groupingSets([[F.col(x)] for x in c], *c).agg(F.count("*").alias("n"))


@query("SELECT o_orderpriority, count(*) AS items, count(*) FILTER (o_orderstatus = 'F') AS succeeded, round_even(count(*) FILTER (o_orderstatus = 'F') * 10000.0 / count(*), 0) / 10000 AS success_rate, median(o_totalprice) FILTER (o_orderstatus = 'F') AS median_value, round_even(count(*) FILTER (o_orderstatus = 'F' AND o_totalprice > 100000) * 10000.0 / count(*) FILTER (o_orderstatus = 'F'), 0) / 10000 AS fill_rate FROM orders GROUP BY 1")
def bench_summary(spark: SparkSession, d: str) -> DataFrame:
    done = F.col("o_orderstatus") == "F"
    n = F.count_if(done)
    return table(spark, d, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("items"), n.alias("succeeded"), (F.rint(n * 10000.0 / F.count("*")) / 10000).alias("success_rate"), F.median(F.when(done, F.col("o_totalprice"))).alias("median_value"), (F.rint(F.count_if(done & (F.col("o_totalprice") > 100000)) * 10000.0 / n) / 10000).alias("fill_rate"))


@query(f"WITH {EV_SQL}, t AS (SELECT user_id, us FROM ev QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) <= 3), l AS (SELECT user_id, max(us) AS at FROM ev WHERE event_type = 'purchase' GROUP BY user_id) SELECT l.user_id, max(CASE WHEN abs(t.us - l.at) <= {24 * HOUR} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS recall_at_3 FROM l JOIN t ON t.user_id = l.user_id GROUP BY 1")
def metrics_at_k(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d)
    top = R.top_k(e, ["user_id"], [F.desc("value"), F.col("event_id")], 3).select("user_id", "us")
    label = e.where("event_type = 'purchase'").groupBy("user_id").agg(F.max("us").alias("at"))
    return label.join(top, "user_id").groupBy("user_id").agg(F.max(F.when(F.abs(F.col("us") - F.col("at")) <= 24 * HOUR, 1.0).otherwise(0.0)).alias("recall_at_3"))


@query(f"WITH {EV_SQL} SELECT user_id, bool_or(value < 5) AS any_dark, bool_or(value > 100) AS any_bright, count(*) FILTER (value < 20) AS low, count(*) FILTER (value BETWEEN 20 AND 60) AS middle, count(*) FILTER (value > 60) AS high FROM ev GROUP BY user_id")
def frame_flags(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d).withColumn("b", S.bucket(F.col("value"), 20, 60, ("low", "middle", "high")))
    return e.groupBy("user_id").agg(F.bool_or(F.col("value") < 5).alias("any_dark"), F.bool_or(F.col("value") > 100).alias("any_bright"), *[F.count_if(F.col("b") == x).alias(x) for x in ("low", "middle", "high")])


@query(f"WITH {EV_SQL} SELECT event_id, 'contact' AS rule, least(100, 50 + k) AS score FROM ev WHERE event_type = 'purchase' UNION ALL SELECT event_id, 'impact', least(100, 30 + k // 2) FROM ev WHERE value > 80 UNION ALL SELECT event_id, 'stop', 10 FROM ev WHERE k < 10")
def event_rule_union(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("k")
    rules = {"contact": (F.col("event_type") == "purchase", F.least(F.lit(100), 50 + k)), "impact": (F.col("value") > 80, F.least(F.lit(100), 30 + F.floor(k / 2).cast("int"))), "stop": (k < 10, F.lit(10))}
    return EV.rule_union(events(spark, d).select("event_id", "event_type", "value", "k"), rules).select("event_id", "rule", "score")


#: Stand-ins for the purposes and sources of evidence images, by number.
_PURPOSE = ("traffic_light_crop", "sign_crop", "event_segment", "event_scan_impact_candidate", "impact_candidate", "actor_crop", "pre_impact", "tracking_overlay", "post_impact", "bev_overlay", "motion_keyframe", "regular_context", "failure_case", "pre_impact+regular_context", "")
_SOURCE = ("traffic_control", "visual_evidence", "road_geometry", "selected_frame", "ocr_roi", "another", "")
_POINTS = {"traffic_light_crop": 96, "sign_crop": 94, "event_segment": 92, "event_scan_impact_candidate": 91, "impact_candidate": 90, "actor_crop": 88, "pre_impact": 86, "tracking_overlay": 84, "post_impact": 80, "bev_overlay": 78, "motion_keyframe": 70, "regular_context": 58, "failure_case": 52, "traffic_control": 8, "visual_evidence": 6, "road_geometry": 4, "selected_frame": 2, "ocr_roi": -8}
EVIDENCE = (
    f"WITH {EV_SQL}, x AS (SELECT event_id, k, {list(_PURPOSE)}[event_id % {len(_PURPOSE)} + 1] AS p, {list(_SOURCE)}[event_id % {len(_SOURCE)} + 1] AS s, event_id % 2 = 0 AS f, event_id % 3 = 0 AS t, event_id % 5 = 0 AS b, CASE WHEN k >= 70 THEN 'high' WHEN k >= 35 THEN 'medium' ELSE 'low' END AS q FROM ev) "
    "SELECT event_id, CAST(greatest(0, least(100, CASE p " + " ".join(f"WHEN '{p}' THEN {_POINTS[p]}" for p in _PURPOSE if p in _POINTS) + " ELSE 50 END + CASE s " + " ".join(f"WHEN '{p}' THEN {_POINTS[p]}" for p in _SOURCE if p in _POINTS) + " ELSE 0 END"
    " + CASE WHEN f THEN 2 ELSE 0 END + CASE WHEN t THEN 4 ELSE 0 END + CASE WHEN b THEN 3 ELSE 0 END - CASE q WHEN 'low' THEN 12 WHEN 'medium' THEN 4 ELSE 0 END)) AS INTEGER) AS score, "
    "'purpose:' || CASE p WHEN '' THEN 'unknown' ELSE p END || ',source:' || CASE s WHEN '' THEN 'unknown' ELSE s END || CASE WHEN f THEN ',frame-linked' ELSE '' END || CASE WHEN t THEN ',actor-linked' ELSE '' END || CASE WHEN b THEN ',localized' ELSE '' END || CASE q WHEN 'low' THEN ',quality_penalty' WHEN 'medium' THEN ',quality_caution' ELSE '' END AS reasons FROM x"
)


@query(EVIDENCE)
def evidence_score(spark: SparkSession, d: str) -> DataFrame:
    e, i = events(spark, d), F.col("event_id")
    pick = lambda names: F.get(F.array(*[F.lit(x) for x in names]), (i % len(names)).cast("int"))
    x = EV.evidence_score(pick(_PURPOSE), pick(_SOURCE), F.when(i % 2 == 0, i), F.when(i % 3 == 0, i), F.when(i % 5 == 0, F.array(F.lit(1), F.lit(2), F.lit(3), F.lit(4))), S.confidence_class(F.col("k"), 70, 35))
    return e.select("event_id", x.alias("x")).select("event_id", "x.score", F.array_join("x.reasons", ",").alias("reasons"))


@query(f"WITH {EV_SQL} SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY us, CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 ELSE 2 END, event_id) AS slot FROM ev WHERE k >= 50")
def storyboard(spark: SparkSession, d: str) -> DataFrame:
    phase = F.when(F.col("event_type") == "view", 0).when(F.col("event_type") == "click", 1).otherwise(2)
    return R.top_k(events(spark, d).where("k >= 50"), ["user_id"], [F.col("us"), phase, F.col("event_id")], 1 << 30, "slot").select("user_id", "event_id", "slot")


@query(f"WITH {EV_SQL}, t AS (SELECT event_id, CAST(round_even((us % {HOUR * 3}) / 1000000.0::DOUBLE * 1000, 0) AS BIGINT) AS ms FROM ev), c AS (SELECT event_id, printf('%02d:%02d.%03d', ms // 60000, ms // 1000 % 60, ms % 1000) AS code FROM t) SELECT event_id, code, (CAST(split_part(code, ':', 1) AS BIGINT) * 60000 + CAST(replace(split_part(code, ':', 2), '.', '') AS BIGINT)) / 1000.0::DOUBLE AS seconds FROM c")
def timecode(spark: SparkSession, d: str) -> DataFrame:
    c = events(spark, d).select("event_id", S.timecode((F.col("us") % (3 * HOUR)) / 1000000.0).alias("code"))
    return c.withColumn("seconds", S.parse_timecode(F.col("code")))


#: Overlay texts in four layouts; what each says follows from the order's numbers.
_LAYOUTS = ("{d} SPEED {v}.5km/h N{a}.125 E{b}.5", " {e} 속도: {v} ㎞/h GPS {a}.125, {b}.5 ", "{k} 3:04:05|spd={v}.25 ＫPH | lat -{a}.125, lon {b}.5", "no date {v}kmh s{a}.125 W {b}.5 x")
_DATES = {"d": ("yyyy-MM-dd HH:mm:ss", "%Y-%m-%d %H:%M:%S"), "e": ("yyyy.M.d HH:mm:ss", "%Y.%-m.%-d %H:%M:%S"), "k": ("yyyy년 M월 d일", "%Y년 %-m월 %-d일")}
OVERLAYS = (
    "WITH x AS (SELECT o_orderkey, o_orderkey % 4 AS l, o_orderdate AS t, o_orderkey % 140 AS v, o_orderkey % 95 + 0.125 AS a, o_custkey % 190 + 0.5 AS b FROM orders), "
    "y AS (SELECT *, CASE WHEN l IN (2, 3) THEN -a ELSE a END AS la, CASE WHEN l = 3 THEN -b ELSE b END AS lo FROM x) "
    "SELECT o_orderkey, CASE l WHEN 2 THEN strftime(t, '%Y-%m-%d') || ' 03:04:05' WHEN 3 THEN NULL ELSE strftime(t, '%Y-%m-%d %H:%M:%S') END AS moment, CAST(v + CASE l WHEN 0 THEN 0.5 WHEN 2 THEN 0.25 ELSE 0 END AS DOUBLE) AS speed_kmh, "
    "CASE WHEN a <= 90 AND b <= 180 THEN CAST(la AS DOUBLE) END AS lat, CASE WHEN a <= 90 AND b <= 180 THEN CAST(lo AS DOUBLE) END AS lon FROM y"
)


@query(OVERLAYS)
def overlay_parse(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    parts = {**{n: F.date_format("o_orderdate", java) for n, (java, _) in _DATES.items()}, "v": F.col("o_orderkey") % 140, "a": F.col("o_orderkey") % 95, "b": F.col("o_custkey") % 190}
    texts = [F.concat(*[parts[x[1:-1]].cast("string") if x.startswith("{") else F.lit(x) for x in re.split(r"(\{.\})", layout) if x]) for layout in _LAYOUTS]
    t = F.get(F.array(*texts), (F.col("o_orderkey") % 4).cast("int"))
    return o.select("o_orderkey", S.overlay(t).alias("x")).select("o_orderkey", "x.*")


@query("SELECT o_orderkey, CAST(regexp_extract(CAST(o_orderkey AS VARCHAR), '(30|40|50|60|70|80|90|100|110)', 1) AS INTEGER) AS limit_kmh FROM orders WHERE regexp_matches(CAST(o_orderkey AS VARCHAR), '(30|40|50|60|70|80|90|100|110)')")
def speed_sign(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("o_orderkey").cast("string")
    return table(spark, d, "orders").where(F.rlike(t, F.lit(S.SIGN))).select("o_orderkey", F.regexp_extract(t, S.SIGN, 1).cast("int").alias("limit_kmh"))


@query("SELECT doc_id, md5(regexp_replace(text, 'pathetic clown|worthless|pathetic|idiot|clown', '', 'g')) AS clean, len(regexp_extract_all(text, 'pathetic clown|worthless|pathetic|idiot|clown')) AS found FROM documents")
def redact_terms(spark: SparkSession, d: str) -> DataFrame:
    terms = ["idiot", "pathetic", "clown", "pathetic clown", "worthless"]
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", F.md5(S.redact(t, terms, "").cast("binary")).alias("clean"), F.size(F.regexp_extract_all(t, F.lit("|".join(sorted(terms, key=lambda x: (-len(x), x)))), F.lit(0))).cast("bigint").alias("found"))


@query("SELECT event_id, coalesce(json_extract_string(props, '$.k'), '확인불가') AS k, json_extract_string(props, '$.k') IS NOT NULL AS known, coalesce(json_extract_string(props, '$.missing'), '확인불가') AS missing FROM events")
def json_path_known(spark: SparkSession, d: str) -> DataFrame:
    got = lambda p: F.get_json_object("props", f"$.{p}")
    return table(spark, d, "events").select("event_id", F.coalesce(got("k"), F.lit(S.UNKNOWN)).alias("k"), got("k").isNotNull().alias("known"), F.coalesce(got("missing"), F.lit(S.UNKNOWN)).alias("missing"))


@query(f"WITH {EV_SQL}, g AS (SELECT user_id, event_type, count(*) FILTER (k >= 50) AS n, sum(k) AS s, count(*) AS c FROM ev GROUP BY ALL) SELECT user_id, event_type, CASE WHEN n > 0 AND s >= 35 * c THEN event_type ELSE '확인불가' END AS fact FROM g")
def evidence_gate(spark: SparkSession, d: str) -> DataFrame:
    g = events(spark, d).groupBy("user_id", "event_type").agg(F.collect_list(F.when(F.col("k") >= 50, F.col("event_id"))).alias("ids"), F.sum("k").alias("s"), F.count("*").alias("c"))
    return g.select("user_id", "event_type", EV.supported(F.col("event_type"), F.col("ids"), S.confidence_class(F.col("s"), 70 * F.col("c"), 35 * F.col("c")), S.UNKNOWN).alias("fact"))


@query(f"WITH {EV_SQL} SELECT user_id, count(DISTINCT event_type) AS kinds, CASE WHEN bool_or(event_type = 'purchase' AND value >= 35 AND k >= 35) THEN '접촉' ELSE '확인불가' END AS collision FROM ev GROUP BY user_id")
def verify_collision(spark: SparkSession, d: str) -> DataFrame:
    sure = F.bool_or((F.col("event_type") == "purchase") & (F.col("value") >= 35) & (F.col("k") >= 35))
    return events(spark, d).groupBy("user_id").agg(F.count_distinct("event_type").alias("kinds"), F.when(sure, "접촉").otherwise(S.UNKNOWN).alias("collision"))


@query("SELECT l_orderkey, CASE WHEN count(DISTINCT l_returnflag) >= 2 THEN '차대차' WHEN list_has_any(list(l_returnflag), ['R']) THEN '차대사람' ELSE '확인불가' END AS kind FROM lineitem GROUP BY 1")
def actor_class(spark: SparkSession, d: str) -> DataFrame:
    types = F.collect_set("l_returnflag")
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(types.alias("t")).select("l_orderkey", F.when(F.size("t") >= 2, "차대차").when(F.array_contains("t", "R"), "차대사람").otherwise(S.UNKNOWN).alias("kind"))


@query(f"WITH {EV_SQL} SELECT user_id, quantile_disc(value, 0.05) AS p5, quantile_disc(value, 0.95) AS p95 FROM ev GROUP BY user_id")
def percentile_rank(spark: SparkSession, d: str) -> DataFrame:
    pick = lambda p: F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY value)")
    return events(spark, d).groupBy("user_id").agg(pick(0.05).alias("p5"), pick(0.95).alias("p95"))


def _positions(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    own = F.when(F.col("l_orderkey") % 9 == 0, F.concat(F.lit("D"), F.col("l_linenumber").cast("string")))
    return li.select(F.col("l_suppkey").alias("video_id"), F.col("l_returnflag").alias("label"), (F.col("l_orderkey") % 50).alias("frame"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("ord"), F.col("l_quantity").alias("x"), (F.col("l_extendedprice") / 100).alias("y"), own.alias("detector_id"))


@query()
def tracking_assign(spark: SparkSession, d: str) -> DataFrame:
    return TR.assign(_positions(spark, d))


@query()
def track_chain(spark: SparkSession, d: str) -> DataFrame:
    t = TR.assign(_positions(spark, d)).groupBy("video_id", "label", "track").agg(F.min("frame").alias("first"), F.max("frame").alias("last"), *[f(c, "frame").alias(n) for f, c, n in ((F.min_by, "x", "x0"), (F.min_by, "y", "y0"), (F.max_by, "x", "x1"), (F.max_by, "y", "y1"))])
    return TR.chain(t)


#: Status words of a reply by number, and what they mean; the note stays as it is.
_STATUS = (" Detected", "confirmed", "VISIBLE", "estimated ", "Inferred", "확인불가", "other", "none")
_MEANT = ("observed", "observed", "observed", "computed", "inferred", "unknown", "other", "none")


@query(f"SELECT event_id, '{{\"items\": [{{\"status\": \"' || {list(_MEANT)}[event_id % 8 + 1] || '\"}}, 1], \"note\": \"none\", \"props\": {{\"k\": ' || json_extract_string(props, '$.k') || '}}, \"status\": \"' || {list(_MEANT)}[event_id % 7 + 1] || '\"}}' AS fact FROM events")
def json_guard(spark: SparkSession, d: str) -> DataFrame:
    """Replies in JSON and, each third, as a Python literal, inside fences."""
    e, i = table(spark, d, "events"), F.col("event_id")
    word = lambda n: F.get(F.array(*[F.lit(x) for x in _STATUS]), (i % n).cast("int"))
    q = F.when(i % 3 == 0, "'").otherwise('"')
    field = lambda name, value: F.concat(q, F.lit(name), q, F.lit(": "), value)
    text = lambda x: F.concat(q, x, q)
    reply = F.concat(F.lit("```json\n{"), field("status", text(word(7))), F.lit(", "), field("note", text(F.lit("none"))), F.lit(", "), field("props", F.col("props")), F.lit(", "), field("items", F.concat(F.lit("[{"), field("status", text(word(8))), F.lit("}, 1]"))), F.lit("}\n``` done"))
    return e.select("event_id", DOC.json_guard(reply).alias("fact"))


@query()
def image_metrics(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", DOC.image_metrics(F.col("text").cast("binary"), F.lit(16)).alias("m")).select("doc_id", "m.*")


PART = "CAST(p_size * 13 % 640 AS BIGINT) AS x, CAST(p_partkey * 7 % 360 AS BIGINT) AS y"


def _points(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", (F.col("p_size") * 13 % 640).cast("bigint").alias("x"), (F.col("p_partkey") * 7 % 360).alias("y"))


@query(f"WITH p AS (SELECT p_partkey, {PART} FROM part) SELECT p_partkey, CASE WHEN x < 0.4 * 640 THEN 'left' WHEN x > 0.6 * 640 THEN 'right' ELSE 'centre' END || '-' || CASE WHEN y >= 0.65 * 360 THEN 'near' ELSE 'far' END AS place FROM p")
def relative_position(spark: SparkSession, d: str) -> DataFrame:
    return _points(spark, d).select("p_partkey", S.relative_position(F.col("x"), F.col("y"), F.lit(640), F.lit(360)).alias("place"))


@query(f"WITH p AS (SELECT p_partkey, {PART} FROM part), m AS (SELECT *, x - lag(x) OVER w AS dx, y - lag(y) OVER w AS dy FROM p WINDOW w AS (PARTITION BY p_partkey % 10 ORDER BY p_partkey)) SELECT p_partkey, CASE WHEN abs(dx) > abs(dy) AND abs(dx) > 20 THEN 'lane_change' WHEN dy > 20 THEN 'approach' WHEN dy < -20 THEN 'depart' ELSE 'keep' END AS movement FROM m WHERE dx IS NOT NULL")
def movement_class(spark: SparkSession, d: str) -> DataFrame:
    p = N.with_previous(_points(spark, d).withColumn("track", F.col("p_partkey") % 10), ["track"], ["p_partkey"], {"x": "x0", "y": "y0"}).where("x0 IS NOT NULL")
    return p.select("p_partkey", S.movement(F.col("x") - F.col("x0"), F.col("y") - F.col("y0")).alias("movement"))


@query(f"WITH p AS (SELECT p_partkey, {PART} FROM part) SELECT p_partkey, greatest(0, x - pad) AS x1, greatest(0, y - pad) AS y1, least(640, x + w + pad) AS x2, least(360, y + 10 + pad) AS y2 FROM (SELECT *, 5 + p_partkey % 50 AS w, greatest(8, CAST(trunc(greatest(5 + p_partkey % 50, 10) * 0.35) AS BIGINT)) AS pad FROM p)")
def padded_crop(spark: SparkSession, d: str) -> DataFrame:
    x, y = F.col("x"), F.col("y")
    box = S.padded([x, y, x + 5 + F.col("p_partkey") % 50, y + 10], F.lit(640).cast("bigint"), F.lit(360).cast("bigint"))
    return _points(spark, d).select("p_partkey", *[c.alias(n) for c, n in zip(box, ("x1", "y1", "x2", "y2"), strict=True)])


@query(f"WITH {EV_SQL}, x AS (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY us, event_id) AS v0, us - lag(us) OVER (PARTITION BY user_id ORDER BY us, event_id) AS gap FROM ev) SELECT user_id, event_id, 'occluded' AS rule FROM x WHERE value < 0.45 * v0 UNION ALL SELECT user_id, event_id, 'reappeared' FROM x WHERE gap > {15 * HOUR}")
def occlusion_rules(spark: SparkSession, d: str) -> DataFrame:
    x = N.with_previous(events(spark, d), ["user_id"], ["us", "event_id"], {"value": "v0", "us": "u0"})
    rules = {"occluded": (F.col("value") < 0.45 * F.col("v0"), F.lit(0)), "reappeared": (F.col("us") - F.col("u0") > 15 * HOUR, F.lit(0))}
    return EV.rule_union(x, rules).select("user_id", "event_id", "rule")


@query(f"WITH {EV_SQL} SELECT user_id, count(*) FILTER (k >= 60) AS lit, count(*) FILTER (k BETWEEN 20 AND 59) AS off, count(*) FILTER (k < 20) AS missing, CASE WHEN count(*) >= 3 AND count(*) FILTER (k >= 60) >= 2 AND count(*) FILTER (k < 60) >= 1 THEN '점멸' ELSE '확인불가' END AS state FROM ev GROUP BY user_id")
def flashing_state(spark: SparkSession, d: str) -> DataFrame:
    status = F.when(F.col("k") >= 60, "lit").when(F.col("k") >= 20, "off").otherwise("missing")
    return RE.flashing(events(spark, d).withColumn("status", status), ["user_id"], "status")


@query("SELECT l_suppkey, round_even(median(l_linenumber), 0) AS lanes, median(l_quantity) AS gap, round_even(median(l_quantity) / 3.2 * 1000, 0) / 1000 AS px_per_metre, CASE WHEN count(*) >= 3 THEN 'medium' ELSE 'low' END AS confidence FROM lineitem GROUP BY 1")
def lane_summary(spark: SparkSession, d: str) -> DataFrame:
    gap = F.median("l_quantity")
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.rint(F.median("l_linenumber")).alias("lanes"), gap.alias("gap"), S.rint(gap / 3.2, 3).alias("px_per_metre"), F.when(F.count("*") >= 3, "medium").otherwise("low").alias("confidence"))


@query(f"WITH {EV_SQL}, m AS (SELECT user_id, event_type AS message, 0 AS o, event_id FROM ev WHERE k < 20 UNION ALL SELECT user_id, event_type, 1, event_id FROM ev WHERE value > 80 UNION ALL SELECT user_id, 'late', 2, event_id FROM ev WHERE k > 90), f AS (SELECT user_id, message, min((o, event_id)) AS o FROM m GROUP BY ALL) SELECT user_id, string_agg(message, '; ' ORDER BY o) AS uncertainties FROM f GROUP BY user_id")
def uncertainty_union(spark: SparkSession, d: str) -> DataFrame:
    e, k = events(spark, d), F.col("k")
    rules = {"0": (k < 20, F.col("event_type")), "1": (F.col("value") > 80, F.col("event_type")), "2": (k > 90, F.lit("late"))}
    m = EV.rule_union(e, rules).groupBy("user_id", F.col("score").alias("message")).agg(F.min(F.struct("rule", "event_id")).alias("o"))
    return m.groupBy("user_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o", "message"))), lambda x: x["message"]), "; ").alias("uncertainties"))


@query("SELECT p_partkey, left(regexp_replace(p_name || ' ' || p_type, '[^\\p{L}\\p{N}]', '_', 'g'), 48) AS id, CAST(regexp_extract_all(p_brand || '-' || p_partkey, '\\d+')[-1] AS BIGINT) AS number FROM part")
def safe_ids(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    return p.select("p_partkey", S.safe_id(F.concat_ws(" ", "p_name", "p_type")).alias("id"), S.last_number(F.concat_ws("-", "p_brand", F.col("p_partkey").cast("string"))).alias("number"))


@query(f"WITH {EV_SQL} SELECT event_id, greatest(0, least(899, CAST(round_even((us % {HOUR}) / 60000000.0::DOUBLE * 15.0, 0) AS BIGINT))) AS frame FROM ev")
def second_to_frame(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).select("event_id", S.frame_of((F.col("us") % HOUR) / 60000000.0, F.lit(15.0), F.lit(900).cast("bigint")).alias("frame"))


@query(f"WITH {EV_SQL}, p AS (SELECT user_id, event_id, us, value, lag(value) OVER w AS v0, lag(us) OVER w AS u0 FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)), s AS (SELECT user_id, event_id, us, degrees(atan2(value - v0, (us - u0) / 3600000000.0)) AS a FROM p WHERE us > u0), t AS (SELECT *, abs(a - lag(a) OVER (PARTITION BY user_id ORDER BY us, event_id)) % 360 AS d FROM s) SELECT user_id, event_id, least(d, 360 - d) >= 90 AS sharp FROM t WHERE least(d, 360 - d) >= 60")
def direction_change(spark: SparkSession, d: str) -> DataFrame:
    p = N.with_previous(events(spark, d), ["user_id"], ["us", "event_id"], {"value": "v0", "us": "u0"}).where("us > u0")
    s = p.withColumn("a", S.angle((F.col("us") - F.col("u0")) / 3600000000.0, F.col("value") - F.col("v0")))
    t = N.with_previous(s, ["user_id"], ["us", "event_id"], {"a": "a0"}).withColumn("d", S.angle_delta(F.col("a"), F.col("a0"))).where("d >= 60")
    return t.select("user_id", "event_id", (F.col("d") >= 90).alias("sharp"))


@query("WITH s AS (SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS f FROM orders GROUP BY 1) SELECT c_custkey, CASE WHEN n > 0 THEN round_even(f * 10000.0 / n, 0) / 10000 END AS fill FROM customer LEFT JOIN s ON c_custkey = o_custkey")
def fill_rates(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("f"))
    return table(spark, d, "customer").join(s, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", S.share(F.col("f"), F.col("n")).alias("fill"))


@query(f"WITH {EV_SQL}, g AS (SELECT user_id, count(DISTINCT event_type) AS n, count(*) FILTER (k >= 35) AS seen, CAST(sum(k) AS BIGINT) AS s, count(*) AS c FROM ev GROUP BY 1) SELECT user_id, round_even(least(1.0, greatest(0.0, 0.45 * (s / (100.0 * c)) + 0.35 * (seen / CAST(c AS DOUBLE)) + 0.20 * least(1.0, n / 3.0))) * 1000, 0) / 1000 AS quality FROM g")
def reading_quality(spark: SparkSession, d: str) -> DataFrame:
    g = events(spark, d).groupBy("user_id").agg(F.count_distinct("event_type").alias("n"), F.count_if(F.col("k") >= 35).alias("seen"), F.sum("k").alias("s"), F.count("*").alias("c"))
    return g.select("user_id", RE.final_score(F.col("n"), F.col("s") / (100.0 * F.col("c")), F.col("seen") / F.col("c").cast("double")).alias("quality"))


@query("SELECT doc_id, upper(text) LIKE '%STOP%' OR text LIKE '%정지%' AS stop, len(list_distinct(string_split(text, chr(10)))) AS lines FROM documents")
def text_flags(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", (F.upper(t).contains("STOP") | t.contains("정지")).alias("stop"), F.size(F.array_distinct(F.split(t, "\n"))).cast("bigint").alias("lines"))
