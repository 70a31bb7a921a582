"""Queries of events' evidence in frames, with DuckDB SQL for each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import evidence as EV
from ..sources.tables import events, table
from .catalogue import EV_SQL, HOUR, query

_BOX = "l_partkey % 700 - 30 AS a, l_suppkey % 400 - 20 AS b, l_partkey % 700 - 30 + CAST(l_quantity AS BIGINT) * 2 AS c, l_suppkey % 400 - 20 + CAST(l_quantity AS BIGINT) AS e"


@query(
    f"WITH p AS (SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN 'low' WHEN 'N' THEN 'high' ELSE 'unknown' END AS f, {_BOX} FROM lineitem SEMI JOIN (SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linestatus = 'F') USING (l_orderkey, l_linenumber)), "
    "q AS (SELECT *, greatest(0, least(a, 639)) AS x1, greatest(0, least(b, 359)) AS y1, greatest(0, least(c, 640)) AS x2, greatest(0, least(e, 360)) AS y2 FROM p), r AS (SELECT *, (x2 - x1) * (y2 - y1) AS area, round_even(sqrt(((x1 + x2) / 2 / 640 - 0.5) ** 2 + ((y1 + y2) / 2 / 360 - 0.5) ** 2) * 10000, 0) / 10000 AS away FROM q WHERE x2 > x1 AND y2 > y1) "
    "SELECT l_orderkey, l_linenumber, x1, y1, x2, y2, area, away, array_to_string([x FOR x IN [CASE WHEN area < 1024 THEN 'small_crop' END, CASE WHEN x1 <= 0 OR y1 <= 0 OR x2 >= 640 OR y2 >= 360 THEN 'bbox_clipped' END, CASE WHEN f IN ('low', 'unknown') THEN 'low_track_confidence' END, CASE WHEN away > 0.45 THEN 'edge_object' END] IF x IS NOT NULL], ',') AS risk FROM r"
)
def framed_boxes(spark: SparkSession, d: str) -> DataFrame:
    """Tracks' boxes in the frames that were selected and have a file, with their risks."""
    l, q = table(spark, d, "lineitem"), F.col("l_quantity").cast("bigint")
    x, y = F.col("l_partkey") % 700 - 30, F.col("l_suppkey") % 400 - 20
    confidence = F.when(F.col("l_returnflag") == "A", "low").when(F.col("l_returnflag") == "N", "high")
    positions = l.select("l_orderkey", F.col("l_linenumber").alias("frame_id"), x.alias("x1"), y.alias("y1"), (x + q * 2).alias("x2"), (y + q).alias("y2"), confidence.alias("confidence"))
    path = F.max(F.when(F.col("l_linestatus") == "F", "f.jpg").otherwise("")).alias("path")
    frames = l.groupBy("l_orderkey", F.col("l_linenumber").alias("frame_id")).agg(path, F.lit(640).alias("width"), F.lit(360).alias("height"))
    out = EV.framed(positions, frames, ["l_orderkey"])
    corners = [F.col("box")[i].cast("bigint").alias(n) for i, n in enumerate(("x1", "y1", "x2", "y2"))]
    return out.select("l_orderkey", F.col("frame_id").alias("l_linenumber"), *corners, F.col("quality.area_px").cast("bigint").alias("area"), F.col("quality.center_distance_norm").alias("away"), F.array_join("risk", ",").alias("risk"))


@query(
    f"WITH {EV_SQL}, x AS (SELECT user_id, event_id, event_type, k, CAST(floor(value) AS INTEGER) AS score, lag(event_id) OVER w AS e2, lag(event_type) OVER w AS t2, lag(k) OVER w AS k2, lag(event_id, 2) OVER w AS e3, lag(event_type, 2) OVER w AS t3, lag(k, 2) OVER w AS k3 FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY event_id)), "
    "b AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, event_id) - 1 AS rank FROM x QUALIFY rank < 8), "
    "f AS (SELECT user_id, event_id, CAST(rank AS INTEGER) AS rank, ([y FOR y IN [{'e': event_id, 't': event_type, 'k': k}, {'e': e2, 't': t2, 'k': k2}, {'e': e3, 't': t3, 'k': k3}] IF y.e IS NOT NULL AND y.t <> 'view'])[1:2] AS l FROM b) "
    "SELECT user_id, event_id, rank, array_to_string([y.e FOR y IN l], ',') AS evidence, CAST(len([y FOR y IN l IF y.k % 3 > 0]) AS INTEGER) AS boxes FROM f WHERE len(l) > 0"
)
def event_overlays(spark: SparkSession, d: str) -> DataFrame:
    """A user's best events with their first two selected frames and the boxes there."""
    w = Window.partitionBy("user_id").orderBy("event_id")
    e = events(spark, d)
    cited = F.array_compact(F.array("event_id", F.lag("event_id").over(w), F.lag("event_id", 2).over(w)))
    best = e.select("user_id", "event_id", F.floor("value").cast("int").alias("event_score"), cited.alias("evidence"))
    frames = e.select("user_id", F.col("event_id").alias("frame_id"), F.when(F.col("event_type") != "view", "f.jpg").alias("path"), F.lit(100).alias("width"), F.lit(100).alias("height"))
    # a box that is outside the frame for every third k
    x = F.when(F.col("k") % 3 == 0, -50).otherwise(F.col("k"))
    positions = e.select("user_id", F.col("event_id").alias("frame_id"), F.lit("t").alias("track_id"), x.alias("x1"), F.lit(-5).alias("y1"), (x + 20).alias("x2"), F.lit(30).alias("y2"))
    out = EV.event_overlays(best, frames, positions, ["user_id"], "event_id")
    return out.select("user_id", "event_id", "rank", F.array_join(F.col("evidence").cast("array<string>"), ",").alias("evidence"), F.size("boxes").alias("boxes"))


_PURPOSES = ["sign_crop", "regular_context", "unheard_of", "bev_overlay", "actor_crop", "post_impact", "other"]


@query(
    f"WITH r AS (SELECT l_suppkey, l_orderkey * 10 + l_linenumber AS o, CASE WHEN l_suppkey % 3 = 0 AND l_linenumber % 2 = 0 THEN 'storyboard' ELSE ['crops', 'overlays', 'evidence_images', 'frames', 'else'][l_linenumber % 5 + 1] END AS section, {_PURPOSES}[l_orderkey % 7 + 1] AS purpose, 'p' || l_partkey % 90 AS path, CASE WHEN l_orderkey % 4 > 0 THEN CAST(l_quantity AS INTEGER) END AS importance, CAST(l_partkey % 12 AS INTEGER) AS slot FROM lineitem WHERE l_partkey % 11 > 0), "
    f"b AS (SELECT *, max(CASE WHEN section = 'storyboard' THEN 1 ELSE 0 END) OVER (PARTITION BY l_suppkey) AS has FROM r), w AS (SELECT *, CASE WHEN has = 1 THEN CASE WHEN slot = 0 THEN 9999 ELSE slot END ELSE coalesce(MAP {EV.PURPOSE_ORDER}[purpose], MAP {EV.SECTION_ORDER}[section], 100) - coalesce(importance, 0) END AS w FROM b WHERE has = 0 OR section = 'storyboard'), "
    "u AS (SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY l_suppkey, path ORDER BY w, o) = 1) SELECT l_suppkey, path, CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY w, o) AS INTEGER) AS rank FROM u QUALIFY rank <= 20"
)
def picked_images(spark: SparkSession, d: str) -> DataFrame:
    """The images that go to a reader, by storyboard or by weight, each once."""
    n = F.col("l_linenumber")
    names = F.array(*[F.lit(s) for s in ("crops", "overlays", "evidence_images", "frames", "else")])
    section = F.when((F.col("l_suppkey") % 3 == 0) & (n % 2 == 0), "storyboard").otherwise(F.get(names, (n % 5).cast("int")))
    r = table(spark, d, "lineitem").select(
        "l_suppkey", (F.col("l_orderkey") * 10 + n).alias("o"), section.alias("section"), F.get(F.array(*[F.lit(p) for p in _PURPOSES]), (F.col("l_orderkey") % 7).cast("int")).alias("purpose"),
        F.when(F.col("l_partkey") % 11 > 0, F.concat(F.lit("p"), (F.col("l_partkey") % 90).cast("string"))).alias("path"), F.when(F.col("l_orderkey") % 4 > 0, F.col("l_quantity").cast("int")).alias("importance"), (F.col("l_partkey") % 12).cast("int").alias("slot"),
    )
    return EV.picked_images(r, ["l_suppkey"], ["o"]).select("l_suppkey", "path", "rank")


_STATES, _SHAPES = ["적색", "좌회전녹색", "녹색", "황색"], ["circle", "left_arrow", "unknown"]


@query(
    f"WITH {EV_SQL}, s AS (SELECT user_id, event_id, {_STATES}[k % 4 + 1] AS state, {_SHAPES}[k % 3 + 1] AS shape, ['{EV.RED_LEFT}', '적색', '녹색'][user_id % 3 + 1] AS chosen FROM ev), p AS (SELECT *, CASE WHEN chosen = '{EV.RED_LEFT}' THEN state IN ('적색', '좌회전녹색') ELSE state = chosen END AS fits FROM s), "
    f"m AS (SELECT user_id, shape FROM (SELECT user_id, shape, count(*) AS n, min(event_id) AS o FROM p WHERE fits GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, o) = 1) "
    f"SELECT p.user_id, chosen, CASE WHEN chosen = '{EV.RED_LEFT}' THEN 'left_arrow' ELSE coalesce(any_value(m.shape), 'unknown') END AS shape, coalesce(string_agg(event_id, ',' ORDER BY CASE WHEN chosen = '{EV.RED_LEFT}' AND state = '좌회전녹색' THEN 1 ELSE 0 END, event_id) FILTER (fits), '') AS items, "
    "CASE WHEN count(*) >= 5 THEN 'high' WHEN count(*) >= 2 THEN 'medium' ELSE 'low' END AS merged, CASE WHEN count(*) FILTER (fits) >= 6 AND p.user_id % 70 < 25 THEN 'high' WHEN count(*) FILTER (fits) >= 3 AND p.user_id % 70 < 55 THEN 'medium' ELSE 'low' END AS quality FROM p LEFT JOIN m USING (user_id) GROUP BY p.user_id, chosen"
)
def signal_shapes(spark: SparkSession, d: str) -> DataFrame:
    """The shape and the observations of a chosen signal, and count-based labels."""
    k, of = F.col("k"), lambda names, i: F.get(F.array(*[F.lit(n) for n in names]), i.cast("int"))
    s = events(spark, d).select("user_id", "event_id", of(_STATES, k % 4).alias("state"), of(_SHAPES, k % 3).alias("shape"), of([EV.RED_LEFT, "적색", "녹색"], F.col("user_id") % 3).alias("chosen"), F.col("event_id").alias("item"))
    n = s.groupBy("user_id").agg(F.count("*").alias("n"))
    out = EV.chosen_shapes(s, ["user_id"], "chosen", "event_id").join(n, "user_id")
    labels = EV.track_confidence(F.col("n"), F.lit(None).cast("string")).alias("merged"), EV.quality_confidence(F.size("items"), F.col("user_id") % 70).alias("quality")
    return out.select("user_id", "chosen", "shape", F.array_join(F.col("items").cast("array<string>"), ",").alias("items"), *labels)


@query(
    f"WITH {EV_SQL}, r AS (SELECT user_id, event_id, us FROM ev WHERE event_type = 'purchase'), n AS (SELECT r.user_id, r.event_id, e.event_id AS near, row_number() OVER (PARTITION BY r.user_id, r.event_id ORDER BY e.us, e.event_id) AS i, e.us FROM r JOIN ev e ON e.user_id = r.user_id AND abs(e.us - r.us) <= {3 * HOUR}) "
    "SELECT user_id, event_id, string_agg(near, ',' ORDER BY i) AS nearby FROM n WHERE i <= 3 GROUP BY ALL"
)
def storyboard_hints(spark: SparkSession, d: str) -> DataFrame:
    """The earliest three events near each purchase."""
    e = events(spark, d)
    near = e.select("user_id", F.col("us").alias("t"), "event_id")
    records = e.where("event_type = 'purchase'").select("user_id", "event_id", F.col("us").alias("t"))
    out = EV.nearby_events(records, near, ["user_id"], "event_id", reach=3 * HOUR)
    return out.select("user_id", "event_id", F.array_join(F.transform("nearby", lambda x: x["event_id"].cast("string")), ",").alias("nearby"))
