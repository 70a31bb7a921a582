"""Queries of records of any shape, built by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import contracts as CO
from ..functions import packages as PA
from ..functions import variants as VA
from ..operators.packages import assembled
from ..sources.tables import events, table
from .catalogue import EV_SQL, query

DEFAULTS = {"scene": {"type": {"value": "확인불가", "status": "unknown"}, "note": "none"}, "actors": [], "n": 0}


@query(
    f"WITH {EV_SQL} SELECT event_id, CASE WHEN k % 5 = 2 THEN NULL WHEN k % 5 = 1 THEN event_type ELSE '확인불가' END AS scene, CASE WHEN k % 5 = 2 THEN NULL WHEN k % 5 = 3 THEN 'k' || k ELSE 'none' END AS note, "
    "CAST(CASE WHEN k % 5 = 4 THEN 0 ELSE k END AS BIGINT) AS n, CASE WHEN k % 5 < 4 AND k % 2 = 0 THEN CAST(k AS BIGINT) END AS actor, k % 5 = 1 AS has_extra FROM ev"
)
def record_merge(spark: SparkSession, d: str) -> DataFrame:
    """A payload in its defaults: a section that is absent, deep, replaced by an array, or
    no object at all; arrays are replaced."""
    k, e = F.col("k"), events(spark, d)
    scene = (
        F.when(k % 5 == 1, F.concat(F.lit(', "scene": {"type": {"value": "'), "event_type", F.lit('"}}, "extra": {"deep": [1]}')))
        .when(k % 5 == 2, F.lit(', "scene": ["gone"]'))
        .when(k % 5 == 3, F.concat(F.lit(', "scene": {"note": "k'), k.cast("string"), F.lit('"}')))
        .otherwise("")
    )
    actors = F.when(k % 2 == 0, F.concat(F.lit(', "actors": [{"id": '), k.cast("string"), F.lit("}]"))).otherwise("")
    text = F.when(k % 5 == 4, F.lit("[1, 2]")).otherwise(F.concat(F.lit('{"n": '), k.cast("string"), scene, actors, F.lit("}")))
    m = e.select("event_id", VA.with_defaults(F.try_parse_json(text), DEFAULTS).alias("m"))
    at = lambda path, kind: F.try_variant_get("m", path, kind)
    return m.select("event_id", at("$.scene.type.value", "string").alias("scene"), at("$.scene.note", "string").alias("note"), at("$.n", "long").alias("n"), at("$.actors[0].id", "long").alias("actor"), at("$.extra.deep", "variant").isNotNull().alias("has_extra"))


@query(
    "WITH f AS (SELECT l_orderkey, 'o' || l_orderkey AS file, 1 AS depth FROM lineitem UNION SELECT l_orderkey, 'p' || l_partkey, 3 FROM lineitem UNION SELECT l_orderkey, 's' || l_suppkey, 5 FROM lineitem) SELECT l_orderkey, file, CAST(depth AS INTEGER) AS depth FROM f"
)
def record_files(spark: SparkSession, d: str) -> DataFrame:
    """Each file that an order's record names at any depth, once."""
    name = lambda letter, c: F.concat(F.lit(letter), F.col(c).cast("string"))
    line = F.struct(name("p", "l_partkey").alias("path"), F.array(F.struct(name("s", "l_suppkey").alias("image_path"))).alias("crops"))
    r = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(line).alias("frames"))
    r = r.select("l_orderkey", F.to_json(F.struct("frames", name("o", "l_orderkey").alias("path"), F.lit(7).alias("n"))).alias("t"))
    return VA.file_paths(r, ["l_orderkey"], "t").select("l_orderkey", "file", F.size("path").alias("depth"))


@query(
    f"WITH {EV_SQL}, s AS (SELECT user_id, CASE k % 4 WHEN 0 THEN event_type WHEN 1 THEN event_type || ' (source: ocr, ' || k % 8 || ')' WHEN 2 THEN 'late' END AS m, event_id FROM ev), "
    "f AS (SELECT user_id, m, min(event_id) AS o FROM s WHERE m IS NOT NULL GROUP BY ALL), a AS (SELECT DISTINCT user_id FROM ev) SELECT a.user_id, coalesce(string_agg(m, '; ' ORDER BY o), '') AS messages FROM a LEFT JOIN f USING (user_id) GROUP BY ALL"
)
def record_messages(spark: SparkSession, d: str) -> DataFrame:
    """A user's uncertainties, texts and objects with sources, as distinct texts."""
    k = F.col("k")
    q = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    item = F.when(k % 4 == 0, q('" ', F.col("event_type"), '"')).when(k % 4 == 1, q('{"note": " ", "message": "', F.col("event_type"), '", "source": ["ocr", ', (k % 8).cast("string"), "]}")).when(k % 4 == 2, F.lit('{"note": "late", "source": []}')).otherwise('"  "')
    g = events(spark, d).groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("event_id", item.alias("i")))), lambda x: x["i"]).alias("l"))
    return g.select("user_id", F.array_join(VA.messages(F.try_parse_json(F.concat(F.lit("["), F.array_join("l", ","), F.lit("]")))), "; ").alias("messages"))


@query(
    f"WITH {EV_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i, count(*) OVER (PARTITION BY user_id) AS c FROM ev) "
    "SELECT user_id, coalesce(string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) FILTER (i <= 20 AND k % 7 <> 0), '') AS frames, count(*) FILTER (i <= 20 AND k % 7 <> 0 AND k % 3 <> 0) AS with_confidence, false AS has_path, "
    "least(8, count(*)) AS segments, string_agg(CAST(k AS VARCHAR), ',' ORDER BY i) FILTER (i = 1 OR i = c // 2 + 1 OR i = c) AS positions, least(12, count(*)) AS events, '{}' AS geometry FROM n GROUP BY user_id"
)
def package_compact(spark: SparkSession, d: str) -> DataFrame:
    """A user's evidence package (frames, some of them no objects, segments, a track and
    events) cut for a prompt."""
    k, i = F.col("k"), F.col("event_id")
    frame = F.when(k % 7 == 0, F.lit('"gone"')).otherwise(F.to_json(F.struct("event_id", i.alias("id"), F.col("event_type").alias("purpose"), F.lit("f.png").alias("path"), F.when(k % 3 != 0, k).alias("confidence"))))
    g = events(spark, d).groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", "k", frame.alias("f")))).alias("l"))
    joined = lambda f: F.concat(F.lit("["), F.array_join(F.transform("l", f), ","), F.lit("]"))
    number = lambda x: x["event_id"].cast("string")
    parts = ['{"frames": ', joined(lambda x: x["f"]), ', "crops": "none", "selected_segments": ', joined(number), ', "precomputed_facts": {"tracks": [{"track_id": "a", "path": "x", "positions": ', joined(lambda x: x["k"].cast("string")), '}], "event_candidates": ', joined(number), "}}"]
    text = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    c = g.select("user_id", F.try_parse_json(PA.compact(F.try_parse_json(text))).alias("c"))
    at = lambda path, kind: F.try_variant_get("c", path, kind)
    frames = at("$.frames", "array<variant>")
    has = lambda key: F.filter(frames, lambda f: F.try_variant_get(f, key, "variant").isNotNull())
    return c.select(
        "user_id", F.array_join(F.transform(frames, lambda f: F.try_variant_get(f, "$.id", "string")), ",").alias("frames"), F.size(has("$.confidence")).cast("bigint").alias("with_confidence"), (F.size(has("$.path")) > 0).alias("has_path"),
        F.size(at("$.selected_segments", "array<variant>")).cast("bigint").alias("segments"), F.array_join(at("$.precomputed_facts.tracks[0].positions", "array<string>"), ",").alias("positions"),
        F.size(at("$.precomputed_facts.event_candidates", "array<variant>")).cast("bigint").alias("events"), F.to_json(at("$.precomputed_facts.road_geometry", "variant")).alias("geometry"),
    )


@query(
    f"WITH {EV_SQL}, f AS (SELECT event_id, concat_ws('; ', CASE WHEN k % 5 IN (0, 1) THEN 'id cannot be blank' END, CASE WHEN k % 4 IN (1, 2, 3) THEN 'time must be MM:SS.mmm' END, CASE WHEN k < 10 THEN 'frame_index must not be negative' END, CASE WHEN event_type = 'error' THEN 'purpose cannot be blank' END) AS faults FROM ev) SELECT * FROM f WHERE faults <> ''"
)
def frame_faults(spark: SparkSession, d: str) -> DataFrame:
    """Selected frames that break their contract, with what they break."""
    k = F.col("k")
    id_ = F.when(k % 5 == 0, F.lit(" 　\t")).when(k % 5 != 1, k.cast("string"))
    time = F.when(k % 4 == 0, F.lit("100:59.001")).when(k % 4 == 1, F.lit("00:61.000")).when(k % 4 == 2, F.lit(" 00:01.000"))
    purpose = F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type"))
    return CO.rejected(events(spark, d), CO.frame_rules(id_, time, k - 10, purpose)).select("event_id", F.array_join("faults", "; ").alias("faults"))


@query(
    f"WITH {EV_SQL} SELECT event_type, count(*) FILTER (k % 6 = 5) AS bad_status, count(*) FILTER (k % 7 = 0) AS blank_items, count(*) FILTER (k % 6 NOT IN (3) AND k % 4 <> 0 AND k % 7 <> 0) AS no_source, count(*) FILTER (k % 6 <> 5 AND k % 7 <> 0 AND (k % 6 = 3 OR k % 4 = 0)) AS whole FROM ev GROUP BY 1"
)
def cell_faults(spark: SparkSession, d: str) -> DataFrame:
    """Cells of facts by what they break; a null status is no status."""
    k = F.col("k")
    status = F.when(k % 6 == 3, "unknown").when(k % 6 == 4, "inferred").when(k % 6 != 5, "observed")
    source = F.when(k % 7 == 0, F.array(F.lit("ocr"), F.lit("  "))).when(k % 4 == 0, F.array(F.lit("ocr"))).when(k % 4 == 1, F.expr("CAST(array() AS array<string>)"))
    rules = CO.cell_rules(status, F.lit("low"), source, F.lit(None).cast("array<string>"))
    e = events(spark, d).withColumn("b", CO.broken(rules))
    n = lambda text: F.count_if(F.array_contains("b", text))
    return e.groupBy("event_type").agg(
        n("status is not known").alias("bad_status"), n("source and evidence items cannot be blank").alias("blank_items"),
        n("source is required when status is not unknown").alias("no_source"), F.count_if(F.size("b") == 0).alias("whole"),
    )


@query(
    "WITH f AS (SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_linenumber, l_partkey) FILTER (l_quantity >= 10) AS frames, string_agg(CAST(l_suppkey AS VARCHAR), ',' ORDER BY l_linenumber DESC, l_suppkey DESC) FILTER (l_returnflag = 'R') AS tracks FROM lineitem GROUP BY 1) "
    "SELECT o_orderkey, coalesce(frames, '') AS frames, coalesce(tracks, '') AS tracks, CASE WHEN o_orderstatus = 'O' THEN 'none' ELSE o_orderpriority END AS quality FROM orders LEFT JOIN f ON o_orderkey = l_orderkey"
)
def package_assembled(spark: SparkSession, d: str) -> DataFrame:
    """An order's lines as the frames and tracks of one package, read back from it."""
    li = table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    at = lambda key: F.col("l_linenumber").cast("long") * 10**9 + F.col(key)  # noqa: E731  line numbers may repeat
    frames = li.where("l_quantity >= 10").select("o_orderkey", at("l_partkey").alias("n"), F.col("l_partkey").alias("id"))
    tracks = li.where("l_returnflag = 'R'").select("o_orderkey", (-at("l_suppkey")).alias("n"), F.col("l_suppkey").alias("id"))
    quality = F.when(F.col("o_orderstatus") != "O", F.struct(F.col("o_orderpriority").alias("reliability")))
    p = assembled(table(spark, d, "orders"), ["o_orderkey"], {"frames": (frames, "n")}, {"tracks": (tracks, "n")}, {"input_quality": quality})
    ids = lambda path: F.array_join(F.from_json(F.get_json_object("package", path), "array<struct<id long>>")["id"], ",")
    return p.select("o_orderkey", ids("$.frames").alias("frames"), ids("$.precomputed_facts.tracks").alias("tracks"), F.coalesce(F.get_json_object("package", "$.precomputed_facts.input_quality.reliability"), F.lit("none")).alias("quality"))
