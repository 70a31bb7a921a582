"""Queries of media metadata, frame measures and sampling plans, with DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import media as M
from ..operators import quality as Q
from ..operators import readings as RE
from ..sources.tables import events, table
from .catalogue import EV_SQL, HOUR, PEAKS, peak_suppression, query
from .frames import dealt

#: Probe outputs by number; {w} is a width. With what each has to give.
_PROBES = (
    ('{"streams": [{"codec_type": "audio"}, {"codec_type": "video", "width": {w}, "height": 480, "avg_frame_rate": "30000/1001", "r_frame_rate": "30/1", "nb_frames": "300", "duration": "10.01"}], "format": {"duration": "10.5"}}', ("10.01", "30000/1001.0", "300", "true", None)),
    ('{"streams": [{"codec_type": "video", "width": "{w}", "height": "480", "avg_frame_rate": "0/0", "r_frame_rate": "25/1", "duration": "4.2"}]}', ("4.2", "25.0", "105", "false", None)),
    ('{"streams": [{"codec_type": "video", "width": {w}, "height": 480, "avg_frame_rate": "N/A", "r_frame_rate": " 24 ", "duration": ""}], "format": {"duration": 3.5}}', ("3.5", "24.0", "84", "false", None)),
    ('{"streams": [{"codec_type": "audio", "width": {w}}]}', (None, None, None, None, "No video stream found in ffprobe payload")),
    ('{"streams": [{"codec_type": "video", "width": 0, "height": 480, "avg_frame_rate": "25"}]}', (None, None, None, None, "Invalid width: expected positive integer")),
    ('{"streams": [{"codec_type": "video", "width": {w}, "height": 480, "avg_frame_rate": "abc", "r_frame_rate": "-5", "nb_frames": "9"}]}', (None, None, None, None, "Invalid frame rate: expected positive avg_frame_rate or r_frame_rate")),
    ('{"streams": [{"codec_type": "video", "width": {w}, "height": 480, "avg_frame_rate": "29.5", "nb_frames": 120, "duration": "N/A"}]}', ("0.0", "29.5", "120", "false", None)),
    ('{"streams": [{"codec_type": "video", "width": {w}, "height": 480, "avg_frame_rate": "25", "nb_frames": "0"}]}', (None, None, None, None, "Missing valid duration and nb_frames; cannot compute frame_count")),
    ('{"streams": {"codec_type": "video", "width": {w}}}', (None, None, None, None, "Malformed ffprobe payload: streams must be a list")),
    ('{"streams": [{"codec_type": "video", "width": {w}, "height": 480, "avg_frame_rate": "25/1", "nb_frames": "50", "duration": "-1"}], "format": {"duration": "2.0"}}', ("2.0", "25.0", "50", "false", None)),
    ('{"streams": [{"codec_type": "video", "width": {w}, "height": "abc", "avg_frame_rate": "25/1"}]}', (None, None, None, None, "Invalid height: expected positive integer")),
    ('{"streams": [{"codec_type": "video", "width": {w}, "height": 480, "avg_frame_rate": "30", "nb_frames": true, "duration": "1.5"}]}', ("1.5", "30.0", "45", "false", None)),
    ('{"format": {}}', (None, None, None, None, "No video stream found in ffprobe payload")),
)
_GIVEN = ", ".join("({}, {})".format(i, ", ".join(f"'{x}'" if isinstance(x, str) and k == 4 else str(x or "NULL") for k, x in enumerate(want))) for i, (_, want) in enumerate(_PROBES))


@query(f"WITH g(i, duration_sec, fps, frame_count, has_audio, error) AS (VALUES {_GIVEN}) SELECT p_partkey, CAST(duration_sec AS DOUBLE) AS duration_sec, CAST(fps AS DOUBLE) AS fps, CASE WHEN error IS NULL THEN CAST(640 + p_partkey % 7 AS VARCHAR) || 'x480' END AS resolution, CAST(frame_count AS BIGINT) AS frame_count, CAST(has_audio AS BOOLEAN) AS has_audio, error FROM part JOIN g ON p_partkey % {len(_PROBES)} = i")
def video_probe(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("p_partkey")
    text = F.replace(F.get(F.array(*[F.lit(t) for t, _ in _PROBES]), (i % len(_PROBES)).cast("int")), F.lit("{w}"), (640 + i % 7).cast("string"))
    return dealt(table(spark, d, "part").select("p_partkey"), "p_partkey").select("p_partkey", M.probe(text).alias("m")).select("p_partkey", "m.*")


#: Stand-in measures of frames, in SQL and as columns.
_MEASURES = "value * 2 AS blur, k * 2.5 AS brightness, value * 0.75 AS noise, k / 800.0 AS glare, (100 - k) / 150.0 AS dark, value * 0.5 AS contrast"
_FLAGGED = "list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{f}' END" for c, f in zip(("blur < 80", "brightness < 65", "brightness > 205", "noise > 75", "glare > 0.08", "dark > 0.45", "contrast < 35"), M.FLAGS, strict=True)) + "], lambda x: x IS NOT NULL)"
_FRAMES = f"{EV_SQL}, fr0 AS (SELECT event_id, user_id, us, k, {_MEASURES}, abs(value - lag(value) OVER (PARTITION BY user_id ORDER BY us, event_id)) AS motion FROM ev), fr AS (SELECT *, {_FLAGGED} AS flags FROM fr0)"


def _frames(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    v, k = F.col("value"), F.col("k")
    before = F.lag("value").over(Window.partitionBy("user_id").orderBy("us", "event_id"))
    e = events(spark, d).select("event_id", "user_id", "us", "k", (v * 2).alias("blur"), (k * 2.5).alias("brightness"), (v * 0.75).alias("noise"), (k / 800.0).alias("glare"), ((100 - k) / 150.0).alias("dark"), (v * 0.5).alias("contrast"), F.abs(v - before).alias("motion"))
    return e.withColumn("flags", M.quality_flags(*[F.col(c) for c in ("blur", "brightness", "noise", "glare", "dark", "contrast")]))


@query(
    f"WITH {_FRAMES}, w AS (SELECT *, len(list_filter(flags, lambda x: x <> 'dark_occlusion_candidate')) AS weak FROM fr) SELECT event_id, array_to_string(flags, ',') AS flags, CASE WHEN list_contains(flags, 'blur') THEN 'high' ELSE 'low' END AS blur, CASE WHEN brightness < 65 THEN 'dark' WHEN brightness > 205 THEN 'overexposed' ELSE 'normal' END AS brightness, "
    "CASE WHEN noise > 75 THEN 'high' ELSE 'low' END AS night_noise, CASE WHEN weak >= 2 THEN 'low' WHEN weak = 1 THEN 'medium' ELSE 'high' END AS analysis_reliability, CASE WHEN blur >= 80 THEN 'none' WHEN motion >= 1.5 AND glare >= 0.03 THEN 'motion_blur_candidate' ELSE 'focus_blur_candidate' END AS blur_type FROM w"
)
def frame_quality(spark: SparkSession, d: str) -> DataFrame:
    kind = M.blur_type(F.col("blur"), F.col("motion"), F.col("glare"))
    return _frames(spark, d).select("event_id", F.array_join("flags", ",").alias("flags"), M.quality_of_flags(F.col("flags")).alias("q"), kind.alias("blur_type")).select("event_id", "flags", "q.*", "blur_type")


_MEAN = "round_even(CAST(sum(CAST({0} AS DECIMAL(18,6))) AS DOUBLE) / count({0}) * 1000.0, 0) / 1000"


@query(
    f"WITH {_FRAMES}, m AS (SELECT user_id, {', '.join(_MEAN.format(c) + f' AS {c}_mean' for c in ('blur', 'brightness', 'noise'))}, coalesce({_MEAN.format('motion')}, 0.0) AS motion_mean, coalesce(max(motion), 0.0) AS peak_motion FROM fr GROUP BY user_id), "
    "p AS (SELECT user_id, us AS peak_time FROM fr WHERE motion IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY motion DESC, event_id) = 1), "
    "c AS (SELECT *, CASE WHEN blur_mean < 80 THEN 'high' WHEN blur_mean > 300 THEN 'low' ELSE 'medium' END AS blur, CASE WHEN brightness_mean < 65 THEN 'dark' WHEN brightness_mean > 205 THEN 'overexposed' ELSE 'normal' END AS brightness, CASE WHEN noise_mean < 35 THEN 'low' WHEN noise_mean > 75 THEN 'high' ELSE 'medium' END AS night_noise, CASE WHEN motion_mean < 0.8 THEN 'low' WHEN motion_mean > 4 THEN 'high' ELSE 'medium' END AS camera_shake FROM m), "
    "w AS (SELECT *, CAST(blur = 'high' AS INTEGER) + CAST(brightness <> 'normal' AS INTEGER) + CAST(night_noise = 'high' AS INTEGER) AS weak FROM c) SELECT w.* EXCLUDE (weak), CASE WHEN weak >= 2 THEN 'low' WHEN weak = 1 THEN 'medium' ELSE 'high' END AS analysis_reliability, p.peak_time FROM w LEFT JOIN p ON p.user_id = w.user_id"
)
def clip_quality(spark: SparkSession, d: str) -> DataFrame:
    return Q.clip_quality(_frames(spark, d), ["user_id"], "event_id", "us")


@query(f"WITH {_FRAMES} SELECT user_id, {', '.join(f'bool_or(list_contains(flags, {chr(39)}{flag}{chr(39)})) AS {name}' for name, flag in Q.CONDITIONS.items())} FROM fr GROUP BY user_id")
def visibility(spark: SparkSession, d: str) -> DataFrame:
    return Q.visibility(_frames(spark, d), ["user_id"], "flags")


@query(
    f"WITH {PEAKS}, {_FRAMES.removeprefix(EV_SQL + ', ')}, w AS (SELECT pk.user_id, pk.event_id AS peak_id, count(*) AS frame_count, count(*) FILTER (len(fr.flags) > 0) AS weak_frame_count, {', '.join(_MEAN.format('fr.' + c) + f' AS mean_{c}' for c in ('blur', 'brightness', 'noise'))} FROM pk JOIN fr ON fr.user_id = pk.user_id AND fr.us BETWEEN pk.us - {6 * HOUR} AND pk.us + {4 * HOUR} GROUP BY ALL) "
    "SELECT *, CASE WHEN weak_frame_count / frame_count >= 0.5 THEN 'low' WHEN weak_frame_count > 0 THEN 'medium' ELSE 'high' END AS analysis_reliability FROM w"
)
def segment_quality(spark: SparkSession, d: str) -> DataFrame:
    w = peak_suppression(spark, d).select("user_id", F.col("event_id").alias("peak_id"), (F.col("us") - 6 * HOUR).alias("w0"), (F.col("us") + 4 * HOUR).alias("w1"))
    return Q.segment_quality(_frames(spark, d), w, ["user_id"], "peak_id", "us", 12 * HOUR)


@query(f"WITH {EV_SQL} SELECT event_id, printf('%02d:%06.3f', CAST(floor(event_id / 29.97 / 60) AS BIGINT), event_id / 29.97 - floor(event_id / 29.97 / 60) * 60) AS code, CASE WHEN k >= 70 THEN 3 WHEN k >= 35 THEN 2 WHEN k >= 10 THEN 1 ELSE 0 END AS rank, NOT (k < 1 AND value < 1) AS flow FROM ev")
def fast_timecode(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("k")
    named = F.when(k >= 70, "high").when(k >= 35, "medium").when(k >= 10, "low").when(k >= 5, "unknown")
    return events(spark, d).select("event_id", M.fast_timecode(F.col("event_id"), F.lit(29.97)).alias("code"), M.rank_of(named).alias("rank"), M.flow_needed(k, F.col("value"), F.lit(0)).alias("flow"))


@query(f"WITH {EV_SQL}, g AS (SELECT user_id, list(event_id ORDER BY event_id) AS l FROM ev WHERE k < user_id % 9 * 3 GROUP BY user_id) SELECT user_id, array_to_string([l[i + 1] FOR i IN list_sort(list_distinct([0, len(l) // 2, len(l) - 1]))], ',') AS sample FROM g")
def sample_positions(spark: SparkSession, d: str) -> DataFrame:
    g = events(spark, d).where("k < user_id % 9 * 3").groupBy("user_id").agg(F.array_sort(F.collect_list("event_id")).alias("l"))
    return g.select("user_id", F.array_join(M.first_middle_last(F.col("l")), ",").alias("sample"))


@query("SELECT p_partkey, greatest(0, round_even((p_size - 3) / 0.25, 0) - 4)::BIGINT AS x1, greatest(0, round_even(p_partkey % 40 / 0.25, 0) - 4)::BIGINT AS y1, least(160, round_even((p_size + 9) / 0.25, 0) + 4)::BIGINT AS x2, least(120, round_even((p_partkey % 40 + 5) / 0.25, 0) + 4)::BIGINT AS y2, (p_size - 3 + p_size + 9) / 2 + 100 AS cx, p_partkey % 40 + 5 + 7 AS bottom FROM part")
def source_boxes(spark: SparkSession, d: str) -> DataFrame:
    y = F.col("p_partkey") % 40
    box = [F.col("p_size") - 3, y, F.col("p_size") + 9, y + 5]
    whole = M.rescaled(box, F.lit(0.25), F.lit(160).cast("bigint"), F.lit(120).cast("bigint"), 4)
    moved = M.bottom_centre(M.shifted(box, F.lit(100), F.lit(7)))
    return table(spark, d, "part").select("p_partkey", *[c.alias(n) for c, n in zip(whole, ("x1", "y1", "x2", "y2"), strict=True)], moved[0].alias("cx"), moved[1].alias("bottom"))




def _readings(spark: SparkSession, d: str) -> DataFrame:
    """Observations made of events: a pass by type, failed where the confidence is low."""
    k, v, kind = F.col("k"), F.col("value"), F.col("event_type")
    target = F.when(kind == "click", "speed").when(kind == "view", "gps").when(kind == "signup", "datetime").when(kind == "error", "general")
    return events(spark, d).select(
        F.col("user_id").alias("video_id"), F.col("event_id").alias("ord"), F.concat(F.lit("f"), F.col("event_id").cast("string")).alias("frame_id"), (k / 100.0).alias("confidence"), target.alias("target_field"), F.when(k < 10, "failed").when(k < 50, "observed").alias("status"),
        F.when(k % 2 == 0, F.concat(F.lit("t"), (k % 4).cast("string"))).alias("moment"), F.when(k % 3 > 0, v).alias("speed_kmh"), F.when(k % 5 > 0, v / 10).alias("lat"), F.when(k % 5 > 0, v / 5).alias("lon"),
    )


_SEEN = "k >= 10 AND CASE field WHEN 'datetime' THEN k % 2 = 0 WHEN 'speed' THEN k % 3 > 0 ELSE k % 5 > 0 END"


@query(f"WITH {EV_SQL} SELECT user_id AS video_id, field, count(*) FILTER ({_SEEN}) AS observed_count, count(*) FILTER (k < 10) AS failure_count, coalesce(round_even(CAST(sum(CAST(k / 100.0 AS DECIMAL(18,6))) FILTER ({_SEEN}) AS DOUBLE) / count(*) FILTER ({_SEEN}) * 1000, 0) / 1000, 0.0) AS mean_confidence FROM ev, (VALUES ('datetime', 'signup'), ('speed', 'click'), ('gps', 'view')) AS f(field, own) WHERE event_type = own OR event_type IN ('error', 'purchase') GROUP BY ALL")
def reading_fields(spark: SparkSession, d: str) -> DataFrame:
    return RE.field_votes(_readings(spark, d))


@query(f"WITH {EV_SQL}, g AS (SELECT user_id, median(value / 10) AS lat, median(value / 5) AS lon, count(*) AS n, CAST(sum(CAST(k / 100.0 AS DECIMAL(18,6))) AS DOUBLE) / count(*) AS c FROM ev WHERE k % 5 > 0 GROUP BY 1) SELECT user_id AS video_id, lat, lon, CASE WHEN n >= 2 THEN 'medium' ELSE 'low' END AS confidence, n AS sample_count, round_even((c * 0.45::DOUBLE + CASE WHEN n >= 2 THEN 0.8::DOUBLE ELSE 0.45::DOUBLE END * 0.35::DOUBLE + least(1.0::DOUBLE, n / 3.0::DOUBLE) * 0.20::DOUBLE) * 1000, 0) / 1000 AS final_confidence_score FROM g")
def reading_positions(spark: SparkSession, d: str) -> DataFrame:
    return RE.positions(_readings(spark, d))


@query()
def reading_speeds(spark: SparkSession, d: str) -> DataFrame:
    return RE.speeds(_readings(spark, d))


@query()
def reading_summary(spark: SparkSession, d: str) -> DataFrame:
    return RE.summary(_readings(spark, d))
