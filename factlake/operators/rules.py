"""Event candidates from tracks, pairs of tracks and clip measures: one DataFrame for
the rules over each kind of row, all with the same columns, and their union with scores.

Positions come as (video_id, track_id, type, ord, t, frame_id, x1, y1, x2, y2), ``ord``
in order of tracks, then of positions. Rules are windows or joins by video; events
carry ``rule`` (the rules' order), the measure that fired, and how many measures
support it.
"""

from __future__ import annotations

import math
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import angle, angle_delta, iou
from .events import event_score
from .joins import pairs_at

#: Kinds of actors that may fall, and movements across lanes.
VULNERABLE = ("person", "보행자", "bicycle", "자전거", "motorcycle", "오토바이", "킥보드")
LATERAL = ("차로변경_좌", "차로변경_우", "끼어들기")
BOX = ("x1", "y1", "x2", "y2")
STATE = "post_event_state_candidate"
#: Turns in degrees that make an event and a strong one, and how near to
#: them the JVM's arc tangent isn't trusted.
TURN, SHARP, UNSURE = 60, 90, 1e-9


def _of(rule: int, event_type: str, time: Column, actors: list[Column], confidence: Column, signals: Column | list[str], supporting: Column | int, evidence: Column, measure: Column, candidate_class: str | None = None) -> list[Column]:
    signals = F.array(*[F.lit(s) for s in signals]) if isinstance(signals, list) else signals
    supporting = F.lit(supporting) if isinstance(supporting, int) else supporting
    ids = F.array(*[a.cast("string") for a in actors]) if actors else F.expr("CAST(array() AS array<string>)")
    return [
        F.lit(rule).alias("rule"), time.cast("double").alias("t"), F.lit(event_type).alias("event_type"), F.lit(candidate_class).cast("string").alias("candidate_class"), ids.alias("actors"), confidence.alias("confidence"),
        signals.alias("signals"), supporting.cast("int").alias("supporting"), evidence.alias("evidence"), measure.cast("double").alias("measure"),
    ]


def _event(df: DataFrame, *of) -> DataFrame:
    """An event of one rule for each row."""
    return df.select("video_id", *_of(*of))


def _fired(df: DataFrame, rules: list[tuple[Column, tuple]]) -> DataFrame:
    """The events of several rules over the same rows, in one pass. The outer form of
    explode, as the plain one infers a filter that evaluates all rules once more."""
    found = F.array_compact(F.array(*[F.when(hit, F.struct(*_of(*of))) for hit, of in rules]))
    return df.select("video_id", F.explode_outer(found).alias("_e")).where("_e IS NOT NULL").select("video_id", "_e.*")


def _class(strong: Column) -> Column:
    return F.when(strong, "medium").otherwise("low")


def area(box: list[Column]) -> Column:
    return F.greatest(F.lit(0), box[2] - box[0]) * F.greatest(F.lit(0), box[3] - box[1])


def _turns(*arrays: pa.Array) -> pa.Array:
    if arrays[0].null_count == len(arrays[0]):
        return pa.nulls(len(arrays[0]), pa.float64())
    rows = zip(*(a.to_pylist() for a in arrays), strict=True)
    delta = lambda x0, y0, x, y: abs(math.degrees(math.atan2(y0, x0)) - math.degrees(math.atan2(y, x))) % 360
    return pa.array([None if None in r else min(d := delta(*r), 360 - d) for r in rows], pa.float64())


def turn_between(old: Column, now: Column) -> Column:
    """The turn in degrees between two moves (dx, dy, angle). The last bits of the JVM's arc
    tangent aren't the C library's, and a right angle lies on a limit: turns next to one
    are taken from the C library, as SQL engines have them."""
    turn = angle_delta(old["angle"], now["angle"])
    unsure = (F.abs(turn - TURN) < UNSURE) | (F.abs(turn - SHARP) < UNSURE)
    given = [F.when(unsure, m[c]) for m in (old, now) for c in ("dx", "dy")]
    return F.coalesce(F.arrow_udf(lambda a, b, c, d: _turns(a, b, c, d), "double").asNondeterministic()(*given), turn)


def track_events(positions: DataFrame) -> DataFrame:
    """What single tracks show, each dealt once: growth of the box over the track and
    from step to step, falls, sudden stops and changes of direction.

    Motion is measured between neighbouring moments of tracks of three positions or more
    (of equal moments none is) and compared with the measured moment before."""
    box, track = [F.col(c) for c in BOX], Window.partitionBy("video_id", "track_id")
    o, m = track.orderBy("ord"), track.orderBy("t", "ord")
    d = positions.withColumns({
        "area": area(box), "ratio": F.greatest(F.lit(0), box[3] - box[1]) / F.greatest(F.lit(1), box[2] - box[0]),
        "cx": (F.col("x1") + F.col("x2")) / 2, "cy": (F.col("y1") + F.col("y2")) / 2,
    })
    d = d.withColumns({
        "n": F.count("*").over(track), "last": F.lead("ord").over(o).isNull(), "a": F.first(F.struct("area", "ratio", "frame_id", "type")).over(o),
        "area0": F.lag("area").over(o), "frame0": F.lag("frame_id").over(o), **{f"{c}0": F.lag(c).over(m) for c in ("cx", "cy", "t")},
    })
    dx, dy = F.col("cx") - F.col("cx0"), F.col("cy") - F.col("cy0")
    d = d.withColumn("now", F.when((F.col("n") >= 3) & (F.col("t") > F.col("t0")), F.struct((F.sqrt(dx * dx + dy * dy) / (F.col("t") - F.col("t0"))).alias("speed"), dx.alias("dx"), dy.alias("dy"), angle(dx, dy).alias("angle"), "frame_id")))
    d = d.withColumn("old", F.last("now", ignorenulls=True).over(m.rowsBetween(Window.unboundedPreceding, -1))).withColumn("turn", turn_between(F.col("old"), F.col("now")))
    whole, moved, actor = F.array("a.frame_id", "frame_id"), F.array("old.frame_id", "frame_id"), [F.col("track_id")]
    size, size0, start, ratio, ratio0 = (F.col(c) for c in ("area", "area0", "a.area", "ratio", "a.ratio"))
    t, speed, speed0, turn = (F.col(c) for c in ("t", "now.speed", "old.speed", "turn"))
    grown = F.col("last") & (F.col("n") >= 2) & (start > 0) & (size >= start * 2.5)
    fallen = F.col("last") & (F.col("n") >= 3) & F.lower("a.type").isin(*VULNERABLE) & (ratio0 > 0) & (ratio < ratio0 * 0.65)
    return _fired(d, [
        (grown, (2, "급접근", t, actor, _class(size >= start * 4), ["bbox_area_increase"], 3, whole, size / start)),
        ((size0 > 0) & (size >= size0 * 1.8), (3, "급접근후보", t, actor, _class(size >= size0 * 2.8), ["bbox_area_frame_to_frame_increase"], 3, F.array("frame0", "frame_id"), size / size0)),
        ((speed0 >= 20) & (speed <= speed0 * 0.35), (4, "사고후정지후보", t, actor, _class(speed0 >= 35), ["object_speed_change"], 3, moved, speed - speed0, STATE)),
        ((turn >= TURN) & (speed0 >= 10) & (speed >= 10), (5, "방향변화후보", t, actor, _class(turn >= SHARP), ["object_direction_change"], 3, moved, turn, STATE)),
        (fallen, (6, "낙상후보", t, actor, _class(ratio <= ratio0 * 0.45), ["bbox_aspect_ratio_change"], 3, whole, ratio0 - ratio, STATE)),
    ])


def lateral_events(tracks: DataFrame, positions: DataFrame) -> DataFrame:
    """Tracks (video_id, track_id, movement, confidence) that cross lanes, at their first position."""
    first = positions.groupBy("video_id", "track_id").agg(F.min_by(F.struct("t", "frame_id"), "ord").alias("p"))
    d = tracks.where(F.col("movement").isin(*LATERAL)).join(first, ["video_id", "track_id"])
    return _event(d, 1, "차로변경시작", F.col("p.t"), [F.col("track_id")], F.coalesce("confidence", F.lit("medium")), ["track_lateral_motion"], 1, F.array("p.frame_id"), F.lit(None))


def contact_events(positions: DataFrame, shakes: DataFrame | None = None) -> DataFrame:
    """Pairs of positions of one moment that overlap by 0.05 or more, with the change
    against the pair's moment before and the video's strongest shake within 0.75 s of it;
    of equally strong ones the earliest."""
    p = pairs_at(positions, ["video_id", "t"], "ord", ["track_id", "frame_id", *BOX])
    p = p.withColumn("v", iou(*[[F.col(f"{c}_{s}") for c in BOX] for s in "ab"]))
    # a pair's moments, whether the boxes overlap or not; pairs of one track have none before
    w = Window.partitionBy("video_id", "track_id_a", "track_id_b").orderBy("t")
    p = p.withColumn("v0", F.when(F.col("track_id_a") != F.col("track_id_b"), F.lag("v").over(w))).where("v >= 0.05")
    near, more, shaken = F.lit(False), F.lit(0), F.expr("CAST(array() AS array<string>)")
    if shakes is not None:
        one = F.struct("t", "value", "compensated", F.col("evidence").alias("seen"))
        s = shakes.where("value IS NOT NULL").groupBy("video_id").agg(F.max_by(one, F.struct("value", -F.col("t"))).alias("s")).where("s.value >= 20").withColumn("ts", F.col("s.t"))
        p = p.join(s, "video_id", "left")
        near = F.coalesce(F.abs(F.col("t") - F.col("ts")) <= 0.75, F.lit(False))
        more, shaken = F.when(near, 1 + F.col("s.compensated").isNotNull().cast("int")).otherwise(0), F.when(near, F.col("s.seen")).otherwise(shaken)
    signals = F.when(near, F.array(F.lit("bbox_overlap"), F.lit("camera_shake"))).otherwise(F.array(F.lit("bbox_overlap")))
    evidence = F.array_distinct(F.filter(F.concat(F.array("frame_id_a", "frame_id_b"), shaken), lambda e: F.coalesce(e, F.lit("")) != ""))
    return _event(p, 7, "접촉", F.col("t"), [F.col("track_id_a"), F.col("track_id_b")], _class(F.col("v") >= 0.12), signals, 1 + F.col("v0").isNotNull().cast("int") + more, evidence, F.col("v"), "direct_contact_candidate")


def speed_drop(speeds: DataFrame) -> DataFrame:
    """The own vehicle's first against its last speed (video_id, ord, kmh, t, evidence): a drop of 20 or more."""
    known = speeds.where("kmh IS NOT NULL")
    d = known.groupBy("video_id").agg(F.count("*").alias("n"), *[f(F.struct("kmh", "t", "evidence"), "ord").alias(n) for f, n in ((F.min_by, "a"), (F.max_by, "b"))]).withColumn("drop", F.col("a.kmh") - F.col("b.kmh"))
    return _event(d.where("n >= 2 AND drop >= 20"), 8, "급감속", F.col("b.t"), [F.lit("ego_vehicle")], _class(F.col("drop") >= 30), ["speed_drop"], 3, F.concat("a.evidence", "b.evidence"), F.col("drop"))


def approaches(motion: DataFrame) -> DataFrame:
    """Two events for each relative motion (video_id, actor_id, trend, confidence, t) that approaches."""
    near, none = F.col("trend") == "접근", F.expr("CAST(array() AS array<string>)")
    kinds = (("접근", None), ("비접촉후보", "non_contact_candidate"))
    return _fired(motion, [(near, (9 + i, kind, F.col("t"), [F.col("actor_id")], F.coalesce("confidence", F.lit("low")), ["relative_motion"], 1, none, F.lit(None), cls)) for i, (kind, cls) in enumerate(kinds)])


def shake_events(shakes: DataFrame) -> DataFrame:
    """Shakes (video_id, value, compensated, t, evidence) of 20 or more."""
    return _event(shakes.where("value >= 20"), 11, "충격후보", F.col("t"), [], F.lit("low"), ["camera_shake"], 1 + F.col("compensated").isNotNull().cast("int"), F.col("evidence"), F.col("value"))


def flow_events(scans: DataFrame) -> DataFrame:
    """Scan peaks (video_id, t, confidence, flow_peak, evidence) of strong flow."""
    return _event(scans.where("flow_peak >= 1.2"), 12, "광류급변후보", F.col("t"), [], F.coalesce("confidence", F.lit("low")), ["event_scan_optical_flow"], 3, F.col("evidence"), F.col("flow_peak"), "motion_peak_candidate")


def event_candidates(positions: DataFrame, tracks: DataFrame | None = None, speeds: DataFrame | None = None, motion: DataFrame | None = None, shakes: DataFrame | None = None, scans: DataFrame | None = None) -> DataFrame:
    """All rules' events with their scores; a video's best first by ``rank``."""
    found = [track_events(positions), contact_events(positions, shakes)]
    found += [lateral_events(tracks, positions)] if tracks is not None else []
    found += [speed_drop(speeds)] if speeds is not None else []
    found += [approaches(motion)] if motion is not None else []
    found += [shake_events(shakes)] if shakes is not None else []
    found += [flow_events(scans)] if scans is not None else []
    e = reduce(DataFrame.unionByName, found)
    return e.withColumn("event_score", event_score(*[F.col(c) for c in ("confidence", "signals", "evidence", "supporting", "event_type", "candidate_class")]))


def best_events(events: DataFrame, k: int = 24) -> DataFrame:
    """The ``k`` best of each video, by score, then time, then the rules' order."""
    w = Window.partitionBy("video_id").orderBy(F.desc("event_score"), F.col("t").asc_nulls_first(), "rule", "actors")
    return events.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def segments(events: DataFrame, duration: str, before: float = 6.0, after: float = 4.0) -> DataFrame:
    """A window around each event (video_id, ord, t, ...) within the clip, numbered in
    order; events without a time are left out."""
    d = events.where("t IS NOT NULL").withColumns({"start": F.greatest(F.lit(0.0), F.col("t") - before), "end": F.least(F.col(duration), F.col("t") + after)})
    number = F.row_number().over(Window.partitionBy("video_id").orderBy("ord"))
    return d.withColumn("id", F.format_string("seg_event_%03d", number))
