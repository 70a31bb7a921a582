"""Evidence of events in frames: boxes in selected frames, event overlays, images for a
reader, and the hints that go with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import padded, rint
from .joins import in_window
from .ranking import top_k

#: Pixels below which a crop is small, the distance from the centre at which
#: it is at the edge, and confidences that are a risk.
SMALL, EDGE, UNSURE = 32 * 32, 0.45, ("low", "unknown")
#: The order of images by purpose, and by section for other purposes.
PURPOSE_ORDER = {
    "traffic_light_crop": 0, "sign_crop": 1, "event_segment": 2, "impact_candidate": 2, "event_scan_impact_candidate": 2, "pre_impact": 3, "event_scan_pre_impact": 3, "actor_crop": 3, "track_overlay": 4, "tracking_overlay": 4,
    "post_impact": 5, "event_scan_post_impact": 5, "bev_overlay": 5, "lane_segmentation_overlay": 6, "motion_keyframe": 7, "event_window_context": 7, "pre_context": 8, "event_scan_pre_context": 8, "regular_context": 8,
    "frame_selection_contact_sheet": 9,
}
SECTION_ORDER = {"crops": 20, "overlays": 40, "evidence_images": 60, "frames": 80}
#: The signal state that two states make up, and its parts.
RED_LEFT, PARTS = "적색+좌회전", ("적색", "좌회전녹색")


def clipped(box: list[Column], width: Column, height: Column) -> list[Column]:
    """A box inside its frame, as numbers; null where nothing is left of it."""
    x1, y1, x2, y2 = (b.cast("int") for b in box)
    held = [F.greatest(F.lit(0), F.least(x1, width - 1)), F.greatest(F.lit(0), F.least(y1, height - 1)), F.greatest(F.lit(0), F.least(x2, width)), F.greatest(F.lit(0), F.least(y2, height))]
    good = (held[2] > held[0]) & (held[3] > held[1])
    return [F.when(good, h) for h in held]


def crop_quality(box: list[Column], width: Column, height: Column, confidence: Column) -> Column:
    """Struct of a clipped box: its area and share, whether it is small or touches the
    frame's edge, its centre's distance from the frame's, and the track's confidence."""
    x1, y1, x2, y2 = box
    area = (x2 - x1) * (y2 - y1)
    away = F.sqrt(((x1 + x2) / 2 / width - 0.5) ** 2 + ((y1 + y2) / 2 / height - 0.5) ** 2)
    return F.struct(
        area.alias("area_px"), rint(area / (width * height), 5).alias("area_ratio"), (area < SMALL).alias("too_small"), rint(away, 4).alias("center_distance_norm"),
        ((x1 <= 0) | (y1 <= 0) | (x2 >= width) | (y2 >= height)).alias("clipped"), F.coalesce(confidence, F.lit("unknown")).alias("track_confidence"),
    )


def crop_risk(quality: Column) -> Column:
    """What speaks against a crop."""
    risks = {"small_crop": quality["too_small"], "bbox_clipped": quality["clipped"], "low_track_confidence": quality["track_confidence"].isin(*UNSURE), "edge_object": quality["center_distance_norm"] > EDGE}
    return F.array_compact(F.array(*[F.when(bad, name) for name, bad in risks.items()]))


def framed(positions: DataFrame, frames: DataFrame, keys: list[str]) -> DataFrame:
    """Positions (keys, frame_id, x1 to y2, confidence) in selected frames that have a
    file (frame_id, path, width, height): the clipped ``box``, the ``padded`` one, its
    ``quality`` and ``risk``. Frames that weren't selected and empty boxes drop out."""
    f = frames.where("path IS NOT NULL AND path <> ''").select(*keys, "frame_id", "path", "width", "height")
    d = positions.join(f, [*keys, "frame_id"])
    w, h = F.col("width"), F.col("height")
    d = d.withColumn("box", F.array(*clipped([F.col(c) for c in ("x1", "y1", "x2", "y2")], w, h))).where(F.col("box")[0].isNotNull())
    box = [F.col("box")[i] for i in range(4)]
    d = d.withColumns({"padded": F.array(*padded(box, w, h)), "quality": crop_quality(box, w, h, F.col("confidence"))})
    return d.withColumn("risk", crop_risk(F.col("quality")))


def event_overlays(events: DataFrame, frames: DataFrame, positions: DataFrame, keys: list[str], order: str, most: int = 8, each: int = 2) -> DataFrame:
    """The best events of a video (evidence as an array of frame ids, in ``order`` where
    scores are equal) with the first ``each`` frames that were selected, and the clipped
    boxes drawn there. ``rank`` counts from 0 over the best events; those without a frame
    leave a gap."""
    best = top_k(events, keys, [-F.coalesce(F.col("event_score"), F.lit(0)), F.col(order)], most).withColumn("rank", F.col("rank") - 1)
    f = frames.where("path IS NOT NULL AND path <> ''").select(*keys, "frame_id", "width", "height")
    cited = best.select(*keys, "rank", F.posexplode("evidence").alias("_n", "frame_id")).join(f, [*keys, "frame_id"])
    cited = cited.withColumn("_k", F.row_number().over(Window.partitionBy(*keys, "rank").orderBy("_n"))).where(F.col("_k") <= each)
    boxes = cited.join(positions, [*keys, "frame_id"], "left")
    box = F.array(*clipped([F.col(c) for c in ("x1", "y1", "x2", "y2")], F.col("width"), F.col("height")))
    drawn = F.when(box[0].isNotNull(), F.struct("_k", "track_id", box.alias("box")))
    g = boxes.groupBy(*keys, "rank").agg(F.array_sort(F.collect_set(F.struct("_k", "frame_id"))).alias("_f"), F.array_sort(F.collect_list(drawn)).alias("_b"))
    out = best.join(g, [*keys, "rank"])
    return out.withColumns({"evidence": F.transform("_f", lambda x: x["frame_id"]), "boxes": F.transform("_b", lambda x: F.struct(x["_k"].alias("frame"), x["track_id"].alias("track_id"), x["box"].alias("box")))}).drop("_f", "_b")


def picked_images(records: DataFrame, keys: list[str], order: list[str], most: int = 20) -> DataFrame:
    """The images that a reader gets (section, path, purpose, importance, slot): those of
    the storyboard by slot, where there is one; else all by the order of purposes and
    sections less their importance, then by ``order``. Each path once, the first of it;
    ``most`` at most, all for 0. ``rank`` from 1."""
    weight = F.coalesce(*[F.element_at(F.create_map(*[F.lit(x) for pair in t.items() for x in pair]), F.coalesce(F.col(c), F.lit(""))) for t, c in ((PURPOSE_ORDER, "purpose"), (SECTION_ORDER, "section"))], F.lit(100))
    board = F.col("section") == "storyboard"
    has = F.max(board.cast("int")).over(Window.partitionBy(*keys)) if keys else F.max(board.cast("int")).over(Window.partitionBy(F.lit(0)))
    d = records.where("path IS NOT NULL AND path <> ''").withColumn("_has", has).where((F.col("_has") == 1) == board)
    slot = F.when(F.coalesce("slot", F.lit(0)) == 0, 9999).otherwise(F.col("slot"))
    d = d.withColumn("_w", F.when(board, slot).otherwise(weight - F.coalesce(F.col("importance").cast("int"), F.lit(0))))
    first = F.row_number().over(Window.partitionBy(*keys, "path").orderBy("_w", *order))
    d = d.withColumn("_n", first).where("_n = 1")
    d = d.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy("_w", *order))).drop("_has", "_w", "_n")
    return d.where(F.col("rank") <= most) if most > 0 else d


def records_of(paths: DataFrame, records: DataFrame, keys: list[str], order: str, all_paths: bool = False) -> DataFrame:
    """The records of a list of paths (ord, path), in the list's order: of several records
    of one path the last by ``order``. Paths without one drop out, or stay with nulls."""
    last = records.where("path IS NOT NULL AND path <> ''").groupBy(*keys, "path").agg(F.max_by(F.struct("*"), order).alias("record"))
    return paths.join(last, [*keys, "path"], "left" if all_paths else "inner")


def track_confidence(positions: Column, own: Column) -> Column:
    """Of a merged track, by its positions' number; with one its own."""
    return F.when(positions >= 5, "high").when(positions >= 2, "medium").otherwise(F.coalesce(own, F.lit("low")))


def quality_confidence(positions: Column, fragmentation: Column) -> Column:
    """Of a track's measures."""
    return F.when((positions >= 6) & (fragmentation < 25), "high").when((positions >= 3) & (fragmentation < 55), "medium").otherwise("low")


def chosen_shapes(signals: DataFrame, keys: list[str], chosen: str, order: str) -> DataFrame:
    """For each key's ``chosen`` state the observations of it (state, shape, item): the
    most frequent shape, the first seen of equal ones, or unknown; and the items, in
    ``order``. A red light with a left arrow is both of its parts and has the arrow."""
    part = F.when(F.col(chosen) == RED_LEFT, F.coalesce(F.array_position(F.array(*[F.lit(p) for p in PARTS]), F.col("state")), F.lit(0))).otherwise((F.col("state") == F.col(chosen)).cast("long"))
    d = signals.withColumn("_p", part)
    shapes = d.where("_p > 0").groupBy(*keys, "shape").agg(F.count("*").alias("n"), F.min(order).alias("o")).groupBy(*keys).agg(F.max_by("shape", F.struct("n", -F.col("o"))).alias("_s"))
    items = d.groupBy(*keys, chosen).agg(F.transform(F.array_sort(F.collect_list(F.when(F.col("_p") > 0, F.struct("_p", order, "item")))), lambda x: x["item"]).alias("items"))
    shape = F.when(F.col(chosen) == RED_LEFT, "left_arrow").otherwise(F.coalesce("_s", F.lit("unknown")))
    return items.join(shapes, keys, "left").select(*keys, chosen, shape.alias("shape"), "items")


def motion_keyframes(stepped: DataFrame, keys: list[str], frame: str, least: float = 12.0, most: int = 8) -> DataFrame:
    """The frames that differ most from the one before, by at least ``least`` on average;
    the earlier of equal ones; in order of frames."""
    d = stepped.where(F.col("motion.frame_diff") >= least).withColumn("score", F.col("motion.frame_diff"))
    return top_k(d, keys, [-F.col("score"), F.col(frame)], most).drop("rank")


def nearby_events(records: DataFrame, events: DataFrame, keys: list[str], record: str, reach: float = 1.5, most: int = 3) -> DataFrame:
    """Records (t) with ``nearby``: the events (t, event_type, ...) within ``reach`` seconds
    of them, the earliest ``most``; empty without any, or without a time."""
    fields = [c for c in events.columns if c not in keys]
    w = records.where("t IS NOT NULL").select(*keys, F.col(record).alias("_r"), (F.col("t") - reach).alias("_a"), (F.col("t") + reach).alias("_b"))
    near = in_window(events.where("t IS NOT NULL"), w, keys, "t", "_a", "_b", max(1, int(2 * reach)))
    near = top_k(near, [*keys, "_r"], [F.col("t"), *[F.col(c) for c in fields if c != "t"]], most)
    g = near.groupBy(*keys, "_r").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", F.struct(*fields).alias("e")))), lambda x: x["e"]).alias("nearby")).withColumnRenamed("_r", record)
    kind = g.schema["nearby"].dataType.simpleString()
    return records.join(g, [*keys, record], "left").withColumn("nearby", F.coalesce("nearby", F.expr(f"CAST(array() AS {kind})")))


def hints(visible: Column, linked: Column, nearby: Column, actor_type: Column, box: Column) -> Column:
    """A record's hints as JSON, without those that say nothing."""
    some = lambda a: F.when(F.size(a) > 0, a)
    return F.to_json(F.struct(some(visible).alias("visible_actor_candidates"), some(linked).alias("linked_actor_ids"), some(nearby).alias("nearby_event_candidates"), F.when(actor_type != "", actor_type).alias("actor_type_hint"), some(box).alias("localized_bbox")))
