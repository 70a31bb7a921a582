"""Roads and speeds: lines of frames to vanishing points, lanes and their votes, and
the choice among speed estimates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.lines import image_lines, view_matrix
from ..functions.scalar import rint

#: How speeds are had, best first, and which wins among equals.
METHODS = ("metadata", "gps", "obd", "ocr_overlay", "bev_tracking_estimate", "relative_motion_only")
PRIORITY = {"metadata": 0, "gps": 0, "obd": 0, "ocr_overlay": 1, "bev_tracking_estimate": 2, "relative_motion_only": 3}


def best_speed(estimates: DataFrame, actors: DataFrame, actor: str, method: str, order: str) -> DataFrame:
    """For each actor the estimate of the best method, the first on ties; estimates of
    other methods don't count, and an actor without one gets method not_available."""
    rank = F.coalesce(*[F.when(F.col(method) == m, i) for i, m in enumerate(METHODS)])
    columns = [c for c in estimates.columns if c != actor]
    best = estimates.withColumn("_k", rank).where("_k IS NOT NULL").groupBy(actor).agg(F.min_by(F.struct(*columns), F.struct("_k", order)).alias("_b"))
    d = actors.join(best, actor, "left").select(*actors.columns, *[F.col(f"_b.{c}").alias(c) for c in columns])
    return d.withColumn(method, F.coalesce(method, F.lit("not_available")))


def speed_range(relative: Column, own: Column) -> Column:
    """Low and high of an absolute speed from a relative one and the own; null without it."""
    return F.when(own.isNotNull(), F.struct(rint(F.greatest(F.lit(0.0), own - relative), 3).alias("low"), rint(own + relative, 3).alias("high")))


def score_class(score: Column) -> Column:
    """The confidence that a geometry score gives; null counts as 0."""
    s = F.coalesce(score, F.lit(0.0))
    return F.when(s >= 0.8, "high").when(s >= 0.45, "medium").otherwise("low")


def failure_reason(available: Column, matrix: Column, scale: Column, reasons: Column) -> Column:
    """Why no absolute speed can be had; null if it can."""
    fine = F.coalesce(available & matrix.isNotNull() & (scale != 0), F.lit(False))
    return F.when(~fine, F.when(F.coalesce(F.size(reasons), F.lit(0)) > 0, F.array_join(reasons, "; ")).otherwise("homography_or_pixels_per_meter_not_available"))


def geometry_score(samples: Column, has_matrix: Column, has_width: Column) -> Column:
    """0.55 for up to three lane samples, 0.45 for a width (0.4 of it without); 0 without a matrix."""
    s = 0.55 * F.least(F.lit(1.0), samples / 3.0) + 0.45 * F.when(has_width, 1.0).otherwise(0.4)
    return F.when(has_matrix, rint(F.greatest(F.lit(0.0), F.least(F.lit(1.0), s)), 3)).otherwise(0.0)


def lane_vote(lines: Column, mask: Column) -> Column:
    """Two counts of lanes: their half-even mean if they differ by at most one, else the
    lines' one; the other where one is null."""
    return F.when(lines.isNull(), mask).when(mask.isNull(), lines).when(F.abs(lines - mask) <= 1, F.rint((lines + mask) / 2).cast("int")).otherwise(lines)


def vanishing_points(lines: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The component-wise median of where a frame's lines (x1, y1, x2, y2) meet, each
    pair once; parallel lines meet nowhere. Pairs are formed inside one frame's array."""
    line = F.struct(order, "x1", "y1", "x2", "y2")
    g = lines.groupBy(*keys).agg(F.array_sort(F.collect_list(line)).alias("_l"))
    p = g.select(*keys, "_l", F.posexplode("_l").alias("_i", "a")).select(*keys, "a", F.explode(F.slice("_l", F.col("_i") + 2, F.size("_l"))).alias("b"))
    x1, y1, x2, y2, x3, y3, x4, y4 = (F.col(f"{s}.{c}").cast("double") for s in "ab" for c in ("x1", "y1", "x2", "y2"))
    d = (x1 - x2) * (y3 - y4) - (y1 - y2) * (x3 - x4)
    px = ((x1 * y2 - y1 * x2) * (x3 - x4) - (x1 - x2) * (x3 * y4 - y3 * x4)) / d
    py = ((x1 * y2 - y1 * x2) * (y3 - y4) - (y1 - y2) * (x3 * y4 - y3 * x4)) / d
    return p.where(F.abs(d) >= 1e-6).select(*keys, px.alias("px"), py.alias("py")).groupBy(*keys).agg(rint(F.median("px"), 3).alias("x"), rint(F.median("py"), 3).alias("y"))


def median_matrix(df: DataFrame, keys: list[str], matrix: str, digits: int = 6) -> DataFrame:
    """Cell-wise medians of matrices given as arrays of rows."""
    cells = df.select(*keys, F.posexplode(matrix).alias("_i", "_row")).select(*keys, "_i", F.posexplode("_row").alias("_j", "_v"))
    m = cells.groupBy(*keys, "_i", "_j").agg(rint(F.median("_v"), digits).alias("_m"))
    rows = m.groupBy(*keys, "_i").agg(F.transform(F.array_sort(F.collect_list(F.struct("_j", "_m"))), lambda x: x["_m"]).alias("_r"))
    return rows.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_r"))), lambda x: x["_r"]).alias(matrix))


def lane_boundaries(positions: DataFrame, keys: list[str], x: str, width: str) -> DataFrame:
    """Lines at least 8 % of the width from the last line that counted, and the median
    gap between neighbours: two meanings of "the one before"."""
    w = Window.partitionBy(*keys).orderBy(x)
    d = positions.withColumn("_gap", F.col(x) - F.lag(x).over(w))
    g = d.groupBy(*keys).agg(F.array_sort(F.collect_list(F.col(x).cast("double"))).alias("_x"), F.max(width).cast("double").alias("_w"), F.median("_gap").alias("gap"))
    start = F.struct(F.lit(None).cast("double").alias("last"), F.lit(0).alias("n"))
    count = F.aggregate("_x", start, lambda acc, v: F.when(acc["last"].isNull() | (v - acc["last"] > 0.08 * F.col("_w")), F.struct(v.alias("last"), (acc["n"] + 1).alias("n"))).otherwise(acc), lambda acc: acc["n"])
    return g.select(*keys, count.alias("boundaries"), "gap")


def scenes(crosswalk: Column, signal: Column, lanes: Column, markings: Column, frames: Column) -> Column:
    """What a scene may be, as an array of (value, confidence, source): rules in order,
    then road markings; unknown where nothing is seen."""
    one = lambda value, confidence, source: F.struct(F.lit(value).alias("value"), confidence.alias("confidence"), F.lit(source).alias("source"))
    of = {"crosswalk": "횡단보도", "stop_line": "정지선", "centerline_yellow": "중앙선"}
    rules = F.array_compact(F.array(F.when(crosswalk["visible"], one("횡단보도", F.coalesce(crosswalk["confidence"], F.lit("medium")), "traffic_control")), F.when(signal["visible"], one("교차로", F.lit("low"), "traffic_signal_presence")), F.when(lanes["value"] >= 2, one("일반도로", F.coalesce(lanes["confidence"], F.lit("medium")), "road_geometry"))))
    label = F.create_map(*[F.lit(x) for pair in of.items() for x in pair])
    marked = F.transform(F.filter(markings, lambda m: F.map_contains_key(label, m["type"])), lambda m: F.struct(F.element_at(label, m["type"]).alias("value"), F.coalesce(m["confidence"], F.lit("medium")).alias("confidence"), F.lit("road_marking_candidate").alias("source")))
    found = F.concat(rules, F.coalesce(marked, F.slice(rules, 1, 0)))
    return F.when(F.size(found) > 0, found).otherwise(F.array(one("확인불가", F.lit("unknown"), "not_available")))


def middle_of(values: Column) -> Column:
    """The median of an array of doubles; null for none."""
    v, n = F.array_sort(values), F.size(values)
    return F.when(n > 0, (F.get(v, ((n - 1) / 2).cast("int")) + F.get(v, (n / 2).cast("int"))) / 2)


def frame_lanes(frames: DataFrame, keys: list[str], image: str = "image", lines: str | None = None) -> DataFrame:
    """For each decoded frame (or its height, width and the ``lines`` already found in it) what its slanted lines say: ``lanes``, the median ``gap``
    between boundaries in pixels, where the lines meet, and the ``matrix`` of the view
    from above. Nulls where there are no lines. A frame's lines stay in its row."""
    f = frames.select(*keys, F.col(f"{image}.height").alias("_h"), F.col(f"{image}.width").alias("_w"), (image_lines(F.col(image)) if lines is None else F.col(lines)).alias("_l"))
    no = F.expr("CAST(array() AS array<double>)")
    bottom = lambda l: l["x1"] + (l["x2"] - l["x1"]) / (l["y2"] - l["y1"]) * (F.col("_h") - l["y1"])
    at = F.array_sort(F.filter(F.transform(F.filter("_l", lambda l: l["y1"] != l["y2"]), bottom), lambda x: (x >= 0) & (x <= F.col("_w"))))
    f = f.withColumn("_x", F.coalesce(at, no))
    start = F.struct(F.lit(None).cast("double").alias("last"), F.lit(0).alias("n"))
    wide = 0.08 * F.col("_w")
    count = F.aggregate("_x", start, lambda acc, v: F.when(acc["last"].isNull() | (v - acc["last"] > wide), F.struct(v.alias("last"), (acc["n"] + 1).alias("n"))).otherwise(acc), lambda acc: acc["n"])
    gaps = F.filter(F.zip_with(F.slice("_x", 2, F.greatest(F.size("_x") - 1, F.lit(0))), F.slice("_x", 1, F.greatest(F.size("_x") - 1, F.lit(0))), lambda b, a: b - a), lambda g: g > wide)
    # each pair of a frame's lines once: a frame has a few dozen at most
    real = lambda l: [l[c].cast("double") for c in ("x1", "y1", "x2", "y2")]

    def meet(a: Column, b: Column) -> Column:
        (x1, y1, x2, y2), (x3, y3, x4, y4) = real(a), real(b)
        d = (x1 - x2) * (y3 - y4) - (y1 - y2) * (x3 - x4)
        x = ((x1 * y2 - y1 * x2) * (x3 - x4) - (x1 - x2) * (x3 * y4 - y3 * x4)) / d
        y = ((x1 * y2 - y1 * x2) * (y3 - y4) - (y1 - y2) * (x3 * y4 - y3 * x4)) / d
        return F.when(F.abs(d) >= 1e-6, F.struct(x.alias("x"), y.alias("y")))

    pairs = F.array_compact(F.flatten(F.transform("_l", lambda a, i: F.transform(F.slice("_l", i + 2, F.size("_l")), lambda b: meet(a, b)))))
    f = f.withColumns({"_p": pairs, "_n": count, "gap": middle_of(gaps)})
    some = F.size("_x") >= 2
    f = f.withColumns({"vanishing_x": rint(middle_of(F.transform("_p", lambda p: p["x"])), 3), "vanishing_y": rint(middle_of(F.transform("_p", lambda p: p["y"])), 3)})
    matrix = view_matrix(F.col("_h"), F.col("_w"), F.when(some, F.get("_x", F.lit(0))), F.try_element_at("_x", F.lit(-1)), F.col("vanishing_x"), F.col("vanishing_y"))
    return f.select(*keys, F.when(some, F.greatest(F.lit(1), F.col("_n") - 1)).alias("lanes"), F.when(some, F.col("gap")).alias("gap"), "vanishing_x", "vanishing_y", matrix.alias("matrix"))


def geometry(frames: DataFrame, keys: list[str], frame: str, lane_width: Column, image: str = "image", lines: str | None = None) -> DataFrame:
    """A video's road from its frames: half-even median of lanes with its confidence, the
    median vanishing point and matrix, pixels a metre from the gaps, and the score."""
    each = frame_lanes(frames, list(dict.fromkeys([*keys, frame])), image, lines)
    n = F.count("lanes")
    cells = F.array(*[F.array(*[rint(F.median(F.col("matrix")[i][j]), 6) for j in range(3)]) for i in range(3)])
    g = each.groupBy(*keys).agg(
        F.rint(F.median("lanes")).cast("int").alias("lanes"), n.alias("samples"), F.when(n >= 3, "medium").when(n >= 1, "low").otherwise("unknown").alias("confidence"), rint(F.median("vanishing_x"), 3).alias("vanishing_x"),
        rint(F.median("vanishing_y"), 3).alias("vanishing_y"), rint(F.median("gap") / lane_width, 3).alias("pixels_per_meter"), F.count("gap").alias("_gaps"), F.when(F.count("matrix") > 0, cells).alias("matrix"),
    )
    return g.withColumn("score", geometry_score(F.col("samples"), F.col("matrix").isNotNull(), F.col("_gaps") > 0)).drop("_gaps")
