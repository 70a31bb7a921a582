"""Pixel kernels on drawn frames: flow, compensation, lines, views, shapes, regions."""

import math
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from factlake.functions import lines, motion, regions, shapes
from factlake.operators import motion as moves
from factlake.operators import roads
from factlake.plans import frames

from .conftest import DATA


def texture(h, w, ox=0.0, oy=0.0, turn=0.0, seed=3):
    """A smooth pattern seen by a camera that moved by (ox, oy) and turned."""
    r = np.random.default_rng(seed)
    y, x = np.mgrid[:h, :w].astype(float)
    x, y = x - w / 2, y - h / 2
    x, y = math.cos(turn) * x + math.sin(turn) * y - ox, -math.sin(turn) * x + math.cos(turn) * y - oy
    out = sum(np.sin(r.normal(0, 0.35) * x + r.normal(0, 0.35) * y + r.uniform(0, 6.28)) for _ in range(24))
    return np.clip(np.rint(128 + 22 * out), 0, 255).astype(np.uint8)


@pytest.mark.parametrize("shift", [(0, 0), (1, 0), (2.5, -1.5), (-3, 2), (0.3, 0.7), (4, 3)])
def test_flow_finds_translations(shift):
    flow = motion.dense_flow(texture(54, 96), texture(54, 96, *shift))
    assert np.abs(flow[10:-10, 10:-10].mean((0, 1)) - shift).max() < 0.1
    peak, mean = motion.flow_size(flow[10:-10, 10:-10])
    assert abs(mean - math.hypot(*shift)) < 0.1 and abs(peak - math.hypot(*shift)) < 0.5


def test_flow_of_flat_and_tiny_frames():
    flat = np.full((40, 60), 90, np.uint8)
    assert np.abs(motion.dense_flow(flat, flat + 20)).max() < 0.1
    assert motion.dense_flow(flat[:3, :2], flat[:3, :2]).shape == (3, 2, 2)
    assert motion.scan(flat, flat) == (0.0, 0.0, 0.0, 0.0) and motion.clip_motion(flat, flat) == (0.0, 0.0)
    assert motion.compensated(flat, flat + 51) == pytest.approx(0.2)  # too few corners: the plain difference


def test_compensation_takes_the_camera_out():
    still = texture(90, 160)
    noisy = np.clip(still + np.random.default_rng(1).normal(0, 4, still.shape), 0, 255).astype(np.uint8)
    moved = texture(90, 160, 2, 1, 0.05)
    plain = float(np.abs(still.astype(float) - moved).mean()) / 255
    noise = float(np.abs(still.astype(float) - noisy).mean()) / 255
    assert motion.compensated(still, moved, overlap=True) < noise < plain
    assert motion.compensated(still, moved) < plain / 4
    # an object that moves by itself is what remains
    other = moved.copy()
    other[30:60, 60:100] = 255 - other[30:60, 60:100]
    assert motion.compensated(still, other, overlap=True) > 3 * motion.compensated(still, moved, overlap=True)


def test_similarity_ignores_those_that_disagree():
    rng = np.random.default_rng(5)
    one = rng.uniform(0, 100, (60, 2))
    want = np.array([[1.02 * math.cos(0.1), -1.02 * math.sin(0.1), 4], [1.02 * math.sin(0.1), 1.02 * math.cos(0.1), -3]])
    two = one @ want[:, :2].T + want[:, 2]
    two[:20] += rng.uniform(20, 60, (20, 2))
    assert np.abs(motion.similarity(one, two) - want).max() < 1e-6
    assert motion.similarity(one[:1], two[:1]) is None and motion.similarity(one[[0, 0]], two[[0, 0]]) is None


def test_corners_and_tracking():
    frame = np.zeros((60, 80), np.uint8)
    frame[20:40, 30:50] = 200
    found = motion.corners(frame)
    assert len(found) == 4 and {(round(x / 10), round(y / 10)) for x, y in found} == {(3, 2), (5, 2), (3, 4), (5, 4)}
    a, b = texture(70, 90), texture(70, 90, 3.4, -2.2)
    points = motion.corners(a)
    points = points[((points > 15) & (points < (75, 55))).all(1)]
    to, good = motion.tracked(a, b, points)
    assert good.mean() > 0.8 and np.abs(np.median(to[good] - points[good], 0) - (3.4, -2.2)).max() < 0.1


def test_steps_of_videos(spark):
    frames = [(v, i, f"v{v}f{i}", i / 5, 48, texture(32, 48, 0 if v else [0, 0, 2, 2][i], 0, seed=v).tobytes()) for v in (0, 1) for i in range(4)] + [(2, 0, "x", 0.0, 48, None)]
    df = spark.createDataFrame(frames, "video_id long, ord long, frame_id string, t double, width int, pixels binary")
    stepped = moves.steps(df, ["video_id"], ["ord"]).cache()
    got = {(r["video_id"], r["ord"]): r["motion"] for r in stepped.collect()}
    assert got[0, 0] is None and got[2, 0] is None and got[1, 2]["flow_mean"] == 0.0
    assert abs(got[0, 2]["flow_x"] - 2) < 0.1 and abs(got[0, 2]["flow_y"]) < 0.1 and got[0, 2]["compensated"] < got[0, 2]["frame_diff"] / 255
    shake = {r["video_id"]: r for r in moves.camera_shake(stepped, ["video_id"]).collect()}
    assert shake[0]["peak"]["evidence"] == ["v0f1", "v0f2"] and shake[0]["peak"]["time"] == 0.4 and shake[1]["camera_shake"] == "low"
    hits = moves.scan_events(stepped, ["video_id"], "t", "frame_id").collect()
    assert [(r["video_id"], r["frame_id"]) for r in hits] == [(0, "v0f2")]
    grown = moves.scan_events(stepped, ["video_id"], "t", "frame_id", area_change=F.when(F.col("frame_id") == "v1f3", 2.0)).collect()
    assert {(r["frame_id"], r["event_score"]) for r in grown if r["video_id"] == 1} == {("v1f3", 20)}


# -- lines and views


def drawn(h, w, segments, wide=1.2, level=220, ground=40):
    y, x = np.mgrid[:h, :w].astype(float)
    out = np.full((h, w), ground, float)
    for x1, y1, x2, y2 in segments:
        t = np.clip(((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) ** 2 + (y2 - y1) ** 2), 0, 1)
        out = np.where(np.hypot(x - x1 - t * (x2 - x1), y - y1 - t * (y2 - y1)) <= wide, level, out)
    return out.astype(np.uint8)


def test_edges_are_ridges_that_touch_strong_ones():
    frame = np.zeros((30, 40), np.uint8)
    frame[:, 20:] = 100
    frame[:15, 5:] += 15
    found = lines.edges(frame)
    assert found[2:-2, 18:22].sum(1).tolist() == [1] * 26 and not found[:, 8:15].any()
    assert not lines.edges(np.full((5, 5), 7, np.uint8)).any() and lines.edges(np.zeros((2, 9))).shape == (2, 9)


def test_votes_are_those_of_a_plain_loop():
    rng = np.random.default_rng(2)
    found = rng.random((13, 17)) < 0.2
    count, most = lines.votes(found, 12), math.ceil(math.hypot(13, 17))
    want = np.zeros_like(count)
    for y, x in zip(*np.nonzero(found), strict=True):
        for a in range(12):
            want[a, int(np.rint(x * math.cos(a * math.pi / 12) + y * math.sin(a * math.pi / 12))) + most] += 1
    assert (count == want).all()


def test_drawn_lines_are_found():
    want = [(20, 110, 150, 60), (200, 115, 120, 30), (230, 10, 230, 110)]
    found = lines.segments(lines.edges(drawn(120, 260, want)), 40, 40, 5)
    for x1, y1, x2, y2 in want:
        away = [np.hypot(np.minimum(np.hypot(a - x1, b - y1), np.hypot(c - x1, d - y1)), np.minimum(np.hypot(a - x2, b - y2), np.hypot(c - x2, d - y2))) for a, b, c, d in found]
        assert min(away) < 6
    # a gap parts a line, and a wide enough one doesn't matter
    broken = drawn(60, 200, [(10, 30, 80, 30), (110, 30, 190, 30)])
    spans = lambda gap: sorted(int(s[2] - s[0]) for s in np.sort(lines.segments(lines.edges(broken), 30, 40, gap).reshape(-1, 2, 2), 1).reshape(-1, 4))
    assert all(s < 90 for s in spans(10)) and any(s > 170 for s in spans(40))


def test_lane_lines_and_marks():
    road = drawn(240, 320, [(60, 238, 150, 120), (260, 238, 170, 120)], wide=2)
    found = lines.lane_lines(road)
    assert len(found) >= 2 and {bool(s > 0) for s in lines.slant(found)} == {True, False} and (found[:, [1, 3]] >= 108).all()
    marked = drawn(160, 240, [*((20, y, 180, y) for y in (60, 90, 120)), (10, 145, 230, 145)], wide=2)
    kinds = {m["type"]: m for m in lines.road_marks(marked)}
    assert kinds["crosswalk"]["lines"] >= 3 and kinds["stop_line"]["box"][2] - kinds["stop_line"]["box"][0] >= 0.45 * 240
    yellow = np.full((60, 100, 3), 60, np.uint8)
    yellow[:, 48:52] = (0, 200, 220)
    assert [m["confidence"] for m in lines.road_marks(yellow) if m["type"] == "centerline_yellow"] == ["medium"]
    assert lines.road_marks(np.full((60, 100, 3), 60, np.uint8)) == []


def test_homography_recovers_a_matrix():
    rng = np.random.default_rng(8)
    want = np.array([[1.1, 0.05, 12], [-0.08, 0.9, 30], [0.0004, -0.0003, 1]])
    one = rng.uniform(0, 300, (9, 2))
    for n in (4, 9):
        assert np.abs(lines.homography(one[:n], lines.mapped(one[:n], want)) - want).max() < 1e-8
    assert lines.homography(one[:3], one[:3]) is None and lines.homography(np.outer(range(5), (1, 2)), one[:5]) is None
    image = texture(40, 60)
    shift = np.array([[1.0, 0, 5], [0, 1, -3], [0, 0, 1]])
    seen = lines.rewarped(image, shift, 40, 60)
    assert (seen[:37, 5:] == image[3:, :55]).all() and not seen[:, :5].any()
    m = lines.road_view(480, 640, 100, 540, 320, 200)
    assert np.abs(lines.mapped(np.array([(100, 479), (540, 479)]), m) - [(224, 479), (416, 479)]).max() < 1e-6


# -- shapes


def plain_regions(mask):
    """Regions by flood fill, numbered by their first pixel."""
    out, n = np.zeros(mask.shape, int), 0
    for y, x in zip(*np.nonzero(mask), strict=True):
        if out[y, x]:
            continue
        n += 1
        todo = [(y, x)]
        while todo:
            a, b = todo.pop()
            if 0 <= a < mask.shape[0] and 0 <= b < mask.shape[1] and mask[a, b] and not out[a, b]:
                out[a, b] = n
                todo += [(a + i, b + j) for i in (-1, 0, 1) for j in (-1, 0, 1)]
    return out


def test_regions_are_those_of_a_flood_fill():
    rng = np.random.default_rng(3)
    for share in (0.0, 0.2, 0.45, 0.7, 1.0):
        mask = rng.random((23, 31)) < share
        assert (shapes.labelled(mask) == plain_regions(mask)).all()


def test_outer_regions_and_outlines():
    mask = np.zeros((20, 20), bool)
    mask[2:15, 2:15] = True
    mask[4:13, 4:13] = False
    mask[7:9, 7:9] = True  # inside the ring's hole
    mask[17, 17] = True
    assert shapes.boxes(mask).tolist() == [[2, 2, 15, 15, 13 * 13 - 81], [17, 17, 18, 18, 1]]
    square = np.zeros((9, 9), bool)
    square[2:7, 3:8] = True
    path = shapes.outline(square)
    assert len(path) == 16 and shapes.enclosed(path) == 16.0 and path[0].tolist() == [3, 2]
    assert len(shapes.outline(np.zeros((3, 3), bool))) == 0 and shapes.outline(np.eye(1, dtype=bool)).tolist() == [[0, 0]]
    rng = random.Random(6)
    blob = np.zeros((40, 40), bool)
    for _ in range(12):
        x, y, r = rng.randrange(14, 26), rng.randrange(14, 26), rng.randrange(3, 9)
        blob |= np.hypot(*(np.mgrid[:40, :40] - np.array([y, x])[:, None, None])) <= r
    border = {(x, y) for y, x in zip(*np.nonzero(blob), strict=True) if not blob[y - 1 : y + 2, x - 1 : x + 2][[0, 1, 1, 2], [1, 0, 2, 1]].all()}
    assert {tuple(p) for p in shapes.outline(blob).tolist()} == border


def painted(h, w, things, ground=(90, 90, 90)):
    image = np.empty((h, w, 3), np.uint8)
    image[:] = ground
    y, x = np.mgrid[:h, :w]
    for inside, colour in things:
        image[inside(x, y)] = colour
    return image


def disc(a, b, r):
    return lambda x, y: (x - a) ** 2 + (y - b) ** 2 <= r * r


RED, AMBER, GREEN = (30, 30, 230), (0, 200, 240), (60, 200, 40)


def test_lamps_signs_and_arrows():
    image = painted(200, 300, [(disc(60, 40, 8), RED), (disc(200, 150, 14), RED)])
    seen = shapes.traffic(image)
    assert [(s["state"], s["shape"]) for s in seen["lamps"]] == [("적색", "circle")] and seen["heads"] == []
    x1, y1, x2, y2 = seen["lamps"][0]["box"]
    assert x1 < 52 and y1 < 32 and x2 > 68 and y2 > 48 and len(seen["signs"]) == 1
    arrow = painted(40, 60, [(lambda x, y: (np.abs(y - 20) <= (x - 8)) & (x <= 24) & (np.abs(y - 20) <= 8), GREEN), (lambda x, y: (np.abs(y - 20) <= 3) & (x >= 8) & (x <= 40), GREEN)])
    assert shapes.lamp_state(arrow)["state"] == "좌회전녹색"
    assert shapes.lamp_state(painted(40, 40, [(disc(20, 20, 12), GREEN)]))["state"] == "녹색"
    assert shapes.lamp_state(painted(40, 40, [(disc(20, 20, 12), AMBER)]))["state"] == "황색"
    assert shapes.lamp_colour(painted(40, 40, []))[0] == "확인불가"


def test_circles_and_dark_heads():
    grey = np.full((80, 120), 150, np.uint8)
    y, x = np.mgrid[:80, :120]
    grey[(x - 40) ** 2 + (y - 30) ** 2 <= 81] = 40
    grey[(x - 90) ** 2 + (y - 50) ** 2 <= 49] = 40
    found = shapes.circles(grey, 12, 4, 12, 15)
    assert sorted((abs(a - p), abs(b - q), abs(r - s)) < (2, 2, 2) for (a, b, r), (p, q, s) in zip(sorted(found[:2].tolist()), [(40, 30, 9), (90, 50, 7)], strict=True)) == [True, True]
    dark = painted(200, 300, [(disc(100, 40, 8), (40, 40, 40))], ground=(140, 140, 140))
    heads = shapes.traffic(dark)["heads"]
    assert len(heads) == 1 and abs(sum(heads[0]["box"][::2]) / 2 - 100) <= 3 and shapes.dark_heads(painted(200, 300, [], ground=(140, 140, 140))) == []


# -- regions


def test_local_thresholds_equal_loops():
    grey = texture(37, 45)
    r = 3
    padded = np.pad(grey.astype(float), r, mode="edge")
    mean = np.array([[padded[y : y + 7, x : x + 7].mean() for x in range(45)] for y in range(37)])
    assert np.abs(regions.box_mean(grey, 7) - mean).max() < 1e-9
    assert (regions.adaptive(grey, 7, 5, bell=False) == np.where(grey > np.rint(mean) - 5, 255, 0)).all()
    g = np.exp(-(np.arange(-3, 4) ** 2) / (2 * (0.3 * (3 - 1) + 0.8) ** 2))
    g = np.outer(g, g) / g.sum() ** 2
    bell = np.array([[(padded[y : y + 7, x : x + 7] * g).sum() for x in range(45)] for y in range(37)])
    assert (regions.adaptive(grey, 7, 5) == np.where(grey > np.rint(bell) - 5, 255, 0)).all()


def test_best_split_is_the_one_of_a_search():
    grey = np.array([[10, 12, 14, 200, 205, 12]] * 3, np.uint8)
    flat = grey.ravel().astype(float)
    split = lambda t: (lambda a, b: len(a) * len(b) * (a.mean() - b.mean()) ** 2 if len(a) and len(b) else 0)(flat[flat <= t], flat[flat > t])
    assert split(regions.best_split(grey)) == max(split(t) for t in range(256)) and regions.best_split(np.full((2, 2), 9, np.uint8)) == 0


def test_fixed_and_found_regions():
    image = np.full((100, 200), 20, np.uint8)
    for i in range(6):
        image[8:16, 120 + 10 * i : 126 + 10 * i] = 240
    found = regions.regions(image)
    assert [n for n, kind, *_ in found if kind == "fixed"] == list(regions.REGIONS) and found[0][2] == [0, 0, 200, 100] and found[4][2] == [110, 0, 200, 25]
    assert [(n, b) for n, kind, b, _ in found if kind != "fixed"] == [("auto_top_text", [112, 2, 184, 22])]
    assert regions.prepared(image, "general") is image and regions.prepared(image[:20, :50], "speed").shape == (40, 100)


def test_flows_of_many_frames_at_once(spark):
    pairs = [(texture(*shape), texture(*shape, 1, i % 2)) for i, shape in enumerate([(24, 32), (54, 96), (24, 32), (9, 17), (24, 32)] * 9)]
    for (one, two), flow in zip(pairs, motion._flows(pairs), strict=True):
        assert flow.shape == (*one.shape, 2) and np.abs(flow - motion.dense_flow(one, two)).max() < 1e-9
    # filters by one product are those by shifted sums, also where edges are mirrored twice
    for shape in ((24, 32), (3, 5), (1, 40)):
        image, kernel = texture(*shape).astype(float), motion.gaussian(5, 1.2)
        assert np.abs(motion.filtered(image, kernel, kernel[3:-3]) - motion.tapped(image, kernel, kernel[3:-3])).max() < 1e-9
    # measures that nobody reads aren't computed
    df = spark.createDataFrame([(i, texture(24, 32, i).tobytes(), 32) for i in range(3)], "ord int, pixels binary, width int").withColumn("v", F.lit(1))
    for clip in (True, False):
        rows = [r["motion"] for r in moves.steps(df, ["v"], ["ord"], clip=clip).orderBy("ord").collect()]
        assert rows[0] is None and all((m["compensated"] is not None) == clip and m["flow_peak"] > 0 for m in rows[1:])


def test_votes_and_peaks_hold_no_frame_of_neighbours():
    r = np.random.default_rng(3)
    count = r.integers(0, 9, (180, 61))
    ring = np.pad(np.vstack((count[-2:, ::-1], count, count[:2, ::-1])), ((0, 0), (2, 2)))
    order = np.arange(ring.size, 0, -1).reshape(ring.shape)
    want = {(a, k) for a, k in np.ndindex(count.shape) if count[a, k] >= 7 and max((ring[a + i, k + j], order[a + i, k + j]) for i in range(5) for j in range(5)) == (count[a, k], order[a + 2, k + 2])}
    assert {tuple(p) for p in lines.peaks(count, 7).tolist()} == want and want
    empty = np.zeros((180, 4001), np.int32)
    tracemalloc.start()
    found = lines.peaks(empty, 1)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert not len(found) and most < 3 * 180 * 4001  # no copies of the counts, nor windows over them


def test_roads_of_found_lines(spark):
    image = {"height": 160, "width": 240, "nChannels": 1, "data": frames.road(3, 4, 2).tobytes()}
    df = spark.createDataFrame([(1, image), (2, None)], "id int, image struct<height: int, width: int, nChannels: int, data: binary>")
    want = [r.asDict(True) for r in roads.geometry(df, ["id"], "id", F.lit(3.2)).orderBy("id").collect()]
    found = df.select("id", "image", lines.image_lines(F.col("image")).alias("l")).cache()
    assert [r.asDict(True) for r in roads.geometry(found, ["id"], "id", F.lit(3.2), lines="l").orderBy("id").collect()] == want
    assert want[0]["lanes"] == 2 and want[1]["lanes"] is None


def test_pixels_of_a_batch_are_not_held(spark):
    for name in ("lamp_states", "road_geometry"):
        assert ".nChannels" not in frames.__dict__[name](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    shape = (200, 200, 3)
    given = [pa.array([bytes(120_000)] * 150 + [None]), *(pa.array([v] * 151) for v in shape)]
    tracemalloc.start()
    got = lines._each(given, lambda image: image.size, pa.int64())
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.to_pylist() == [120_000] * 150 + [None] and most < 2_000_000


def test_readings_of_a_frame_make_no_table(spark):
    plan = frames.overlay_readings(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPythonUDTF" in plan and "ArrowEvalPythonUDTF" not in plan
    image = texture(30, 50)
    g = motion.gaussian(15, 0.3 * (30 * 0.5 - 1) + 0.8)
    wide = np.pad(image.astype(float), 15, mode="edge")
    want = np.array([[(wide[y : y + 31, x : x + 31] * np.outer(g, g)).sum() for x in range(50)] for y in range(30)])
    assert np.abs(regions.local_mean(image) - want).max() < 1e-9
