import json
import math

from pyspark.sql import functions as F

from factlake.functions import storyboard
from factlake.operators import evidence, rules


def test_records_in_the_order_of_paths(spark):
    paths = spark.createDataFrame([(0, "b"), (1, "x"), (2, "a")], "ord int, path string")
    records = spark.createDataFrame([(1, "a", "old"), (2, "a", "new"), (3, "b", "one"), (4, "", "none"), (5, None, "none")], "o int, path string, note string")
    got = lambda every: [(r["path"], r["record"] and r["record"]["note"]) for r in evidence.records_of(paths, records, [], "o", every).orderBy("ord").collect()]
    assert got(False) == [("b", "one"), ("a", "new")] and got(True) == [("b", "one"), ("x", None), ("a", "new")]


def test_motion_keyframes(spark):
    rows = [(1, i, {"frame_diff": v}) for i, v in enumerate([None, 12.0, 11.9, 30.0, 30.0, 20.0])]
    df = spark.createDataFrame(rows, "v int, f int, motion struct<frame_diff: double>")
    assert sorted(r["f"] for r in evidence.motion_keyframes(df, ["v"], "f", most=3).collect()) == [3, 4, 5]
    assert sorted(r["f"] for r in evidence.motion_keyframes(df, ["v"], "f").collect()) == [1, 3, 4, 5]


def test_picked_images_without_groups(spark):
    rows = [("frames", "f1", "regular_context", None, None), ("crops", "c1", "other", 19, None), ("crops", "c1", "sign_crop", None, None), ("overlays", "", "bev_overlay", None, None), ("nowhere", "n1", None, 95, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "o int, section string, path string, purpose string, importance int, slot int")
    assert [r["path"] for r in evidence.picked_images(df, [], ["o"], 0).orderBy("rank").collect()] == ["c1", "n1", "f1"]
    board = df.union(spark.createDataFrame([(9, "storyboard", "s2", None, None, 0), (10, "storyboard", "s1", None, None, 7), (11, "storyboard", "s1", None, None, 3)], df.schema))
    assert [(r["path"], r["slot"]) for r in evidence.picked_images(board, [], ["o"], 20).orderBy("rank").collect()] == [("s1", 3), ("s2", 0)]


def test_links_and_hints(spark):
    records = spark.createDataFrame([(1, "f1", None, ["t9", "t2", None, "t9"]), (2, "f1", None, []), (3, "f2", "t5", None)], "id int, frame_id string, track_id string, tracks array<string>")
    positions = spark.createDataFrame([("f1", "t1", "car", 0), ("f1", "t0", "", 1), ("f1", "t1", "car", 2)], "frame_id string, track_id string, type string, ord int")
    got = {r["id"]: (r["linked_actor_ids"], r["visible_actor_candidates"]) for r in storyboard.linked_actors(records, positions, []).collect()}
    assert got == {1: (["t2", "t9"], ["car"]), 2: (["t0", "t1"], ["car"]), 3: (["t5"], [])}
    near = spark.createDataFrame([(2.0, "x", None), (0.6, "y", 3), (2.1, "z", 1), (1.9, "w", 0), (1.8, "v", 0)], "t double, event_type string, event_score int")
    items = evidence.nearby_events(spark.createDataFrame([(1, 2.0), (2, None), (3, 90.0)], "id int, t double"), near, [], "id")
    assert {r["id"]: [e["event_type"] for e in r["nearby"]] for r in items.collect()} == {1: ["y", "v", "w"], 2: [], 3: []}
    j = items.where("id <= 2").select("id", evidence.hints(F.array().cast("array<string>"), F.array(F.lit("t1")), F.col("nearby"), F.lit(""), F.lit(None).cast("array<int>")).alias("h"))
    said = {r["id"]: json.loads(r["h"]) for r in j.collect()}
    assert said[2] == {"linked_actor_ids": ["t1"]} and [e["event_type"] for e in said[1]["nearby_event_candidates"]] == ["y", "v", "w"] and "event_score" not in said[1]["nearby_event_candidates"][0] or said[1]["nearby_event_candidates"][0]["event_score"] == 3


def test_one_shake_a_video(spark):
    boxes = [(1, "a", 0, 0.0, "f0", 0, 0, 10, 10), (1, "b", 1, 0.0, "f0", 2, 0, 12, 10)]
    positions = spark.createDataFrame(boxes, "video_id int, track_id string, ord int, t double, frame_id string, x1 int, y1 int, x2 int, y2 int")
    shakes = lambda *rows: spark.createDataFrame([(1, t, v, 1.0, ["s"]) for t, v in rows], "video_id int, t double, value double, compensated double, evidence array<string>")
    found = lambda *rows: [r["signals"] for r in rules.contact_events(positions, shakes(*rows)).collect()]
    assert found((0.5, 30.0), (0.2, 25.0)) == found((0.2, 25.0)) == [["bbox_overlap", "camera_shake"]]
    assert found((9.0, 40.0), (0.2, 25.0)) == found((0.2, 19.0)) == [["bbox_overlap"]]


def test_right_angles_as_the_c_library_has_them(spark):
    # moves at right angles, which rounding puts at 90 degrees or next to it
    moves = [((-40.5, 3.0), (-2.0, -27.0)), ((-39.5, -13.0), (-13.0, 39.5)), ((-6.0, 19.5), (65.0, 20.0))]
    rows = []
    for v, ((ax, ay), (bx, by)) in enumerate(moves):
        for i, (x, y) in enumerate(((0.0, 0.0), (ax, ay), (ax + bx, ay + by))):
            x1, y1 = int(x // 1) - 10, int(y // 1) - 10
            rows.append((v, "a", "car", i, float(i), f"f{i}", x1, y1, int(2 * x) - x1, int(2 * y) - y1))
    positions = spark.createDataFrame(rows, "video_id int, track_id string, type string, ord int, t double, frame_id string, x1 int, y1 int, x2 int, y2 int")
    degrees = lambda m: math.degrees(math.atan2(m[1], m[0]))
    apart = [abs(degrees(a) - degrees(b)) % 360 for a, b in moves]
    want = {v: "medium" if min(d, 360 - d) >= 90 else "low" for v, d in enumerate(apart)}
    assert {r["video_id"]: r["confidence"] for r in rules.track_events(positions).where("rule = 5").collect()} == want
