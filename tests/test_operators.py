import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from factlake.functions import documents, scalar
from factlake.operators import joins, neighbours, ranking, sets, tracks, votes


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("seconds", "code"), [(0.0, "00:00.000"), (59.9996, "01:00.000"), (6000.0, "100:00.000"), (1.0005, "00:01.000"), (-1.0, None)])
def test_timecode(spark, seconds, code):
    assert one(spark, scalar.timecode(F.lit(seconds))) == code


@pytest.mark.parametrize(("code", "seconds"), [("00:05.800", 5.8), ("1:05.800", None), ("00:65.000", None), ("00:05.800\n", None), (None, None)])
def test_parse_timecode(spark, code, seconds):
    assert one(spark, scalar.parse_timecode(F.lit(code).cast("string"))) == seconds


def test_overlay(spark):
    x = one(spark, scalar.overlay(F.lit("2026년 05월 19일 08:31:22 SPEED 47km/h GPS S37.123456 E127.654321")))
    assert (x["moment"], x["speed_kmh"], x["lat"], x["lon"]) == ("2026-05-19 08:31:22", 47.0, -37.123456, 127.654321)
    assert one(spark, scalar.overlay(F.lit("N95.5 E10.5")))["lat"] is None
    for text, want in (("47.5km/h", 47.5), ("82.4 km/h", 82.4), ("60㎞/h", 60.0), ("1234km/h", 234.0), ("speed: 7KPH", 7.0), ("60 mph", None)):
        assert one(spark, scalar.overlay(F.lit(text)))["speed_kmh"] == want
    for text, want in (("37.5665, 126.9780", (37.5665, 126.978)), ("GPS 37.123456, 127.654321", (37.123456, 127.654321)), ("위치: lat s37.1 lon W 127.5", (-37.1, -127.5)), ("-37.1,-127.5", (-37.1, -127.5)), ("GPS 37 127", (None, None))):
        x = one(spark, scalar.overlay(F.lit(text)))
        assert (x["lat"], x["lon"]) == want
    assert one(spark, scalar.overlay(F.lit("2026-13-05 8:31:22")))["moment"] == "2026-13-05 08:31:22"


def test_iou(spark):
    box = lambda *v: [F.lit(x) for x in v]
    assert one(spark, scalar.iou(box(0, 0, 10, 10), box(5, 0, 15, 10))) == pytest.approx(1 / 3)
    assert one(spark, scalar.iou(box(0, 0, 10, 10), box(20, 0, 25, 10))) == 0


def test_suppression_equals_the_loop(spark):
    rng = random.Random(3)
    rows = [(v, i, rng.randint(0, 60), rng.randint(0, 5)) for v in range(20) for i in range(rng.randint(0, 25))]
    got = ranking.suppress(spark.createDataFrame(rows, "v int, o int, p int, s int"), ["v"], "s", "p", "o", 7, 4)
    want = set()
    for v in range(20):
        chosen = []
        for _, o, p, s in sorted((r for r in rows if r[0] == v), key=lambda r: (-r[3], r[1])):
            if len(chosen) < 4 and all(abs(p - q) >= 7 for _, q, _ in chosen):
                chosen.append((o, p, s))
        want |= {(v, *c) for c in chosen}
    assert {tuple(r) for r in got.collect()} == want


def test_nearest_equals_the_loop(spark):
    rng = random.Random(5)
    left = [(v, i, rng.randint(0, 50)) for v in range(8) for i in range(9)]
    right = [(v, i, rng.randint(0, 50)) for v in range(7) for i in range(5)]
    got = joins.nearest(spark.createDataFrame(left, "v long, l long, p long"), spark.createDataFrame(right, "v long, r long, q long"), ["v"], "p", "q", "r")
    want = {(v, i): min((abs(p - q), q, r) for w, r, q in right if w == v)[2] for v, i, p in left if v < 7}
    found = {(r["v"], r["l"]): r["near_r"] for r in got.collect() if r["near_r"] is not None}
    assert found == want


def test_range_join_equals_the_product(spark):
    rng = random.Random(7)
    points = [(v, rng.randint(-40, 90)) for v in range(3) for _ in range(30)]
    windows = [(v, i, a, a + rng.randint(0, 30)) for v in range(3) for i in range(6) for a in [rng.randint(-30, 60)]]
    got = joins.in_window(spark.createDataFrame(points, "v int, p long"), spark.createDataFrame(windows, "v int, w int, a long, b long"), ["v"], "p", "a", "b", 10)
    assert sorted((r["v"], r["w"], r["p"]) for r in got.collect()) == sorted((v, w, p) for v, p in points for u, w, a, b in windows if u == v and a <= p <= b)


def test_jump_filter_and_clusters(spark):
    df = spark.createDataFrame([(1, i, x) for i, x in enumerate([40, 42, 88, 90, 43])], "v int, o int, x int")
    assert neighbours.jump_filter(df, ["v"], ["o"], "x", 44).first()["kept"] == [40, 42, 43]
    got = neighbours.clusters(df, ["v"], "x", 5).orderBy("cluster").collect()
    assert [(r["total"], r["n"]) for r in got] == [(125, 3), (178, 2)]


def test_merge_keeps_plan_order(spark):
    plan = lambda p, *f: spark.createDataFrame([(1, x, p) for x in f], "v int, f int, purpose string")
    got = {r["f"]: r["purpose"] for r in sets.merge_by_key([plan("b", 1, 2), plan("a", 2, 3), plan("b", 2)], ["v", "f"], "purpose").collect()}
    assert got == {1: "b", 2: "b+a", 3: "a"}


def test_assignment_equals_the_loop(spark):
    rng = random.Random(9)
    rows = [(v, f, o, rng.choice("ab"), float(rng.randint(0, 600)), float(rng.randint(0, 60)), rng.choice([None, None, None, "D1", "D2", "T1", ""])) for v in range(6) for f in range(25) for o in range(rng.randint(0, 4))]
    got = tracks.assign(spark.createDataFrame(rows, "video_id long, frame long, ord long, label string, x double, y double, detector_id string"))
    want = {}
    for v in range(6):
        found, number = [], 1  # [name, label, last place]
        for _, f, o, label, x, y, own in sorted(r for r in map(lambda r: (*r[:6], r[6] or ""), rows) if r[0] == v):
            at = next((t for t in found if own and t[0] == own), None)
            if at is None:
                near = [(math.hypot(t[2] - x, t[3] - y), i) for i, t in enumerate(found) if t[1] == label]
                at = found[min(near)[1]] if near and min(near)[0] < 120 else None
            if at is None:
                at = [own or f"T{number}", label, x, y]
                number += not own
                found.append(at)
            at[2:] = x, y
            want[v, f, o] = at[0]
    assert {(r["video_id"], r["frame"], r["ord"]): r["track"] for r in got.collect()} == want


def test_chaining_equals_the_loop(spark):
    f = spark.createDataFrame([(1, "car", "1", 0, 30, 0.0, 0.0, 10.0, 0.0), (1, "car", "9", 45, 60, 20.0, 0.0, 30.0, 0.0), (1, "car", "A", 46, 60, 900.0, 0.0, 900.0, 0.0)], "video_id long, label string, track string, first long, last long, x0 double, y0 double, x1 double, y1 double")
    assert {r["track"]: r["chain"] for r in tracks.chain(f).collect()} == {"1": 0, "9": 0, "A": 1}
    rng = random.Random(4)
    rows = [(v, "car", f"{i:02}", a, a + rng.randint(0, 40), *[float(rng.randint(0, 500)) for _ in range(4)]) for v in range(4) for i in range(30) for a in [rng.randint(0, 400)]]
    want = {}
    for v in range(4):
        ends = []
        for r in sorted((r for r in rows if r[0] == v), key=lambda r: (r[3], r[2])):
            at = next((i for i, e in enumerate(ends) if 0 <= r[3] - e[4] <= 45 and math.hypot(e[7] - r[5], e[8] - r[6]) <= 240), len(ends))
            ends[at : at + 1] = [r]
            want[v, r[2]] = at
    assert {(r["video_id"], r["track"]): r["chain"] for r in tracks.chain(spark.createDataFrame(rows, f.schema)).collect()} == want


def test_json_guard_and_image_metrics():
    assert documents.guard("x {'a': [' Unknown', 1], 'status': ' Detected', 'b': [{'status': '확인불가', 'note': 'none'}]} y") == '{"a": [" Unknown", 1], "b": [{"note": "none", "status": "unknown"}], "status": "observed"}'
    assert documents.guard("none") is None
    assert documents.grey_metrics(np.full((8, 8), 7, np.uint8)) == (7.0, 0.0, 0.0)


def test_red_and_the_left_arrow_are_one_state(spark):
    rows = [(1, "적색", 10.0), (1, "좌회전녹색", 4.0), (1, "녹색", 50.0), (2, "녹색", 30.0), (2, "녹색", 3.0), (2, "적색", 20.0), (3, "황색", 5.0)]
    df = spark.createDataFrame([(v, s, x, i) for i, (v, s, x) in enumerate(rows)], "v int, state string, score double, o int")
    got = {r["v"]: (r["state"], r["confidence"], r["margin"], r["votes"]) for r in votes.signal_vote(df, ["v"], "state", "score", "o").collect()}
    assert got == {1: ("적색+좌회전", "medium", -36.0, 2), 2: ("녹색", "medium", 13.0, 2), 3: ("황색", "low", 5.0, 1)}


def test_legal_terms(spark):
    text = "신호위반 차량의 과실. (가.해) $1"
    assert one(spark, scalar.redact(F.lit(text))) == "[법적 판단 표현 제거] 차량의 [법적 판단 표현 제거]. (가.해) $1"
    assert one(spark, scalar.found_terms(F.lit(text))) == ["과실", "신호위반"]
    assert one(spark, scalar.found_terms(F.lit("위반과 신호위반"))) == ["위반", "신호위반"]
    assert one(spark, scalar.redact(F.lit("a.b axb (c"), ["a.b", "(c"], "$0")) == "$0 axb $0"
