import random
from statistics import median

from pyspark.sql import functions as F

from factlake.functions import scalar
from factlake.operators import readings, sampling

SCHEMA = "video_id long, ord long, frame_id string, confidence double, target_field string, status string, moment string, speed_kmh double, lat double, lon double"


def loop(values):
    """A plain restatement: values in order to (median, low, high, kept, rejected)."""
    near = [v for v in values if 0 <= v <= 180]
    rejected = len(values) - len(near)
    if len(near) < 3:
        left = near or values
    else:
        m = median(near)
        left = [v for v in near if abs(v - m) <= 35]
        rejected += len(near) - len(left)
        left = left or near
    if len(left) >= 3:
        kept = [left[0]]
        for v in left[1:]:
            if abs(v - kept[-1]) <= 45:
                kept.append(v)
        rejected += len(left) - len(kept)
        left = kept if len(kept) >= 2 else left
    return median(left), min(left), max(left), len(left), rejected


def test_speeds_equal_the_loop(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for v in range(60):
        base = rng.randint(0, 170)
        values = [float(rng.choice([base, base + rng.randint(-60, 60), rng.randint(-20, 260)])) for _ in range(rng.randint(1, 9))]
        rows += [(v, i, f"f{i}", 0.5, "speed", None, None, x, None, None) for i, x in enumerate(values)]
        want[v] = loop(values), len(values)
    got = {r["video_id"]: r for r in readings.speeds(spark.createDataFrame(rows, SCHEMA)).collect()}
    for v, ((m, low, high, n, rejected), total) in want.items():
        r, spread = got[v], high - low
        assert (r["numeric_kmh"], r["low"], r["high"], r["sample_count"], r["rejected_count"]) == (m, low, high, n, rejected)
        assert r["confidence"] == ("high" if total >= 3 and spread <= 3 else "medium" if spread <= 8 else "low")
        assert r["temporal_consistency"] == ("stable" if spread <= 3 and n >= 3 else "variable")
        assert abs(r["final_confidence_score"] - (0.225 + max(0, 1 - min(spread, 30) / 30) * 0.35 + min(1, n / 3) * 0.2)) < 0.00051


def test_positions_votes_and_summary(spark):
    rows = [
        (1, 0, "a", 0.9, "general", None, "2026-01-01 00:00:00", 50.0, 1.0, 10.0), (1, 1, "b", 0.5, "gps", "observed", None, None, 3.0, 30.0), (1, 2, "c", None, "speed", "failed", None, None, None, None), (1, 3, "d", 0.6, None, "observed", "2026-01-01 00:00:00", None, 5.0, 20.0),
        (2, 0, "e", 0.4, "datetime", "observed", "x", None, None, None),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    p = {r["video_id"]: r for r in readings.positions(df).collect()}
    assert (p[1]["lat"], p[1]["lon"], p[1]["confidence"], p[1]["sample_count"]) == (3.0, 20.0, "medium", 3) and 2 not in p
    v = {(r["video_id"], r["field"]): (r["observed_count"], r["failure_count"], r["mean_confidence"]) for r in readings.field_votes(df).collect()}
    assert v[1, "datetime"] == (2, 0, 0.75) and v[1, "speed"] == (1, 1, 0.9) and v[1, "gps"] == (3, 0, 0.667) and v[2, "datetime"] == (1, 0, 0.4)
    s = {r["video_id"]: r for r in readings.summary(df).collect()}
    assert (s[1]["moment_confidence"], s[1]["numeric_kmh"], s[1]["observation_count"]) == ("high", 50.0, 4) and s[2]["speed_confidence"] == s[2]["gps_confidence"] == "unknown"
    assert readings.summary(df.limit(0)).count() == 0


def test_target_and_flashing(spark):
    text = scalar.overlay(F.lit("2026-05-19 08:31:22 47km/h 37.5, 127.5"))
    for target, kept in (("speed", (None, 47.0, None)), ("gps", (None, None, 37.5)), ("general", ("2026-05-19 08:31:22", 47.0, 37.5))):
        x = spark.range(1).select(readings.target_only(text, F.lit(target)).alias("x")).first()["x"]
        assert (x["moment"], x["speed_kmh"], x["lat"]) == kept
    df = spark.createDataFrame([(1, s) for s in ("lit", "off", "lit")] + [(2, "lit")] * 3 + [(3, "lit"), (3, "missing")], "v int, s string")
    got = {r["v"]: (r["lit"], r["off"], r["missing"], r["state"]) for r in readings.flashing(df, ["v"], "s").collect()}
    assert got == {1: (2, 1, 0, "점멸"), 2: (3, 0, 0, "확인불가"), 3: (1, 0, 1, "확인불가")}


def test_precision_plans_search_no_entries(spark):
    # a filter inside the transform over frames is quadratic in a clip's frames
    clips = spark.createDataFrame([(i, 400.0 + i, 800.0, 10.0, 8000) for i in range(2)], "id int, center double, dur double, fps double, n long")
    plan = sampling.precision_plan(clips, "center", "dur", "fps", "n", before=40.0, after=40.0)
    made = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(" not in made and "exists(" not in made
    rows = plan.groupBy("id").agg(F.count("*").alias("n"), F.countDistinct("frame").alias("frames"), F.sum(F.col("selected").cast("int")).alias("kept")).collect()
    assert len(rows) == 2 and all(r["n"] == r["frames"] > 750 and r["kept"] == 20 for r in rows)
    # where two groups meet in a frame it has both purposes, in the groups' order
    assert plan.where("frame = 3998 AND id = 0").first()["purpose"] == "event_scan_pre_impact+event_scan_impact_candidate"
