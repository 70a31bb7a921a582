"""Contracts of rows, packages cut for a prompt, and plans merged in their row."""

import json

import pytest
from pyspark.errors.exceptions.base import PySparkException
from pyspark.sql import functions as F

from factlake.functions import contracts, packages
from factlake.operators import sets
from factlake.operators.packages import assembled

NAN, INF = float("nan"), float("inf")


def test_metadata_rules(spark):
    rows = [
        (10.0, 30.0, "1920x1080", 300, True, 0), (0.0, 0.001, "x", 0, False, 0), (-1.0, 0.0, " \t", -1, None, 5), (NAN, NAN, "x", 1, True, 2),
        (INF, -INF, "", 1, True, 3), (None, None, None, None, None, 5), (1.0, 30.0, "　", 1, True, 1),
    ]
    df = spark.createDataFrame(rows, "d double, f double, r string, n long, a boolean, want int")
    rules = contracts.metadata_rules(*[F.col(c) for c in "dfrna"])
    assert df.where(F.size(contracts.broken(rules)) != F.col("want")).count() == 0
    assert contracts.accepted(df, rules).count() == 2 and contracts.rejected(df, rules).count() == 5
    assert contracts.rejected(df.limit(0), rules).count() == 0
    assert contracts.required(df.limit(2), rules).count() == 2
    with pytest.raises(PySparkException, match="fps must be finite and positive"):
        contracts.required(df, rules).collect()


def test_settings_and_types(spark):
    df = spark.createDataFrame([(20, 0.0, "교차로", "단독사고"), (0, -0.1, "바다", None), (None, 0.5, "확인불가", "확인불가")], "max_selected_frames int, event_scan_min_score double, scene string, accident string")
    rules = contracts.setting_rules({c: F.col(c) for c in df.columns[:2]}) | contracts.type_rules(F.col("scene"), F.col("accident"))
    got = [r["b"] for r in df.select(contracts.broken(rules).alias("b")).collect()]
    assert got[0] == [] and got[2] == ["max_selected_frames must be positive"]
    assert got[1] == ["max_selected_frames must be positive", "event_scan_min_score must be non-negative", "scene type is not known", "accident type is not known"]


def test_cells(spark):
    rows = [("observed", ["a"], None, 0), ("unknown", None, None, 0), ("unknown", [], [" "], 1), ("inferred", [], [], 1), ("seen", ["a"], ["b"], 1), ("computed", [None], [], 1)]
    df = spark.createDataFrame(rows, "s string, source array<string>, evidence array<string>, want int")
    rules = contracts.cell_rules(F.col("s"), F.lit("low"), F.col("source"), F.col("evidence"))
    assert df.where(F.size(contracts.broken(rules)) != F.col("want")).count() == 0


def test_packages(spark):
    image = {"id": "f", "path": "x", "time": None, "confidence": "high", "box": [1, 2]}
    package = {
        "vlm_storyboard": [{"slot": i, "phase": "p", "precomputed_hints": {"n": i}, "path": "x"} for i in range(30)] + ["x"],
        "frames": [image, "text", 5, None] + [image] * 30, "overlays": {"not": "a list"}, "crops": [image] * 9, "selected_segments": [1, {"a": None}] * 9,
        "precomputed_facts": {"metadata": {"fps": 30.0}, "tracks": [{"track_id": "t", "positions": [1, 2, 3, 4, 5], "x": 1}, "none", {"type": "car", "positions": []}], "preprocessing_uncertainties": ["u"] * 25, "ocr_summary": None},
    }
    df = spark.createDataFrame([(json.dumps(package),), ("{}",), ("[]",), (None,), ("no json",)], "t string")
    got = [json.loads(r["c"]) for r in df.select(packages.compact(F.try_parse_json("t")).alias("c")).collect()]
    first = got[0]
    assert first["vlm_storyboard"] == [{"slot": i, "phase": "p", "precomputed_hints": {"n": i}} for i in range(24)]
    assert first["frames"] == [{"id": "f", "confidence": "high"}] * 17 and first["overlays"] == [] and len(first["crops"]) == 8
    assert first["selected_segments"] == [1, {"a": None}] * 4
    facts = first["precomputed_facts"]
    assert facts["tracks"] == [{"track_id": "t", "positions": [1, 3, 5]}, {}, {"type": "car"}] and facts["metadata"] == {"fps": 30.0}
    assert facts["preprocessing_uncertainties"] == ["u"] * 20 and facts["road_geometry"] == {} and facts["event_candidates"] == []
    assert all(g["frames"] == [] and g["precomputed_facts"]["metadata"] == {} for g in got[1:])


def test_plans_merged_in_their_row(spark):
    df = spark.createDataFrame([(1, [1, 2], [2, 3], [2, None]), (2, None, [5, 5], []), (3, [], [], None)], "v int, b array<long>, a array<long>, c array<long>")
    merged = sets.merged_in_row([(F.col("b"), "b"), (F.col("a"), "a"), (F.col("c"), "b")])
    got = {(r["v"], r["f"]): r["p"] for r in df.select("v", F.explode(merged).alias("f", "p")).collect()}
    assert got == {(1, 1): "b", (1, 2): "b+a", (1, 3): "a", (2, 5): "a"}


def test_assembled_packages(spark):
    videos = spark.createDataFrame([(1, 30.0), (2, None), (None, 1.0)], "v int, fps double")
    frames = spark.createDataFrame([(1, 2, "b", None), (1, 1, 'a"', "x"), (9, 1, "lost", None), (1, 2, "a", None)], "v int, n int, id string, path string")
    tracks = spark.createDataFrame([(2, 1, [1, 2])], "v int, n int, box array<int>")
    single = {"metadata": F.when(F.col("fps") > 1, F.struct("fps"))}
    got = {r["v"]: json.loads(r["package"]) for r in assembled(videos, ["v"], {"frames": (frames, "n"), "crops": (frames.limit(0), "n")}, {"tracks": (tracks, "n")}, single).collect()}
    assert got[1] == {"frames": [{"n": 1, "id": 'a"', "path": "x"}, {"n": 2, "id": "a"}, {"n": 2, "id": "b"}], "crops": [], "precomputed_facts": {"metadata": {"fps": 30.0}, "tracks": []}}
    assert got[2] == {"frames": [], "crops": [], "precomputed_facts": {"metadata": {}, "tracks": [{"n": 1, "box": [1, 2]}]}}
    assert got[None] == {"frames": [], "crops": [], "precomputed_facts": {"metadata": {}, "tracks": []}}
    assert assembled(videos.limit(0), ["v"], {"frames": (frames, "n")}, {}, {}).count() == 0
