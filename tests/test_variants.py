"""Records of any shape against plain Python."""

import json
import random
from copy import deepcopy

from pyspark.sql import functions as F

from factlake.functions import variants


def value(rng, depth):
    kind = rng.random()
    if depth and kind < 0.5:
        return {rng.choice("abcdef"): value(rng, depth - 1) for _ in range(rng.randrange(4))}
    if depth and kind < 0.65:
        return [value(rng, depth - 1) for _ in range(rng.randrange(3))]
    return rng.choice([1, 2.5, "x", "", "a: [b, {c}]", True, None, 'q"uote'])


def deep(base, over):
    out = deepcopy(base)
    for k, v in over.items():
        out[k] = deep(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else deepcopy(v)
    return out


def test_merge_at_any_depth(spark):
    rng = random.Random(11)
    pairs = [(value(rng, 6), value(rng, 6)) for _ in range(300)] + [({"a": {"b": {"c": [1, 2], "d": 1}}}, {"a": {"b": {"c": [], "e": None}}})]
    rows = [(i, json.dumps(a), json.dumps(b)) for i, (a, b) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "id long, a string, b string")
    got = {r["id"]: json.loads(r["m"]) for r in df.select("id", F.to_json(variants.merged(F.parse_json("a"), F.parse_json("b"), 7)).alias("m")).collect()}
    for i, (a, b) in enumerate(pairs):
        assert got[i] == (deep(a, b) if isinstance(a, dict) and isinstance(b, dict) else b), (a, b)


def test_defaults_of_a_payload(spark):
    defaults = {"scene": {"type": {"value": "확인불가", "evidence": []}, "note": ""}, "actors": [], "n": 0}
    payloads = [{"scene": {"type": {"value": "교차로"}}, "extra": {"x": [1]}}, {"scene": None, "actors": [{"id": 1}]}, {"scene": [1]}, {}]
    df = spark.createDataFrame([(i, json.dumps(p)) for i, p in enumerate(payloads)] + [(9, None), (10, "[1]"), (11, "no json")], "id int, p string")
    got = {r[0]: json.loads(r[1]) for r in df.select("id", F.to_json(variants.with_defaults(F.try_parse_json("p"), defaults))).collect()}
    assert [got[i] for i in range(4)] == [deep(defaults, p) for p in payloads] and got[9] == got[10] == got[11] == defaults


def walk(v, path=(), key=None):
    yield list(path), key, len(path), v
    for k, x in v.items() if isinstance(v, dict) else enumerate(v) if isinstance(v, list) else ():
        yield from walk(x, (*path, str(k)), k if isinstance(v, dict) else None)


def test_walk_of_all_depths(spark):
    rng = random.Random(3)
    values = [value(rng, 5) for _ in range(120)]
    df = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)] + [(999, None), (1000, "{")], "id long, t string")
    got = sorted((r["id"], r["path"], r["key"] or "", r["depth"], json.dumps(json.loads(r["v"]), sort_keys=True)) for r in variants.walked(df, ["id"], "t").withColumn("v", F.to_json("value")).drop("value").collect())
    assert got == sorted((i, p, k or "", d, json.dumps(x, sort_keys=True)) for i, v in enumerate(values) for p, k, d, x in walk(v))


def test_files_of_a_record(spark):
    record = {"frames": [{"path": "b.jpg", "mask_path": "m.png", "crops": [{"image_path": "c.jpg"}, {"path": "b.jpg"}]}], "path": "top.jpg", "n": {"path": 3, "image_path": ""}}
    df = spark.createDataFrame([(1, json.dumps(record)), (2, '{"a":[[{"path":"x"}],{"path":"x"}]}')], "id int, t string")
    got = {(r["id"], r["file"]): r["path"] for r in variants.file_paths(df, ["id"], "t").collect()}
    assert got == {(1, "top.jpg"): ["path"], (1, "b.jpg"): ["frames", "0", "path"], (1, "m.png"): ["frames", "0", "mask_path"], (1, "c.jpg"): ["frames", "0", "crops", "0", "image_path"], (2, "x"): ["a", "0", "0", "path"]}


def plain(v):
    if isinstance(v, str):
        return v.strip(" ")
    if isinstance(v, dict):
        for k in variants.MESSAGE_KEYS:
            if isinstance(v.get(k), str) and v[k].strip():
                s = v.get("source")
                return f"{v[k].strip()} (source: {', '.join(map(str, s))})" if isinstance(s, list) and s else v[k].strip()
    return json.dumps(v, ensure_ascii=False, sort_keys=True)


def test_messages(spark):
    cases = [None, "one ", ["a", " a ", "", {"note": "n", "source": ["s1", 2]}, {"description": " ", "reason": "r", "source": []}, {"x": [1, "a: b, c"], "b": {"y": "확"}}, 5], {"value": "v"}, {"message": 3}]
    df = spark.createDataFrame([(i, json.dumps(c)) for i, c in enumerate(cases)] + [(9, None)], "id int, t string")
    got = {r[0]: r[1] for r in df.select("id", variants.messages(F.try_parse_json("t"))).collect()}
    for i, c in enumerate(cases):
        items = [] if c is None else c if isinstance(c, list) else [c]
        assert got[i] == list(dict.fromkeys(m for m in map(plain, items) if m)), c
    assert got[9] == []


def test_depth(spark):
    texts = ["1", "[]", '{"a":"[[["}', '{"a":[{"b":[1]}],"c":{}}', '["\\\\\\"{"]']
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(variants.depth_of(F.col("t"))).collect()]
    assert got == [0, 1, 1, 4, 1]


def test_files_by_one_walk(spark):
    text = '{"path": "a", "12": {"path": "late"}, "frames": [{"crops": [{"image_path": "c", "path": "a"}, {}], "mask_path": ""}, {"path": "late", "deep": [[["x"], {"path": "e"}]]}, [], null], "path_": "no", "image_path": 5}'
    df = spark.createDataFrame([(1, text), (2, "[]"), (3, "broken {"), (4, '"path"'), (5, None)], "id int, t string")
    found = variants.file_paths(df, ["id"], "t")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate variant_explode") == 6 and "Union" not in plan  # as many as levels, not a chain for each level
    got = {(r["id"], r["file"]): "/".join(r["path"]) for r in found.collect()}
    assert got == {(1, "a"): "path", (1, "late"): "frames/1/path", (1, "c"): "frames/0/crops/0/image_path", (1, "e"): "frames/1/deep/0/1/path"}
