import json
import struct
import zlib
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factlake.functions import media, pixels
from factlake.operators import jobs
from factlake.sources import tables


def png(path, image):
    """A grey or red-green-blue image as PNG."""
    h, w = image.shape[:2]
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    raw = b"".join(b"\0" + row.tobytes() for row in image)
    Path(path).write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0 if image.ndim == 2 else 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def test_labels_and_results_by_name(spark, tmp_path):
    (tmp_path / "l/a").mkdir(parents=True)
    for name, x in (("l/v1.json", {"video": {"accident_object": 2}}), ("l/a/x.json", {"video": {"video_name": "v2", "accident_object": 1}}), ("l/z.json", {"video": {"video_name": "v2", "accident_object": 4}}), ("l/bad.json", None)):
        (tmp_path / name).write_text(json.dumps(x) if x else "{")
    got = {r["video_name"]: r["accident_object"] for r in tables.read_labels(spark, str(tmp_path / "l")).collect() if r["accident_object"]}
    assert got == {"v1": 2, "v2": 4}
    found = tables.read_results(spark, str(tmp_path / "l"), T.StructType.fromDDL("video struct<accident_object: int>"))
    assert {"v1", "x", "z"} <= {r["video_name"] for r in found.collect()}


def test_manifest(spark, tmp_path):
    items = [{"video_path": "/a/one.mp4", "labels": {"lanes": "2"}}, {"id": "x", "video_path": "/a/two.mp4"}, {"id": "y", "labels": {}}]
    (tmp_path / "m.json").write_text(json.dumps({"schema_version": "v1", "items": items}))
    got = [(r["ord"], r["id"], r["error"]) for r in tables.read_manifest(spark, str(tmp_path / "m.json"), "v1").orderBy("ord").collect()]
    assert got == [(0, "one", None), (1, "x", "manifest item 1 requires labels"), (2, "y", "manifest item 2 requires a video_path")]
    (tmp_path / "n.json").write_text(json.dumps({"schema_version": "other", "items": items[:1]}))
    assert "unsupported" in tables.read_manifest(spark, str(tmp_path / "n.json"), "v1").first()["error"]


def test_file_lists_and_reuse(spark, tmp_path):
    for name in ("b.MP4", "a.mov", "c.txt"):
        (tmp_path / name).write_text("x")
    names = [r["path"].rsplit("/", 1)[1] for r in tables.list_files(spark, str(tmp_path)).collect()]
    assert names == ["a.mov", "b.MP4"] and tables.list_files(spark, str(tmp_path), limit=1).count() == 1
    df = spark.createDataFrame([(1, 2), (2, 1), (None, 1), (1, None)], "o int, s int")
    assert [r[0] for r in df.select(tables.reusable(F.col("o"), F.col("s"))).collect()] == [False, True, False, True]


def test_html_and_class_lists(spark, tmp_path):
    df = spark.createDataFrame([(1, "b", "<x> & 'y'"), (1, "a", None)], "v int, n string, t string")
    tables.write_html(df, str(tmp_path / "h"), "v", "Evidence")
    page = "\n".join(p.read_text() for p in (tmp_path / "h/v=1").glob("*.txt"))
    assert "<td>a</td><td></td>" in page and "&lt;x&gt; &amp; &#x27;y&#x27;" in page and page.index("<td>a</td>") < page.index("<td>b</td>")
    assert tables.class_list(["car", "bus"], "/d").splitlines()[-2:] == ["  0: car", "  1: bus"]


def test_job_log(spark, tmp_path):
    for i, x in enumerate(({"status": "queued"}, {"status": "running", "stage": "scan"}, {"status": "succeeded", "pre_path": "p"}, {"status": "running"})):
        jobs.append(spark, str(tmp_path / "j"), spark.createDataFrame([{"job_id": "a", "seq": i, **x}]))
    log = spark.read.parquet(str(tmp_path / "j"))
    state = jobs.latest(log.where("seq < 3")).withColumn("result", jobs.result_path(log)).first()
    assert (state["status"], state["stage"], state["result"], state["seq"]) == ("succeeded", "scan", "p", 2)
    assert [(r["seq"], r["before"]) for r in jobs.wrong_steps(log).collect()] == [(3, "succeeded")]


def test_images_are_decoded_and_judged(spark, tmp_path):
    rng = np.random.default_rng(1)
    images = {"flat": np.full((40, 60), 120, np.uint8), "noise": rng.integers(0, 256, (40, 60), dtype=np.uint8), "colour": np.dstack([np.full((30, 30), x, np.uint8) for x in (250, 10, 20)])}
    for name, image in images.items():
        png(tmp_path / f"{name}.png", image)
    (tmp_path / "bad.png").write_text("no image")
    df = tables.decode_images(spark, str(tmp_path)).withColumn("q", pixels.image_quality(F.col("image")))
    got = {Path(r["image"]["origin"]).stem: r["q"] for r in df.collect()}
    assert set(got) == set(images) and got["flat"]["blur"] == "high" and got["flat"]["analysis_reliability"] == "low" and got["noise"]["blur"] == "low"
    for name in ("flat", "noise"):
        want = pixels.quality(images[name])
        assert got[name].asDict() == want


def test_kernels_equal_the_loops():
    rng = np.random.default_rng(2)
    g = rng.integers(0, 256, (13, 17), dtype=np.uint8)
    at = lambda y, x: float(g[abs(y) if y < 13 else 24 - y, abs(x) if x < 17 else 32 - x])
    lap = [at(y - 1, x) + at(y + 1, x) + at(y, x - 1) + at(y, x + 1) - 4 * at(y, x) for y in range(13) for x in range(17)]
    assert abs(pixels.laplacian_variance(g) - np.var(lap)) < 1e-6
    small = pixels.shrunk(g, 8)
    rows, cols = [i * 13 // 6 for i in range(6)] + [13], [i * 17 // 8 for i in range(8)] + [17]
    assert small.shape == (6, 8) and small.tolist() == [[round(float(np.mean(g[rows[i] : rows[i + 1], cols[j] : cols[j + 1]]))) for j in range(8)] for i in range(6)]
    assert pixels.frame_change(g, g) == (0.0, 0.0) and pixels.frame_change(g, 255 - g)[0] == np.abs(2 * g.astype(int) - 255).mean()
    mask = rng.random((20, 25)) < 0.35
    seen, boxes = np.zeros_like(mask), []
    for y in range(20):
        for x in range(25):
            if mask[y, x] and not seen[y, x]:
                todo, found = [(y, x)], []
                seen[y, x] = True
                while todo:
                    a, b = todo.pop()
                    found.append((a, b))
                    for c in range(max(0, a - 1), min(20, a + 2)):
                        for d in range(max(0, b - 1), min(25, b + 2)):
                            if mask[c, d] and not seen[c, d]:
                                seen[c, d] = True
                                todo.append((c, d))
                ys, xs = zip(*found, strict=True)
                boxes.append([min(xs), min(ys), max(xs) + 1, max(ys) + 1, len(found)])
    assert pixels.components(mask).tolist() == boxes
    import colorsys

    image = rng.integers(0, 256, (6, 5, 3), dtype=np.uint8)
    got = pixels.hsv(image)
    for y in range(6):
        for x in range(5):
            h, s, v = colorsys.rgb_to_hsv(*(image[y, x, ::-1] / 255))
            assert np.allclose(got[y, x], (h * 180, s * 255, v * 255))
    assert pixels.colour_ratio(np.dstack([np.full((4, 4), c, np.uint8) for c in (0, 0, 255)]), (170, 10)) == 1.0


def test_changes_between_frames(spark):
    a, b = bytes(range(100)), bytes(range(99, -1, -1))
    df = spark.createDataFrame([(1, a, 10), (2, b, 10), (3, b[:50], 10), (4, None, 10)], "f int, p binary, w int")
    from pyspark.sql import Window

    got = [r["c"] for r in df.withColumn("b", F.lag("p").over(Window.orderBy("f"))).select("f", pixels.change(F.col("b"), F.col("p"), F.col("w")).alias("c")).orderBy("f").collect()]
    assert got[0] is None and got[2] is None and got[3] is None and got[1]["frame_diff"] == 50.0


def box(kind, *parts):
    body = b"".join(parts)
    return struct.pack(">I4s", 8 + len(body), kind) + body


def movie(scale=600, duration=6000, samples=250, size=(1280, 720), turn=(1, 0, 0, 1), audio=True, version=0, pad=0, codec=b"avc1"):
    """A file of a movie's boxes without its pictures."""
    times = lambda: struct.pack(">QQIQ", 0, 0, scale, duration) if version else struct.pack(">IIII", 0, 0, scale, duration)
    head = bytes([version, 0, 0, 0])
    matrix = struct.pack(">9i", turn[0] << 16, turn[1] << 16, 0, turn[2] << 16, turn[3] << 16, 0, 0, 0, 1 << 30)
    tkhd = box(b"tkhd", head, bytes(32 if version else 20), bytes(16), matrix, struct.pack(">2I", size[0] << 16, size[1] << 16))
    media = lambda kind, n: box(b"mdia", box(b"mdhd", head, times(), bytes(4)), box(b"hdlr", bytes(8), kind, bytes(12)), box(b"minf", box(b"stbl", box(b"stsd", bytes(4), struct.pack(">I", 1), struct.pack(">I4s", 16, codec), bytes(8)), box(b"stts", bytes(4), struct.pack(">III", 2, n - 1, 24), struct.pack(">II", 1, 30)))))
    tracks = [box(b"trak", tkhd, media(b"vide", samples))] + ([box(b"trak", tkhd, media(b"soun", 9))] if audio else [])
    wide = struct.pack(">I4sQ", 1, b"mdat", 16 + pad) + bytes(pad)
    return box(b"ftyp", b"isom") + wide + box(b"moov", box(b"mvhd", head, times(), bytes(80)), *tracks)


def test_video_headers(spark, tmp_path):
    from factlake.sources import videos

    (tmp_path / "v/deep").mkdir(parents=True)
    good = movie(pad=5000)
    files = {
        "v/a.mp4": good, "v/deep/B.MOV": movie(version=1, turn=(0, 1, -1, 0), audio=False, samples=300, codec=b"hvc1"), "v/c.txt": good, "v/cut.mp4": good[:-100], "v/empty.mp4": b"", "v/noise.mp4": bytes(range(256)) * 4,
        "v/sound.mp4": good.replace(b"vide", b"soun"), "v/zero.mp4": movie(scale=0),
    }
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    got = {r["path"].rsplit("/", 1)[1]: r for r in videos.read_videos(spark, str(tmp_path / "v"), partitions="3").collect()}
    assert set(got) == {"a.mp4", "B.MOV", "cut.mp4", "empty.mp4", "noise.mp4", "sound.mp4", "zero.mp4"}
    a, b = got["a.mp4"], got["B.MOV"]
    assert (a["duration_sec"], a["fps"], a["frame_count"], a["width"], a["height"], a["rotation"], a["video_codec"], a["has_audio"], a["error"], a["size"]) == (10.0, 25.0, 250, 1280, 720, 0, "avc1", True, None, len(good))
    assert (b["fps"], b["rotation"], b["has_audio"], b["video_codec"]) == (30.0, 90, False, "hvc1")
    assert got["sound.mp4"]["error"] == "no video stream" and got["empty.mp4"]["error"] == "no movie header" and "doesn't fit" in got["cut.mp4"]["error"] and got["noise.mp4"]["error"]
    assert (got["zero.mp4"]["fps"], got["zero.mp4"]["error"]) == (0.0, None)
    (tmp_path / "none").mkdir()
    assert videos.read_videos(spark, (tmp_path / "none").as_uri()).count() == 0
    assert videos.read_videos(spark, (tmp_path / "v").as_uri(), suffixes="mov").count() == 1


def test_a_probe_is_parsed_once(spark):
    none, listed = "No video stream found in ffprobe payload", "Malformed ffprobe payload: streams must be a list"
    given = [(None, none), ("", none), ("no json", none), ('{"streams": null}', none), ('{"streams": []}', none), ('{"streams": [null]}', none), ('{"streams": "x"}', listed), ('{"streams": [{"codec_type": "video", "width": 2, "height": 1, "avg_frame_rate": "50/2", "duration": "2"}]}', None)]
    df = spark.createDataFrame([(i, t, e) for i, (t, e) in enumerate(given)], "i int, t string, want string").select("i", "want", media.probe(F.col("t")).alias("m"))
    assert df.select("m.*")._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
    rows = df.orderBy("i").collect()
    assert [r["m"]["error"] for r in rows] == [e for _, e in given]
    assert rows[-1]["m"][:5] == (2.0, 25.0, "2x1", 50, False) and all(r["m"][:5] == (None,) * 5 for r in rows[:-1])
