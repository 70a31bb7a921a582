import zlib

import numpy as np
from pyspark.sql import functions as F

from factlake.functions import drawing, lines
from factlake.sources import pictures, tables


def test_boxes_crops_and_pairs():
    image = np.full((40, 60, 3), 50, np.uint8)
    out = drawing.boxed(image, [[10, 5, 30, 25]])
    assert (out[5:7, 10:30] == (0, 180, 255)).all() and (out[7:23, 12:28] == 50).all() and (out[23:25, 10:30] == (0, 180, 255)).all() and (image == 50).all()
    assert drawing.crop(image, [0, 0, 10, 20]).shape == (100, 50, 3) and drawing.crop(image, [70, 0, 80, 5]) is None and drawing.crop(image[:, :, 0], [-5, 0, 60, 40]).shape == (40, 60)
    assert drawing.beside([image, image[:20]]).shape == (20, 30 + 60, 3)


def test_sheets():
    images = [np.full((100, 200 + 100 * (i % 2), 3), i, np.uint8) for i in range(7)]
    out = drawing.sheet(images, thumb=40)
    assert out.shape == (34 + 2 * 20, 200, 3) and out[34, 0, 0] == 0 and out[34, 45, 0] == 1 and out[54, 5, 0] == 5 and drawing.sheet([]) is None
    assert drawing.sheet([np.zeros((10, 10), np.uint8)]).shape == (34 + 240, 240, 3)


def test_png_holds_the_pixels():
    image = np.random.default_rng(1).integers(0, 256, (5, 7, 3), np.uint8)
    data = drawing.png(image)
    at = data.index(b"IDAT")
    raw = np.frombuffer(zlib.decompress(data[at + 4 : at + 4 + int.from_bytes(data[at - 4 : at], "big")]), np.uint8).reshape(5, 22)
    assert (raw[:, 1:].reshape(5, 7, 3)[..., ::-1] == image).all()


def test_pictures_as_files(spark, tmp_path):
    rows = [(i, "v%d" % (i % 2), {"data": np.full((30, 40, 3), 20 * i, np.uint8).tobytes(), "height": 30, "width": 40, "nChannels": 3}) for i in range(5)] + [(9, "v0", None)]
    frames = spark.createDataFrame(rows, "n int, v string, image struct<data: binary, height: int, width: int, nChannels: int>")
    drawn = pictures.overlays(frames.withColumn("boxes", F.array(F.array(F.lit(2), F.lit(3), F.lit(20), F.lit(20))))).withColumn("name", F.concat("v", F.lit("/o"), F.col("n").cast("string"), F.lit(".png")))
    wrote = {r["name"]: r for r in pictures.write_files(drawn, str(tmp_path / "out")).collect()}
    assert len(wrote) == 6 and wrote["v0/o9.png"]["error"] == "no_content" and sum(r["error"] is None for r in wrote.values()) == 5
    again = {r["name"]: r["bytes"] for r in pictures.write_files(drawn, (tmp_path / "out").as_uri()).collect()}
    assert again == {n: r["bytes"] for n, r in wrote.items()} and len(list((tmp_path / "out").rglob("*.png*"))) == 5
    seen = tables.decode_images(spark, str(tmp_path / "out/v1")).select("image.*").orderBy("origin").collect()
    assert [(r["height"], r["width"]) for r in seen] == [(30, 40)] * 2
    pixels = np.frombuffer(seen[0]["data"], np.uint8).reshape(30, 40, 3)
    assert pixels[10, 10, 0] == 20 and pixels[3, 5].tolist() == [0, 180, 255]
    cut = pictures.crops(frames.withColumn("padded", F.array(F.lit(0), F.lit(0), F.lit(12), F.lit(10))))
    assert sum(r["content"] is not None for r in cut.collect()) == 5
    sheets = pictures.contact_sheets(frames, ["v"], "n", most=2).collect()
    assert sorted((r["v"], r["sheet"], r["content"] is None) for r in sheets) == [("v0", 0, False), ("v0", 1, False), ("v1", 0, False)]


def test_lanes_of_a_mask():
    mask = np.zeros((100, 200), bool)
    for x in (20, 26, 90, 170):
        mask[50:95, x : x + 4] = True
    mask[60, 140] = True  # too small
    mask[5:20, 120:130] = True  # above the road
    assert lines.mask_lanes(mask) == 2 and lines.mask_lanes(np.zeros((10, 10), bool)) == 1
    assert (lines.lane_mask(mask[None, None].astype(np.float32), 100, 200) == mask).all() and lines.lane_mask(np.ones((2, 4, 5)), 8, 10).all()
