"""Evidence pictures as files: boxes over frames, crops and contact sheets, drawn and
written where the frames are."""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import drawing
from ..functions.pixels import decoded

WROTE = "name string, path string, bytes long, error string"


def write_files(df: DataFrame, folder: str) -> DataFrame:
    """Rows (name, content) as files below a folder, a path or a URI that pyarrow knows;
    (name, path, bytes, error). A file is written under another name and then renamed, so
    that one written twice is whole; rows without content make none and say so. Nothing
    is written before an action."""
    import pyarrow as pa

    def run(batches):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder) if ":" in folder else (fs.LocalFileSystem(), folder)
        for batch in batches:
            out = []
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                path = posixpath.join(root, name or "")
                if not name or data is None:
                    out.append((name, None, None, "no_content"))
                    continue
                try:
                    store.create_dir(posixpath.dirname(path), recursive=True)
                    part = f"{path}.{uuid.uuid4().hex}"
                    with store.open_output_stream(part) as f:
                        f.write(data)
                    store.move(part, path)
                    out.append((name, path, len(data), None))
                except OSError as e:
                    out.append((name, None, None, str(e)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.string()))], ["name", "path", "bytes", "error"])

    return df.select("name", "content").mapInArrow(run, WROTE)


def overlays(frames: DataFrame, boxes: str = "boxes", image: str = "image") -> DataFrame:
    """Frames with ``content``, the PNG of a decoded image with its array of boxes drawn;
    null where there is no image."""
    import pyarrow as pa

    def draw(data, height, width, channels, found):
        rows = []
        for d, h, w, c, b in zip(*(x.to_pylist() for x in (data, height, width, channels, found)), strict=True):
            i = decoded(d, h or 0, w or 0, c or 0)
            rows.append(None if i is None else drawing.png(drawing.boxed(i, b or [])))
        return pa.array(rows, pa.binary())

    i = F.col(image)
    return frames.withColumn("content", F.arrow_udf(lambda d, h, w, c, b: draw(d, h, w, c, b), "binary")(i["data"], i["height"], i["width"], i["nChannels"], F.col(boxes).cast("array<array<int>>")))


def crops(boxes: DataFrame, box: str = "padded", image: str = "image") -> DataFrame:
    """Rows of a decoded image and one box with ``content``, the crop's PNG."""
    import pyarrow as pa

    def cut(data, height, width, channels, found):
        rows = []
        for d, h, w, c, b in zip(*(x.to_pylist() for x in (data, height, width, channels, found)), strict=True):
            i = decoded(d, h or 0, w or 0, c or 0)
            part = None if i is None or b is None else drawing.crop(i, b)
            rows.append(None if part is None else drawing.png(part))
        return pa.array(rows, pa.binary())

    i = F.col(image)
    return boxes.withColumn("content", F.arrow_udf(lambda d, h, w, c, b: cut(d, h, w, c, b), "binary")(i["data"], i["height"], i["width"], i["nChannels"], F.col(box).cast("array<int>")))


def contact_sheets(frames: DataFrame, keys: list[str], order: str, image: str = "image", most: int = 60) -> DataFrame:
    """Sheets of a video's selected frames: (keys, sheet, content), ``most`` frames on each,
    in order, so a video of any number of frames has as many sheets as it needs."""
    import pandas as pd

    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1
    kinds = ", ".join(f"{k} {frames.schema[k].dataType.simpleString()}" for k in keys)
    cut = frames.select(*keys, F.floor(nth / most).cast("int").alias("sheet"), nth.alias("_n"), F.col(f"{image}.data").alias("d"), F.col(f"{image}.height").alias("h"), F.col(f"{image}.width").alias("w"), F.col(f"{image}.nChannels").alias("c"))

    def lay(group: pd.DataFrame) -> pd.DataFrame:
        images = [decoded(r.d, int(r.h), int(r.w), int(r.c)) for r in group.sort_values("_n").itertuples() if r.d is not None]
        made = drawing.sheet([i for i in images if i is not None])
        return group[[*keys, "sheet"]].head(1).assign(content=[None if made is None else drawing.png(made)])

    return cut.groupBy(*keys, "sheet").applyInPandas(lay, f"{kinds}, sheet int, content binary")
