"""Readings of a frame's overlay text: a table function from a frame to rows."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.pixels import decoded
from ..functions.regions import TRACKED, prepared, regions
from ..functions.scalar import overlay, overlay_text

#: What reads text: of a region's image and a field it gives (text, confidence, box in the
#: region or none), any number of times. It goes to the workers as it is.
Reader = Callable[[np.ndarray, str], list[tuple[str, float, list[int] | None]]]

ROWS = "roi_name string, roi_kind string, target_field string, roi_box array<int>, box array<int>, text string, confidence double, status string, failure_reason string"

#: The field that each part of a parsed text belongs to.
FIELD_OF = {"moment": "datetime", "speed_kmh": "speed", "lat": "gps", "lon": "gps"}


def no_reader(image: np.ndarray, field: str) -> list[tuple[str, float, list[int] | None]]:
    """The reader that finds nothing."""
    return []


def reader_rows(reader: Reader):
    """The table function (data, height, width, nChannels) of a decoded image: a row for
    each region, field and text; where nothing is read, a failed row for the fields that
    are tracked. A frame that can't be decoded has a row of nulls."""

    class Rows:
        def eval(self, data, height, width, channels):
            image = decoded(data, height or 0, width or 0, channels or 0)
            if image is None:
                yield (None,) * 9
                return
            for name, kind, box, fields in regions(image):
                crop = image[box[1] : box[3], box[0] : box[2]]
                made: dict[bool, np.ndarray] = {}  # the tracked fields' readers get one image
                for field in fields:
                    tracked = field in TRACKED
                    if tracked not in made:
                        made[tracked] = prepared(crop, field)
                    found = reader(made[tracked], field)
                    if not found and tracked:
                        yield name, kind, field, box, None, "", 0.0, "failed", "no_text_detected"
                    for text, confidence, inner in found:
                        moved = None if inner is None else [inner[0] + box[0], inner[1] + box[1], inner[2] + box[0], inner[3] + box[1]]
                        yield name, kind, field, box, moved, text, float(confidence), "observed", None

    # rows as they are: the Arrow form makes a table of its own for every frame
    return F.udtf(Rows, returnType=ROWS, useArrow=False)


def observations(frames: DataFrame, reader: Reader = no_reader, image: str = "image", parsed: bool = True) -> DataFrame:
    """The frames' other columns with the rows of ``reader_rows``, laterally. With ``parsed`` the text made plain and what it says
    about the field: a field's reading tells nothing about the others."""
    image_ = lambda c: F.col(f"{image}.{c}").outer()
    rows = reader_rows(reader)(image_("data"), image_("height"), image_("width"), image_("nChannels"))
    out = frames.lateralJoin(rows).drop(image)
    if not parsed:
        return out
    out = out.withColumn("normalized_text", overlay_text(F.col("text")))
    said = overlay(F.col("normalized_text"))
    return out.withColumns({name: F.when(F.col("target_field").isin("general", field), said[name]) for name, field in FIELD_OF.items()})
