"""Columns over media metadata and frame measures: probe output, rates, quality."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_STREAMS = "array<struct<codec_type:string,width:string,height:string,avg_frame_rate:string,r_frame_rate:string,nb_frames:string,duration:string>>"


def present(x: Column) -> Column:
    """A probe's value, trimmed; null where it is missing, blank or N/A."""
    t = F.trim(x)
    return F.when(~t.isin("", "N/A"), t)


def positive_int(x: Column) -> Column:
    """A whole number above 0 in decimal digits; null otherwise, as for true or 1.5."""
    t = present(x)
    n = F.when(F.rlike(t, F.lit(r"^[0-9]+$")), t.try_cast("bigint"))
    return F.when(n > 0, n)


def non_negative(x: Column) -> Column:
    """A finite number from 0 on; null otherwise."""
    n = present(x).try_cast("double")
    return F.when((n >= 0) & (n < float("inf")) & ~F.isnan(n), n)


def frame_rate(x: Column) -> Column:
    """A rate such as 30000/1001 or 25; null where it isn't above 0."""
    t = present(x)
    whole = F.rlike(t, F.lit(r"^[0-9]+/[0-9]+$"))
    ratio = F.try_divide(F.split_part(t, F.lit("/"), F.lit(1)).try_cast("double"), F.split_part(t, F.lit("/"), F.lit(2)).try_cast("double"))
    rate = F.when(whole, ratio).when(~t.contains("/"), t.try_cast("double"))
    return F.when((rate > 0) & (rate < float("inf")), rate)


def _once(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is named: as the variable
    of a function over an array of it. A plain name would stand for the whole expression."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def probe(text: Column) -> Column:
    """Struct of duration, fps, resolution, frame count and audio from a media probe's
    JSON, or the first reason why it can't be had (``error``). Each step is computed once
    a row: the text is parsed once, then its values are read, then judged."""

    def parsed(raw: Column) -> Column:
        listed = F.ltrim(raw).startswith("[")
        return F.struct((raw.isNotNull() & ~listed).alias("malformed"), F.when(listed, F.from_json(raw, _STREAMS)).alias("streams"))

    def read(p: Column) -> Column:
        return _once(F.get(F.filter(p["streams"], lambda s: s["codec_type"] == "video"), F.lit(0)), lambda video: F.struct(
            p["malformed"].alias("malformed"), video.isNull().alias("none"), *[positive_int(video[c]).alias(n) for n, c in (("width", "width"), ("height", "height"), ("frames", "nb_frames"))],
            F.coalesce(frame_rate(video["avg_frame_rate"]), frame_rate(video["r_frame_rate"])).alias("fps"), non_negative(video["duration"]).alias("duration"),
            F.exists(p["streams"], lambda s: s["codec_type"] == "audio").alias("has_audio"),
        ))

    def timed(v: Column) -> Column:
        return v.withField("duration", F.coalesce(v["duration"], non_negative(F.get_json_object(text, "$.format.duration")), F.when(v["frames"].isNotNull(), F.lit(0.0))))

    def judged(v: Column) -> Column:
        error = (
            F.when(v["malformed"], "Malformed ffprobe payload: streams must be a list")
            .when(v["none"], "No video stream found in ffprobe payload")
            .when(v["width"].isNull(), "Invalid width: expected positive integer")
            .when(v["height"].isNull(), "Invalid height: expected positive integer")
            .when(v["fps"].isNull(), "Invalid frame rate: expected positive avg_frame_rate or r_frame_rate")
            .when(v["duration"].isNull(), "Missing valid duration and nb_frames; cannot compute frame_count")
        )
        return _once(error, lambda e: said(v, e))

    def said(v: Column, error: Column) -> Column:
        values = {
            "duration_sec": v["duration"], "fps": v["fps"], "resolution": F.concat_ws("x", v["width"].cast("string"), v["height"].cast("string")),
            "frame_count": F.coalesce(v["frames"], F.rint(v["duration"] * v["fps"]).cast("bigint")), "has_audio": v["has_audio"],
        }
        return F.struct(*[F.when(error.isNull(), x).alias(n) for n, x in values.items()], error.alias("error"))

    whole = _once(F.get_json_object(text, "$.streams"), lambda raw: _once(parsed(raw), read))
    return _once(_once(whole, timed), judged)


def enabled(name: Column) -> Column:
    """Whether a backend's name asks for one."""
    return ~F.lower(F.trim(name)).isin("none", "disabled", "off", "false", "0")


#: Flags of a frame's measures, in order, and those that make it weak.
FLAGS = ("blur", "low_light", "overexposure", "night_noise", "glare", "dark_occlusion_candidate", "low_contrast_fog_or_dirty_lens_candidate")
WEAK = tuple(f for f in FLAGS if f != "dark_occlusion_candidate")


def quality_flags(blur: Column, brightness: Column, noise: Column, glare: Column, dark: Column, contrast: Column) -> Column:
    conditions = (blur < 80, brightness < 65, brightness > 205, noise > 75, glare > 0.08, dark > 0.45, contrast < 35)
    return F.array_compact(F.array(*[F.when(c, f) for c, f in zip(conditions, FLAGS, strict=True)]))


def reliability(weak: Column) -> Column:
    """From a number of weak factors."""
    return F.when(weak >= 2, "low").when(weak >= 1, "medium").otherwise("high")


def quality_of_flags(flags: Column) -> Column:
    """Struct of what a frame's flags say about it."""
    has = lambda f: F.array_contains(flags, f)
    return F.struct(
        F.when(has("blur"), "high").otherwise("low").alias("blur"), F.when(has("low_light"), "dark").when(has("overexposure"), "overexposed").otherwise("normal").alias("brightness"),
        F.when(has("night_noise"), "high").otherwise("low").alias("night_noise"), reliability(F.size(F.array_intersect(flags, F.array(*[F.lit(f) for f in WEAK])))).alias("analysis_reliability"),
    )


def blur_type(blur: Column, motion: Column, compensated: Column) -> Column:
    return F.when(blur >= 80, "none").when((motion >= 1.5) & (compensated >= 0.03), "motion_blur_candidate").otherwise("focus_blur_candidate")


def flow_needed(frame_diff: Column, histogram_change: Column, area_change: Column) -> Column:
    """Whether a pair of frames differs enough for the costly motion measure."""
    return ~((frame_diff < 1) & (histogram_change < 1) & (area_change <= 0))


def rank_of(confidence: Column) -> Column:
    """unknown 0, low 1, medium 2, high 3; anything else 0."""
    return F.when(confidence == "high", 3).when(confidence == "medium", 2).when(confidence == "low", 1).otherwise(0)


def first_middle_last(items: Column) -> Column:
    """Elements at the distinct positions 0, n // 2 and n - 1."""
    n = F.size(items)
    at = F.array_distinct(F.array(F.lit(1), (n / 2).cast("int") + 1, n))
    return F.when(n > 0, F.transform(at, lambda i: F.element_at(items, i))).otherwise(items)


def fast_timecode(frame: Column, fps: Column) -> Column:
    """MM:SS.mmm of the fast path: minutes are cut before seconds are rounded, so
    :60.000 can occur, which the strict parser rejects."""
    seconds = frame / fps
    minutes = F.floor(seconds / 60)
    return F.format_string("%02d:%06.3f", minutes, seconds - minutes * 60)


def centre(box: list[Column]) -> list[Column]:
    return [(box[0] + box[2]) / 2, (box[1] + box[3]) / 2]


def bottom_centre(box: list[Column]) -> list[Column]:
    return [(box[0] + box[2]) / 2, box[3]]


def rescaled(box: list[Column], scale: Column, width: Column, height: Column, padding: int = 0) -> list[Column]:
    """A box found in an image shrunk by ``scale``, in the source's pixels, padded and clipped."""
    v = [F.rint(x / scale).cast("bigint") for x in box]
    return [F.greatest(F.lit(0), v[0] - padding), F.greatest(F.lit(0), v[1] - padding), F.least(width, v[2] + padding), F.least(height, v[3] + padding)]


def shifted(box: list[Column], x: Column, y: Column) -> list[Column]:
    """A box of a crop in the whole image's coordinates; null stays null."""
    return [box[0] + x, box[1] + y, box[2] + x, box[3] + y]


def crop_quality(box: list[Column], width: Column, height: Column) -> Column:
    """Struct of a clipped crop's area, its share of the image and whether it is too small."""
    side = lambda a, b, most: F.greatest(F.lit(0), F.least(most, b) - F.greatest(F.lit(0), a))
    area = side(box[0], box[2], width) * side(box[1], box[3], height)
    return F.struct(area.alias("area"), (F.rint(area / (width * height) * 1e6) / 1e6).alias("share"), (area < 1024).alias("too_small"))
