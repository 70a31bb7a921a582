"""Scalar functions: time codes, rounding, geometry, overlay text, redaction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "확인불가"
#: What overlay text looks like, after the replacements below.
SPEED = r"(?i)(\d{1,3}(?:\.\d+)?)\s*(?:km/?h|kph)"
MOMENT = r"(\d{4})[-./년\s]+(\d{1,2})[-./월\s]+(\d{1,2})일?\s+(\d{1,2}):(\d{2}):(\d{2})"
#: A direction isn't the last letter of the word before the position.
GPS = r"(?i)(?:(?<!gp)[NS]\s*)?-?\d{1,3}\.\d+[,\s]+(?:lon|lng)?\s*[EW]?\s*-?\d{1,3}\.\d+"
REPLACED = (("㎞", "km"), ("Ｋ", "K"), ("ｍ", "m"), ("／", "/"), ("|", " "))
SIGN = r"(30|40|50|60|70|80|90|100|110)"


def rint(x: Column, digits: int = 0) -> Column:
    """Half to even, as on IEEE doubles."""
    return F.rint(x * 10**digits) / 10**digits if digits else F.rint(x)


def clamp(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def timecode(seconds: Column) -> Column:
    """MM:SS.mmm with unbounded minutes; null for negative time."""
    ms = F.rint(seconds * 1000).cast("bigint")
    return F.when(seconds >= 0, F.format_string("%02d:%02d.%03d", F.floor(ms / 60000), F.floor(ms / 1000) % 60, ms % 1000))


def parse_timecode(code: Column) -> Column:
    """Seconds of a full match; null otherwise."""
    part = lambda i: F.regexp_extract(code, r"^(\d{2,}):([0-5]\d)\.(\d{3})\z", i).cast("bigint")
    ok = F.rlike(code, F.lit(r"^\d{2,}:[0-5]\d\.\d{3}\z"))
    return F.when(ok, (part(1) * 60000 + part(2) * 1000 + part(3)) / 1000.0)


def iou(a: list[Column], b: list[Column]) -> Column:
    """Intersection over union of two boxes x1, y1, x2, y2; 0 without overlap."""
    w = F.greatest(F.lit(0), F.least(a[2], b[2]) - F.greatest(a[0], b[0]))
    h = F.greatest(F.lit(0), F.least(a[3], b[3]) - F.greatest(a[1], b[1]))
    area = lambda x: F.greatest(F.lit(0), x[2] - x[0]) * F.greatest(F.lit(0), x[3] - x[1])
    union = area(a) + area(b) - w * h
    return F.when(union > 0, (w * h) / union).otherwise(0.0)


def homography(x: Column, y: Column, m: list[list[float]] | Column) -> tuple[Column, Column]:
    """A point through a 3x3 matrix, given or in a column of rows; unchanged where the
    divisor vanishes."""
    den = m[2][0] * x + m[2][1] * y + m[2][2]
    flat = F.abs(den) < 1e-9
    return F.when(flat, x).otherwise((m[0][0] * x + m[0][1] * y + m[0][2]) / den), F.when(flat, y).otherwise((m[1][0] * x + m[1][1] * y + m[1][2]) / den)


def overlay_text(text: Column) -> Column:
    """OCR text with wide and composed characters made plain, trimmed."""
    for a, b in REPLACED:
        text = F.replace(text, F.lit(a), F.lit(b))
    return F.btrim(text, F.lit(" \t\n\x0b\f\r"))


def overlay(text: Column) -> Column:
    """Struct of datetime (normalised, not validated), speed and position found in
    overlay text. The text is searched once for each; parts are cut from the match, and
    what isn't found is null by itself: nothing is computed again in a branch."""
    text = overlay_text(text)
    timed, fast, placed = (F.regexp_extract(text, p, 0) for p in (MOMENT, SPEED, GPS))
    all_of = lambda found, pattern: F.regexp_extract_all(found, F.lit(pattern), F.lit(0))
    y, mo, d, h, mi, s = (F.get(all_of(timed, r"\d+"), F.lit(i)) for i in range(6))
    two = lambda x: F.lpad(x, 2, "0")
    moment = F.concat(y, F.lit("-"), two(mo), F.lit("-"), two(d), F.lit(" "), two(h), F.lit(":"), mi, F.lit(":"), s)
    lat, lon = (F.get(all_of(placed, r"-?\d{1,3}\.\d+"), F.lit(i)).try_cast("double") for i in range(2))
    lat = F.when(F.upper(F.left(placed, F.lit(1))) == "S", -F.abs(lat)).otherwise(lat)
    lon = F.when(F.upper(F.regexp_extract(placed, r"(?i)([EW])\s*-?[\d.]+$", 1)) == "W", -F.abs(lon)).otherwise(lon)
    ok = (F.abs(lat) <= 90) & (F.abs(lon) <= 180)
    return F.struct(moment.alias("moment"), F.regexp_extract(fast, r"^[\d.]+", 0).try_cast("double").alias("speed_kmh"), F.when(ok, lat).alias("lat"), F.when(ok, lon).alias("lon"))


#: Terms of legal judgement and what replaces them.
LEGAL_TERMS = ("가해", "피해", "과실", "위반", "불법", "책임", "주의의무", "신호위반", "안전거리 미확보")
LEGAL_MARK = "[법적 판단 표현 제거]"


def longest_first(terms: tuple[str, ...] | list[str]) -> str:
    """An alternation of literal terms in which a longer one wins."""
    return "|".join("\\Q" + t + "\\E" for t in sorted(terms, key=lambda t: (-len(t), t)))


def redact(text: Column, terms: tuple[str, ...] | list[str] = LEGAL_TERMS, mark: str = LEGAL_MARK) -> Column:
    """Each longest match replaced by ``mark``, literally."""
    return F.regexp_replace(text, F.lit(longest_first(terms)), F.lit(mark.replace("\\", "\\\\").replace("$", "\\$")))


def found_terms(text: Column, terms: tuple[str, ...] | list[str] = LEGAL_TERMS) -> Column:
    """Terms that stand in a text other than inside a longer match, in the terms' order."""
    found = F.regexp_extract_all(text, F.lit(longest_first(terms)), F.lit(0))
    return F.filter(F.array(*[F.lit(t) for t in terms]), lambda t: F.array_contains(found, t))


def confidence_class(share: Column, high: float = 0.7, medium: float = 0.35) -> Column:
    return F.when(share >= high, "high").when(share >= medium, "medium").otherwise("low")


def bucket(v: Column, low: float, high: float, labels: tuple[str, str, str]) -> Column:
    """Three ways; both limits belong to the middle."""
    return F.when(v < low, labels[0]).when(v > high, labels[2]).otherwise(labels[1])


def angle(dx: Column, dy: Column) -> Column:
    return F.degrees(F.atan2(dy, dx))


def angle_delta(a: Column, b: Column) -> Column:
    """Circular difference, 0 to 180."""
    d = F.abs(a - b) % 360
    return F.least(d, 360 - d)


def relative_position(x: Column, y: Column, width: Column, height: Column) -> Column:
    """3 x 2 position class: limits at 0.4 and 0.6 across, 0.65 down."""
    across = F.when(x < 0.4 * width, "left").when(x > 0.6 * width, "right").otherwise("centre")
    return F.concat_ws("-", across, F.when(y >= 0.65 * height, "near").otherwise("far"))


def movement(dx: Column, dy: Column, step: float = 20.0) -> Column:
    """Lateral when it dominates and exceeds ``step``; else by the vertical change."""
    return F.when((F.abs(dx) > F.abs(dy)) & (F.abs(dx) > step), "lane_change").when(dy > step, "approach").when(dy < -step, "depart").otherwise("keep")


def padded(box: list[Column], width: Column, height: Column, ratio: float = 0.35, least: int = 8) -> list[Column]:
    """A box grown on all sides by a share of its greater side, cut to whole pixels and at
    least ``least``, and clipped."""
    pad = F.greatest(F.lit(least), (F.greatest(box[2] - box[0], box[3] - box[1]) * ratio).cast("int"))
    return [F.greatest(F.lit(0), box[0] - pad), F.greatest(F.lit(0), box[1] - pad), F.least(width, box[2] + pad), F.least(height, box[3] + pad)]


def safe_id(text: Column, length: int = 48) -> Column:
    return F.left(F.regexp_replace(text, r"[^\p{L}\p{N}]", "_"), F.lit(length))


def last_number(text: Column) -> Column:
    return F.get(F.reverse(F.regexp_extract_all(text, F.lit(r"\d+"), F.lit(0))), F.lit(0)).try_cast("bigint")


def frame_of(seconds: Column, fps: Column, frames: Column) -> Column:
    """The nearest frame (half-even) within the clip; 0 without frames."""
    return F.greatest(F.lit(0), F.least(frames - 1, F.rint(seconds * fps).cast("bigint")))


def share(n: Column, d: Column, digits: int = 4) -> Column:
    """n / d, rounded half-even; null where d is not positive."""
    return F.when(d > 0, F.rint(n * 10.0**digits / d) / 10**digits)
