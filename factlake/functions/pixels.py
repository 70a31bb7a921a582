"""Pixel kernels over decoded images in numpy: metrics, changes between frames, colours.

Images are arrays of height x width (grey) or height x width x 3 (blue, green, red) bytes,
as Spark's image source gives them. Arrow functions take them a batch at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def grey_of(image: np.ndarray) -> np.ndarray:
    """Luma of a blue-green-red image, rounded; a grey image stays."""
    if image.ndim == 2:
        return image
    return np.rint(image @ np.array([0.114, 0.587, 0.299])).astype(np.uint8)


def shrunk(image: np.ndarray, most: int) -> np.ndarray:
    """An image whose greater side is at most ``most``, by means of areas; never enlarged."""
    h, w = image.shape[:2]
    scale = most / max(h, w)
    if scale >= 1:
        return image
    rows, cols = max(1, round(h * scale)), max(1, round(w * scale))
    at = [np.arange(n) * size // n for n, size in ((rows, h), (cols, w))]
    total = np.add.reduceat(np.add.reduceat(image.astype(np.float64), at[0], 0), at[1], 1)
    size = np.outer(np.diff([*at[0], h]), np.diff([*at[1], w]))
    return np.rint(total / (size[..., None] if image.ndim == 3 else size)).astype(image.dtype)


def laplacian_variance(grey: np.ndarray) -> float:
    """Variance of the Laplacian; edges are mirrored without their own row."""
    g = np.pad(grey.astype(np.float64), 1, mode="reflect" if min(grey.shape) > 1 else "edge")
    lap = g[:-2, 1:-1] + g[2:, 1:-1] + g[1:-1, :-2] + g[1:-1, 2:] - 4 * g[1:-1, 1:-1]
    return float(lap.var())


def percentile_range(grey: np.ndarray, low: float = 5, high: float = 95) -> float:
    """Difference of two percentiles by nearest rank; 0 for no pixels."""
    flat = np.sort(grey, axis=None)
    rank = lambda p: float(flat[max(0, int(np.ceil(len(flat) * p / 100)) - 1)])
    return rank(high) - rank(low) if len(flat) else 0.0


def quality(image: np.ndarray, most: int = 96) -> dict[str, object]:
    """Measures of one image and the classes that they give; five factors may be weak."""
    grey = shrunk(grey_of(image), most)
    blur, bright, noise, glare, contrast = laplacian_variance(grey), float(grey.mean()), float(grey.std()), float((grey >= 245).mean()), percentile_range(grey)
    classes = {
        "blur": "high" if blur < 80 else "medium" if blur < 300 else "low", "brightness": "dark" if bright < 65 else "overexposed" if bright > 205 else "normal",
        "night_noise": "high" if noise > 75 else "medium" if noise > 35 else "low",
    }
    weak = sum((classes["blur"] == "high", classes["brightness"] != "normal", classes["night_noise"] == "high", glare > 0.08, contrast < 35))
    return {
        **classes, "analysis_reliability": "low" if weak >= 2 else "medium" if weak else "high", "blur_score": round(blur, 3), "brightness_score": round(bright, 3), "noise_score": round(noise, 3),
        "glare_ratio": round(glare, 5), "dark_ratio": round(float((grey <= 35).mean()), 5), "contrast_score": round(contrast, 3),
    }


QUALITY = "blur string, brightness string, night_noise string, analysis_reliability string, blur_score double, brightness_score double, noise_score double, glare_ratio double, dark_ratio double, contrast_score double"


def histogram(grey: np.ndarray, bins: int = 32) -> np.ndarray:
    return np.bincount(grey.ravel().astype(np.int64) * bins // 256, minlength=bins).astype(np.float64)


def correlation(a: np.ndarray, b: np.ndarray) -> float:
    """Correlation of two histograms; 1 where both are flat."""
    x, y = a - a.mean(), b - b.mean()
    d = np.sqrt((x * x).sum() * (y * y).sum())
    return float((x * y).sum() / d) if d else 1.0


def frame_change(before: np.ndarray, after: np.ndarray) -> tuple[float, float]:
    """Mean absolute difference of two grey frames, and how far their histograms are
    apart, 0 to 100."""
    diff = float(np.abs(before.astype(np.int64) - after.astype(np.int64)).mean())
    return diff, max(0.0, 1.0 - correlation(histogram(before), histogram(after))) * 100


def hsv(image: np.ndarray) -> np.ndarray:
    """Hue 0 to 180, saturation and value 0 to 255 of a blue-green-red image."""
    b, g, r = (image[..., i].astype(np.float64) for i in range(3))
    v = np.maximum(np.maximum(b, g), r)
    c = v - np.minimum(np.minimum(b, g), r)
    safe = np.where(c == 0, 1, c)
    hue = np.where(v == r, (g - b) / safe, np.where(v == g, 2 + (b - r) / safe, 4 + (r - g) / safe)) * 30 % 180
    return np.stack((np.where(c == 0, 0, hue), np.where(v == 0, 0, c / np.where(v == 0, 1, v) * 255), v), -1)


def colour_ratio(image: np.ndarray, hues: tuple[float, float], least_saturation: float = 80, least_value: float = 80) -> float:
    """The share of pixels of a range of hues that are saturated and bright enough; a
    range that wraps is given with its greater end first."""
    h, s, v = np.moveaxis(hsv(image), -1, 0)
    low, high = hues
    inside = (h >= low) & (h <= high) if low <= high else (h >= low) | (h <= high)
    return float((inside & (s >= least_saturation) & (v >= least_value)).mean()) if h.size else 0.0


def components(mask: np.ndarray) -> np.ndarray:
    """Boxes (x1, y1, x2, y2, pixels) of regions of a mask that touch by sides or corners,
    in order of their first pixel. Labels spread along rows and columns until they rest."""
    label = np.where(mask, np.arange(1, mask.size + 1).reshape(mask.shape), 0)
    while True:
        new = label
        for axis, step in ((0, 1), (0, -1), (1, 1), (1, -1)):
            new = np.maximum(new, np.where(mask, _shifted(new, axis, step), 0))
        for dy in (1, -1):
            for dx in (1, -1):
                new = np.maximum(new, np.where(mask, _shifted(_shifted(new, 0, dy), 1, dx), 0))
        if (new == label).all():
            break
        label = new
    out = []
    for k in np.unique(label[mask]):
        y, x = np.nonzero(label == k)
        out.append((y[0] * mask.shape[1] + x[0], (x.min(), y.min(), x.max() + 1, y.max() + 1, len(y))))
    return np.array([b for _, b in sorted(out, key=lambda o: o[0])], np.int64).reshape(-1, 5)


def _shifted(a: np.ndarray, axis: int, step: int) -> np.ndarray:
    out = np.zeros_like(a)
    src, dst = [slice(None)] * 2, [slice(None)] * 2
    src[axis], dst[axis] = (slice(None, -1), slice(1, None)) if step > 0 else (slice(1, None), slice(None, -1))
    out[tuple(dst)] = a[tuple(src)]
    return out


def decoded(data: bytes, height: int, width: int, channels: int) -> np.ndarray | None:
    """An image's array from its bytes; null where they don't fit its shape."""
    if not data or height <= 0 or width <= 0 or len(data) != height * width * channels:
        return None
    a = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    return a[..., 0] if channels == 1 else a[..., :3]


def _quality(data: pa.Array, height: pa.Array, width: pa.Array, channels: pa.Array) -> pa.Array:
    rows = []
    for d, h, w, c in zip(*(x.to_pylist() for x in (data, height, width, channels)), strict=True):
        image = decoded(d, h or 0, w or 0, c or 0)
        rows.append(quality(image) if image is not None else None)
    fields = [f.split(" ") for f in QUALITY.split(", ")]
    return pa.array(rows, pa.struct([(n, pa.string() if t == "string" else pa.float64()) for n, t in fields]))


def image_quality(image: Column) -> Column:
    """``quality`` of a column of Spark's image source; null where there is no image."""
    return F.arrow_udf(_quality, QUALITY)(image["data"], image["height"], image["width"], image["nChannels"])


def _change(before: pa.Array, after: pa.Array, width: pa.Array) -> pa.Array:
    rows = []
    for a, b, w in zip(*(x.to_pylist() for x in (before, after, width)), strict=True):
        if not a or not b or not w or len(a) != len(b) or len(a) % w:
            rows.append(None)
            continue
        diff, apart = frame_change(*(np.frombuffer(x, np.uint8).reshape(-1, w) for x in (a, b)))
        rows.append({"frame_diff": diff, "histogram_change": apart})
    return pa.array(rows, pa.struct([("frame_diff", pa.float64()), ("histogram_change", pa.float64())]))


def change(before: Column, after: Column, width: Column) -> Column:
    """``frame_change`` of two grey frames given as bytes, as with ``lag``; null without
    both, or where their shapes differ."""
    return F.arrow_udf(_change, "frame_diff double, histogram_change double")(before, after, width)
