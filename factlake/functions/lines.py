"""Edges, straight lines and views from above, in numpy.

Edges are ridges of the slope that touch a strong one. Lines are peaks of votes by
angle and distance; what lies on a peak's line is cut into segments at gaps. Points are
(x, y) and matrices carry them as (x, y, 1)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column
from pyspark.sql import functions as F

from .motion import gaussian, resized, sampled, tapped
from .pixels import decoded, grey_of, hsv, shrunk

#: Limits of weak and strong edges, the smoothing before, the share of a
#: frame above the road, and a lane line's slant in degrees.
WEAK, STRONG, SMOOTH, HORIZON, SLANT = 60, 160, 1.1, 0.45, (20, 160)
#: Fixed values of the road marks: a frame's width, votes, the least length and gap; of
#: the yellow line: its hues, least saturation and value, and the share of pixels.
MARK_WIDTH, YELLOW, YELLOW_LEAST, YELLOW_SHARE = 240, (15, 40), 60, 0.003


def edges(grey: np.ndarray, weak: float = WEAK, strong: float = STRONG) -> np.ndarray:
    """Pixels where the slope is greatest across its direction and above ``weak``, in
    groups that hold one above ``strong``; the frame's border has none."""
    from .shapes import labelled

    g = np.asarray(grey, np.float64)
    if min(g.shape) < 3:
        return np.zeros(g.shape, bool)
    side, mid = np.array([-1.0, 0, 1]), np.array([1.0, 2, 1])
    gx, gy = tapped(g, mid, side), tapped(g, side, mid)
    size = np.abs(gx) + np.abs(gy)
    y, x = np.nonzero(size > weak)
    inside = (y > 0) & (y < g.shape[0] - 1) & (x > 0) & (x < g.shape[1] - 1)
    y, x = y[inside], x[inside]
    at, wide = y * g.shape[1] + x, g.shape[1]
    gx, gy, flat = gx.ravel()[at], gy.ravel()[at], size.ravel()
    # the neighbour before, across the edge; the one after lies opposite
    level, steep = np.abs(gy) < 0.41421 * np.abs(gx), np.abs(gy) > 2.41421 * np.abs(gx)
    step = np.where(level, 1, np.where(steep, wide, np.where(gx * gy > 0, wide + 1, wide - 1)))
    ridge = (flat[at] > flat[at - step]) & (flat[at] >= flat[at + step])
    mask = np.zeros(g.shape, bool)
    mask[y[ridge], x[ridge]] = True
    sure = mask & (size > strong)
    if not sure.any() or (sure == mask).all():
        return sure
    group = labelled(mask)
    held = np.zeros(int(group.max()) + 1, bool)
    held[group[sure]] = True
    return held[group]


def votes(found: np.ndarray, angles: int = 180) -> np.ndarray:
    """Edge pixels by angle (rows, 180 degrees) and distance from the corner; distances
    count from minus the frame's diagonal."""
    y, x = np.nonzero(found)
    t = np.arange(angles) * np.pi / angles
    most = int(np.ceil(np.hypot(*found.shape)))
    wide = 2 * most + 1
    out = np.zeros((angles, wide), np.int32)
    step = max(1, 8192 // max(len(x), 1))  # so many angles at once stay in a core's cache
    for first in range(0, angles, step):
        some = t[first : first + step, None]
        at = np.cos(some) * x
        at += np.sin(some) * y
        np.rint(at, out=at)
        at += most + np.arange(len(some))[:, None] * wide
        out[first : first + step] = np.bincount(at.astype(np.int64).ravel(), minlength=len(some) * wide).reshape(-1, wide)
    return out


def peaks(count: np.ndarray, least: int, reach: int = 2) -> np.ndarray:
    """(angle, distance) of cells with ``least`` votes that no cell around beats, the most
    voted first. Past the last angle the distances are mirrored; of equal neighbours the
    first counts."""
    a, r = np.nonzero(count >= max(least, 1))
    # only cells with the votes are compared with those around
    down, right = (v.ravel() for v in np.mgrid[-reach : reach + 1, -reach : reach + 1])
    rows, cols = a[:, None] + down, r[:, None] + right
    cols = np.where((rows < 0) | (rows >= len(count)), count.shape[1] - 1 - cols, cols)
    inside = (cols >= 0) & (cols < count.shape[1])
    around = np.where(inside, count[rows % len(count), np.where(inside, cols, 0)], 0)
    own, off = count[a, r][:, None], down * (2 * reach + 1) + right
    best = ~((around > own) | ((around == own) & (off < 0))).any(1)
    a, r = a[best], r[best]
    order = np.argsort(-count[a, r], kind="stable")
    return np.stack((a[order], r[order]), 1)


def segments(found: np.ndarray, least: int, length: float, gap: float, near: float = 1.5) -> np.ndarray:
    """Segments (x1, y1, x2, y2) of straight edges: for each peak of at least ``least``
    votes the edge pixels on its line that no stronger line took, cut where more than
    ``gap`` pixels miss, of at least ``length``."""
    count = votes(found)
    y, x = np.nonzero(found)
    free, most, out = np.ones(len(x), bool), count.shape[1] // 2, []
    for a, r in peaks(count, least):
        t = a * np.pi / len(count)
        on = np.flatnonzero(free & (np.abs(x * np.cos(t) + y * np.sin(t) - (r - most)) <= near))
        if len(on) < 2:
            continue
        along = y[on] * np.cos(t) - x[on] * np.sin(t)
        order = np.argsort(along, kind="stable")
        on, along = on[order], along[order]
        for run in np.split(np.arange(len(on)), np.flatnonzero(np.diff(along) > gap) + 1):
            first, last = on[run[0]], on[run[-1]]
            if np.hypot(x[last] - x[first], y[last] - y[first]) >= length:
                out.append((x[first], y[first], x[last], y[last]))
                free[on[run]] = False
    return np.array(out, np.int64).reshape(-1, 4)


def slant(lines: np.ndarray) -> np.ndarray:
    """Angles in degrees, -180 to 180."""
    return np.degrees(np.arctan2(lines[:, 3] - lines[:, 1], lines[:, 2] - lines[:, 0]))


def smoothed(grey: np.ndarray) -> np.ndarray:
    g = gaussian(2, SMOOTH)
    return tapped(np.asarray(grey, np.float64), g, g)


def lane_lines(image: np.ndarray) -> np.ndarray:
    """Slanted segments of the road, in the frame's coordinates."""
    grey, top = grey_of(image), int(image.shape[0] * HORIZON)
    lines = segments(edges(smoothed(grey[top:])), 60, max(40, image.shape[1] // 12), 30)
    turned = np.abs(slant(lines))
    return lines[(turned > SLANT[0]) & (turned < SLANT[1])] + (0, top, 0, top)


def clusters(values: list[float], apart: float) -> list[float]:
    """Means of runs of sorted values; one starts where a value is further than ``apart``
    from the mean so far."""
    runs: list[list[float]] = []
    for v in sorted(values):
        if runs and abs(sum(runs[-1]) / len(runs[-1]) - v) <= apart:
            runs[-1].append(v)
        else:
            runs.append([v])
    return [sum(r) / len(r) for r in runs]


def road_marks(image: np.ndarray) -> list[dict]:
    """What is painted on the road: a long low level line is a stop line, three levels or
    more a crosswalk, yellow in the middle or an upright line there the centre line."""
    h, w = image.shape[:2]
    scale = MARK_WIDTH / w if w > MARK_WIDTH else 1.0
    small = shrunk(image, max(MARK_WIDTH, round(h * scale))) if scale < 1 else image
    high, wide = small.shape[:2]
    lines = segments(edges(smoothed(grey_of(small))), 45, max(30, wide // 8), 20)
    turned, found = np.abs(slant(lines)), []
    level = lines[(turned < 12) | (turned > 168)]
    if len(level):
        length = np.hypot(level[:, 2] - level[:, 0], level[:, 3] - level[:, 1])
        x1, y1, x2, y2 = level[np.argmax(length)]
        if length.max() >= wide * 0.45 and y1 > high * 0.55:
            box = [int(min(m - 1, max(0, round(v / scale)))) for v, m in zip((min(x1, x2), min(y1, y2), max(x1, x2), max(y1, y2)), (w, h, w, h), strict=True)]
            found.append({"type": "stop_line", "confidence": "medium", "box": box})
        rows = clusters(level[:, 1].tolist(), 12)
        if len(rows) >= 3:
            found.append({"type": "crosswalk", "confidence": "medium", "lines": len(rows)})
    upright = ((turned >= 75) & (turned <= 105) & (np.abs((lines[:, 0] + lines[:, 2]) / 2 - wide / 2) < wide * 0.12)).any()
    share = 0.0
    if small.ndim == 3:
        hue, saturation, value = np.moveaxis(hsv(small)[:, int(wide * 0.35) : int(wide * 0.65)], -1, 0)
        yellow = (hue >= YELLOW[0]) & (hue <= YELLOW[1]) & (saturation >= YELLOW_LEAST) & (value >= YELLOW_LEAST)
        share = float(yellow.mean()) if yellow.size else 0.0
    if share > YELLOW_SHARE or upright:
        found.append({"type": "centerline_yellow", "confidence": "medium" if share > YELLOW_SHARE else "low", "yellow_ratio": round(share, 5)})
    return found


def lane_mask(output: np.ndarray, height: int, width: int) -> np.ndarray:
    """A segmentation model's first plane at a frame's size, from a half on."""
    plane = np.asarray(output, np.float64)
    while plane.ndim > 2:
        plane = plane[0]
    return resized(plane, height, width) >= 0.5


def mask_lanes(mask: np.ndarray) -> int:
    """Lanes between the regions of a mask below the horizon that are 20 pixels large:
    those nearer than 12 pixels to each other are one boundary."""
    from .shapes import boxes

    b = boxes(mask[int(mask.shape[0] * HORIZON) :])
    wide, high = b[:, 2] - b[:, 0], b[:, 3] - b[:, 1]
    middles = (b[:, 0] + wide / 2)[wide * high >= 20]
    return max(1, len(clusters([float(int(x)) for x in middles], 12)) - 1)


def homography(one: np.ndarray, two: np.ndarray) -> np.ndarray | None:
    """The 3 x 3 matrix, its last cell 1, that carries points of ``one`` into ``two``: exact
    for four, by least squares of centred and scaled points for more; null where they
    don't determine one."""
    if len(one) < 4 or len(one) != len(two):
        return None
    scaled = []
    for p in (np.asarray(one, np.float64), np.asarray(two, np.float64)):
        centre = p.mean(0)
        far = np.sqrt(((p - centre) ** 2).sum(1)).mean()
        if not far:
            return None
        scaled.append((p, np.array([[1 / far, 0, -centre[0] / far], [0, 1 / far, -centre[1] / far], [0, 0, 1]])))
    (p, s), (q, t) = scaled
    (x, y), (u, v) = (mapped(points, m).T for points, m in scaled)
    nil, unit = np.zeros_like(x), np.ones_like(x)
    rows = np.vstack((np.stack((x, y, unit, nil, nil, nil, -u * x, -u * y, -u), 1), np.stack((nil, nil, nil, x, y, unit, -v * x, -v * y, -v), 1)))
    _, size, basis = np.linalg.svd(rows)
    if size[7] < 1e-9 * size[0]:
        return None
    m = np.linalg.inv(t) @ basis[-1].reshape(3, 3) @ s
    return m / m[2, 2] if abs(m[2, 2]) > 1e-12 else None


def mapped(points: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    p = np.column_stack((np.asarray(points, np.float64), np.ones(len(points)))) @ matrix.T
    return p[:, :2] / p[:, 2:]


def rewarped(image: np.ndarray, matrix: np.ndarray, height: int, width: int) -> np.ndarray:
    """The image seen through a matrix, 0 where nothing comes from."""
    y, x = np.mgrid[:height, :width].astype(np.float64)
    back = np.stack((x.ravel(), y.ravel(), np.ones(x.size))).T @ np.linalg.inv(matrix).T
    with np.errstate(divide="ignore", invalid="ignore"):
        x, y = (back[:, k] / back[:, 2] for k in (0, 1))
    inside = (back[:, 2] != 0) & (x >= 0) & (x <= image.shape[1] - 1) & (y >= 0) & (y <= image.shape[0] - 1)
    out = np.zeros((height * width, *image.shape[2:]))
    out[inside] = sampled(image.astype(np.float64), x[inside], y[inside])
    return np.rint(out).astype(image.dtype).reshape(height, width, *image.shape[2:])


def road_view(height: int, width: int, left: float, right: float, x: float, y: float) -> np.ndarray | None:
    """The matrix that shows a road from above: its outer lines at the frame's bottom and
    the point where they meet, made upright."""
    half, top = max(10.0, max(20.0, right - left) * 0.18), max(0.0, min(height * 0.65, y + height * 0.08))
    middle = max(0.0, min(float(width), x))
    last = float(width - 1)
    one = [(max(0.0, middle - half), top), (min(last, middle + half), top), (min(last, right), height - 1.0), (max(0.0, left), height - 1.0)]
    two = [(width * 0.35, 0), (width * 0.65, 0), (width * 0.65, height - 1), (width * 0.35, height - 1)]
    return homography(np.array(one), np.array(two, np.float64))


LINES = pa.list_(pa.struct([(c, pa.int64()) for c in ("x1", "y1", "x2", "y2")]))
LINES_SQL = "array<struct<x1: bigint, y1: bigint, x2: bigint, y2: bigint>>"


def _each(arrays: tuple[pa.Array, ...], kernel, kind: pa.DataType) -> pa.Array:
    """A kernel's result for each image; of the pixels one image's are copied at a time."""
    rows, (pixels, *shape) = [], arrays
    for d, h, w, c in zip(pixels, *(x.to_pylist() for x in shape), strict=True):
        image = decoded(d.as_py(), h or 0, w or 0, c or 0)
        rows.append(kernel(image) if image is not None else None)
    return pa.array(rows, kind)


def lane_rows(image: np.ndarray) -> list[dict]:
    return [dict(zip(("x1", "y1", "x2", "y2"), map(int, l), strict=True)) for l in lane_lines(image)]


def _lane_lines(*arrays: pa.Array) -> pa.Array:
    return _each(arrays, lane_rows, LINES)


def _road_marks(*arrays: pa.Array) -> pa.Array:
    return _each(arrays, road_marks, pa.list_(pa.struct([("type", pa.string()), ("confidence", pa.string()), ("box", pa.list_(pa.int64())), ("lines", pa.int64()), ("yellow_ratio", pa.float64())])))


def _view(*arrays: pa.Array) -> pa.Array:
    rows = []
    for r in zip(*(x.to_pylist() for x in arrays), strict=True):
        m = None if None in r else road_view(*r)
        rows.append(None if m is None else np.round(m, 6).tolist())
    return pa.array(rows, pa.list_(pa.list_(pa.float64())))


def image_lines(image: Column) -> Column:
    """``lane_lines`` of a column of Spark's image source; null where there is no image.
    Not deterministic to Spark, so that it is computed once."""
    return F.arrow_udf(lambda d, h, w, c: _lane_lines(d, h, w, c), LINES_SQL).asNondeterministic()(image["data"], image["height"], image["width"], image["nChannels"])


def image_marks(image: Column) -> Column:
    """``road_marks`` of a column of Spark's image source; null where there is no image.
    Not deterministic to Spark, so that it is computed once."""
    return F.arrow_udf(lambda d, h, w, c: _road_marks(d, h, w, c), "array<struct<type: string, confidence: string, box: array<bigint>, lines: bigint, yellow_ratio: double>>").asNondeterministic()(image["data"], image["height"], image["width"], image["nChannels"])


def view_matrix(height: Column, width: Column, left: Column, right: Column, x: Column, y: Column) -> Column:
    """``road_view`` as an array of rows; null where anything is missing."""
    return F.arrow_udf(lambda a, b, c, d, e, f: _view(a, b, c, d, e, f), "array<array<double>>").asNondeterministic()(height, width, *[v.cast("double") for v in (left, right, x, y)])
