"""Regions, outlines, arrows and circles in numpy, and the lamps and signs found by them.

Regions touch by sides or corners. An outer region isn't enclosed by another. Boxes are
(x1, y1, x2, y2), the second corner exclusive."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column
from pyspark.sql import functions as F

from .lines import _each, edges
from .motion import tapped
from .pixels import grey_of, hsv, shrunk

#: lamps' hues with their least saturation and value, in the order of ties,
#: the least score of a lit lamp, the part of a frame that holds lamps, and unknown.
LAMPS = {"적색": (((0, 10), (170, 180)), 80), "황색": (((18, 38),), 80), "녹색": (((40, 90),), 60)}
LIT, UPPER, UNKNOWN, LEFT = 4.0, 0.45, "확인불가", "좌회전녹색"
#: Sizes of lit lamps, of signs and of dark heads (pixels, share of the frame).
LAMP_AREA, SIGN_AREA, HEAD_AREA, HEAD_WIDTH = (20, 0.05), (80, 0.08), (80, 0.08), 320
#: Fixed value: pixels of a side of the cells in which circles' centres are counted.
CELL = 1.2


def labelled(mask: np.ndarray, corners: bool = True) -> np.ndarray:
    """Regions' numbers from 1 in order of their first pixel, 0 elsewhere. Runs of a row
    join those of the row above that they touch; the least number spreads and is then
    followed to its end."""
    h, w = mask.shape
    flat = np.zeros((h, w + 2), bool)
    flat[:, 1:-1] = mask
    flat, reach = flat.ravel().astype(np.int8), int(corners)
    step = np.diff(flat)
    start, end = np.flatnonzero(step == 1) + 1, np.flatnonzero(step == -1) + 1
    low, high = np.searchsorted(end, start - (w + 2) - reach, "right"), np.searchsorted(start, end - (w + 2) + reach, "left")
    here = np.repeat(np.arange(len(start)), np.maximum(high - low, 0))
    above = np.arange(len(here)) - np.repeat(np.cumsum(np.maximum(high - low, 0)) - np.maximum(high - low, 0), np.maximum(high - low, 0)) + np.repeat(low, np.maximum(high - low, 0))
    label = np.arange(len(start))
    while len(here):
        least = np.minimum(label[here], label[above])
        new = label.copy()
        np.minimum.at(new, label[here], least)
        np.minimum.at(new, label[above], least)
        while (new[new] != new).any():
            new = new[new]
        new = new[label]
        if (new == label).all():
            break
        label = new
    number = np.unique(label, return_inverse=True)[1] + 1
    out = np.zeros(h * (w + 2) + 1, np.int64)
    out[start], held = number, np.zeros(h * (w + 2) + 1, np.int64)
    np.add.at(held, start, number)
    np.add.at(held, end, -number)
    return np.cumsum(held)[:-1].reshape(h, w + 2)[:, 1:-1] if len(start) else np.zeros((h, w), np.int64)


def outer(mask: np.ndarray) -> np.ndarray:
    """Regions' numbers, without those inside another one's hole."""
    label = labelled(mask)
    around = np.pad(~mask, 1, constant_values=True)
    ground = labelled(around, corners=False)
    if ground.max() == 1:  # no holes, so nothing is in one
        return label
    open_ = sliding_window_view(np.pad(ground == ground[0, 0], 1), (3, 3))
    touch = (open_[..., 0, 1] | open_[..., 2, 1] | open_[..., 1, 0] | open_[..., 1, 2])[1:-1, 1:-1]
    return np.where(np.isin(label, np.unique(label[touch & mask])), label, 0)


def boxes(mask: np.ndarray) -> np.ndarray:
    """Boxes of the outer regions, with their pixels' number as fifth column."""
    if not mask.any():
        return np.zeros((0, 5), np.int64)
    label = outer(mask)
    y, x = np.nonzero(label)
    if not len(x):
        return np.zeros((0, 5), np.int64)
    of, at, n = np.unique(label[y, x], return_inverse=True, return_counts=True)
    low, high = np.full((len(of), 2), max(mask.shape)), np.zeros((len(of), 2), np.int64)
    for k, v in enumerate((x, y)):
        np.minimum.at(low[:, k], at, v)
        np.maximum.at(high[:, k], at, v + 1)
    return np.column_stack((low, high, n))


#: The eight neighbours clockwise from the left, as (x, y).
AROUND = ((-1, 0), (-1, -1), (0, -1), (1, -1), (1, 0), (1, 1), (0, 1), (-1, 1))


def outline(mask: np.ndarray) -> np.ndarray:
    """The border of the region of the first pixel, clockwise from there: at each pixel
    the next one is the first clockwise from where the last came from. It ends where the
    first step is taken again."""
    first = np.flatnonzero(mask)
    if not len(first):
        return np.zeros((0, 2), np.int64)
    held = np.pad(mask, 1)
    begin = at = (int(first[0]) % mask.shape[1] + 1, int(first[0]) // mask.shape[1] + 1)
    path, back, step = [], 0, None
    while True:
        turn = next((k for i in range(1, 9) if held[at[1] + AROUND[k := (back + i) % 8][1], at[0] + AROUND[k][0]]), None)
        if turn is None:
            return np.array([at]) - 1
        if at == begin and turn == step:
            return np.array(path) - 1
        step = turn if step is None else step
        path.append(at)
        at, back = (at[0] + AROUND[turn][0], at[1] + AROUND[turn][1]), (turn + 4) % 8


def enclosed(points: np.ndarray) -> float:
    """The area inside an outline through pixels' centres."""
    x, y = points[:, 0], points[:, 1]
    return abs(float((x * np.roll(y, -1) - y * np.roll(x, -1)).sum())) / 2


def moments(mask: np.ndarray) -> tuple[float, float, float]:
    """Pixels and their mean x and y; zeros for none."""
    y, x = np.nonzero(mask)
    return (float(len(x)), float(x.mean()), float(y.mean())) if len(x) else (0.0, 0.0, 0.0)


def lamp_mask(image: np.ndarray, colour: str, planes: np.ndarray | None = None) -> np.ndarray:
    """Where an image, or its hue, saturation and value if known, has a lamp's colour."""
    hue, saturation, value = np.moveaxis(hsv(image) if planes is None else planes, -1, 0)
    ranges, least = LAMPS[colour]
    return np.logical_or.reduce([(hue >= a) & (hue <= b) for a, b in ranges]) & (saturation >= least) & (value >= least)


def lamp_colour(image: np.ndarray) -> tuple[str, float]:
    """The colour that covers most, on a scale of 255; unknown under LIT."""
    planes = hsv(image)
    score = {c: float(lamp_mask(image, c, planes).mean()) * 255 if image.size else 0.0 for c in LAMPS}
    best = max(score, key=score.__getitem__)
    return best if score[best] >= LIT else UNKNOWN, score[best]


def lamp_shape(image: np.ndarray, colour: str) -> str:
    """A wide green region whose weight is left is an arrow; all else is a circle."""
    if colour != "녹색":
        return "circle"
    mask = lamp_mask(image, colour)
    n, x, _ = moments(mask)
    if not n:
        return "unknown"
    label = outer(mask)
    largest = max(np.unique(label[label > 0]), key=lambda k: enclosed(outline(label == k)))
    ys, xs = np.nonzero(label == largest)
    wide, high = xs.max() - xs.min() + 1, ys.max() - ys.min() + 1
    return "left_arrow" if wide > high * 1.15 and x < image.shape[1] * 0.58 and xs.min() < image.shape[1] * 0.45 else "circle"


def lamp_state(image: np.ndarray) -> dict:
    colour, score = lamp_colour(image)
    shape = lamp_shape(image, colour)
    return {"state": LEFT if colour == "녹색" and shape == "left_arrow" else colour, "colour": colour, "shape": shape, "score": round(score, 3)}


def padded(box: np.ndarray, pad: int, height: int, width: int) -> list[int]:
    x1, y1, x2, y2 = (int(v) for v in box[:4])
    return [max(0, x1 - pad), max(0, y1 - pad), min(width, x2 + pad), min(height, y2 + pad)]


def lit_lamps(image: np.ndarray) -> list[list[int]]:
    """Boxes of coloured regions in a frame's upper part, widened."""
    h, w = image.shape[:2]
    upper = image[: int(h * UPPER)]
    planes = hsv(upper)
    mask = np.logical_or.reduce([lamp_mask(upper, c, planes) for c in LAMPS])
    out = []
    for b in boxes(mask):
        wide, high = b[2] - b[0], b[3] - b[1]
        if LAMP_AREA[0] <= wide * high <= w * h * LAMP_AREA[1]:
            out.append(padded(b, max(6, int(max(wide, high) * 0.75)), h, w))
    return out


def red_signs(image: np.ndarray) -> list[list[int]]:
    """Boxes of about round red regions below a frame's upper part, widened."""
    h, w = image.shape[:2]
    out = []
    for b in boxes(lamp_mask(image, "적색")):
        wide, high = b[2] - b[0], b[3] - b[1]
        if SIGN_AREA[0] <= wide * high <= w * h * SIGN_AREA[1] and min(wide, high) / max(wide, high) >= 0.65 and b[1] >= h * 0.4:
            out.append(padded(b, max(6, int(max(wide, high) * 0.25)), h, w))
    return out


def median_of(grey: np.ndarray, side: int = 5) -> np.ndarray:
    """Medians of squares; edges are repeated."""
    return np.median(sliding_window_view(np.pad(grey, side // 2, mode="edge"), (side, side)), (2, 3))


def circles(grey: np.ndarray, least: int, low: int, high: int, apart: float, strong: float = 40) -> np.ndarray:
    """Circles (x, y, radius) with radii from ``low`` to ``high``: every edge pixel votes
    for centres along its slope, both ways; peaks with more than ``least`` votes, the most
    voted first and ``apart`` from each other, take the radius that most edge pixels per
    pixel of radius have."""
    found = edges(grey, strong / 2, strong)
    y, x = np.nonzero(found)
    h, w = grey.shape
    side, mid = np.array([-1.0, 0, 1]), np.array([1.0, 2, 1])
    g = np.asarray(grey, np.float64)
    gx, gy = tapped(g, mid, side)[y, x], tapped(g, side, mid)[y, x]
    size = np.hypot(gx, gy)
    x, y, gx, gy, size = (v[size > 0] for v in (x, y, gx, gy, size))
    reach = np.concatenate((np.arange(low, high + 1), -np.arange(low, high + 1)))
    cells = [np.rint((p[:, None] + g[:, None] / size[:, None] * reach) / CELL).astype(np.int64) for p, g in ((x, gx), (y, gy))]
    wide, tall = int(np.ceil(w / CELL)) + 1, int(np.ceil(h / CELL)) + 1
    inside = (cells[0] >= 0) & (cells[0] < wide) & (cells[1] >= 0) & (cells[1] < tall)
    votes = np.bincount((cells[1] * wide + cells[0])[inside], minlength=tall * wide).reshape(tall, wide)
    top = (votes >= sliding_window_view(np.pad(votes, 1), (3, 3)).max((2, 3))) & (votes > least)
    py, px = np.nonzero(top)
    out: list[tuple[float, float, float]] = []
    for i in np.argsort(-votes[py, px], kind="stable"):
        cx, cy = px[i] * CELL, py[i] * CELL
        if any((cx - a) ** 2 + (cy - b) ** 2 < apart * apart for a, b, _ in out):
            continue
        count = np.bincount(np.rint(np.hypot(x - cx, y - cy)).astype(np.int64), minlength=high + 2)
        near = (count[low - 1 : high] + count[low : high + 1] + count[low + 1 : high + 2]) / np.arange(low, high + 1)
        if len(near) and near.max() > 0:
            out.append((float(cx), float(cy), float(low + int(np.argmax(near)))))
    return np.array(out).reshape(-1, 3)


def _dull(crop: np.ndarray) -> tuple[float, float]:
    """The share of saturated pixels, and the brightness."""
    return float((hsv(crop)[..., 1] > 80).mean()), float(grey_of(crop).mean())


def dark_heads(image: np.ndarray) -> list[dict]:
    """Dark heads without a lit lamp in a frame's upper part: dull circles, then dull
    regions that are about round and not found as circles."""
    h, w = image.shape[:2]
    upper = image[: int(h * UPPER)]
    if not upper.size:
        return []
    scale = HEAD_WIDTH / w if w > HEAD_WIDTH else 1.0
    small = shrunk(upper, HEAD_WIDTH) if scale < 1 and w >= len(upper) else upper
    grey, (high, wide) = grey_of(small), small.shape[:2]
    found = []
    for x, y, r in circles(median_of(grey), 12, max(3, round(5 * scale)), max(8, min(wide, high) // 12), max(8, round(20 * scale))):
        x, y, r = (int(round(v / scale)) for v in (x, y, r))
        box = [max(0, x - r - 6), max(0, y - r - 6), min(w, x + r + 6), min(h, y + r + 6)]
        crop = upper[box[1] : box[3], box[0] : box[2]]
        if crop.size:
            vivid, bright = _dull(crop)
            if vivid < 0.08 and 10 <= bright <= 120:
                found.append({"box": box, "detector": "hough_dark_signal_head", "score": round((1 - vivid) * 100, 3), "brightness": round(bright, 3)})
    for b in boxes((grey >= 25) & (grey <= 130)):
        across, down = b[2] - b[0], b[3] - b[1]
        if not max(12, round(HEAD_AREA[0] * scale * scale)) <= across * down <= wide * high * HEAD_AREA[1] or min(across, down) / max(across, down) < 0.55:
            continue
        x1, y1, x2, y2 = (int(round(v / scale)) for v in b[:4])
        box = [max(0, min(w - 1, x1 - 6)), max(0, min(len(upper) - 1, y1 - 6)), max(0, min(w, x2 + 6)), max(0, min(len(upper), y2 + 6))]
        if any(abs(f["box"][0] - box[0]) < 8 and abs(f["box"][1] - box[1]) < 8 for f in found):
            continue
        vivid, bright = _dull(upper[box[1] : box[3], box[0] : box[2]])
        if vivid < 0.12 and 10 <= bright <= 130:
            found.append({"box": box, "detector": "dark_circular_signal_head", "score": round((1 - vivid) * 90, 3), "brightness": round(bright, 3)})
    return found


_STATE = [("state", pa.string()), ("colour", pa.string()), ("shape", pa.string()), ("score", pa.float64())]
_BOX = ("box", pa.list_(pa.int64()))


def traffic(image: np.ndarray) -> dict:
    """Lit lamps with their states, dark heads where none is lit, and signs."""
    lit = []
    for box in lit_lamps(image):
        state = lamp_state(image[box[1] : box[3], box[0] : box[2]])
        if state["colour"] != UNKNOWN:
            lit.append(state | {"box": box})
    return {"lamps": lit, "heads": [] if lit else dark_heads(image), "signs": [{"box": b} for b in red_signs(image)]}


TRAFFIC = pa.struct([("lamps", pa.list_(pa.struct([*_STATE, _BOX]))), ("heads", pa.list_(pa.struct([_BOX, ("detector", pa.string()), ("score", pa.float64()), ("brightness", pa.float64())]))), ("signs", pa.list_(pa.struct([_BOX])))])
TRAFFIC_SQL = "struct<lamps array<struct<state: string, colour: string, shape: string, score: double, box: array<bigint>>>, heads array<struct<box: array<bigint>, detector: string, score: double, brightness: double>>, signs array<struct<box: array<bigint>>>>"


def image_traffic(image: Column) -> Column:
    """``traffic`` of a column of Spark's image source (blue, green, red); null where there
    is no image, or a grey one."""
    return F.arrow_udf(lambda d, h, w, c: _each((d, h, w, c), lambda i: traffic(i) if i.ndim == 3 else None, TRAFFIC), TRAFFIC_SQL).asNondeterministic()(image["data"], image["height"], image["width"], image["nChannels"])
