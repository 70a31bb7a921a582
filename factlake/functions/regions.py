"""Regions of a frame that may hold overlay text, and their binary images, in numpy."""

from __future__ import annotations

import numpy as np

from .motion import BANDED, _band, gaussian
from .pixels import grey_of
from .shapes import boxes

#: Named regions as shares of the frame (x1, y1, x2, y2), and the fields that
#: are read there.
REGIONS = {
    "full_frame": (0.0, 0.0, 1.0, 1.0), "top_band": (0.0, 0.0, 1.0, 0.22), "bottom_band": (0.0, 0.72, 1.0, 1.0), "top_left": (0.0, 0.0, 0.45, 0.25),
    "top_right": (0.55, 0.0, 1.0, 0.25), "bottom_left": (0.0, 0.65, 0.55, 1.0), "bottom_right": (0.45, 0.65, 1.0, 1.0),
}
FIELDS = {
    "full_frame": ("general",), "top_band": ("general", "datetime", "gps"), "bottom_band": ("general", "datetime", "speed", "gps"), "top_left": ("general", "datetime", "gps"),
    "top_right": ("general", "speed", "gps"), "bottom_left": ("general", "datetime", "gps"), "bottom_right": ("general", "speed", "gps"),
}
#: Fields whose failed readings are recorded.
TRACKED = ("datetime", "speed", "gps")
#: Bands searched for text, as shares of the height, with their fields; a
#: region's margins; the side and offset of the local threshold, and the size below which
#: a region is doubled.
BANDS = {"auto_top_text": (0.0, 0.28, ("datetime", "gps")), "auto_bottom_text": (0.62, 1.0, ("datetime", "speed", "gps"))}
MARGIN, SIDE, OFFSET, SMALL = (8, 6), 31, 7, 80


def best_split(grey: np.ndarray) -> int:
    """The grey level that parts the pixels into two classes whose means differ most,
    weighted by their sizes; 0 where all are equal."""
    n = np.bincount(grey.ravel(), minlength=256).astype(np.float64)
    below, total = np.cumsum(n), np.cumsum(n * np.arange(256))
    above = below[-1] - below
    with np.errstate(divide="ignore", invalid="ignore"):
        between = below * above * (total / below - (total[-1] - total) / above) ** 2
    return int(np.argmax(np.nan_to_num(between))) if n.any() else 0


def integral(a: np.ndarray) -> np.ndarray:
    return np.pad(np.cumsum(np.cumsum(a, 0), 1), ((1, 0), (1, 0)))


def box_mean(image: np.ndarray, side: int) -> np.ndarray:
    """Means of squares around each pixel from the integral image; edges are repeated."""
    r = side // 2
    s = integral(np.pad(np.asarray(image, np.float64), r, mode="edge"))
    return (s[side:, side:] - s[:-side, side:] - s[side:, :-side] + s[:-side, :-side]) / (side * side)


def local_mean(image: np.ndarray, side: int = SIDE) -> np.ndarray:
    """Means weighted by a bell curve of the side's width; edges are repeated."""
    from numpy.lib.stride_tricks import sliding_window_view

    r = side // 2
    g = gaussian(r, 0.3 * ((side - 1) * 0.5 - 1) + 0.8)
    if 0 < max(image.shape) <= BANDED:
        down, across = (_band(n, g.tobytes(), "edge") for n in image.shape)
        return down @ np.asarray(image, np.float64) @ across.T
    padded = np.pad(np.asarray(image, np.float64), r, mode="edge")
    return sliding_window_view(sliding_window_view(padded, side, 0) @ g, side, 1) @ g


def adaptive(grey: np.ndarray, side: int = SIDE, offset: float = OFFSET, bell: bool = True) -> np.ndarray:
    """White where a pixel is above its surroundings' mean less ``offset``; the mean is
    weighted by a bell curve, or plain from the integral image."""
    mean = np.rint(local_mean(grey, side) if bell else box_mean(grey, side))
    return np.where(grey > mean - offset, 255, 0).astype(np.uint8)


def fixed_regions(height: int, width: int) -> list[tuple[str, list[int], tuple[str, ...]]]:
    out = []
    for name, (x1, y1, x2, y2) in REGIONS.items():
        box = [round(width * x1), round(height * y1), round(width * x2), round(height * y2)]
        if box[0] < box[2] and box[1] < box[3]:
            out.append((name, box, FIELDS[name]))
    return out


def text_regions(image: np.ndarray) -> list[tuple[str, list[int], tuple[str, ...]]]:
    """For each band the box around all bright regions of a letter's height."""
    h, w = image.shape[:2]
    out = []
    for name, (top, bottom, fields) in BANDS.items():
        y1, y2 = int(h * top), h if bottom == 1 else int(h * bottom)
        band = image[y1:y2]
        if not band.size:
            continue
        grey = grey_of(band)
        b = boxes(grey > best_split(grey))
        wide, high = b[:, 2] - b[:, 0], b[:, 3] - b[:, 1]
        b = b[(high >= 4) & (high <= max(12, int((y2 - y1) * 0.8))) & (wide >= 3)]
        if len(b):
            box = [max(0, int(b[:, 0].min()) - MARGIN[0]), max(0, int(b[:, 1].min()) - MARGIN[1]), min(w, int(b[:, 2].max()) + MARGIN[0]), min(y2 - y1, int(b[:, 3].max()) + MARGIN[1])]
            out.append((name, [box[0], y1 + box[1], box[2], y1 + box[3]], fields))
    return out


def regions(image: np.ndarray) -> list[tuple[str, str, list[int], tuple[str, ...]]]:
    """(name, kind, box, fields): the fixed regions, then those found."""
    h, w = image.shape[:2]
    return [*((n, "fixed", b, f) for n, b, f in fixed_regions(h, w)), *((n, "auto_text_candidate", b, f) for n, b, f in text_regions(image))]


def prepared(image: np.ndarray, field: str) -> np.ndarray:
    """A region as the reader of a field takes it: for all fields as it is, else grey,
    doubled where small, with its local threshold."""
    if field == "general":
        return image
    grey = grey_of(image)
    if min(grey.shape) < SMALL:
        grey = np.repeat(np.repeat(grey, 2, 0), 2, 1)
    return adaptive(grey)
