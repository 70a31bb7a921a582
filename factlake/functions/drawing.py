"""Pictures of evidence in numpy: boxes drawn, crops, pairs side by side, contact sheets,
and PNG, without losses."""

from __future__ import annotations

import struct
import zlib

import numpy as np

from .motion import resized
from .pixels import shrunk

#: A crop's least side, and a sheet's thumbnails, columns and title's height.
LEAST_SIDE, THUMB, COLUMNS, TITLE = 48, 240, 5, 34


def boxed(image: np.ndarray, boxes: list[list[int]], colour: tuple[int, ...] = (0, 180, 255), thick: int = 2) -> np.ndarray:
    """The image with rectangles of ``thick`` pixels inside the boxes' borders."""
    out = image.copy()
    ink = colour if image.ndim == 3 else max(colour)
    for x1, y1, x2, y2 in boxes:
        for rows, cols in ((slice(y1, y1 + thick), slice(x1, x2)), (slice(max(y1, y2 - thick), y2), slice(x1, x2)), (slice(y1, y2), slice(x1, x1 + thick)), (slice(y1, y2), slice(max(x1, x2 - thick), x2))):
            out[rows, cols] = ink
    return out


def crop(image: np.ndarray, box: list[int]) -> np.ndarray | None:
    """What is inside a box, enlarged a whole number of times where a side is short; null
    for nothing."""
    x1, y1, x2, y2 = box
    part = image[max(0, y1) : max(0, y2), max(0, x1) : max(0, x2)]
    if not part.size:
        return None
    times = max(1, round(LEAST_SIDE / min(part.shape[:2]))) if min(part.shape[:2]) < LEAST_SIDE else 1
    return scaled(part, part.shape[0] * times, part.shape[1] * times) if times > 1 else part


def scaled(image: np.ndarray, height: int, width: int) -> np.ndarray:
    planes = [resized(p.astype(np.float64), height, width) for p in (np.moveaxis(image, -1, 0) if image.ndim == 3 else [image])]
    out = np.stack(planes, -1) if image.ndim == 3 else planes[0]
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


def beside(images: list[np.ndarray]) -> np.ndarray:
    """Images in a row, as high as the lowest."""
    high = min(i.shape[0] for i in images)
    return np.concatenate([i if i.shape[0] == high else scaled(i, high, max(1, round(i.shape[1] * high / i.shape[0]))) for i in images], 1)


def sheet(images: list[np.ndarray], thumb: int = THUMB) -> np.ndarray | None:
    """Thumbnails of one width in rows of COLUMNS at most, under a bar for a title; null
    for no images."""
    if not images:
        return None
    colour = [i if i.ndim == 3 else np.repeat(i[..., None], 3, 2) for i in images]
    small = [shrunk(i, round(thumb * max(1.0, i.shape[0] / i.shape[1]))) if i.shape[1] > thumb else i for i in colour]
    small = [i if i.shape[1] == thumb else scaled(i, max(1, round(i.shape[0] * thumb / i.shape[1])), thumb) for i in small]
    wide, high = min(COLUMNS, len(small)), max(i.shape[0] for i in small)
    out = np.full((TITLE + high * -(-len(small) // wide), thumb * wide, 3), 24, np.uint8)
    for n, i in enumerate(small):
        y, x = TITLE + n // wide * high, n % wide * thumb
        out[y : y + i.shape[0], x : x + thumb] = i
    return out


def png(image: np.ndarray) -> bytes:
    """A grey, or blue, green and red, image as PNG."""
    h, w = image.shape[:2]
    rows = image if image.ndim == 2 else np.ascontiguousarray(image[..., ::-1])
    raw = np.zeros((h, 1 + w * (1 if image.ndim == 2 else 3)), np.uint8)
    raw[:, 1:] = rows.reshape(h, -1)
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0 if image.ndim == 2 else 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw.tobytes())) + chunk(b"IEND", b"")
