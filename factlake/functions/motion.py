"""Motion between two grey frames in numpy: dense flow, and what is left of a change
once the camera's own motion is taken out.

Flow fits a quadratic to each neighbourhood of both frames; the shift that carries one
fit into the other is averaged over a window and refined from coarse to fine. The
camera's motion is a similarity (shift, turn, zoom) that most tracked corners agree
on. Frames are arrays of height x width; points and shifts are (x, y)."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column
from pyspark.sql import functions as F

from .pixels import frame_change, shrunk

#: Differences below which flow is not computed, a frame's greatest side
#: for the motion of its clip, and the percentile that counts as the flow's peak.
SKIP_DIFF, SKIP_HISTOGRAM, SKIP_STILL, MOTION_SIDE, PEAK = 1.0, 1.0, 0.5, 64, 95
#: Fixed values of the flow: window, rounds, levels, reach and spread of the fit.
WINDOW, ROUNDS, LEVELS, REACH, SPREAD = 15, 3, 3, 5, 1.2
#: Sides up to which a filter is one product with a matrix, and pixels of all
#: frames that are taken at once.
BANDED, AT_ONCE = 128, 1 << 14
#: Fixed values of tracking: corners at most, their least quality and distance, the
#: tracked window, and corners without which there is no compensation.
CORNERS, QUALITY, APART, PATCH, LEAST = 200, 0.01, 7, 21, 6
#: Consensus: tries, the distance in pixels of those that agree, and the seed.
TRIES, AGREE, SEED = 512, 3.0, 7


@lru_cache(256)
def _band(size: int, kernel: bytes, edges: str = "symmetric") -> np.ndarray:
    """The matrix that correlates a side of pixels with an odd kernel, edges mirrored or as
    ``np.pad`` names it."""
    k = np.frombuffer(kernel)
    at = np.pad(np.arange(size), len(k) // 2, mode=edges)
    out = np.zeros((size, size))
    np.add.at(out, (np.arange(size)[:, None], sliding_window_view(at, len(k))), k)
    return out


def tapped(image: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """``filtered`` by sums of shifted images: equal surroundings give equal bits, which
    keeps ties ties."""
    out = np.asarray(image, np.float64)
    for axis, kernel in ((0, rows), (1, cols)):
        half, size, part = len(kernel) // 2, out.shape[axis], (slice(None),) * axis
        if half <= size:
            wide = np.concatenate((out[(*part, slice(0, half))][(*part, slice(None, None, -1))], out, out[(*part, slice(size - half, size))][(*part, slice(None, None, -1))]), axis)
        else:
            wide = np.pad(out, [(half, half) if k == axis else (0, 0) for k in range(out.ndim)], mode="symmetric")
        # two buffers for all taps: large arrays that come and go cost more than the sums
        out, one = np.zeros(out.shape), np.empty(out.shape)
        for i, k in enumerate(kernel):
            if k:
                np.multiply(wide[(*part, slice(i, i + size))], k, out=one)
                out += one
    return out


def filtered(image: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Correlation with an outer product of two odd kernels; edges are mirrored. Further
    axes are images of their own."""
    high, wide = image.shape[:2]
    if not 0 < max(high, wide) <= BANDED:
        return tapped(image, rows, cols)
    m, n = (_band(size, np.asarray(k, np.float64).tobytes()) for size, k in ((high, rows), (wide, cols)))
    down = m @ np.asarray(image, np.float64).reshape(high, -1)
    return (np.matmul(n, down.reshape(high, wide, -1)) if image.ndim > 2 else down @ n.T).reshape(image.shape)


def gaussian(reach: int, spread: float) -> np.ndarray:
    g = np.exp(-(np.arange(-reach, reach + 1) ** 2) / (2 * spread * spread))
    return g / g.sum()


def sampled(image: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Values between pixels by bilinear weights; beyond the edges the edge's."""
    h, w = image.shape[:2]
    x, y = np.clip(x, 0, w - 1), np.clip(y, 0, h - 1)
    i, j = np.minimum(y.astype(np.int64), max(h - 2, 0)), np.minimum(x.astype(np.int64), max(w - 2, 0))
    dy, dx = y - i, x - j
    if image.ndim == 3:
        dy, dx = dy[..., None], dx[..., None]
    below, right = np.minimum(i + 1, h - 1), np.minimum(j + 1, w - 1)
    return (image[i, j] * (1 - dx) + image[i, right] * dx) * (1 - dy) + (image[below, j] * (1 - dx) + image[below, right] * dx) * dy


def resized(image: np.ndarray, h: int, w: int) -> np.ndarray:
    """To another size by bilinear weights, with pixels' centres kept."""
    y, x = np.meshgrid((np.arange(h) + 0.5) * image.shape[0] / h - 0.5, (np.arange(w) + 0.5) * image.shape[1] / w - 0.5, indexing="ij")
    return sampled(image, x, y)


@lru_cache(8)
def _weights(reach: int, spread: float) -> np.ndarray:
    """What makes the fit's slopes and curves of the six moments."""
    d = np.arange(-reach, reach + 1)
    g = gaussian(reach, spread)
    basis = np.stack([np.outer(d**j, d**i).ravel() for i, j in POWERS]).astype(np.float64)
    return np.linalg.inv(basis * np.outer(g, g).ravel() @ basis.T)[:, 1:].T


#: Powers of x and y of a fit's terms.
POWERS = ((0, 0), (1, 0), (0, 1), (2, 0), (0, 2), (1, 1))


def quadratic(images: np.ndarray, reach: int = REACH, spread: float = SPREAD) -> np.ndarray:
    """The weighted least-squares fit at each pixel of each image (height x width x number):
    slopes x, y and curves xx, yy, xy, which come first."""
    d = np.arange(-reach, reach + 1)
    g = gaussian(reach, spread)
    moments = np.stack([filtered(images, g * d**j, g * d**i) for i, j in POWERS])
    return (_weights(reach, spread) @ moments.reshape(6, -1)).reshape(5, *images.shape)


def _carried(planes: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``sampled`` for planes (5 x height x width x number), of each image at its own places."""
    h, w, n = x.shape
    x, y = np.clip(x, 0, w - 1), np.clip(y, 0, h - 1)
    i, j = np.minimum(y.astype(np.int64), max(h - 2, 0)), np.minimum(x.astype(np.int64), max(w - 2, 0))
    dy, dx = y - i, x - j
    flat, at = planes.reshape(len(planes), -1), (i * w + j) * n + np.arange(n)
    right, below = n if w > 1 else 0, w * n if h > 1 else 0
    take = lambda at, weight: np.take(flat, at, 1) * weight
    return take(at, (1 - dx) * (1 - dy)) + take(at + right, dx * (1 - dy)) + take(at + below, (1 - dx) * dy) + take(at + below + right, dx * dy)


def _refined(flow: np.ndarray, one: np.ndarray, two: np.ndarray, window: int) -> np.ndarray:
    """One round: the shift that carries the first fits into the second, found from where
    the present flow (2 x height x width x number) leads, averaged over the window."""
    h, w = flow.shape[1:3]
    y, x = np.mgrid[:h, :w].astype(np.float64)[..., None]
    there = _carried(two, x + flow[0], y + flow[1])
    mean = (one + there) / 2
    a, b, c = mean[2], mean[3], mean[4] / 2
    p = (one[0] - there[0]) / 2 + a * flow[0] + c * flow[1]
    q = (one[1] - there[1]) / 2 + c * flow[0] + b * flow[1]
    box = np.full(window, 1 / window)
    xx, yy, xy, u, v = np.moveaxis(filtered(np.stack((a * a + c * c, b * b + c * c, c * (a + b), a * p + c * q, c * p + b * q), 2), box, box), 2, 0)
    det = xx * yy - xy * xy
    # without structure there is no evidence of motion: a small ridge pulls it to none
    ridge = 1e-6 * (xx + yy) ** 2 + 1e-9
    return np.stack((yy * u - xy * v, xx * v - xy * u)) / (det + ridge)


def dense_flows(before: np.ndarray, after: np.ndarray, window: int = WINDOW, rounds: int = ROUNDS, levels: int = LEVELS) -> np.ndarray:
    """The shift (x, y) of each pixel of each image of ``before`` (height x width x number),
    with the shift first. Levels stop where a side would fall under 16 pixels."""
    pair = [np.asarray(f, np.float64) for f in (before, after)]
    steps = [pair]
    while len(steps) < levels and min(steps[-1][0].shape[:2]) >= 32:
        smooth = gaussian(2, 1.0)
        steps.append([resized(filtered(f, smooth, smooth), f.shape[0] // 2, f.shape[1] // 2) for f in steps[-1]])
    flow = None
    for one, two in reversed(steps):
        h, w = one.shape[:2]
        flow = np.zeros((2, *one.shape)) if flow is None else np.stack([resized(f, h, w) * s for f, s in zip(flow, (w / flow.shape[2], h / flow.shape[1]), strict=True)])
        fits = quadratic(one), quadratic(two)
        for _ in range(rounds):
            flow = _refined(flow, *fits, min(window, h | 1, w | 1))
    return flow


def dense_flow(before: np.ndarray, after: np.ndarray, window: int = WINDOW, rounds: int = ROUNDS, levels: int = LEVELS) -> np.ndarray:
    """The shift (x, y) of each pixel of ``before``; height x width x 2."""
    return np.moveaxis(dense_flows(np.asarray(before)[..., None], np.asarray(after)[..., None], window, rounds, levels)[..., 0], 0, -1)


def nearest_rank(values: np.ndarray, percentile: float) -> float:
    flat = values.ravel()
    return float(np.partition(flat, at := max(0, int(np.ceil(flat.size * percentile / 100)) - 1))[at]) if flat.size else 0.0


def flow_size(flow: np.ndarray) -> tuple[float, float]:
    """The flow's peak and mean length."""
    length = np.hypot(flow[..., 0], flow[..., 1])
    return nearest_rank(length, PEAK), float(length.mean()) if length.size else 0.0


def gradients(image: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slopes along x and y of smoothed differences."""
    side, mid = np.array([-0.5, 0, 0.5]), np.array([3, 10, 3]) / 16
    return filtered(image, mid, side), filtered(image, side, mid)


def corners(image: np.ndarray, most: int = CORNERS, quality: float = QUALITY, apart: float = APART) -> np.ndarray:
    """Points (x, y) where the lesser eigenvalue of the slopes' products is a local peak
    and at least ``quality`` of the greatest, strongest first, ``apart`` pixels apart."""
    gx, gy = gradients(np.asarray(image, np.float64))
    box = np.ones(3)
    xx, yy, xy = np.moveaxis(filtered(np.stack((gx * gx, gy * gy, gx * gy), -1), box, box), -1, 0)
    least = (xx + yy) / 2 - np.sqrt(((xx - yy) / 2) ** 2 + xy * xy)
    around = sliding_window_view(np.pad(least, 1, constant_values=-1), (3, 3)).max((2, 3))
    y, x = np.nonzero((least >= around) & (least > max(quality * least.max(initial=0), 1e-9)))
    order = np.argsort(-least[y, x], kind="stable")
    points, kept = np.stack((x, y), 1)[order], []
    open_ = np.ones(len(points), bool)
    while open_.any() and len(kept) < most:
        i = int(np.argmax(open_))
        kept.append(i)
        open_ &= ((points - points[i]) ** 2).sum(1) >= apart * apart
    return points[kept].astype(np.float64)


def tracked(before: np.ndarray, after: np.ndarray, points: np.ndarray, patch: int = PATCH, levels: int = LEVELS, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Where ``points`` of one frame are in the next, by least squares over a window from
    coarse to fine, and which could be followed: with structure, and inside."""
    steps = [[np.asarray(f, np.float64) for f in (before, after)]]
    smooth = gaussian(2, 1.0)
    while len(steps) < levels and min(steps[-1][0].shape) >= 32:
        steps.append([resized(filtered(f, smooth, smooth), f.shape[0] // 2, f.shape[1] // 2) for f in steps[-1]])
    dy, dx = np.mgrid[:patch, :patch].astype(np.float64) - patch // 2
    shift, good = np.zeros_like(points), np.ones(len(points), bool)
    for level, (one, two) in reversed(list(enumerate(steps))):
        sx, sy = one.shape[1] / steps[0][0].shape[1], one.shape[0] / steps[0][0].shape[0]
        at = (points + 0.5) * (sx, sy) - 0.5
        x, y = at[:, 0, None, None] + dx, at[:, 1, None, None] + dy
        gx, gy = gradients(one)
        gx, gy, here = sampled(gx, x, y), sampled(gy, x, y), sampled(one, x, y)
        xx, yy, xy = (m.sum((1, 2)) for m in (gx * gx, gy * gy, gx * gy))
        det = xx * yy - xy * xy
        usable = (xx + yy) / 2 - np.sqrt(((xx - yy) / 2) ** 2 + xy * xy) > 1e-4 * dx.size
        good &= usable | (level > 0)
        d, going = shift * (sx, sy), np.flatnonzero(usable)
        for _ in range(rounds):
            i = going
            error = here[i] - sampled(two, x[i] + d[i, 0, None, None], y[i] + d[i, 1, None, None])
            u, v = (error * gx[i]).sum((1, 2)), (error * gy[i]).sum((1, 2))
            step = np.stack((yy[i] * u - xy[i] * v, xx[i] * v - xy[i] * u), 1) / det[i, None]
            d[i] += step
            going = i[(np.abs(step) >= 0.01).any(1)]
            if not len(going):
                break
        shift = d / (sx, sy)
    to = points + shift
    h, w = steps[0][0].shape
    return to, good & (to >= 0).all(1) & (to[:, 0] <= w - 1) & (to[:, 1] <= h - 1)


def similarity(one: np.ndarray, two: np.ndarray, tries: int = TRIES, agree: float = AGREE, seed: int = SEED) -> np.ndarray | None:
    """The 2 x 3 matrix of the shift, turn and zoom that carries most points of ``one``
    into ``two``; null without two points that differ. As complex numbers z -> a z + b:
    two points determine it, those that agree settle it by least squares."""
    p, q = one @ np.array([1, 1j]), two @ np.array([1, 1j])
    if len(p) < 2:
        return None
    pick = np.random.default_rng(seed).integers(0, len(p), (tries, 2))
    pick = pick[p[pick[:, 0]] != p[pick[:, 1]]]
    if not len(pick):
        return None
    (p0, p1), (q0, q1) = p[pick].T, q[pick].T
    a = (q1 - q0) / (p1 - p0)
    b = q0 - a * p0
    near = np.abs(a[:, None] * p + b[:, None] - q) <= agree
    held = near[np.argmax(near.sum(1))]
    p, q = p[held], q[held]
    centre = p - p.mean()
    size = (np.abs(centre) ** 2).sum()
    if not size:
        return None
    a = (np.conj(centre) * (q - q.mean())).sum() / size
    b = q.mean() - a * p.mean()
    return np.array([[a.real, -a.imag, b.real], [a.imag, a.real, b.imag]])


def warped(image: np.ndarray, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The image moved by a 2 x 3 matrix, 0 where nothing comes from, and where something
    does."""
    h, w = image.shape
    y, x = np.mgrid[:h, :w].astype(np.float64)
    back = np.linalg.inv(matrix[:, :2])
    x, y = x - matrix[0, 2], y - matrix[1, 2]
    x, y = back[0, 0] * x + back[0, 1] * y, back[1, 0] * x + back[1, 1] * y
    inside = (x >= -1e-6) & (x <= w - 1 + 1e-6) & (y >= -1e-6) & (y <= h - 1 + 1e-6)
    return np.where(inside, sampled(image.astype(np.float64), x, y), 0.0), inside


def compensated(before: np.ndarray, after: np.ndarray, overlap: bool = False) -> float:
    """The mean difference (0 to 1) of two frames once the camera's motion is taken out;
    the plain one with under LEAST corners or followed corners. What moves in from
    beyond the first frame differs from 0, or doesn't count with ``overlap``."""
    before, after = np.asarray(before, np.float64), np.asarray(after, np.float64)
    plain = float(np.abs(before - after).mean()) / 255
    points = corners(before)
    if len(points) < LEAST:
        return plain
    to, good = tracked(before, after, points)
    matrix = similarity(points[good], to[good]) if good.sum() >= LEAST else None
    if matrix is None or abs(np.linalg.det(matrix[:, :2])) < 1e-6:
        return plain
    moved, inside = warped(before, matrix)
    diff = np.abs(moved - after)
    if overlap:
        return float(diff[inside].mean()) / 255 if inside.any() else plain
    return float(diff.mean()) / 255


def scan(before: np.ndarray, after: np.ndarray, area_change: float = 0.0) -> tuple[float, float, float, float]:
    """Difference, histogram change, peak and mean flow of two frames of an event scan;
    flow is 0 where little changed and no box grew."""
    diff, apart = frame_change(before, after)
    if area_change <= 0 and diff < SKIP_DIFF and apart < SKIP_HISTOGRAM:
        return diff, apart, 0.0, 0.0
    return diff, apart, *flow_size(dense_flow(before, after))


def clip_motion(before: np.ndarray, after: np.ndarray, overlap: bool = False, flow: np.ndarray | None = None) -> tuple[float, float]:
    """Mean flow and compensated difference of two frames of a clip's quality, at most
    MOTION_SIDE pixels wide or high; both 0 where the mean difference is under SKIP_STILL.
    A flow known for the frames serves where they aren't shrunk."""
    one, two = shrunk(before, MOTION_SIDE), shrunk(after, MOTION_SIDE)
    if float(np.abs(one.astype(np.float64) - two).mean()) < SKIP_STILL:
        return 0.0, 0.0
    flow = flow if flow is not None and one.shape == before.shape else dense_flow(one, two)
    return flow_size(flow)[1], compensated(one, two, overlap)


MOTION = "frame_diff double, histogram_change double, flow_peak double, flow_mean double, flow_x double, flow_y double, motion_score double, compensated double"


def _frames(data: bytes | None, width: int | None) -> np.ndarray | None:
    return np.frombuffer(data, np.uint8).reshape(-1, width) if data and width and width > 0 and len(data) % width == 0 else None


def _flows(pairs: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """``dense_flow`` of pairs of any shapes; those of one shape are taken many at once."""
    out: list = [None] * len(pairs)
    by_shape: dict[tuple[int, int], list[int]] = {}
    for i, (one, _) in enumerate(pairs):
        by_shape.setdefault(one.shape, []).append(i)
    for (h, w), held in by_shape.items():
        step = max(1, AT_ONCE // (h * w))
        for at in (held[k : k + step] for k in range(0, len(held), step)):
            flow = dense_flows(*(np.stack([pairs[i][k] for i in at], -1) for k in (0, 1)))
            for i, f in zip(at, np.ascontiguousarray(np.moveaxis(flow, (3, 0), (0, -1))), strict=True):
                out[i] = f
    return out


_NAMES = [f.split(" ")[0] for f in MOTION.split(", ")]


def _motion(before: pa.Array, after: pa.Array, width: pa.Array, change: pa.Array, clip: bool) -> pa.Array:
    rows: list = [None] * len(before)
    for start in range(0, len(before), 512):  # bounds the flows that are held
        seen = []
        for i, (a, b, w, c) in enumerate(zip(*(x.slice(start, 512).to_pylist() for x in (before, after, width, change)), strict=True), start):
            one, two = _frames(a, w), _frames(b, w)
            if one is not None and two is not None and one.shape == two.shape:
                diff, apart = frame_change(one, two)
                seen.append((i, one, two, diff, apart, (c or 0.0) <= 0 and diff < SKIP_DIFF and apart < SKIP_HISTOGRAM))
        flows = iter(_flows([(one, two) for _, one, two, _, _, skip in seen if not skip]))
        for i, one, two, diff, apart, skip in seen:
            flow = None if skip else next(flows)
            shift = (0.0,) * 4 if flow is None else (*flow_size(flow), *map(float, np.median(flow.reshape(-1, 2), 0)))
            rows[i] = dict(zip(_NAMES, (diff, apart, *shift, *(clip_motion(one, two, flow=flow) if clip else (None, None))), strict=True))
    return pa.array(rows, pa.struct([(n, pa.float64()) for n in _NAMES]))


def frame_motion(before: Column, after: Column, width: Column, area_change: Column | None = None, clip: bool = True) -> Column:
    """Struct MOTION of two grey frames given as bytes, as with ``lag`` over a video's
    frames: difference and histogram change, peak and mean flow (0 where little changed
    and no box grew), the median shift, and the clip measures, which are null without
    ``clip``: they cost as much as the flow. Null without both frames, or where their
    shapes differ."""
    return F.arrow_udf(lambda a, b, w, c: _motion(a, b, w, c, clip), MOTION)(before, after, width, F.lit(0.0) if area_change is None else area_change)
