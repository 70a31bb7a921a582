"""Sequential rules on boxes: assignment to tracks, first-fit chaining.

These depend on the order of earlier decisions within one video, so they run as
grouped functions; a group is one video's detections.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

ASSIGNED = "video_id long, frame long, ord long, label string, x double, y double, track string, method string"
CHAINED = "video_id long, label string, track string, chain long"


def assign(df: DataFrame, reach: float = 120.0) -> DataFrame:
    """Detections (video_id, frame, ord, label, x, y, detector_id), in order of frame
    and ord, joined to tracks: the first track that has the detector's id, else of the
    tracks of its label the one whose last position is nearest and nearer than
    ``reach``, the earlier on ties; else it starts a track, named by the detector's id
    or T1, T2 and so on. A track may take several detections of one frame. One video is
    one task: what a detection joins depends on all before it."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["frame", "ord"], kind="stable").reset_index(drop=True)
        at_id: dict[str, int] = {}
        of_label: dict[str, list[int]] = {}
        names, labels, methods = [], [], []
        last = np.zeros((64, 2))
        out, how, number = [], [], 1
        for label, x, y, own in zip(pdf["label"], pdf["x"], pdf["y"], pdf["detector_id"], strict=True):
            own = own if isinstance(own, str) and own else None
            k = at_id.get(own, -1) if own else -1
            if k < 0 and (rivals := of_label.get(label)):
                d = np.hypot(last[rivals, 0] - x, last[rivals, 1] - y)
                best = int(d.argmin())
                k = rivals[best] if d[best] < reach else -1
            if k < 0:
                k = len(names)
                names.append(own or f"T{number}")
                number += own is None
                at_id.setdefault(names[k], k)
                labels.append(label)
                methods.append("detector_track_id" if own else "center_distance")
                of_label.setdefault(label, []).append(k)
                if k == len(last):
                    last = np.concatenate((last, np.zeros_like(last)))
            last[k] = x, y
            out.append(names[k])
            how.append(methods[k])
        return pdf.assign(track=out, method=how)[["video_id", "frame", "ord", "label", "x", "y", "track", "method"]]

    return df.select("video_id", "frame", "ord", "label", "x", "y", "detector_id").groupBy("video_id").applyInPandas(run, ASSIGNED)


def chain(df: DataFrame, gap: int = 45, reach: float = 240.0) -> DataFrame:
    """Fragments (video_id, label, track, first, last, x0, y0, x1, y1), in order
    of start, join the first chain that ended at most ``gap`` frames before and
    within ``reach``."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["first", "track"], kind="stable").reset_index(drop=True)
        ends: list[tuple[int, float, float]] = []
        out = []
        for r in pdf.itertuples():
            at = next((i for i, (f, x, y) in enumerate(ends) if 0 <= r.first - f <= gap and math.hypot(x - r.x0, y - r.y0) <= reach), len(ends))
            ends[at : at + 1] = [(r.last, r.x1, r.y1)]
            out.append(at)
        return pdf.assign(chain=out)[["video_id", "label", "track", "chain"]]

    return df.groupBy("video_id", "label").applyInPandas(run, CHAINED)
