"""Structured Streaming forms of the batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_events(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).parquet(folder)


def peaks(events: DataFrame, time: str, value: str, keys: list[str], width: str = "12 hours", late: str = "1 hour") -> DataFrame:
    """The best value in each tumbling window: the streaming neighbour of greedy
    suppression, which needs all candidates and is not the same."""
    return events.withWatermark(time, late).groupBy(*keys, F.window(time, width)).agg(F.max(value).alias("peak"), F.max_by(time, value).alias("at"), F.count("*").alias("n"))


def around(events: DataFrame, marks: DataFrame, key: str, before: str = "6 seconds", after: str = "4 seconds", late: str = "1 minute") -> DataFrame:
    """Stream-stream interval join: events (ts) around marks (mark_ts)."""
    e, m = events.withWatermark("ts", late).alias("e"), marks.withWatermark("mark_ts", late).alias("m")
    return e.join(m, F.expr(f"e.{key} = m.{key} AND e.ts BETWEEN m.mark_ts - interval {before} AND m.mark_ts + interval {after}"))


def visible(events: DataFrame, time: str, keys: list[str], gap: str = "6 seconds", late: str = "1 minute") -> DataFrame:
    """Sessions broken by gaps."""
    return events.withWatermark(time, late).groupBy(*keys, F.session_window(time, gap)).agg(F.count("*").alias("n"))


CHANGES = "video_id long, frame_index long, previous_index long, frame_diff double, histogram_change double, flow_peak double, flow_mean double, compensated double"


def frame_changes(frames: DataFrame) -> DataFrame:
    """Each grey frame (video_id, frame_index, width, pixels) against the one before of
    its video, across batches: the state is one frame. Frames of a batch are put in
    order; one that comes after a later one was seen, or whose shape differs from the
    last one's, makes no pair. Flow and the compensated difference are those of
    ``motion``."""
    import numpy as np
    import pandas as pd
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    from ..functions.motion import clip_motion, scan

    def run(key, batches, state: GroupState):
        last, at, width = (bytes(state.get[0]), state.get[1], state.get[2]) if state.exists else (None, -1, 0)
        out = []
        for r in pd.concat(list(batches)).sort_values("frame_index").itertuples():
            if r.frame_index <= at:
                continue
            if last is not None and width == r.width and len(last) == len(r.pixels) and width and len(last) % width == 0:
                pair = [np.frombuffer(x, np.uint8).reshape(-1, width) for x in (last, r.pixels)]
                out.append((key[0], r.frame_index, at, *scan(*pair), clip_motion(*pair)[1]))
            last, at, width = bytes(r.pixels), int(r.frame_index), int(r.width)
        if last is not None:
            state.update((last, at, width))
        yield pd.DataFrame(out, columns=[c.split(" ")[0] for c in CHANGES.split(", ")])

    return frames.groupBy("video_id").applyInPandasWithState(run, CHANGES, "pixels binary, at long, width long", "append", GroupStateTimeout.NoTimeout)


def job_states(updates: DataFrame, key: str = "job_id", order: str = "seq") -> DataFrame:
    """The last status of each job as updates arrive; for update or complete mode."""
    return updates.groupBy(key).agg(F.max(order).alias(order), F.max_by("status", order).alias("status"))
