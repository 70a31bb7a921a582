"""Plans of frames around events, made inside one row each: no shuffle until they are
exploded. A plan is an array of (frame, purpose), in order of frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import frame_of


def evenly(start: Column, end: Column, count: int) -> Column:
    """``count`` seconds from start to end; the start alone if there is no span."""
    if count <= 1:
        return F.array(start)
    step = (end - start) / (count - 1)
    return F.when(end <= start, F.array(start)).otherwise(F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: start + i * step))


def at_rate(start: Column, end: Column, fps: float, least: int) -> Column:
    """Seconds at a fixed rate, or ``least`` even ones where these are fewer."""
    n = F.floor((end - start + 1e-9) * fps).cast("int")
    steps = F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(0))), lambda i: start + i / fps)
    return F.when(end <= start, F.array(start)).when(n + 1 < least, evenly(start, end, least)).otherwise(steps)


def merged(entries: Column) -> Column:
    """Entries of one frame become one, their purposes joined by '+' in order, once each."""
    frames = F.array_sort(F.array_distinct(F.transform(entries, lambda e: e["frame"])))
    purposes = lambda f: F.array_distinct(F.transform(F.filter(entries, lambda e: e["frame"] == f), lambda e: e["purpose"]))
    return F.transform(frames, lambda f: F.struct(f.alias("frame"), F.array_join(purposes(f), "+").alias("purpose")))


def limited(items: Column, most: Column | int) -> Column:
    """``most`` even elements, at half-even rounded places; all if there are no more, none for 0."""
    most = F.lit(most) if isinstance(most, int) else most
    last = F.size(items) - 1
    places = F.array_distinct(F.transform(F.sequence(F.lit(0), F.greatest(most - 1, F.lit(1))), lambda i: F.rint(i * last / F.greatest(most - 1, F.lit(1))).cast("int")))
    few = F.when(most == 1, F.slice(items, 1, 1)).otherwise(F.transform(places, lambda i: F.get(items, i)))
    return F.when(most <= 0, F.slice(items, 1, 0)).when(F.size(items) <= most, items).otherwise(few)


def _groups(center: Column, duration: Column, before: float, after: float, reach: float) -> list[tuple[Column, Column, int]]:
    """Start, end and frames of the four groups around an event."""
    zero = F.lit(0.0)
    start, end = F.greatest(zero, center - before), F.least(duration, center + after)
    impact = F.greatest(start, center - reach), F.least(end, center + reach)
    focus = F.greatest(start, center - 2.5)
    return [(start, F.greatest(start, focus), 5), (focus, center, 6), (*impact, 5), (F.least(end, impact[1]), end, 4)]


def _entries(seconds: Column, purpose: str, fps: Column, frames: Column) -> Column:
    return F.transform(seconds, lambda s: F.struct(frame_of(s, fps, frames).alias("frame"), F.lit(purpose).alias("purpose")))


def _rows(df: DataFrame, columns: list[str], items: str) -> DataFrame:
    """A row for each element as ``_x``. The outer form, as the plain one infers a filter
    on the array, which is then pushed through and repeats every step that made it."""
    return df.select(*columns, F.explode_outer(items).alias("_x")).where("_x IS NOT NULL")


def window_plan(clips: DataFrame, center: str, duration: str, fps: str, frames: str, most: int = 20, before: float = 6.0, after: float = 4.0) -> DataFrame:
    """Rows (frame, purpose) for each clip: 5, 6, 5 and 4 frames before, close to, at and
    after an event, filled up from its window; without an event, even frames over the
    clip. Each step is a column of its own, so that none is evaluated twice."""
    at, length, rate, n = (F.col(c) for c in (center, duration, fps, frames))
    names = ("pre_context", "pre_impact", "impact_candidate", "post_impact")
    groups = _groups(at, length, before, after, 0.75)
    d = clips.withColumn("_e", F.concat(*[_entries(evenly(a, b, k), name, rate, n) for name, (a, b, k) in zip(names, groups, strict=True)]))
    d = d.withColumn("_plan", merged(F.col("_e"))).withColumn("_fill", _entries(evenly(groups[0][0], groups[3][1], most), "event_window_context", rate, n))
    # a frame's merged purpose is one name when it is filled up
    d = d.withColumn("_e", F.when(F.size("_plan") < most, F.concat("_plan", "_fill")).otherwise(F.col("_plan"))).withColumn("_plan", merged(F.col("_e")))
    # without an event: every interval, within the clip
    d = d.withColumn("_step", F.greatest(length / max(most - 1, 1), F.lit(0.001)))
    d = d.withColumn("_r", F.array_distinct(F.transform(F.sequence(F.lit(0), F.floor(length / F.col("_step") + 1e-9).cast("int")), lambda i: F.rint(i * F.col("_step") * rate).cast("bigint"))))
    regular = F.transform(F.filter("_r", lambda f: f <= F.floor(length * rate + 1e-9)), lambda f: F.struct(f.alias("frame"), F.lit("regular_context").alias("purpose")))
    d = d.withColumn("_plan", F.when(at.isNull(), regular).otherwise(F.col("_plan"))).withColumn("_out", limited(F.col("_plan"), most))
    return _rows(d, clips.columns, "_out").select(*clips.columns, "_x.frame", "_x.purpose")


def precision_plan(clips: DataFrame, center: str, duration: str, fps: str, frames: str, most: int = 20, before: float = 6.0, after: float = 4.0, rate: float = 15.0, impact: int = 5) -> DataFrame:
    """Rows (frame, purpose, selected) for each clip with an event: frames at ``rate``
    around it; of too many, ``impact`` of the moment itself are kept first and the others
    thinned evenly. Each group stays an array of its own distinct frames: what a frame is
    for is which of them hold it, asked once it is a row, so that no frame's purposes are
    searched among all entries."""
    at, length, fps_, n = (F.col(c) for c in (center, duration, fps, frames))
    names = ("event_scan_pre_context", "event_scan_pre_impact", "event_scan_impact_candidate", "event_scan_post_impact")
    groups = _groups(at, length, before, after, 0.35)
    d = clips.where(at.isNotNull()).withColumns({f"_{s}{i}": x for i, g in enumerate(groups) for s, x in zip("ab", g[:2], strict=True)})
    spans = [(F.col(f"_a{i}"), F.col(f"_b{i}"), max(impact, 5) if i == 2 else k) for i, (_, _, k) in enumerate(groups)]
    d = d.withColumns({f"_f{i}": F.array_distinct(F.transform(at_rate(*span[:2], rate, span[2]), lambda s: frame_of(s, fps_, n))) for i, span in enumerate(spans)})
    each = [f"_f{i}" for i in range(len(names))]
    d = d.withColumns({"_plan": F.sort_array(F.array_distinct(F.concat(*each))), "_hit": F.sort_array("_f2")})
    d = d.withColumns({"_rest": F.array_except("_plan", "_hit"), "_kept": limited(F.col("_hit"), F.least(F.lit(max(impact, 1)), F.size("_hit"), F.lit(most)))})
    d = d.withColumn("_others", limited(F.col("_rest"), F.lit(most) - F.size("_kept")))
    d = d.withColumn("_chosen", F.when(F.size("_plan") <= most, F.col("_plan")).otherwise(F.slice(F.sort_array(F.concat("_kept", "_others")), 1, most)))
    d = _rows(d, [*clips.columns, "_chosen", *each], "_plan")
    purpose = F.concat_ws("+", *[F.when(F.array_contains(f, F.col("_x")), name) for f, name in zip(each, names, strict=True)])
    return d.select(*clips.columns, F.col("_x").alias("frame"), purpose.alias("purpose"), F.array_contains("_chosen", F.col("_x")).alias("selected"))


def primary_event(events: DataFrame, keys: list[str], score: str, time: str, order: str) -> DataFrame:
    """The time of the best event that has one, the first on ties."""
    return events.where(F.col(time).isNotNull()).groupBy(*keys).agg(F.max_by(time, F.struct(F.coalesce(score, F.lit(0.0)).alias("s"), (-F.col(order)).alias("o"))).alias("center"))


def dense_frames(segments: DataFrame, key: str, order: str, start: str, end: str, stride: int, per_segment: int, total: int | None = None) -> DataFrame:
    """Every ``stride``-th frame of each segment, at most ``per_segment``; the overall
    number is used up in the segments' order."""
    n = F.least(F.lit(per_segment), F.greatest(F.lit(0), F.floor((F.col(end) - F.col(start)) / stride).cast("int") + 1))
    d = segments.withColumn("_n", n)
    if total is not None:
        before = F.coalesce(F.sum("_n").over(Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        d = d.withColumn("_n", F.least(F.col("_n"), F.greatest(F.lit(0), F.lit(total) - before)).cast("int"))
    frames = F.explode(F.transform(F.sequence(F.lit(0), F.col("_n") - 1), lambda i: F.col(start) + i * stride)).alias("frame")
    return d.where("_n > 0").select(key, order, frames)


def strided(videos: DataFrame, frames: str, step: int) -> DataFrame:
    """Every ``step``-th frame of a clip from 0."""
    if step <= 0:
        raise ValueError("step must be positive")
    return videos.where(F.col(frames) > 0).select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(frames).cast("bigint") - 1, F.lit(step).cast("bigint"))).alias("frame_index"))
