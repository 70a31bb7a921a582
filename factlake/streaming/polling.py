"""Waiting for the results of submitted jobs: state with a deadline for each job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: How long a job is waited for, in milliseconds, and the states that end it.
DEADLINE_MS, ENDED = 900_000, ("succeeded", "failed")
OUTCOMES = "job_id string, status string, result string, error string, submitted_ms long, waited_ms long, polls int"


def outcomes(updates: DataFrame, deadline_ms: int = DEADLINE_MS, late: str = "0 seconds") -> DataFrame:
    """One row for each job of a stream of updates (job_id, ts, status, result): the first
    that ends it, or a failure once the watermark has passed its first update by
    ``deadline_ms``. What comes after that says nothing more about the job while its state
    is kept, which is as long again: then it is forgotten.

    A job's updates of a batch are taken in order of time; the wait counts from the first.
    An update behind the watermark still counts where its job is known; without a time it
    counts as of the watermark. A job without a name isn't waited for. Needs a state store
    that has timers, as RocksDB's provider, and writes in append mode."""
    import pandas as pd
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    class Wait(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.job = handle.getValueState("job", "first long, polls int, done boolean")

        def row(self, key, status, result, error, first, at, polls):
            return pd.DataFrame({"job_id": [key], "status": [status], "result": [result], "error": [error], "submitted_ms": [first], "waited_ms": [at - first], "polls": [polls]})

        def handleInputRows(self, key, rows, timerValues):
            now = timerValues.getCurrentWatermarkInMs()
            met = pd.concat(list(rows)).assign(at=lambda d: d["at"].fillna(now).astype("int64")).sort_values("at", kind="stable")
            first, polls, done = self.job.get() if self.job.exists() else (None, 0, False)
            for r in met.itertuples():
                if first is not None and r.at - first > 2 * deadline_ms:  # forgotten, though its timer has yet to fire
                    if not done:
                        yield self.expired(key[0], first, polls)
                    first = None
                if first is None:
                    first, polls, done = int(r.at), 0, False
                    self.handle.registerTimer(first + deadline_ms)
                if done or r.at - first > deadline_ms:
                    continue
                polls += 1
                if r.status in ENDED:
                    done = True
                    said = r.result if isinstance(r.result, str) else None
                    well = r.status == ENDED[0]
                    yield self.row(key[0], r.status, said if well else None, None if well else said or "failed", first, int(r.at), polls)
            self.job.update((first, polls, done))

        def expired(self, job, first, polls):
            return self.row(job, "failed", None, f"timeout after {deadline_ms // 1000} seconds", first, first + deadline_ms, polls)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            if not self.job.exists():
                return
            first, polls, done = self.job.get()
            at = expiredTimerInfo.getExpiryTimeInMs()
            if at == first + 2 * deadline_ms:
                self.job.clear()
            elif at == first + deadline_ms:  # else the timer of a life before
                self.handle.registerTimer(first + 2 * deadline_ms)
                if not done:
                    self.job.update((first, polls, True))
                    yield self.expired(key[0], first, polls)

        def close(self) -> None:
            pass

    named = updates.where("job_id IS NOT NULL").withWatermark("ts", late).select("job_id", "ts", F.unix_millis("ts").alias("at"), "status", "result")
    return named.groupBy("job_id").transformWithStateInPandas(statefulProcessor=Wait(), outputStructType=OUTCOMES, outputMode="append", timeMode="eventTime")
