"""A table of jobs as an append-only log of updates: the last one of each job counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The states of a job, and which may follow which.
NEXT = {"queued": ("running", "failed"), "running": ("running", "succeeded", "failed"), "succeeded": (), "failed": ()}
COLUMNS = "job_id string, seq long, updated_at string, status string, stage string, message string, pre_path string, final_path string, error string"


def now() -> Column:
    """UTC with whole seconds, as text."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def append(spark: SparkSession, folder: str, updates: DataFrame) -> None:
    """Add updates; columns that they lack are null. Files are only ever added."""
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    kinds = dict(c.split() for c in COLUMNS.split(", "))
    updates.select(*[(F.col(n) if n in updates.columns else F.lit(None)).cast(kinds[n]).alias(n) for n in names]).write.mode("append").parquet(folder)


def latest(log: DataFrame, key: str = "job_id", order: str = "seq") -> DataFrame:
    """Each job's state: of every column the last value that isn't null, in order."""
    columns = [c for c in log.columns if c not in (key, order)]
    return log.groupBy(key).agg(F.max(order).alias(order), *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns])


def wrong_steps(log: DataFrame, key: str = "job_id", order: str = "seq", status: str = "status") -> DataFrame:
    """Updates whose status may not follow the one before."""
    from pyspark.sql import Window

    before = F.lag(status).over(Window.partitionBy(key).orderBy(order))
    allowed = F.lit(False)
    for state, following in NEXT.items():
        allowed = allowed | ((F.col("_before") == state) & F.col(status).isin(*following)) if following else allowed
    return log.withColumn("_before", before).where(F.col("_before").isNotNull() & ~allowed).withColumnRenamed("_before", "before")


def result_path(state: DataFrame) -> Column:
    """The final result's path, else the intermediate one's."""
    return F.coalesce("final_path", "pre_path")
