"""Sessions. On a cluster the platform's settings hold; this is for one machine."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(master: str = "local[8]", partitions: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(master)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
