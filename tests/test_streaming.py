from pyspark.sql import functions as F

from factlake.streaming import windows


def test_stream_peaks_equal_batch(spark, tmp_path):
    rows = spark.range(200).select((F.col("id") % 3).alias("user"), F.timestamp_seconds(F.col("id") * 977 % 90000).alias("ts"), (F.col("id") * 31 % 101).alias("value"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = windows.peaks(windows.read_events(spark, str(tmp_path / "in"), rows.schema), "ts", "value", ["user"])
    q = stream.writeStream.format("memory").queryName("peaks").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    batch = rows.groupBy("user", F.window("ts", "12 hours")).agg(F.max("value").alias("peak"), F.count("*").alias("n"))
    key = lambda df: sorted((r["user"], r["window"]["start"], r["peak"], r["n"]) for r in df.collect())
    assert key(spark.table("peaks")) == key(batch)


def test_frame_changes_and_job_states(spark, tmp_path):
    frames = [[(1, 0, 2, bytes(4)), (2, 5, 2, bytes([9] * 4)), (1, 1, 2, bytes([10] * 4))], [(1, 2, 2, bytes([4] * 4)), (2, 4, 2, bytes(4)), (2, 6, 2, bytes([1] * 6))]]
    schema = "video_id long, frame_index long, width long, pixels binary"
    jobs = [[("a", 1, "queued"), ("b", 1, "queued")], [("a", 2, "running")]]
    for i in range(2):
        spark.createDataFrame(frames[i], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "f"))
        spark.createDataFrame(jobs[i], "job_id string, seq long, status string").coalesce(1).write.mode("append").parquet(str(tmp_path / "j"))
    read = lambda name, s: spark.readStream.schema(s).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name))
    for name, df, mode in (("changes", windows.frame_changes(read("f", schema)), "append"), ("states", windows.job_states(read("j", "job_id string, seq long, status string")), "complete")):
        df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start().awaitTermination(120)
    got = {(r["video_id"], r["frame_index"]): (r["previous_index"], r["frame_diff"]) for r in spark.table("changes").collect()}
    assert got == {(1, 1): (0, 10.0), (1, 2): (1, 6.0)}
    assert {r["job_id"]: r["status"] for r in spark.table("states").collect()} == {"a": "running", "b": "queued"}


def test_outcomes_of_jobs_until_their_deadline(spark, tmp_path):
    """A job that ends, one that fails, one that ends too late, and one never heard of again."""
    from factlake.streaming import polling

    at = "timestamp'2024-01-01 00:00:00' + interval %d seconds"
    batches = [
        [("a", 0, "queued", None), ("b", 1, "queued", None), ("late", 2, "queued", None), ("lost", 3, "running", None), (None, 3, "queued", None)],
        [("a", 5, "running", None), ("b", 6, "failed", "disk"), ("a", 8, "succeeded", "r1")],
        [("a", 9, "succeeded", "again"), ("clock", 40, "queued", None)],
        [("late", 41, "succeeded", "r2"), ("clock", 42, "succeeded", "r3")],
        [("clock2", 200, "queued", None)],
        [("a", 201, "succeeded", "new life"), ("clock2", 202, "succeeded", None)],
    ]
    schema = "job_id string, s long, status string, result string"
    for rows in batches:
        df = spark.createDataFrame(rows, schema).select("job_id", F.expr((at % 0).replace("interval 0 seconds", "make_interval(0,0,0,0,0,0,s)")).alias("ts"), "status", "result")
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "u"))
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        stream = spark.readStream.schema("job_id string, ts timestamp, status string, result string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "u"))
        polling.outcomes(stream, deadline_ms=30_000).writeStream.format("memory").queryName("outcomes").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination(300)
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    got = [(r["job_id"], r["status"], r["result"], r["error"], r["waited_ms"]) for r in spark.table("outcomes").collect()]
    assert sorted(got, key=repr) == sorted([
        ("a", "succeeded", "r1", None, 8000), ("b", "failed", None, "disk", 5000), ("late", "failed", None, "timeout after 30 seconds", 30000), ("lost", "failed", None, "timeout after 30 seconds", 30000),
        ("clock", "succeeded", "r3", None, 2000), ("clock2", "succeeded", None, None, 2000), ("a", "succeeded", "new life", None, 0),
    ], key=repr)
