"""Sources and sinks: tables by name, typed JSON and label readers, fact records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def micros(ts: Column) -> Column:
    """Microseconds of a zone-less timestamp, read as UTC."""
    return F.unix_micros(ts.cast("timestamp"))


def events(spark: SparkSession, folder: str) -> DataFrame:
    """The event stream with its time in microseconds and the confidence in props."""
    e = table(spark, folder, "events")
    return e.select("event_id", "user_id", "event_type", "value", micros(F.col("ts")).alias("us"), F.get_json_object("props", "$.k").cast("int").alias("k"))


LABELS = T.StructType([T.StructField("video", T.StructType([T.StructField("video_name", T.StringType()), T.StructField("accident_object", T.IntegerType())]))])


def stem(path: Column) -> Column:
    """A file's name without folder and last suffix."""
    return F.regexp_replace(F.regexp_replace(path, r"^.*/", ""), r"(?<=.)\.[^.]*$", "")


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """One label for each video, from files at any depth, named by the label or else by
    its file; broken files are left out, and of one name the last path wins."""
    reader = spark.read.schema(LABELS).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").option("mode", "DROPMALFORMED")
    rows = reader.json(path).select("video.*", F.col("_metadata.file_path").alias("_path"))
    named = rows.withColumn("video_name", F.coalesce(F.nullif(F.col("video_name"), F.lit("")), stem(F.col("_path"))))
    return named.groupBy("video_name").agg(F.max_by("accident_object", "_path").alias("accident_object"))


def read_results(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Result records at any depth with their file's stem as ``video_name``, in order of
    paths; broken files are left out. Join them to labels by that name."""
    reader = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").option("mode", "DROPMALFORMED")
    return reader.json(path).withColumn("path", F.col("_metadata.file_path")).withColumn("video_name", stem(F.col("path"))).orderBy("path")


MANIFEST = "schema_version string, items array<struct<id: string, video_path: string, labels: map<string, string>, metadata: map<string, string>>>"


def read_manifest(spark: SparkSession, path: str, version: str) -> DataFrame:
    """A manifest's items in order (ord, id, video_path, labels, metadata), each with the
    ``error`` that makes it unusable, or null; an id defaults to the file's stem. Its
    ``schema_version`` has to be ``version``."""
    m = spark.read.schema(MANIFEST).option("multiLine", True).json(path)
    good = F.coalesce(F.col("schema_version") == version, F.lit(False))
    rows = m.select("schema_version", F.posexplode_outer("items").alias("ord", "item"))
    error = (
        F.when(~good, F.concat(F.lit("unsupported benchmark manifest schema: "), F.coalesce("schema_version", F.lit("None")))).when(F.col("ord").isNull(), "benchmark manifest requires an items list")
        .when(F.col("item").isNull(), F.format_string("manifest item %d must be an object", "ord")).when(F.col("item.labels").isNull(), F.format_string("manifest item %d requires labels", "ord")).when(F.coalesce("item.video_path", F.lit("")) == "", F.format_string("manifest item %d requires a video_path", "ord"))
    )
    return rows.select("ord", F.coalesce("item.id", stem(F.col("item.video_path"))).alias("id"), "item.video_path", "item.labels", "item.metadata", error.alias("error"))


VIDEOS = ("mp4", "mov", "avi", "mkv")


def list_files(spark: SparkSession, folder: str, suffixes: tuple[str, ...] = VIDEOS, limit: int = 0) -> DataFrame:
    """Files at any depth with one of the suffixes, in any case, in order of paths, with
    the triple that says whether a cached reading of one still holds; 0: all. Contents
    are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", F.col("modificationTime").alias("modified"), F.col("length"))
    found = files.where(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(*suffixes)).orderBy("path")
    return found.limit(limit) if limit > 0 else found


def reusable(output_modified: Column, source_modified: Column) -> Column:
    """Whether an existing output still holds: it is no older than its source, or the
    source's age isn't known."""
    return output_modified.isNotNull() & (source_modified.isNull() | (output_modified >= source_modified))


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def decode_images(spark: SparkSession, path: str) -> DataFrame:
    """Decoded images (image.origin, height, width, nChannels, data: blue, green, red);
    unreadable ones are left out. A query of the shape alone reads no pixels' column."""
    return spark.read.format("image").option("dropInvalid", True).option("recursiveFileLookup", True).load(path)


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """Encoded images with their path, undecoded."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.{png,jpg,jpeg}").load(path)


def write_facts(df: DataFrame, path: str, key: str = "video_id") -> None:
    """One JSON record for each input, unknowns kept as fields."""
    df.select(key, F.to_json(F.struct(*[c for c in df.columns]), {"ignoreNullFields": "false"}).alias("value")).select("value").write.mode("overwrite").text(path)


def escaped(x: Column) -> Column:
    """Text for HTML; null becomes empty."""
    x = F.coalesce(x.cast("string"), F.lit(""))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def html_rows(df: DataFrame) -> DataFrame:
    """A table row of escaped cells for each row, as ``value``."""
    cells = [F.concat(F.lit("<td>"), escaped(F.col(c)), F.lit("</td>")) for c in df.columns]
    return df.select(F.concat(F.lit("<tr>"), *cells, F.lit("</tr>")).alias("value"))


def write_html(df: DataFrame, folder: str, key: str, title: str) -> None:
    """One HTML file for each key: its rows, in the order of the other columns, as a
    table. Files are named by the key."""
    columns = [c for c in df.columns if c != key]
    row = F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), escaped(F.col(c)), F.lit("</td>")) for c in columns], F.lit("</tr>"))
    head = "".join(f"<th>{c}</th>" for c in columns)
    body = F.transform(F.array_sort(F.collect_list(F.struct(*columns, row.alias("_row")))), lambda x: x["_row"])
    page = F.concat(F.lit(f'<!doctype html><meta charset="utf-8"><title>{title}</title><table><tr>{head}</tr>\n'), F.array_join(body, "\n"), F.lit("\n</table>"))
    df.groupBy(key).agg(page.alias("value")).write.mode("overwrite").partitionBy(key).text(folder)


def class_list(names: list[str], root: str) -> str:
    """A detector's class list as YAML: the order of the names is the class id."""
    lines = [f"path: {root}", "train: images/train", "val: images/val", "test: images/test", "names:"]
    return "\n".join([*lines, *(f"  {i}: {n}" for i, n in enumerate(names))]) + "\n"


def write_class_list(spark: SparkSession, names: list[str], root: str, folder: str) -> None:
    spark.createDataFrame([(class_list(names, root),)], "value string").coalesce(1).write.mode("overwrite").text(folder)
