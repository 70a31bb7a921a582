"""Records of any shape as VARIANT: walking them, merging them, and their messages."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys that name an image's file, in a record's order, and the keys of a
#: message's text, the first that says something.
PATHS = ("path", "mask_path", "image_path")
MESSAGE_KEYS = ("description", "message", "reason", "note", "value")


def is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def is_array(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("ARRAY"), F.lit(False))


def is_text(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v) == "STRING", F.lit(False))


def depth_of(text: Column) -> Column:
    """How deep objects and arrays of a JSON text are nested; 0 for a plain value. What
    stands in strings doesn't count."""
    bare = F.regexp_replace(F.regexp_replace(text, r'"(?:[^"\\]|\\.)*+"', ""), r"[^\[\]{}]", "")
    steps = F.transform(F.filter(F.split(bare, ""), lambda c: c != ""), lambda c: F.when(c.isin("[", "{"), 1).otherwise(-1))
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))
    return F.aggregate(steps, start, lambda a, s: F.struct((a["now"] + s).alias("now"), F.greatest(a["most"], a["now"] + s).alias("most")), lambda a: a["most"])


def walked(df: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """A row for every value at any depth of a JSON text: the keys, ``path`` (object keys
    and array positions from the root), ``depth``, ``key`` (null in arrays) and ``value``
    as variant. As many lateral explodes as the deepest text needs, in one plan."""
    deepest = df.agg(F.max(depth_of(F.col(text)))).first()[0] or 0
    spark = df.sparkSession
    none = F.expr("CAST(array() AS array<string>)")
    level = df.select(*keys, none.alias("path"), F.lit(None).cast("string").alias("key"), F.try_parse_json(text).alias("value")).where("value IS NOT NULL")
    out = level.withColumn("depth", F.lit(0))
    for d in range(1, deepest + 1):
        inner = level.where(is_object(F.col("value")) | is_array(F.col("value"))).withColumnsRenamed({"value": "_v", "key": "_k", "path": "_p"})
        step = inner.lateralJoin(spark.tvf.variant_explode(F.col("_v").outer()))
        level = step.select(*keys, F.concat("_p", F.array(F.coalesce("key", F.col("pos").cast("string")))).alias("path"), "key", "value")
        out = out.union(level.withColumn("depth", F.lit(d)))
    return out


def leaves(df: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """Those rows of ``walked`` that hold no others, without ``depth``, in one pass over the
    texts: each step puts the values of an object or array in its place and leaves the rest
    as it is. No row is walked to from the root once more for every level."""
    deepest = df.agg(F.max(depth_of(F.col(text)))).first()[0] or 0
    spark = df.sparkSession
    level = df.select(*keys, F.expr("CAST(array() AS array<string>)").alias("path"), F.lit(None).cast("string").alias("key"), F.try_parse_json(text).alias("value")).where("value IS NOT NULL")
    for _ in range(deepest):
        step = level.withColumnsRenamed({"value": "_v", "key": "_k", "path": "_p"}).lateralJoin(spark.tvf.variant_explode_outer(F.col("_v").outer()))
        inner = lambda a, b: F.when(F.col("pos").isNotNull(), a).otherwise(b)
        path = F.concat("_p", F.array(F.coalesce("key", F.col("pos").cast("string"))))
        level = step.select(*keys, inner(path, F.col("_p")).alias("path"), inner(F.col("key"), F.col("_k")).alias("key"), inner(F.col("value"), F.col("_v")).alias("value"))
    return level


def file_paths(df: DataFrame, keys: Sequence[str], text: str, names: Sequence[str] = PATHS) -> DataFrame:
    """Each file that a record names at any depth, once, where it stands first: parents
    before what they hold, array items in order, keys by name. (keys, file, path)"""
    found = leaves(df, keys, text).where(F.col("key").isin(*names) & is_text(F.col("value")))
    found = found.select(*keys, "path", "key", F.variant_get("value", "$", "string").alias("file")).where("file <> ''")
    rank = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("key"))
    # names are kept from the cast, which fails by an exception for each
    # an object's own files come before those of what it holds, in the order of the names
    place = F.transform("path", lambda p, i: F.struct((i < F.size("path") - 1).alias("deep"), F.when(i == F.size("path") - 1, rank).otherwise(0).alias("rank"), F.coalesce(F.when(F.rlike(p, F.lit(r"^\s*[+-]?\d+\s*$")), p.try_cast("int")), F.lit(0)).alias("pos"), p.alias("key")))
    # the places' keys are the path; min_by would make each place several times
    return found.groupBy(*keys, "file").agg(F.min(place).alias("_place")).select(*keys, "file", F.transform("_place", lambda p: p["key"]).alias("path"))


def merged(base: Column, over: Column, depth: int) -> Column:
    """``over`` merged into ``base``, both variants: objects key by key down to ``depth``
    levels, and anything else, arrays included, replaced. Null is what is absent; the JSON
    value null replaces. ``depth`` is that of the shallower of both or more."""
    if depth <= 0:
        return F.coalesce(over, base)
    both = F.map_zip_with(base.try_cast("map<string,variant>"), over.try_cast("map<string,variant>"), lambda _, a, b: F.when(b.isNull(), a).otherwise(merged(a, b, depth - 1)))
    return F.when(is_object(base) & is_object(over), F.call_function("to_variant_object", both)).otherwise(F.coalesce(over, base))


def depth_of_value(value: object) -> int:
    inner = value.values() if isinstance(value, dict) else value if isinstance(value, list) else None
    return 0 if inner is None else 1 + max(map(depth_of_value, inner), default=0)


def with_defaults(payload: Column, defaults: dict) -> Column:
    """A payload with what it lacks of ``defaults``, at any depth; the defaults where it
    is no object."""
    base = F.parse_json(F.lit(json.dumps(defaults, ensure_ascii=False)))
    return F.when(is_object(payload), merged(base, payload, depth_of_value(defaults))).otherwise(base)


def spaced(text: Column) -> Column:
    """Compact JSON with a space behind each comma and colon outside strings."""
    parts = F.regexp_extract_all(text, F.lit(r'("(?:[^"\\]|\\.)*+"|[^",:]++|[,:])'), F.lit(1))
    return F.array_join(F.transform(parts, lambda p: F.when(p.isin(",", ":"), F.concat(p, F.lit(" "))).otherwise(p)), "")


def message(v: Column) -> Column:
    """One uncertainty as text: a text trimmed; of an object the first of its texts that
    isn't blank, with its sources if it lists any, else all of it as JSON; anything else
    as JSON."""
    held = v.try_cast("map<string,variant>")
    said = F.coalesce(*[F.when(is_text(held[k]), F.nullif(F.trim(F.try_variant_get(held[k], "$", "string")), F.lit(""))) for k in MESSAGE_KEYS])
    source = F.when(is_array(held["source"]), held["source"].try_cast("array<variant>"))
    plain = lambda x: F.when(is_text(x), F.try_variant_get(x, "$", "string")).otherwise(spaced(F.to_json(x)))
    sources = F.when(F.size(source) > 0, F.concat(F.lit(" (source: "), F.array_join(F.transform(source, plain), ", "), F.lit(")"))).otherwise("")
    whole = spaced(F.to_json(v))
    return F.when(is_text(v), F.trim(F.try_variant_get(v, "$", "string"))).when(is_object(v), F.coalesce(F.concat(said, F.coalesce(sources, F.lit(""))), whole)).otherwise(whole)


def messages(v: Column) -> Column:
    """Uncertainties as an array of distinct texts, in order: none for null, one for what
    is no array, without blank ones."""
    items = F.when(is_array(v), v.try_cast("array<variant>")).otherwise(F.array(v))
    null = v.isNull() | (F.schema_of_variant(v) == "VOID")
    return F.when(F.coalesce(null, F.lit(True)), F.expr("CAST(array() AS array<string>)")).otherwise(F.array_distinct(F.filter(F.transform(items, message), lambda m: m != "")))
