"""Evidence packages of any shape, shortened for a prompt: lists are cut to a length and
records to the keys that are read. Each package is a column of its row; a key is read by
its path, so that nothing else of a record is built."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .media import first_middle_last
from .variants import is_array, is_object

#: Keys of records that stay, and the lengths of lists.
STORYBOARD_KEYS = ("slot", "id", "frame_id", "time", "phase", "role", "purpose", "source", "track_id", "linked_actor_ids", "why_selected", "precomputed_hints")
IMAGE_KEYS = ("id", "time", "frame_index", "purpose", "source", "frame_id", "track_id", "type", "confidence", "importance_score", "rank_reason")
TRACK_KEYS = ("track_id", "type", "confidence", "movement_candidate", "relative_position_start", "relative_position_end", "tracking_method", "source_stage")
IMAGES = {"frames": 20, "overlays": 8, "crops": 8, "evidence_images": 20}
STORYBOARD, SEGMENTS, TRACKS = 24, 8, 8
FACTS = ("metadata", "input_quality", "ocr_summary", "tracker_comparison", "road_geometry", "traffic_control", "evidence_summary")
FACT_LISTS = {"preprocessing_uncertainties": 20, "scene_type_candidates": 5, "event_candidates": 12}


def value(record: Column, key: str) -> Column:
    """A key's value; null if it is absent or null."""
    found = F.try_variant_get(record, f"$.{key}", "variant")
    return F.when(~F.is_variant_null(found), found)


def listed(record: Column, key: str, most: int) -> Column:
    """The first ``most`` elements of a list; none if it is not a list."""
    found = value(record, key)
    items = F.when(is_array(found), F.try_variant_get(found, "$", "array<variant>"))
    return F.slice(F.coalesce(items, F.expr("CAST(array() AS array<variant>)")), 1, most)


def kept(record: Column, keys: tuple[str, ...]) -> list[Column]:
    return [value(record, k).alias(k) for k in keys]


def records(items: Column, keys: tuple[str, ...]) -> Column:
    """The objects among elements, with some keys only; the others are left out."""
    return F.transform(F.filter(items, is_object), lambda r: F.struct(*kept(r, keys)))


def track(record: Column) -> Column:
    """A track with its first, middle and last positions; of what is no object nothing stays."""
    positions = F.try_variant_get(F.when(is_array(value(record, "positions")), value(record, "positions")), "$", "array<variant>")
    return F.struct(*kept(record, TRACK_KEYS), F.when(F.size(positions) > 0, first_middle_last(positions)).alias("positions"))


def compact(package: Column) -> Column:
    """A package (VARIANT) as the JSON text of its short form. What is absent is an empty
    list, or an empty object among the facts; a null value of a record is left out."""
    facts = F.try_variant_get(package, "$.precomputed_facts", "variant")
    none = F.parse_json(F.lit("{}"))
    whole = [F.coalesce(F.try_variant_get(facts, f"$.{k}", "variant"), none).alias(k) for k in (*FACTS, "speed_estimates")]
    lists = [listed(facts, k, n).alias(k) for k, n in FACT_LISTS.items()]
    images = [records(listed(package, k, n), IMAGE_KEYS).alias(k) for k, n in IMAGES.items()]
    return F.to_json(
        F.struct(
            records(listed(package, "vlm_storyboard", STORYBOARD), STORYBOARD_KEYS).alias("vlm_storyboard"),
            *images,
            listed(package, "selected_segments", SEGMENTS).alias("selected_segments"),
            F.struct(*whole, *lists, F.transform(listed(facts, "tracks", TRACKS), track).alias("tracks")).alias("precomputed_facts"),
        )
    )
