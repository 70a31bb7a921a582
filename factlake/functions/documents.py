"""Arrow functions over free-form JSON and images, where structure is not fixed."""

from __future__ import annotations

import ast
import json
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that a status may be given in, and the status meant.
STATUS = {"confirmed": "observed", "detected": "observed", "visible": "observed", "observed": "observed", "computed": "computed", "estimated": "computed", "inferred": "inferred", "unknown": "unknown", "확인불가": "unknown"}


def _visit(x: Any) -> Any:
    """Fields named status, at any depth, in the words that are meant; other values
    and unlisted words stay."""
    if isinstance(x, dict):
        out = {k: _visit(v) for k, v in x.items()}
        if isinstance(out.get("status"), str):
            out["status"] = STATUS.get(out["status"].strip().lower(), out["status"])
        return out
    return [_visit(v) for v in x] if isinstance(x, list) else x


def guard(text: str | None) -> str | None:
    """The outermost object of a reply, with status words unified at any depth;
    null where there is none. JSON first, then a Python literal."""
    if not text or "{" not in text or "}" not in text:
        return None
    body = text[text.index("{") : text.rindex("}") + 1]
    for read in (json.loads, ast.literal_eval):
        try:
            found = read(body)
        except (ValueError, SyntaxError, MemoryError, RecursionError):
            continue
        return json.dumps(_visit(found), ensure_ascii=False, sort_keys=True) if isinstance(found, dict) else None
    return None


def _guard(text: pa.Array) -> pa.Array:
    return pa.array([guard(x) for x in text.to_pylist()], pa.string())


def json_guard(text: Column) -> Column:
    return F.arrow_udf(_guard, "string")(text)


def grey_metrics(grey: np.ndarray) -> tuple[float, float, float]:
    """Mean, variance of the Laplacian, and p95 - p5 by nearest rank."""
    g = grey.astype(np.float64)
    lap = g[:-2, 1:-1] + g[2:, 1:-1] + g[1:-1, :-2] + g[1:-1, 2:] - 4 * g[1:-1, 1:-1]
    flat = np.sort(grey, axis=None)
    rank = lambda p: float(flat[max(0, -(-len(flat) * p // 100) - 1)])
    return float(g.mean()), float(lap.var()) if lap.size else 0.0, rank(95) - rank(5)


def _metrics(pixels: pa.Array, width: pa.Array) -> pa.Array:
    rows = []
    for p, w in zip(pixels.to_pylist(), width.to_pylist(), strict=True):
        a = np.frombuffer(p or b"", np.uint8)
        n = len(a) // w * w if w else 0
        rows.append(grey_metrics(a[:n].reshape(-1, w)) if n else (0.0, 0.0, 0.0))
    cols = list(zip(*rows, strict=True)) or [(), (), ()]
    return pa.StructArray.from_arrays([pa.array(c, pa.float64()) for c in cols], ["brightness", "sharpness", "contrast"])


def image_metrics(pixels: Column, width: Column) -> Column:
    """Metrics of a grey image given as its bytes, row by row."""
    return F.arrow_udf(_metrics, "brightness double, sharpness double, contrast double")(pixels, width)
