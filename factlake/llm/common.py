"""What the operators of this subpackage share: scratch tables, shipping, words."""

from __future__ import annotations

import ctypes
import os
import sys
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = Path(__file__).resolve().parents[2]

#: Texts are worked on in groups of about this many bytes, so that a Python
#: worker's memory follows this figure and the longest text, not the batch.
GROUP_BYTES = 1 << 20


def scratch(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, which all machines share.

    Only where the setting is absent and the session runs in one process (tests) a
    folder of this machine is used. The folder goes when the session ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not (spark.sparkContext.master + "[").startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that all machines share")
        base = "file:///tmp/checkpoints"
    path = f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop)
    fs.deleteOnExit(hadoop)
    return path


def drop(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder whose tables are no longer read."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(hadoop, True)


def written(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back: lineage ends here, and a lost
    executor costs a re-read, never a second computation of what came before."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Make the package importable on the workers if the environment does not."""
    paths = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if str(ROOT) in paths or os.getcwd() == str(ROOT):
        return
    sc = spark.sparkContext
    if getattr(sc, "_factlake_shipped", False):
        return
    target = os.path.join(tempfile.mkdtemp(), "factlake.zip")
    with zipfile.ZipFile(target, "w") as z:
        for p in (ROOT / "factlake").rglob("*.py"):
            z.write(p, p.relative_to(ROOT))
    sc.addPyFile(target)
    sc._factlake_shipped = True


def spread_join(left: DataFrame, right: DataFrame, on: list[str], by: str, how: str, parts: int = 16) -> DataFrame:
    """``left`` with the one row of the far smaller ``right`` that has its key. One
    key may stand in a third of the left rows, so these are dealt to ``parts`` parts
    by a hash of ``by``, and the right row goes to each."""
    copies = right.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return left.withColumn("_part", F.pmod(F.xxhash64(by), F.lit(parts)).cast("int")).join(copies, [*on, "_part"], how).drop("_part")


_working: list = ["", None]


def working(name: str, release: Callable[[], None] | None = None) -> None:
    """An operator's function starts in this Python worker, which runs one operator
    after another: what another one kept is released and its memory given back."""
    if _working[0] == name:
        return
    if _working[1]:
        _working[1]()
    if Generations.in_use:
        Generations.in_use.clear()
        Generations.in_use = None
    _working[:] = [name, release]
    pa.set_memory_pool(pa.system_memory_pool())  # its memory can be given back
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library keeps or returns memory by itself
        pass


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % parts


def blobs(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The UTF-8 bytes of a string column; null becomes empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def groups(texts: list[bytes], limit: int = GROUP_BYTES):
    """Consecutive runs of texts of about ``limit`` bytes: (from, to)."""
    return runs(list(map(len, texts)), limit)


def runs(sizes: list[int], limit: int = GROUP_BYTES):
    """Consecutive runs whose sizes sum up to about ``limit``: (from, to)."""
    start = total = 0
    for i, n in enumerate(sizes):
        total += n
        if total >= limit:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


class Generations:
    """A bounded memo: when the young half is full, the old half is forgotten.

    It holds at most 2 * ``size`` entries and only ever saves work; what it
    returns does not depend on what it remembers. A worker runs one operator
    after another: the memo in use is the only one that keeps anything.
    """

    in_use: Generations | None = None

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def clear(self) -> None:
        self.young, self.old = {}, {}

    def use(self) -> None:
        if Generations.in_use is not self:
            if Generations.in_use:
                Generations.in_use.clear()
            Generations.in_use = self

    def missing(self, keys) -> list:
        """Those of the distinct ``keys`` not known; known old ones get young."""
        self.use()
        young, old, out = self.young, self.old, []
        for k in keys - young.keys():
            v = old.get(k)
            if v is None:
                out.append(k)
            else:
                young[k] = v
        return out

    def learn(self, pairs) -> None:
        self.young.update(pairs)

    def age(self) -> None:
        """Call between groups, never between ``missing`` and a look-up."""
        if len(self.young) > self.size:
            self.old, self.young = self.young, {}


def mix(h: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64 over unsigned integers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


