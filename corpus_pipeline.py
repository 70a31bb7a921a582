"""A corpus from documents to training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's ``docs``. All but the last return
the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factlake.llm import common, decontaminate, neardup, packing, quality, secrets
from factlake.llm.queries import tokenizer


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the compression bands reject go."""
    return quality.kept_only(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, 0.8) the document
    with the least id stays, once."""
    return neardup.first_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, perhaps re-parameterised, go."""
    return decontaminate.clean_only(docs, common.table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the text are replaced by a mark; ``n_chars`` follows the text."""
    out = secrets.redacted(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces placed in sequences of at most 2048 tokens."""
    return packing.pack(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can't express compression ratios, sketches or tokenizers; tests hold the
#: stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; each stage's result is written to the shared folder."""
    docs = common.table(spark, sf_dir, "documents")
    folder = common.scratch(spark)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = common.written(docs, f"{folder}/{i}_{name}")
    return docs
