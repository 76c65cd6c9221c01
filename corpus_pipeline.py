"""A training corpus from raw documents: five stages, each over all that the one before has kept.

quality    documents that the quality rules reject go, with the boilerplate lines of the others
line_runs  later copies of long line runs are deleted; documents that lose every line go
near       one document of each group of near duplicates (five words, similarity 0.8) stays
benchmark  documents that hold a test item go
packing    the rest is packed into sequences of 1024 tokens: one row per piece

Every stage but the last returns the columns of ``documents``. Stages are written as Parquet to the shared
scratch folder and read again, so each can be repeated by itself. The operators say what they do with
nulls, empty texts, ties and repeated rows; an empty table gives no rows. Packing needs a tokenizer, which
SQL does not have, so there is no SQL for the whole: ``ORACLE_SQL`` is None.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from viewmart.llm import fragment_join, level_packing, line_runs, quality_lines, wand_decontamination
from viewmart.llm.common import materialised, table, tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_lines.filtered(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_runs.deduplicated(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return fragment_join.one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return wand_decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return level_packing.packed(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("line_runs", line_dedup),
    ("near", near_duplicates),
    ("benchmark", benchmark),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialised(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
