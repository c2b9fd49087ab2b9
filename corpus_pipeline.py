"""Corpus pipeline: raw documents to token ids.

Five stages, each calling one operator of ``ledgerlake.llm``; every stage is
written as Parquet in the shared checkpoint folder and read back as the next
one's input, so a lost executor costs at most the stage that is running.

1. ``quality``: documents that importance resampling rejects go.
2. ``line_dedup``: boilerplate lines of a source are dropped from its texts.
3. ``near_dedup``: of each SimHash component one document stays.
4. ``decontaminate``: documents that hold a benchmark item go.
5. ``tokenize``: texts become token ids, with digests of the round trip.

All but the last return the columns of ``documents``.  Rows that a stage keeps
are never altered otherwise; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import bpe, decontaminate, line_dedup, quality, simhash
from ledgerlake.llm import queries as settings
from ledgerlake.llm.common import written

#: Importance resampling, learned models and Hamming search have no SQL form;
#: tests/llm/test_pipeline.py holds run() against a plain version.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = quality.resample(docs, settings.table(spark, sf_dir, "labels"), language=F.col("lang"))
    return kept.select(*docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = line_dedup.drop_boilerplate(docs, F.col("source"), ratio=settings.BOILERPLATE_RATIO,
                                      min_pages=settings.BOILERPLATE_PAGES)
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    whole = F.when(F.col("n_dropped") > 0, length).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", whole).select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle=settings.SIMHASH_SHINGLE, radius=settings.SIMHASH_RADIUS)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, settings.table(spark, sf_dir, "benchmark")).select(*docs.columns)


def tokenize_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs.select("doc_id", "text"), settings.vocabulary_path(), ids=True).drop("text")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("tokenize", tokenize_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = settings.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {}
