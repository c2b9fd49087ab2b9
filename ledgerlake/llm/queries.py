"""The operators applied to the given tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontaminate, line_dedup, quality, repair, rlz, secret_scan, simhash
from . import string_kernel, syncmers, toxicity, whitening

QueryFn = Callable[[SparkSession, str], DataFrame]

#: Contract values.
SIMHASH_SHINGLE, SIMHASH_RADIUS = 3, 2
REPEAT_WINDOW = 35
#: A line on more than this share of a host's pages, and on more than one, is boilerplate.
BOILERPLATE_RATIO, BOILERPLATE_PAGES = 0.06, 2


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without their source's boilerplate lines; every row is a page."""
    docs = table(spark, sf_dir, "documents")
    out = line_dedup.drop_boilerplate(docs, F.col("source"), ratio=BOILERPLATE_RATIO, min_pages=BOILERPLATE_PAGES, once_a_text=False)
    return out.select("doc_id", "text", "n_lines", "n_dropped")


def op2_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation rendered once per participant."""
    return chat.perspectives(table(spark, sf_dir, "conversations"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of all documents that hold a benchmark item."""
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_id")


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints and components of all documents."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=SIMHASH_SHINGLE, radius=SIMHASH_RADIUS)
    return found.select("doc_id", "fingerprint", "component_id")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, table(spark, sf_dir, "labels")).drop("text")


def op6_quality_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that importance resampling keeps, with their weights."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    kept = quality.resample(docs, table(spark, sf_dir, "labels"), language=F.col("lang"))
    return kept.select("doc_id", "log_weight", "gumbel_weight")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs)
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op8_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return syncmers.compare_with_next(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE round trip of all documents."""
    out = bpe.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary_path())
    return out.drop("text")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of repeated 35-word windows removed from all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rlz.remove_repeats(docs, window=REPEAT_WINDOW, digest_only=True).drop("spans")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings projected on the leading components, whitened."""
    return whitening.whitening_report(table(spark, sf_dir, "embeddings"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return string_kernel.identify(docs).drop("text", "lang")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every damaged conversation."""
    return repair.repair_report(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, QueryFn] = {f.__name__: f for f in (
    op1_line_dedup, op2_chat_perspectives, op3_decontaminate, op4_simhash_near_dedup, op5_toxicity,
    op6_quality_resample, op7_secrets, op8_syncmers, op9_bpe, op10_substring_dedup, op11_whitening, op12_language_id,
    op13_conversation_repair)}


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": line_dedup.ORACLE_SQL.format(ratio=BOILERPLATE_RATIO),
            "op2_chat_perspectives": chat.ORACLE_SQL, "op7_secrets": secret_scan.ORACLE_SQL}
