"""The medallion run: bronze -> silver -> gold, and observability beside silver.

Each layer is written as tables and the next layer reads the written
tables back, so lineage is cut at every layer boundary (a lost executor
re-reads files instead of recomputing the pipeline), exactly like the
four notebooks hand over by saved table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import gold, obs, silver
from ..sources import driver, runs, tables
from .payload_queries import run_results

LAYERS = ("bronze", "silver", "gold", "obs")


def _write_all(spark: SparkSession, layer: str, frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    tables.create_schema(spark, layer)
    out = {}
    for name, df in frames.items():
        full = f"{layer}.{name}"
        tables.write_table(df, full)
        out[name] = tables.read_table(spark, full)
    return out


def bronze_from_driver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    email = driver.bronze_email(spark, sf_dir)
    return {
        "bronze_invoice_header": driver.bronze_header(spark, sf_dir),
        "bronze_invoice_lineitem": driver.bronze_lines(spark, sf_dir),
        "bronze_ingestion_email": email,
        "bronze_run_result": run_results(email),
        "bronze_run_manifest": driver.bronze_manifest(spark, sf_dir),
    }


def run_pipeline(spark: SparkSession, bronze_frames: dict[str, DataFrame]) -> dict[str, dict[str, DataFrame]]:
    """Write all four layers; returns the tables read back per layer."""
    bronze = _write_all(spark, "bronze", bronze_frames)
    header, lines = bronze["bronze_invoice_header"], bronze["bronze_invoice_lineitem"]
    # the headers are deduplicated once: lines and issues read the written ones
    sil = _write_all(spark, "silver", {"silver_invoice": silver.latest_headers(header)})
    latest = sil["silver_invoice"]
    sil |= _write_all(spark, "silver", {
        "silver_invoice_lineitem": silver.latest_lines(lines, latest),
        "silver_dq_issues": silver.dq_issues(silver.checked_from_lines(latest, lines))})
    ob = _write_all(spark, "obs", obs.obs(bronze["bronze_run_manifest"], bronze["bronze_invoice_header"]))
    gld = _write_all(spark, "gold", gold.gold(sil["silver_invoice"], sil["silver_invoice_lineitem"]))
    return {"bronze": bronze, "silver": sil, "gold": gld, "obs": ob}


def run_from_folders(spark: SparkSession, root: str) -> dict[str, dict[str, DataFrame]]:
    """The notebooks' run over a folder of ``run-*`` directories."""
    return run_pipeline(spark, runs.bronze_from_runs(spark, root))


def run_from_driver(spark: SparkSession, sf_dir: str) -> dict[str, dict[str, DataFrame]]:
    """The same run over the benchmark tables."""
    return run_pipeline(spark, bronze_from_driver(spark, sf_dir))
