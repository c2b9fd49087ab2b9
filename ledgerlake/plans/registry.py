"""Named queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the driver tables through :class:`Model` and returns the
table the matching operator produces.  Columns that hold the wall clock
(``ingested_at``, ``detected_at``) are left out, so results are
reproducible and comparable with the DuckDB oracle.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import gold, obs, reports, silver
from ..session import scratch_folder
from ..sources import driver, runs, tables
from .model import Model

QueryFn = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: Callable[[Model], DataFrame]) -> Callable[[Model], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Model(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        _REGISTRY[name] = run
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    from . import payload_queries, rules_queries  # noqa: F401  (register their queries)
    return dict(_REGISTRY)


# --- bronze ------------------------------------------------------------------

@query("bronze_invoice_header")
def _bronze_header(m: Model) -> DataFrame:
    """Invoice headers with lineage (run_id, source_path)."""
    return m.bronze_header_fresh.drop("ingested_at")


@query("bronze_invoice_lineitem")
def _bronze_lines(m: Model) -> DataFrame:
    """One row per line item, numeric columns as double."""
    return m.bronze_lines_fresh.drop("ingested_at")


@query("bronze_run_manifest")
def _bronze_manifest(m: Model) -> DataFrame:
    """File inventory per run, ms -> timestamp."""
    return m.bronze_manifest_fresh


@query("bronze_ingestion_email")
def _bronze_email(m: Model) -> DataFrame:
    """Flattened ingestion email with status and reason."""
    return m.bronze_email_fresh.drop("ingested_at")


# --- silver ------------------------------------------------------------------

@query("silver_invoice")
def _silver_invoice(m: Model) -> DataFrame:
    """W1 + F1: latest header per invoiceId."""
    return m.silver_invoice_fresh.drop("ingested_at")


@query("silver_invoice_lineitem")
def _silver_lines(m: Model) -> DataFrame:
    """J1 + F2: lines of the kept run."""
    return m.silver_lines_fresh.drop("ingested_at")


@query("invoice_line_sums")
def _line_sums(m: Model) -> DataFrame:
    """Per-invoice line sums."""
    return silver.line_sums(m.silver_lines_fresh)


@query("checked_invoice")
def _checked(m: Model) -> DataFrame:
    """J2 + A1: headers with line sums and reconciliation / FX check columns."""
    return m.checked.select("invoiceId", "vendorName", "totalAmount", "exchangeRate",
                            "convertedInvoiceAmount", "sum_lineTotal", "sum_convertedLineTotal",
                            "reconcile_diff", "fx_expected", "fx_diff_pct")


@query("silver_dq_issues")
def _dq(m: Model) -> DataFrame:
    """U1 + A2-A6: one row per failed data-quality check."""
    return silver.dq_issues(m.checked, with_timestamp=False)


@query("vendor_summary")
def _vendor_summary(m: Model) -> DataFrame:
    """The notebook's SQL summary per vendor."""
    return silver.vendor_summary(m.spark, m.silver_invoice)


@query("table_row_counts")
def _row_counts(m: Model) -> DataFrame:
    """Rows per bronze table (all five) and before / after dedup."""
    from . import payload_queries
    return silver.table_counts({
        "bronze_invoice_header": m.bronze_header,
        "bronze_invoice_lineitem": m.bronze_lines,
        "bronze_ingestion_email": m.bronze_email,
        "bronze_run_manifest": m.bronze_manifest,
        "bronze_run_result": payload_queries.run_results(m.bronze_email),
        "silver_invoice": m.silver_invoice_fresh,
        "silver_invoice_lineitem": m.silver_lines_fresh,
    })


# --- gold --------------------------------------------------------------------

@query("spend_by_vendor_month")
def _g1(m: Model) -> DataFrame:
    """G1."""
    return gold.spend_by_vendor_month(m.silver_invoice)


@query("spend_by_category")
def _g2(m: Model) -> DataFrame:
    """G2 + W2."""
    return gold.spend_by_category(m.silver_lines)


@query("unit_price_stats")
def _g3a(m: Model) -> DataFrame:
    """G3 (per-category statistics)."""
    return gold.unit_price_stats(m.silver_lines)


@query("unit_price_benchmark")
def _g3(m: Model) -> DataFrame:
    """G3 + J3 + F5."""
    return gold.unit_price_benchmark(m.silver_lines, m.category_medians)


@query("payment_calendar")
def _g4(m: Model) -> DataFrame:
    """G4 + P8."""
    return gold.payment_calendar(m.silver_invoice)


@query("fx_sensitivity")
def _g5(m: Model) -> DataFrame:
    """G5 + F4."""
    return gold.fx_sensitivity(m.silver_invoice)


@query("line_measures_by_category")
def _g17a(m: Model) -> DataFrame:
    """Default sum measures of silver lines by category."""
    return gold.default_measures(m.silver_lines, ["categoryName"])


@query("latency_measures_by_day")
def _g17b(m: Model) -> DataFrame:
    """Default sum measures of stage latency by run day."""
    lat = obs.stage_latency(m.bronze_manifest).withColumn("run_day", F.substring("run_id", 5, 8))
    return gold.default_measures(lat, ["run_day"], gold.LATENCY_MEASURES)


@query("line_measures_by_level")
def _g17c(m: Model) -> DataFrame:
    """The line measures by vendor and category, by each of them and in all, in one pass."""
    return gold.measures_by_levels(m.silver_lines, ["vendorName", "categoryName"],
                                   [["vendorName", "categoryName"], ["vendorName"], ["categoryName"], []])


@query("unit_price_medians_by_day")
def _g3_sketches(m: Model) -> DataFrame:
    """G3 from the saved sketches of each day: how many prices, and whether the
    median's rank is within one percent of the half."""
    sketches = m.fresh("price-sketches", gold.price_sketches(m.silver_lines))
    medians = gold.medians_of_sketches(sketches)
    named = F.col("l.categoryName").eqNullSafe(F.col("s.categoryName"))
    ranks = (m.silver_lines.where("convertedUnitPrice is not null").alias("l").join(F.broadcast(medians).alias("s"), named)
             .groupBy("s.categoryName", "prices")
             .agg(F.avg((F.col("convertedUnitPrice") < F.col("median_unit_price_aud")).cast("int")).alias("below"),
                  F.avg((F.col("convertedUnitPrice") <= F.col("median_unit_price_aud")).cast("int")).alias("up_to")))
    return ranks.select("categoryName", "prices", ((F.col("below") <= 0.51) & (F.col("up_to") >= 0.49)).alias("within_error"))


# --- reports (O1, O2) -----------------------------------------------------------

def _ranked(m: Model, report: str, df: DataFrame) -> DataFrame:
    name = f"saved_{uuid.uuid4().hex}"
    tables.create_schema(m.spark, name, f"{scratch_folder(m.spark)}/{name}")
    reports.save_sorted(df, f"{name}.{report}", reports.REPORT_ORDER[report])
    return reports.read_ranked(m.spark, f"{name}.{report}", reports.REPORT_ORDER[report])


@query("spend_report")
def _o1_spend(m: Model) -> DataFrame:
    """O1: spend by vendor and month, saved in its reading order, each row with its place."""
    return _ranked(m, "gold_spend_by_vendor_month", gold.spend_by_vendor_month(m.silver_invoice))


@query("price_report")
def _o1_prices(m: Model) -> DataFrame:
    """O1: all lines by how far their price is off the median, the farthest first."""
    return _ranked(m, "gold_unit_price_benchmark", gold.unit_price_benchmark(m.silver_lines, m.category_medians))


@query("header_preview")
def _o2_headers(m: Model) -> DataFrame:
    """O2: the first 20 invoice headers."""
    return reports.preview(m.bronze_header.drop("ingested_at"), (("run_id", True), ("fileName", True)), 20)


@query("manifest_preview")
def _o2_manifest(m: Model) -> DataFrame:
    """O2: the first 50 files by run and time."""
    return reports.preview(m.bronze_manifest, reports.REPORT_ORDER["bronze_run_manifest"], 50)


# --- observability -------------------------------------------------------------

@query("stage_timestamps")
def _g8(m: Model) -> DataFrame:
    """G8 + P6 + F6."""
    return obs.stage_timestamps(m.bronze_manifest)


@query("stage_latency")
def _g9(m: Model) -> DataFrame:
    """G9 + P9."""
    return obs.stage_latency(m.bronze_manifest)


@query("extraction_quality")
def _g10(m: Model) -> DataFrame:
    """G10."""
    return obs.extraction_quality(m.bronze_header)


@query("duplicate_runs")
def _g11(m: Model) -> DataFrame:
    """G11 + F7 (long form)."""
    return obs.duplicate_runs(m.bronze_header)


@query("runs_by_stage")
def _g11_bitmaps(m: Model) -> DataFrame:
    """G11 from saved bitmaps: distinct runs by stage and week, merged from those of each day;
    the days after a month's 20th come later than the others and are added to them."""
    day = driver.run_date(F.col("run_id"))
    rows = obs.with_stage(m.bronze_manifest).select("run_id", "stage", day.alias("day"))
    first = F.coalesce(F.day("day") <= 20, F.lit(True))
    name = f"saved_{uuid.uuid4().hex}"
    tables.create_schema(m.spark, name, f"{scratch_folder(m.spark)}/{name}")
    known = obs.number_runs(m.spark, rows.where(first), f"{name}.first_runs")
    numbers = obs.number_runs(m.spark, rows.where(~first), f"{name}.later_runs", known)
    days = [m.fresh("run-bitmaps", obs.run_bitmaps(rows.where(part), numbers, ["stage", "day"])) for part in (first, ~first)]
    saved = days[0].unionByName(days[1]).withColumn("week", F.date_trunc("week", "day").cast("date"))
    return obs.runs_of_bitmaps(saved, ["stage", "week"])


@query("ingestion_status_summary")
def _g12(m: Model) -> DataFrame:
    """G12."""
    return obs.ingestion_status_summary(m.bronze_email)


@query("email_decisions")
def _a12(m: Model) -> DataFrame:
    """A12."""
    return obs.email_decisions(m.bronze_email)


# --- run folders over the manifest (S1, S9, S10) and invoice arithmetic (P20) ---------

@query("discover_runs")
def _s1(m: Model) -> DataFrame:
    """Run folders that hold at least one file."""
    return runs.runs_of(m.bronze_manifest)


@query("run_list")
def _s9(m: Model) -> DataFrame:
    """The 20 newest runs (name descending) -- the limit is the feature."""
    return runs.latest_runs(m.bronze_manifest)


@query("supported_documents")
def _s10(m: Model) -> DataFrame:
    """Manifest files the pipeline accepts as documents."""
    return runs.supported_documents(m.bronze_manifest).select("run_id", "file_name", "size_bytes")


def _coded_lines(m: Model) -> DataFrame:
    """lineitem as (invoice, line_no, quantity, unit_price, tax_rate)."""
    return driver.table(m.spark, m.sf_dir, "lineitem").select(
        F.concat(F.lit("INV-"), F.col("l_orderkey").cast("string")).alias("invoice"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_quantity").alias("quantity"),
        F.round(F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")), 2).alias("unit_price"),
        F.col("l_tax").alias("tax_rate"))


@query("invoice_arithmetic")
def _p20(m: Model) -> DataFrame:
    """P20: subtotal, tax on it and total per order; the order's one rate is
    the highest of its lines'."""
    out = obs.invoice_arithmetic(_coded_lines(m))
    return out.select("invoice", "lines", *[F.col(c).cast("double").alias(c) for c in ("subtotal", "tax", "grand_total")])


@query("invoice_line_tax")
def _p20_lines(m: Model) -> DataFrame:
    """P20: amount and tax of each line."""
    out = obs.line_amounts(_coded_lines(m))
    return out.select("invoice", "line_no", "tax_rate", F.col("amount").cast("double").alias("amount"),
                      F.col("line_tax").cast("double").alias("line_tax"))
