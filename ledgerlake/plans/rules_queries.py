"""Named queries for the business rules (FX, ledger matching, classification)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.columns import run_id_of
from ..operators import fx
from ..operators import ledger as L
from ..operators import rules as R
from ..session import scratch_folder
from ..sources import driver
from .model import Model
from .registry import query


# --- FX --------------------------------------------------------------------------

@query("fx_rate_lookup")
def _j4(m: Model) -> DataFrame:
    """Rate into AUD at each invoice date (null when the currency has none)."""
    inv = m.silver_invoice.select("invoiceId", "currency", "invoiceDate")
    out = fx.fx_rate_lookup(inv, m.fx_rates, "currency", "invoiceDate", "rate",
                            known_rate_rows=fx.GENERATED_FX_ROWS)
    return out.withColumn("rate", F.col("rate").cast("double"))


@query("fx_convert")
def _j5(m: Model) -> DataFrame:
    """Invoice totals converted to AUD at the invoice date (half-even, decimal)."""
    inv = m.silver_invoice.select("invoiceId", "currency", "invoiceDate", "totalAmount")
    out = fx.fx_convert(inv, m.fx_rates, "totalAmount", "currency", "invoiceDate",
                        rate_col="rate", out_col="aud_amount", known_rate_rows=fx.GENERATED_FX_ROWS)
    return (out.withColumn("rate", F.col("rate").cast("double"))
            .withColumn("aud_amount", F.col("aud_amount").cast("double")))


@query("fx_convert_unit_price")
def _j5b(m: Model) -> DataFrame:
    """A price of four decimals (a seventh of the total) converted: AUD
    keeps all of them, other currencies are rounded once, after the rate."""
    inv = m.silver_invoice.select("invoiceId", "currency", "dueDate", F.round(F.col("totalAmount") / 7, 4).alias("price"))
    out = fx.fx_convert(inv, m.fx_rates, "price", "currency", "dueDate", rate_col="rate", out_col="aud_price",
                        known_rate_rows=fx.GENERATED_FX_ROWS)
    return out.select("invoiceId", "currency", "price", F.col("aud_price").cast("double").alias("aud_price"))


@query("fx_convert_first_rate")
def _j6(m: Model) -> DataFrame:
    """Browser conversion with the first listed rate, date ignored."""
    inv = m.silver_invoice.select("invoiceId", "currency", "totalAmount")
    return fx.convert_first_rate(inv, fx.generated_rates(m.spark), "totalAmount", "currency",
                                 known_rate_rows=fx.GENERATED_FX_ROWS)


# --- ledger ------------------------------------------------------------------------

@query("ledger_aliases")
def _p22(m: Model) -> DataFrame:
    """Flat (item, alias) table of the ledger."""
    return L.ledger_aliases(m.ledger_items)


@query("ledger_match_category")
def _j7(m: Model) -> DataFrame:
    """Category-scoped first ledger item per line."""
    lookup = L.category_lookup(m.silver_lines, m.ledger_items, m.ledger_categories)
    out = L.match_in_category(m.silver_lines, m.ledger_items, m.ledger_categories, lookup=lookup)
    return out.select("invoiceId", "lineNo", "categoryName", "description", "ledger_category",
                      F.col("ledger_item.ledgerCode").alias("ledgerCode"),
                      F.col("ledger_item.itemName").alias("itemName"))


@query("ledger_match_global")
def _j8(m: Model) -> DataFrame:
    """Best ledger item over all items by description, then vendor."""
    lines, items = m.silver_lines, m.ledger_items
    by_desc = m.fresh("by_description", L.description_lookup(lines, items))
    by_vend = m.fresh("by_vendor", L.vendor_lookup(lines, items, by_desc))
    out = L.match_global(lines, items, by_desc=by_desc, by_vend=by_vend)
    return out.select("invoiceId", "lineNo", "description", "vendorName",
                      F.col("ledger_item.ledgerCode").alias("ledgerCode"),
                      F.col("ledger_item.itemName").alias("itemName"),
                      F.col("ledger_item.match_rank").alias("match_rank"))


@query("classify_lines_aud")
def _a7(m: Model) -> DataFrame:
    """R1-R5 classification on AUD values (match records)."""
    return R.classify_aud(m.matched_global)


@query("classify_lines_category")
def _a8(m: Model) -> DataFrame:
    """Browser classification incl. R6."""
    return R.classify_category(m.matched_in_category)


def _rules_file(m: Model, rows) -> DataFrame:
    """A rules file, written as JSON and read back as one row a rule."""
    fields = ", ".join(f"{c} {t}" for c, t in zip(K.RULE_FIELDS, ("string", "string", "boolean", "double", "double", "double")))
    path = f"{scratch_folder(m.spark)}/rules-{uuid.uuid4().hex}"
    rules = m.spark.createDataFrame([(list(rows),)], f"rules array<struct<{fields.replace(' ', ':').replace(',:', ',')}>>")
    rules.select(F.to_json(F.struct("rules")).alias("value")).write.text(path)
    return L.read_rules_json(m.spark, path)


@query("classify_lines_shipped_rules")
def _a8_shipped(m: Model) -> DataFrame:
    """S8 + A8: classified by the shipped rules file, read as data."""
    return R.classify_category(m.matched_in_category, R.rules_of(_rules_file(m, K.SHIPPED_RULES)))


@query("classify_lines_changed_rules")
def _a8_changed(m: Model) -> DataFrame:
    """S8 + A8: classified by a changed rules file."""
    return R.classify_category(m.matched_in_category, R.rules_of(_rules_file(m, K.CHANGED_RULES)))


@query("classify_aud_changed_rules")
def _a7_changed(m: Model) -> DataFrame:
    """S8 + A7: AUD values classified by a changed rules file."""
    return R.classify_aud(m.matched_global, R.rules_of(_rules_file(m, K.CHANGED_RULES)))


@query("match_outcome_summary")
def _g13(m: Model) -> DataFrame:
    """Per-invoice outcome counts."""
    return R.outcome_summary(m.records_category)


@query("processing_notes")
def _g14(m: Model) -> DataFrame:
    """Processing notes, one row per note line."""
    return R.processing_notes(m.records_category)


@query("exception_queue")
def _u2(m: Model) -> DataFrame:
    """U2 + J11 + F8: exceptions and review items, with the names of the
    invoices' last documents."""
    return R.exception_queue(m.records_aud, m.bronze_header)


@query("posted_lines")
def _u3(m: Model) -> DataFrame:
    """Matched and exception records."""
    return R.posted_lines(m.records_aud)


@query("posted_entries")
def _a9(m: Model) -> DataFrame:
    """Ledger entries for matched records."""
    return R.posted_entries(m.records_aud)


@query("ledger_posting_view")
def _j9(m: Model) -> DataFrame:
    """J9 + J12: ledger items with their posted lines."""
    return L.posting_view(m.ledger_items, R.posted_lines(m.records_aud), L.invoice_currency(m.bronze_header))


@query("expected_price_lookup")
def _j10(m: Model) -> DataFrame:
    """Match records with the ledger's expected unit price."""
    recs = m.records_aud.select("invoiceId", "lineNo", "ledgerCode", "convertedUnitPrice")
    return L.expected_price_lookup(recs, m.ledger_items)


@query("budget_position")
def _g16(m: Model) -> DataFrame:
    """Per-category budget, YTD, remaining and item count."""
    return L.budget_position(m.ledger_categories, m.ledger_items)


# --- agent JSON ---------------------------------------------------------------------

@query("agent_json_extract")
def _p12(m: Model) -> DataFrame:
    """JSON objects cut out of event payload text and parsed, per event type."""
    from ..functions import jsonops as J
    ev = driver.table(m.spark, m.sf_dir, "events").select("event_type", "props")
    parsed = ev.withColumn("j", J.parse_agent_json("props", "struct<k: bigint>"))
    return (parsed.groupBy("event_type")
            .agg(F.count(F.lit(1)).alias("events"),
                 F.count("j.k").alias("parsed"),
                 F.sum("j.k").alias("sum_k")))


def _overlay(m: Model) -> DataFrame:
    from ..functions import jsonops as J
    ingestion, result, updates = driver.result_updates(m.bronze_email)
    base = ingestion.withColumn("file", F.lit("ingestion.json")).unionByName(result.withColumn("file", F.lit("result.json")))
    return J.result_overlay(base, updates, "run_id", "file", ["step"], "text")


@query("result_overlay")
def _p16(m: Model) -> DataFrame:
    """Per run, the nodes of its result document after the updates."""
    return _overlay(m)


@query("result_document")
def _p16_document(m: Model) -> DataFrame:
    """The rebuilt result.json of each run (by length and MD5)."""
    from ..functions import jsonops as J
    out = J.overlay_documents(_overlay(m), "run_id")
    return out.select("run_id", F.length("document").cast("long").alias("chars"), F.md5("document").alias("document_md5"))


@query("event_overlay")
def _p16_events(m: Model) -> DataFrame:
    """Per run, the latest value of every top-level node of its events' JSON."""
    from ..functions import jsonops as J
    ev = driver.table(m.spark, m.sf_dir, "events").select("event_id", "ts", "user_id", "props")
    return J.overlay_nodes(ev.withColumn("run_id", run_id_of("ts", "user_id")), "run_id", ["ts", "event_id"], "props")
