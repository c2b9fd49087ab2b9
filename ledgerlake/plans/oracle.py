"""DuckDB oracle SQL for every named query that SQL can express.

The same driver-table mapping as ``sources.driver`` is written once as
common table expressions; each query appends its own SELECT.  Spark's
``round`` on a double rounds HALF_UP on the number's decimal text, so the
oracle does the same (``_r``): double -> text -> DECIMAL -> round.
"""

from __future__ import annotations

from .. import constants as K


def _r(expr: str, places: int = 2) -> str:
    """Spark-compatible HALF_UP rounding of a double expression."""
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,20)), {places}) AS DOUBLE)"


def _values(rows) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return repr(v)
    return ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)


def _stage_case(col: str) -> str:
    parts = []
    for kind, pattern, stage in K.STAGE_RULES:
        cond = f"ends_with({col}, '{pattern}')" if kind == "suffix" else f"{col} = '{pattern}'"
        parts.append(f"WHEN {cond} THEN '{stage}'")
    return "CASE " + " ".join(parts) + f" ELSE '{K.OTHER_STAGE}' END"


def _takes(key: str, rule: tuple[int, int]) -> str:
    return f"{key} % {rule[0]} = {rule[1]}"


def half_even(product: str) -> str:
    """A decimal product rounded half-even to cents, by exact arithmetic."""
    cents = f"(({product}) * 100)"
    return (f"(CASE WHEN {cents} - floor({cents}) < 0.5 THEN floor({cents}) WHEN {cents} - floor({cents}) > 0.5 "
            f"THEN floor({cents}) + 1 WHEN floor({cents}) % 2 = 0 THEN floor({cents}) ELSE floor({cents}) + 1 END / 100)")


def converted(amount: str, currency: str, rate: str) -> str:
    """AUD as it is, else decimal amount x rate rounded once."""
    return (f"CASE WHEN upper({currency}) = 'AUD' THEN {amount} "
            f"ELSE CAST({half_even(f'CAST({amount} AS DECIMAL(20,6)) * CAST({rate} AS DECIMAL(12,6))')} AS DOUBLE) END")


def _field(name: str, value: str) -> str:
    rule = next((m, r) for n, m, r in K.FIELD_MISSING if n == name)
    return f"CASE WHEN {_takes('o_orderkey', rule)} THEN NULL ELSE {value} END AS {name}"


_QUARTERS = 4 * (K.FX_GENERATED_LAST_YEAR - K.FX_GENERATED_FIRST_YEAR + 1)
_FIRST_YEAR = K.FX_GENERATED_FIRST_YEAR


def _rate_at(date_expr: str) -> str:
    return (f"(SELECT fx.rate FROM fx WHERE upper(fx.\"from\") = upper(hk.ccy) "
            f"AND fx.fd <= {date_expr} AND (fx.td IS NULL OR {date_expr} <= fx.td) "
            f"ORDER BY fx.fd DESC LIMIT 1)")


RUN_OF_EVENT = ("'run-' || strftime(e.ts, '%Y%m%d') || CASE WHEN length(CAST(e.user_id AS VARCHAR)) < 6 "
                "THEN lpad(CAST(e.user_id AS VARCHAR), 6, '0') ELSE CAST(e.user_id AS VARCHAR) END")

BASE = f"""
region_ccy(n_regionkey, currency) AS (VALUES {_values(K.REGION_CURRENCY)}),
terms(o_orderpriority, paymentTerms, due_days) AS (VALUES {_values(K.PRIORITY_TERMS)}),
event_files(event_type, slot, file_name) AS (VALUES {_values(K.EVENT_FILE_NAMES)}),
fx_base("from", base, ccy_idx) AS (VALUES {_values([(c, b, i) for i, (c, b) in enumerate(K.FX_GENERATED_BASE)])}),
fx_q AS (
  SELECT b."from", CAST(b.base AS DOUBLE) AS base, b.ccy_idx, q.range AS qi, {_FIRST_YEAR} + q.range // 4 AS yr
  FROM fx_base b, range(0, {_QUARTERS}) q),
fx AS (
  SELECT "from", 'AUD' AS "to",
         make_date(CAST(yr AS INT), CAST((qi % 4) * 3 + 1 AS INT), 1) AS fd,
         CASE WHEN qi = {_QUARTERS - 1} THEN NULL
              ELSE CAST(last_day(make_date(CAST(yr AS INT), CAST((qi % 4) * 3 + 1 AS INT), 1) + INTERVAL 2 MONTH) AS DATE)
         END AS td,
         CAST({_r("base + CAST(0.01 AS DOUBLE) * CAST(((yr * 4 + qi % 4) * 3) % 5 - 2 AS DOUBLE)")} AS DECIMAL(18,6)) AS rate,
         ccy_idx * 1000 + qi AS position
  FROM fx_q),
order_lines AS (
  SELECT l_orderkey, {_r("sum(l_extendedprice)")} AS lines_total FROM lineitem GROUP BY l_orderkey),
hdr0 AS (
  SELECT o.o_orderkey, o.o_orderdate, o.o_orderstatus, c.c_name, rc.currency AS ccy, t.paymentTerms, t.due_days,
         CASE WHEN {_takes("o.o_orderkey", K.TOTAL_AS_ORDERED)} THEN o.o_totalprice
              ELSE coalesce(ol.lines_total, o.o_totalprice) END AS total
  FROM orders o
  LEFT JOIN order_lines ol ON ol.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region_ccy rc ON rc.n_regionkey = n.n_regionkey
  LEFT JOIN terms t ON t.o_orderpriority = o.o_orderpriority),
hkeys AS (
  SELECT *, false AS rerun, CAST(o_orderdate AS DATE) AS run_day FROM hdr0
  UNION ALL
  SELECT *, true AS rerun, CAST(o_orderdate AS DATE) + {K.RERUN_DELAY_DAYS} AS run_day FROM hdr0
  WHERE o_orderstatus = '{K.RERUN_ORDER_STATUS}'),
hk AS (
  SELECT *, 'run-' || strftime(run_day, '%Y%m%d') AS run_id,
         CAST(o_orderdate AS DATE) AS inv_d, CAST(o_orderdate AS DATE) + due_days AS due_d
  FROM hkeys),
hr AS (
  SELECT hk.*, {_rate_at("hk.inv_d")} AS rate_inv, {_rate_at("hk.due_d")} AS rate_due FROM hk),
spoiled AS (
  SELECT *, {_field("invoiceId", "'INV-' || CAST(o_orderkey AS VARCHAR)")}, {_field("vendorName", "c_name")},
         {_field("invoiceDate", "strftime(inv_d, '%Y-%m-%d')")}, {_field("totalAmount", "total")}, {_field("currency", "ccy")},
         o_orderstatus = '{K.RERUN_ORDER_STATUS}' AND (NOT rerun OR {_takes("o_orderkey", K.STILL_FAILED)}) AS failed
  FROM hr),
bronze_header AS (
  SELECT o_orderkey, run_id,
         '/invoices/' || run_id || '/invoice.json' AS source_path,
         'invoice-' || CAST(o_orderkey AS VARCHAR) || '.pdf' AS fileName,
         CAST(NULL AS VARCHAR) AS blobUrl,
         invoiceId, vendorName,
         lower(replace(c_name, '#', '')) || '@vendor.example' AS vendorEmail,
         invoiceDate,
         strftime(due_d, '%Y-%m-%d') AS dueDate,
         paymentTerms, currency, totalAmount,
         'invoice' AS documentType,
         CASE WHEN failed THEN 'failed' ELSE 'ok' END AS extractionStatus,
         CASE WHEN failed THEN 'partial extraction' END AS extractionNotes,
         CASE WHEN {_takes("o_orderkey", K.NO_BUSINESS_NAME)} THEN ''
              WHEN rerun AND {_takes("o_orderkey", K.CORRECTED_BUSINESS)} THEN vendorName || ' Ltd' ELSE vendorName END AS businessName,
         invoiceDate AS fromDate,
         coalesce(strftime(due_d, '%Y-%m-%d'), '') AS toDate,
         totalAmount AS invoiceAmount,
         CASE WHEN {_takes("o_orderkey", K.NO_INVOICE_CURRENCY)} THEN '' ELSE currency END AS invoiceCurrency,
         CAST(CASE WHEN upper(ccy) = 'AUD' THEN CAST(1 AS DECIMAL(18,6)) ELSE rate_inv END AS DOUBLE) AS exchangeRate,
         {converted("total", "ccy", "rate_due")} AS convertedInvoiceAmount,
         'AUD' AS convertedInvoiceCurrency
  FROM spoiled),
priced AS (
  SELECT l.l_orderkey, CAST(l.l_linenumber AS VARCHAR) AS lineNo,
         CASE WHEN {_takes("p_partkey", K.UNLISTED_CATEGORY)} THEN 'Unlisted ' || p.p_type ELSE p.p_type END AS categoryName,
         CASE WHEN {_takes("p_partkey", K.UNNAMED_PART)} THEN 'Freight charge ' || CAST(p_partkey AS VARCHAR)
              WHEN {_takes("p_partkey", K.ITEM_NAME_ONLY)} THEN p.p_name
              ELSE concat_ws(' ', p.p_name, p.p_brand) END AS description,
         l.l_quantity AS quantity,
         CASE WHEN {_takes("p_partkey", K.LIST_PRICE)} THEN p.p_retailprice
              ELSE {_r("l.l_extendedprice / l.l_quantity")} END AS unitPrice,
         l.l_extendedprice AS lineTotal
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
bronze_lines AS (
  SELECT h.run_id, h.invoiceId, h.vendorName, l.lineNo,
         l.categoryName, l.description, l.quantity, l.unitPrice, l.lineTotal,
         {_r("l.unitPrice * h.exchangeRate")} AS convertedUnitPrice,
         {_r("l.lineTotal * h.exchangeRate")} AS convertedLineTotal
  FROM priced l
  JOIN bronze_header h ON l.l_orderkey = h.o_orderkey),
bronze_manifest AS (
  SELECT {RUN_OF_EVENT} AS run_id,
         coalesce(f.file_name, e.event_type || '.json') AS file_name,
         CAST(floor(e.value * 1000) AS BIGINT) AS size_bytes,
         epoch_us(e.ts) // 1000 AS modify_time_ms,
         make_timestamp((epoch_us(e.ts) // 1000) * 1000) AS modify_time
  FROM events e LEFT JOIN event_files f ON f.event_type = e.event_type AND f.slot = e.event_id % 3),
bronze_email AS (
  SELECT 'run-' || CAST(d.doc_id AS VARCHAR) AS run_id,
         CASE WHEN lb.quality = 1 THEN 'accepted' WHEN lb.quality = 0 THEN 'rejected' END AS ingestionStatus,
         CASE WHEN lb.toxic = 1 THEN 'flagged content' WHEN lb.quality = 0 THEN 'not an invoice'
              WHEN lb.quality = 1 THEN 'invoice attached' END AS reason,
         CAST(d.doc_id AS VARCHAR) AS email_id,
         d.source || '@mail.example' AS email_from,
         d.source AS email_from_name,
         'ap@ledger.example' AS email_to,
         concat_ws(' ', d.lang, 'document', CAST(d.doc_id AS VARCHAR)) AS email_subject,
         CAST(DATE '2024-01-01' + CAST(d.doc_id % 366 AS INTEGER) AS DATE) AS email_date,
         substring(d.text, 1, 80) AS email_preview,
         d.text AS email_body,
         CAST(d.doc_id % 3 AS INTEGER) AS attachment_count
  FROM documents d LEFT JOIN labels lb ON lb.doc_id = d.doc_id),
silver_invoice AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY invoiceId
                                 ORDER BY run_id DESC, source_path DESC, fileName DESC) AS rn
    FROM bronze_header) WHERE rn = 1),
silver_lines AS (
  SELECT l.* FROM bronze_lines l JOIN silver_invoice s ON l.invoiceId = s.invoiceId AND l.run_id = s.run_id),
line_sums AS (
  SELECT invoiceId, {_r("sum(lineTotal)")} AS sum_lineTotal,
         {_r("sum(convertedLineTotal)")} AS sum_convertedLineTotal
  FROM silver_lines GROUP BY invoiceId),
checked0 AS (
  SELECT h.*, s.sum_lineTotal, s.sum_convertedLineTotal,
         {_r("s.sum_lineTotal - h.totalAmount")} AS reconcile_diff,
         {_r("h.totalAmount * h.exchangeRate")} AS fx_expected
  FROM silver_invoice h LEFT JOIN line_sums s ON h.invoiceId = s.invoiceId),
checked AS (
  SELECT *, CASE WHEN fx_expected = 0 THEN NULL
                 ELSE abs(convertedInvoiceAmount - fx_expected) / fx_expected END AS fx_diff_pct
  FROM checked0),
stage_rows AS (
  SELECT *, {_stage_case("file_name")} AS stage FROM bronze_manifest),
stage_latency AS (
  SELECT run_id,
         {", ".join(f"max(CASE WHEN stage = '{s}' THEN modify_time END) AS {s}" for s in K.LATENCY_STAGES)},
         epoch_us(max(CASE WHEN stage = 'result' THEN modify_time END)) // 1000000
           - epoch_us(max(CASE WHEN stage = 'ingested' THEN modify_time END)) // 1000000 AS total_seconds,
         epoch_us(max(CASE WHEN stage = 'ocr' THEN modify_time END)) // 1000000
           - epoch_us(max(CASE WHEN stage = 'ingested' THEN modify_time END)) // 1000000 AS sec_ingest_to_ocr,
         epoch_us(max(CASE WHEN stage = 'normalized' THEN modify_time END)) // 1000000
           - epoch_us(max(CASE WHEN stage = 'agent_input' THEN modify_time END)) // 1000000 AS sec_agent_total,
         epoch_us(max(CASE WHEN stage = 'final' THEN modify_time END)) // 1000000
           - epoch_us(max(CASE WHEN stage = 'normalized' THEN modify_time END)) // 1000000 AS sec_normalize_to_final
  FROM stage_rows WHERE stage <> '{K.OTHER_STAGE}' GROUP BY run_id)
"""

_HEADER_COLS = ("run_id, source_path, " + ", ".join(K.HEADER_COLUMNS))

_DQ = " UNION ALL ".join(
    [
        "SELECT invoiceId, vendorName, 'line_total_mismatch' AS rule, "
        "concat_ws(' ', 'diff=', CAST(reconcile_diff AS VARCHAR)) AS detail FROM checked WHERE abs(reconcile_diff) > 0.01",
        "SELECT invoiceId, vendorName, 'fx_inconsistent', concat_ws(' ', 'pct=', CAST(fx_diff_pct AS VARCHAR)) "
        "FROM checked WHERE fx_diff_pct > 0.01",
        "SELECT invoiceId, vendorName, 'extraction_not_ok', extractionStatus FROM checked WHERE extractionStatus <> 'ok'",
        "SELECT invoiceId, vendorName, 'due_before_invoice_date', concat_ws(' ', invoiceDate, '->', dueDate) "
        "FROM checked WHERE TRY_CAST(dueDate AS DATE) < TRY_CAST(invoiceDate AS DATE)",
    ]
    + [f"SELECT invoiceId, vendorName, 'null_{c}', CAST(NULL AS VARCHAR) FROM checked WHERE {c} IS NULL"
       for c in K.REQUIRED_HEADER_FIELDS]
)

_MEASURES_LINES = ", ".join(
    _r(f"sum(CAST({m} AS DOUBLE))") + f" AS sum_{m}"
    for m in ("quantity", "unitPrice", "lineTotal", "convertedUnitPrice", "convertedLineTotal"))
_MEASURES_LAT = ", ".join(
    _r(f"sum(CAST({m} AS DOUBLE))") + f" AS sum_{m}"
    for m in ("total_seconds", "sec_ingest_to_ocr", "sec_agent_total", "sec_normalize_to_final"))

_CODED = (
    "SELECT 'INV-' || CAST(l_orderkey AS VARCHAR) AS invoice, l_linenumber AS line_no, l_tax, CAST(l_tax AS DECIMAL(9,6)) AS rate, "
    "CAST(" + half_even("CAST(l_quantity AS DECIMAL(12,4)) * CAST(" + _r("l_extendedprice / l_quantity") + " AS DECIMAL(14,4))")
    + " AS DECIMAL(18,2)) AS amount FROM lineitem")

SPEND_BY_VENDOR_MONTH = (
    f"SELECT vendorName, strftime(TRY_CAST(invoiceDate AS DATE), '%Y-%m') AS invoice_month, "
        f"count(invoiceId) AS invoices, {_r('sum(totalAmount)')} AS total_native, "
        f"{_r('sum(convertedInvoiceAmount)')} AS total_aud FROM silver_invoice GROUP BY 1, 2")

_PRICE_BENCHMARK = (
        "WITH b AS (SELECT categoryName, quantile_disc(convertedUnitPrice, 0.5) AS median_unit_price_aud, "
        "count(DISTINCT vendorName) AS vendors FROM silver_lines GROUP BY categoryName) "
        "SELECT l.invoiceId, l.vendorName, l.categoryName, l.description, l.convertedUnitPrice, "
        "b.median_unit_price_aud, CASE WHEN b.median_unit_price_aud = 0 THEN NULL ELSE "
        + _r("100 * (l.convertedUnitPrice - b.median_unit_price_aud) / b.median_unit_price_aud", 1)
        + " END AS vs_median_pct FROM silver_lines l JOIN b ON l.categoryName = b.categoryName WHERE b.vendors > 1")

SELECTS: dict[str, str] = {
    "bronze_invoice_header": f"SELECT {_HEADER_COLS} FROM bronze_header",
    "bronze_invoice_lineitem": "SELECT * FROM bronze_lines",
    "bronze_run_manifest": "SELECT * FROM bronze_manifest",
    "bronze_ingestion_email": "SELECT * FROM bronze_email",
    "silver_invoice": f"SELECT {_HEADER_COLS} FROM silver_invoice",
    "silver_invoice_lineitem": "SELECT * FROM silver_lines",
    "invoice_line_sums": "SELECT * FROM line_sums",
    "checked_invoice": (
        "SELECT invoiceId, vendorName, totalAmount, exchangeRate, convertedInvoiceAmount, sum_lineTotal, "
        "sum_convertedLineTotal, reconcile_diff, fx_expected, fx_diff_pct FROM checked"),
    "silver_dq_issues": _DQ,
    "vendor_summary": (
        f"SELECT vendorName, count(*) AS invoices, {_r('sum(totalAmount)')} AS total_native, "
        f"{_r('sum(convertedInvoiceAmount)')} AS total_aud FROM silver_invoice GROUP BY vendorName"),
    "table_row_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {cte}" for name, cte in (
            ("bronze_invoice_header", "bronze_header"), ("bronze_invoice_lineitem", "bronze_lines"),
            ("bronze_ingestion_email", "bronze_email"), ("bronze_run_manifest", "bronze_manifest"),
            ("bronze_run_result", "bronze_email"), ("silver_invoice", "silver_invoice"), ("silver_invoice_lineitem", "silver_lines"))),
    "spend_by_vendor_month": SPEND_BY_VENDOR_MONTH,
    "spend_by_category": (
        f"WITH cat AS (SELECT vendorName, categoryName, {_r('sum(convertedLineTotal)')} AS spend_aud, "
        f"count(DISTINCT invoiceId) AS invoices, count(*) AS line_count FROM silver_lines GROUP BY 1, 2), "
        f"tot AS (SELECT *, sum(spend_aud) OVER (PARTITION BY vendorName) AS vt FROM cat) "
        f"SELECT vendorName, categoryName, spend_aud, invoices, line_count, "
        f"CASE WHEN vt = 0 THEN NULL ELSE {_r('100 * spend_aud / vt')} END AS share_pct FROM tot"),
    "unit_price_stats": (
        "SELECT categoryName, quantile_disc(convertedUnitPrice, 0.5) AS median_unit_price_aud, "
        "min(convertedUnitPrice) AS min_unit_price, max(convertedUnitPrice) AS max_unit_price, "
        "count(DISTINCT vendorName) AS vendors, count(*) AS line_count FROM silver_lines GROUP BY categoryName"),
    "unit_price_benchmark": _PRICE_BENCHMARK,
    "payment_calendar": (
        f"SELECT date_trunc('week', CAST(TRY_CAST(dueDate AS DATE) AS TIMESTAMP)) AS due_week, "
        f"count(invoiceId) AS invoices, {_r('sum(convertedInvoiceAmount)')} AS due_aud "
        f"FROM silver_invoice GROUP BY 1"),
    "fx_sensitivity": (
        "WITH s AS (SELECT currency, CAST(sum(CAST(convertedInvoiceAmount AS DECIMAL(28,6))) AS DOUBLE) AS s "
        "FROM silver_invoice WHERE currency <> 'AUD' GROUP BY currency) "
        f"SELECT currency, {_r('s')} AS base_aud, {_r('s * CAST(1.05 AS DOUBLE)')} AS plus_5pct, "
        f"{_r('s * CAST(0.95 AS DOUBLE)')} AS minus_5pct FROM s"),
    "line_measures_by_level": (
        "SELECT vendorName, categoryName, CAST(grouping(vendorName, categoryName) AS BIGINT) AS level, "
        + ", ".join(_r(f"CAST(sum(CAST({m} AS DECIMAL(28,6))) AS DOUBLE)") + f" AS sum_{m}"
                    for m in ("quantity", "unitPrice", "lineTotal", "convertedUnitPrice", "convertedLineTotal"))
        + " FROM silver_lines GROUP BY GROUPING SETS ((vendorName, categoryName), (vendorName), (categoryName), ())"),
    "unit_price_medians_by_day": (
        "SELECT categoryName, count(convertedUnitPrice) AS prices, true AS within_error FROM silver_lines "
        "GROUP BY categoryName HAVING count(convertedUnitPrice) > 0"),
    "spend_report": (
        "SELECT *, row_number() OVER (ORDER BY invoice_month ASC NULLS FIRST, total_aud DESC NULLS LAST, vendorName ASC NULLS FIRST, "
        f"invoices, total_native ASC NULLS FIRST) AS rank FROM ({SPEND_BY_VENDOR_MONTH})"),
    "price_report": (
        "SELECT *, row_number() OVER (ORDER BY vs_median_pct DESC NULLS LAST, invoiceId ASC NULLS FIRST, vendorName ASC NULLS FIRST, "
        "categoryName ASC NULLS FIRST, description ASC NULLS FIRST, convertedUnitPrice ASC NULLS FIRST, median_unit_price_aud ASC NULLS FIRST) "
        f"AS rank FROM ({_PRICE_BENCHMARK})"),
    "header_preview": (
        f"SELECT {_HEADER_COLS}, row_number() OVER (ORDER BY run_id, fileName) AS rank FROM bronze_header "
        "ORDER BY run_id, fileName LIMIT 20"),
    "manifest_preview": (
        "SELECT *, row_number() OVER (ORDER BY run_id, modify_time, file_name, size_bytes, modify_time_ms) AS rank "
        "FROM bronze_manifest ORDER BY run_id, modify_time, file_name, size_bytes, modify_time_ms LIMIT 50"),
    "line_measures_by_category": f"SELECT categoryName, {_MEASURES_LINES} FROM silver_lines GROUP BY categoryName",
    "latency_measures_by_day": (
        f"SELECT substring(run_id, 5, 8) AS run_day, {_MEASURES_LAT} FROM stage_latency GROUP BY 1"),
    "stage_timestamps": (
        f"SELECT run_id, stage, max(modify_time) AS stage_ts FROM stage_rows "
        f"WHERE stage <> '{K.OTHER_STAGE}' GROUP BY run_id, stage"),
    "stage_latency": "SELECT * FROM stage_latency",
    "extraction_quality": (
        "WITH q AS (SELECT vendorName, count(*) AS runs, "
        "CAST(sum(CASE WHEN extractionStatus = 'ok' THEN 1 ELSE 0 END) AS BIGINT) AS ok_runs, "
        "CAST(sum(CASE WHEN extractionStatus <> 'ok' THEN 1 ELSE 0 END) AS BIGINT) AS failed_runs "
        f"FROM bronze_header GROUP BY vendorName) SELECT *, {_r('100 * ok_runs / runs', 1)} AS success_rate_pct FROM q"),
    "duplicate_runs": (
        "WITH t AS (SELECT DISTINCT invoiceId, vendorName, run_id FROM bronze_header WHERE run_id IS NOT NULL), "
        "c AS (SELECT invoiceId, vendorName, count(*) AS run_count FROM t GROUP BY 1, 2 HAVING count(*) > 1) "
        "SELECT t.invoiceId, t.vendorName, t.run_id, c.run_count FROM t "
        "JOIN c ON t.invoiceId IS NOT DISTINCT FROM c.invoiceId AND t.vendorName IS NOT DISTINCT FROM c.vendorName"),
    "runs_by_stage": (
        "SELECT stage, CAST(date_trunc('week', strptime(substr(run_id, 5, 8), '%Y%m%d')) AS DATE) AS week, "
        "count(DISTINCT run_id) AS run_count FROM stage_rows GROUP BY ALL"),
    "ingestion_status_summary": "SELECT ingestionStatus, count(*) AS runs FROM bronze_email GROUP BY 1",
    "email_decisions": "SELECT run_id, ingestionStatus, reason, email_from, email_subject FROM bronze_email",
    "discover_runs": "SELECT DISTINCT run_id FROM bronze_manifest WHERE starts_with(run_id, 'run-')",
    "run_list": (
        "SELECT run_id FROM (SELECT DISTINCT run_id FROM bronze_manifest WHERE starts_with(run_id, 'run-')) "
        "ORDER BY run_id DESC LIMIT 20"),
    "supported_documents": (
        "SELECT run_id, file_name, size_bytes FROM bronze_manifest "
        "WHERE regexp_matches(lower(file_name), '\\.(pdf|png|jpg|jpeg)$')"),
    "invoice_arithmetic": (
        f"WITH l AS ({_CODED}), "
        "t AS (SELECT invoice, count(*) AS lines, sum(amount) AS subtotal, max(rate) AS rate FROM l GROUP BY invoice), "
        f"x AS (SELECT *, {half_even('CAST(subtotal AS DECIMAL(20,2)) * rate')} AS tax FROM t) "
        "SELECT invoice, lines, CAST(subtotal AS DOUBLE) AS subtotal, CAST(tax AS DOUBLE) AS tax, "
        "CAST(CAST(subtotal AS DECIMAL(20,2)) + CAST(tax AS DECIMAL(20,2)) AS DOUBLE) AS grand_total FROM x"),
    "invoice_line_tax": (
        f"WITH l AS ({_CODED}) SELECT invoice, line_no, l_tax AS tax_rate, CAST(amount AS DOUBLE) AS amount, "
        f"CAST({half_even('amount * rate')} AS DOUBLE) AS line_tax FROM l"),
}


def oracle_sql() -> dict[str, str]:
    from .oracle_payloads import CTES as PAYLOAD_CTES, SELECTS as PAYLOAD_SELECTS
    from .oracle_rules import RULE_CTES, RULE_SELECTS
    selects = dict(SELECTS)
    selects.update(RULE_SELECTS)
    selects.update(PAYLOAD_SELECTS)
    ctes = BASE.strip()
    for extra in (RULE_CTES, PAYLOAD_CTES):
        if extra.strip():
            ctes += "," + extra.rstrip()
    out = {}
    for name, sel in selects.items():
        if sel.lstrip().upper().startswith("WITH"):
            sel = f"SELECT * FROM ({sel})"
        out[name] = f"WITH {ctes}\n{sel}"
    return out
