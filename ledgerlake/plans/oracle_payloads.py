"""DuckDB oracle SQL for the payload and ledger-change queries.

The JSON round trips are the identity on the fields they carry, so their
oracle reads the bronze CTEs directly; the result document (P4) is written
out as text; the change batch is replayed with window functions.
"""

from __future__ import annotations

from .. import constants as K
from .oracle import SPEND_BY_VENDOR_MONTH, _r

_NEW_LINE = "(l_returnflag = 'N' AND l_linestatus = 'O')"
_REOPEN = "(l_returnflag = 'R' AND l_linestatus = 'O')"
_FIELDS = ("InvoiceNumber", "Vendor", "Account", "Amount", "Currency", "EntryDate", "Status", "Description")
_ADD_DEFAULTS = {"Currency": "'USD'", "Status": "'pending'"}


def _j(expr: str) -> str:
    return f"CAST(to_json({expr}) AS VARCHAR)"


_ATTACHMENTS = ("'[' || coalesce((SELECT string_agg('{\"name\":\"invoice-' || email_id || '-' || i || '.pdf\"}', ',' ORDER BY i) "
                "FROM (SELECT unnest(range(1, attachment_count + 1)) AS i)), '') || ']'")

def _gl_field(f: str) -> str:
    added = f"r.{f}"
    if f in _ADD_DEFAULTS:
        added = f"coalesce(r.{f}, {_ADD_DEFAULTS[f]})"
    return f"coalesce(u.u_{f}, CASE WHEN r.op = 'add' THEN {added} ELSE o.{f} END)"


_GL_FIELDS = ", ".join(
    f"CAST({_gl_field(f)} AS DOUBLE) AS {f}" if f == "Amount" else
    f"CAST({_gl_field(f)} AS DATE) AS {f}" if f == "EntryDate" else f"{_gl_field(f)} AS {f}" for f in _FIELDS)
_NO_INGESTION = f"CAST(email_id AS BIGINT) % {K.NO_INGESTION_FILE[0]} <> {K.NO_INGESTION_FILE[1]}"
_WRAPPED = ("'{\"ingestionStatus\":' || " + _j("ingestionStatus") + " || coalesce(',\"reason\":' || " + _j("reason")
            + ", '') || ',\"email\":' || email_json || '}'")
_RERUN = f"day(run_date) % {K.RERUN_DAY[0]} = {K.RERUN_DAY[1]}"

CTES = f"""
result_email AS (
  SELECT *, '{{"id":' || email_id || ',"from":' || {_j("email_from")} || ',"fromName":' || {_j("email_from_name")}
         || ',"to":' || {_j("email_to")} || ',"subject":' || {_j("email_subject")}
         || ',"date":"' || strftime(email_date, '%Y-%m-%d') || '","preview":' || {_j("email_preview")}
         || ',"body":' || {_j("email_body")} || ',"attachments":' || {_ATTACHMENTS} || '}}' AS email_json,
         '{{"attachments":' || {_ATTACHMENTS} || ',"body":' || {_j("email_body")}
         || ',"date":"' || strftime(email_date, '%Y-%m-%d') || '","from":' || {_j("email_from")}
         || ',"fromName":' || {_j("email_from_name")} || ',"id":' || email_id || ',"preview":' || {_j("email_preview")}
         || ',"subject":' || {_j("email_subject")} || ',"to":' || {_j("email_to")} || '}}' AS email_sorted
  FROM bronze_email),
overlay AS (
  -- base: result.json (ingestionStatus, draft) for half of the decided runs, else ingestion.json
  SELECT run_id, 'draft' AS node, '{{"score":' || CAST(CAST(email_id AS BIGINT) % 7 AS VARCHAR) || ',"version":"first"}}' AS value FROM result_email
  UNION ALL SELECT run_id, 'ingestionStatus', CASE WHEN attachment_count > 0 THEN '"processed"' ELSE {_j("ingestionStatus")} END
  FROM result_email WHERE attachment_count > 0 OR ingestionStatus IS NOT NULL
  UNION ALL SELECT run_id, 'invoices', '[' || email_id || ']' FROM result_email WHERE attachment_count > 0
  UNION ALL SELECT run_id, 'reason', {_j("reason")} FROM result_email
  WHERE reason IS NOT NULL AND NOT (ingestionStatus IS NOT NULL AND CAST(email_id AS BIGINT) % 2 = 0)
  UNION ALL SELECT run_id, 'email', email_sorted FROM result_email
  WHERE NOT (ingestionStatus IS NOT NULL AND CAST(email_id AS BIGINT) % 2 = 0)),
gl_old AS (
  SELECT invoiceId AS Id, invoiceId AS InvoiceNumber, vendorName AS Vendor, currency AS Account,
         CAST(convertedInvoiceAmount AS DECIMAL(18,2)) AS Amount, 'AUD' AS Currency,
         CAST(CAST(invoiceDate AS DATE) AS TIMESTAMP) AS EntryDate, 'posted' AS Status,
         fileName AS Description, true AS held
  FROM silver_invoice),
gl_changes AS (
  SELECT CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'delete'
              WHEN {_REOPEN} OR {_NEW_LINE} THEN 'add' ELSE 'update' END AS op,
         CASE WHEN {_NEW_LINE} THEN 'INV-' || CAST(l_orderkey AS VARCHAR) || '-L' || CAST(l_linenumber AS VARCHAR)
              ELSE 'INV-' || CAST(l_orderkey AS VARCHAR) END AS Id,
         CASE WHEN {_REOPEN} OR {_NEW_LINE} THEN 'INV-' || CAST(l_orderkey AS VARCHAR) END AS InvoiceNumber,
         CAST(NULL AS VARCHAR) AS Vendor,
         CASE WHEN {_NEW_LINE} THEN CAST(l_partkey AS VARCHAR) END AS Account,
         CAST(CASE WHEN l_returnflag = 'A' THEN {_r("l_extendedprice * (1 - l_discount)")}
                   WHEN {_REOPEN} OR {_NEW_LINE} THEN l_extendedprice END AS DECIMAL(18,2)) AS Amount,
         CAST(NULL AS VARCHAR) AS Currency,
         CASE WHEN {_REOPEN} OR {_NEW_LINE} THEN CAST(l_shipdate AS TIMESTAMP) END AS EntryDate,
         CASE WHEN l_returnflag = 'A' THEN 'adjusted'
              WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'settled' END AS Status,
         CASE WHEN {_NEW_LINE} THEN 'line ' || CAST(l_linenumber AS VARCHAR)
              WHEN {_REOPEN} THEN 're-opened' END AS Description,
         row_number() OVER (ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey) AS seqn
  FROM lineitem),
gl_reset AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY Id ORDER BY seqn DESC) AS rn
    FROM gl_changes WHERE op IN ('add', 'delete')) WHERE rn = 1),
gl_upd AS (
  SELECT c.Id, {", ".join(f"arg_max(c.{f}, c.seqn) FILTER (WHERE c.{f} IS NOT NULL) AS u_{f}" for f in _FIELDS)}
  FROM gl_changes c LEFT JOIN gl_reset r ON c.Id = r.Id
  WHERE c.op = 'update' AND (r.Id IS NULL OR c.seqn > r.seqn)
  GROUP BY c.Id),
run_files AS (
  -- result documents as the app writes them (null fields included) and as P4 keeps them
  SELECT CASE WHEN ingestionStatus IS NULL THEN 'email-' || email_id ELSE run_id END AS folder, 'ingestion.json' AS file_name,
         CASE WHEN ingestionStatus IS NULL THEN email_json ELSE {_WRAPPED} END AS text, CAST(NULL AS VARCHAR) AS kept
  FROM result_email WHERE ingestionStatus IS NULL OR {_NO_INGESTION}
  UNION ALL
  SELECT run_id, 'invoice-' || email_id || '.PDF', '%PDF-1.4', NULL FROM result_email
  WHERE ingestionStatus IS NOT NULL AND attachment_count > 0
  UNION ALL
  SELECT run_id, 'result.json',
    CASE CAST(email_id AS BIGINT) % 8
      WHEN 0 THEN '{{"ingestionStatus":' || {_j("ingestionStatus")} || ',"draft":{{"title":' || {_j("email_subject")} || ',"number":' || email_id || '}},"note":null}}'
      WHEN 2 THEN '{{"ingestionStatus":' || {_j("ingestionStatus")} || ',"draft":' || {_j("email_body")} || ',"v":1}}'
      WHEN 4 THEN '{{"draft":["{{\\"n\\":' || email_id || '}}",null,' || {_j("email_subject")} || '],"v":9007199254740993,"email":'
           || replace(email_json, '.pdf"}}', '.pdf","blobUrl":null,"invoiceId":null}}') || '}}'
      ELSE '{{"draft":null,"v":{{"k":"a\\":null,","deep":{{"none":null,"yes":true}}}}}}' END,
    CASE CAST(email_id AS BIGINT) % 8
      WHEN 0 THEN '{{"draft":{{"number":' || email_id || ',"title":' || {_j("email_subject")} || '}},"ingestionStatus":' || {_j("ingestionStatus")} || '}}'
      WHEN 2 THEN '{{"draft":' || {_j("email_body")} || ',"ingestionStatus":' || {_j("ingestionStatus")} || ',"v":1}}'
      WHEN 4 THEN '{{"draft":["{{\\"n\\":' || email_id || '}}",null,' || {_j("email_subject")} || '],"email":' || email_sorted || ',"v":9007199254740993}}'
      ELSE '{{"v":{{"deep":{{"yes":true}},"k":"a\\":null,"}}}}' END
  FROM result_email WHERE ingestionStatus IS NOT NULL AND CAST(email_id AS BIGINT) % 2 = 0),
documents AS (
  SELECT l_orderkey, (CAST(lineNo AS BIGINT) - 1) // {K.LINES_PER_DOCUMENT} AS part, count(*) AS line_items FROM priced GROUP BY ALL),
manifest_days AS (
  SELECT run_id, file_name, size_bytes, CAST(strptime(substr(run_id, 5, 8), '%Y%m%d') AS DATE) AS run_date FROM bronze_manifest),
gl_new AS (
  SELECT coalesce(o.Id, r.Id) AS Id, {_GL_FIELDS}
  FROM gl_old o FULL OUTER JOIN gl_reset r ON o.Id = r.Id LEFT JOIN gl_upd u ON u.Id = coalesce(o.Id, r.Id)
  WHERE r.op = 'add' OR (r.op IS NULL AND o.held)),
fx_sub AS (
  SELECT currency AS "from", 'AUD' AS "to",
         strftime(date_trunc('quarter', CAST(dueDate AS DATE)), '%Y-%m-%d') AS fromDate,
         strftime(last_day(date_trunc('quarter', CAST(dueDate AS DATE)) + INTERVAL 2 MONTH), '%Y-%m-%d') AS toDate,
         CAST(CAST({_r("max(CASE WHEN totalAmount = 0 THEN NULL ELSE convertedInvoiceAmount / totalAmount END)", 4)}
              AS DECIMAL(18,6)) AS DOUBLE) AS rate,
         count(*) AS invoices
  FROM silver_invoice GROUP BY 1, 3, 4),
fx_checked AS (
  SELECT *,
         CASE WHEN "from" IS NULL OR trim("from") = '' OR "to" IS NULL OR trim("to") = ''
                   OR fromDate IS NULL OR trim(fromDate) = '' OR rate IS NULL OR rate <= 0
              THEN 'From/To currency, From Date and a positive rate are required.' END AS reject_reason
  FROM fx_sub)
"""


SELECTS = {
    "saved_spend_table": SPEND_BY_VENDOR_MONTH,
    "ledger_file_items": (
        "SELECT categoryName, ledgerCode, itemName, expectedUnitPrice, array_to_string(aliases, '|') AS aliases FROM ledger_items"),
    "fx_rates_file": "SELECT \"from\", \"to\", fromDate, toDate, rate FROM fx_sub",
    "fx_rate_validation": (
        "SELECT CASE WHEN reject_reason IS NULL THEN upper(trim(\"from\")) ELSE \"from\" END AS \"from\", "
        "CASE WHEN reject_reason IS NULL THEN upper(trim(\"to\")) ELSE \"to\" END AS \"to\", "
        "fromDate, toDate, rate, invoices, reject_reason IS NULL AS valid, reject_reason FROM fx_checked"),
    "fx_table_replace": (
        "SELECT upper(trim(\"from\")) AS \"from\", upper(trim(\"to\")) AS \"to\", fromDate, toDate, rate "
        "FROM fx_checked WHERE reject_reason IS NULL"),
    "json_invoice_header": (
        "SELECT h.run_id, h.source_path, " + ", ".join(f"h.{c}" for c in K.HEADER_COLUMNS)
        + " FROM bronze_header h LEFT JOIN priced p ON p.l_orderkey = h.o_orderkey"),
    "json_invoice_lineitem": "SELECT * FROM bronze_lines",
    "json_ingestion_email": (
        "SELECT run_id, ingestionStatus, reason, email_id, email_from, email_from_name, email_to, email_subject, "
        "email_date, email_preview, md5(email_body) AS email_body, attachment_count FROM bronze_email"),
    "invoice_replies": (
        "SELECT h.run_id, CASE WHEN paymentTerms IN ('PREPAID', 'NET 14') THEN 'array' "
        "WHEN paymentTerms = 'NET 30' THEN 'object' ELSE 'single' END AS shape, "
        + ", ".join(f"h.{c}" for c in K.HEADER_COLUMNS)
        + ", coalesce(CAST(d.line_items AS INTEGER), 0) AS line_items, p.lineNo, p.description, p.lineTotal "
        "FROM bronze_header h LEFT JOIN priced p ON p.l_orderkey = h.o_orderkey "
        f"LEFT JOIN documents d ON d.l_orderkey = p.l_orderkey AND d.part = (CAST(p.lineNo AS BIGINT) - 1) // {K.LINES_PER_DOCUMENT} "
        "WHERE h.invoiceId IS NOT NULL OR paymentTerms = 'NET 30'"),
    "attachment_urls": (
        "SELECT run_id, 'invoice-' || email_id || '-' || i || '.pdf' AS name, "
        "CASE WHEN i = 1 THEN 'https://files.example/' || run_id || CASE WHEN CAST(email_id AS BIGINT) % " + str(K.UPLOADED_TWICE[0])
        + " = " + str(K.UPLOADED_TWICE[1]) + " THEN '/2' ELSE '/1' END END AS blobUrl "
        "FROM (SELECT run_id, email_id, unnest(range(1, attachment_count + 1)) AS i FROM bronze_email)"),
    "result_overlay": "SELECT run_id, node, value FROM overlay",
    "result_document": (
        "SELECT run_id, CAST(length(d) AS BIGINT) AS chars, md5(d) AS document_md5 FROM ("
        "SELECT run_id, '{' || string_agg('\"' || node || '\":' || value, ',' ORDER BY node) || '}' AS d "
        "FROM overlay GROUP BY run_id)"),
    "ingestion_emails": (
        "SELECT run_id, ingestionStatus IS NOT NULL AS wrapped, CAST(email_id AS BIGINT) AS email_id, "
        "email_from, email_subject, strftime(email_date, '%Y-%m-%d') AS email_date, "
        "CAST(length(email_body) AS BIGINT) AS body_chars, md5(email_body) AS body_md5 FROM bronze_email"),
    "bronze_run_result": (
        "SELECT run_id, CAST(length(d) AS BIGINT) AS chars, md5(d) AS result_md5 FROM ("
        "SELECT run_id, '{\"email\":' || email_json || coalesce(',\"ingestionStatus\":' || "
        + _j("ingestionStatus") + ", '') || coalesce(',\"reason\":' || " + _j("reason") + ", '') || '}' AS d FROM result_email)"),
    "ledger_changes": f"SELECT Id, {', '.join(_FIELDS)} FROM gl_new",
    "ledger_entry_list": f"SELECT Id, {', '.join(_FIELDS)} FROM gl_new",
    "ledger_entry_get": (
        "SELECT q.Id, n.Id IS NOT NULL AS found, " + ", ".join(f"n.{f}" for f in _FIELDS)
        + " FROM (SELECT 'INV-' || CAST(l_orderkey AS VARCHAR) || '-L' || CAST(l_linenumber AS VARCHAR) AS Id FROM lineitem) q "
        "LEFT JOIN gl_new n ON n.Id = q.Id"),
    "folder_runs": "SELECT DISTINCT folder AS run_id FROM run_files WHERE folder LIKE 'run-%'",
    "folder_run_manifest": (
        "SELECT folder AS run_id, file_name, CAST(strlen(text) AS BIGINT) AS size_bytes, true AS has_time "
        "FROM run_files WHERE folder LIKE 'run-%'"),
    "folder_documents": "SELECT folder AS run_id, file_name FROM run_files WHERE folder LIKE 'run-%' AND file_name LIKE '%.PDF'",
    "folder_ingestion_email": (
        "SELECT run_id, ingestionStatus, reason, email_id, email_from, email_from_name, email_to, email_subject, "
        "email_date, email_preview, md5(email_body) AS email_body, attachment_count FROM bronze_email "
        f"WHERE ingestionStatus IS NOT NULL AND {_NO_INGESTION}"),
    "folder_run_result": (
        "SELECT folder AS run_id, CAST(length(kept) AS BIGINT) AS chars, md5(kept) AS result_md5 "
        "FROM run_files WHERE file_name = 'result.json'"),
    "manifest_by_day": (
        f"SELECT run_id, file_name, CASE WHEN {_RERUN} THEN size_bytes * 2 ELSE size_bytes END AS size_bytes, run_date "
        f"FROM manifest_days m WHERE NOT ({_RERUN}) OR file_name LIKE '%.json' "
        f"OR NOT EXISTS (SELECT 1 FROM manifest_days d WHERE d.run_date = m.run_date AND d.file_name LIKE '%.json')"),
}
