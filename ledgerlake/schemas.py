"""Explicit schemas for every JSON input and table of the data model.

JSON is not schema-inferred -- inference scans the input twice and lets a
single malformed file change the table -- except for result.json, which is
kept whole (see ``sources/runs.py``).  Missing fields read as null.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, I, B = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.BooleanType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Line numerics are read as text (a JSON number keeps its digits) and cast
# with try_cast in bronze, so "2" and 2 both give 2.0 and junk gives null.
LINE_ITEM = _struct(
    ("lineNo", S), ("categoryName", S), ("description", S),
    ("quantity", S), ("unitPrice", S), ("lineTotal", S),
    ("convertedUnitPrice", S), ("convertedLineTotal", S),
)

INVOICE = _struct(
    ("fileName", S), ("blobUrl", S), ("invoiceId", S), ("vendorName", S), ("vendorEmail", S),
    ("invoiceDate", S), ("dueDate", S), ("paymentTerms", S), ("currency", S), ("totalAmount", D),
    ("documentType", S), ("extractionStatus", S), ("extractionNotes", S), ("businessName", S),
    ("fromDate", S), ("toDate", S), ("invoiceAmount", D), ("invoiceCurrency", S),
    ("exchangeRate", D), ("convertedInvoiceAmount", D), ("convertedInvoiceCurrency", S),
    ("lineItems", T.ArrayType(LINE_ITEM)),
)

INVOICE_FILE = _struct(("invoices", T.ArrayType(INVOICE)))


def invoice_file(fields) -> T.StructType:
    """The invoice file with only some fields of each invoice: the JSON reader
    skips the others."""
    wanted = set(fields)
    return _struct(("invoices", T.ArrayType(T.StructType([f for f in INVOICE.fields if f.name in wanted]))))


ATTACHMENT = _struct(("name", S), ("blobUrl", S), ("invoiceId", S))

EMAIL = _struct(
    ("id", L), ("from", S), ("fromName", S), ("to", S), ("subject", S), ("date", S),
    ("preview", S), ("body", S), ("attachments", T.ArrayType(ATTACHMENT)),
)

INGESTION_FILE = _struct(("ingestionStatus", S), ("reason", S), ("email", EMAIL))

MATCH_RECORD = _struct(
    ("invoiceId", S), ("lineNo", S), ("lineItemDescription", S), ("businessName", S),
    ("quantity", D), ("unitPrice", D), ("lineTotal", D), ("convertedUnitPrice", D),
    ("convertedLineTotal", D), ("convertedCurrency", S), ("status", S),
    ("matchedLedgerItem", S), ("ledgerCode", S), ("ruleApplied", S), ("reason", S),
    ("humanInLoop", B),
)

RESULT_FILE = _struct(
    ("email", EMAIL), ("ingestionStatus", S), ("reason", S),
    ("invoices", T.ArrayType(INVOICE)),
    ("LedgerMatched", T.ArrayType(MATCH_RECORD)),
    ("LedgerException", T.ArrayType(MATCH_RECORD)),
)

LEDGER_ITEM = _struct(
    ("ledgerCode", S), ("itemName", S), ("expectedUnitPrice", D), ("aliases", T.ArrayType(S)),
)
LEDGER_CATEGORY = _struct(
    ("categoryName", S), ("approvedBudget", D), ("ytdBalance", D),
    ("items", T.ArrayType(LEDGER_ITEM)),
)
LEDGER_FILE = _struct(
    ("currency", S), ("categories", T.ArrayType(LEDGER_CATEGORY)), ("postedEntries", T.ArrayType(S)),
)

RULE = _struct(
    ("id", S), ("name", S), ("description", S), ("outcome", S),
    ("tolerancePercent", D), ("toleranceAbsolute", D), ("thresholdAmount", D), ("humanInLoop", B),
)
RULES_FILE = _struct(("rules", T.ArrayType(RULE)))

FX_RATE = T.StructType([
    T.StructField("from", S), T.StructField("to", S), T.StructField("fromDate", S),
    T.StructField("toDate", S), T.StructField("rate", T.DecimalType(18, 6)),
])
FX_FILE = _struct(("rates", T.ArrayType(FX_RATE)))

LEDGER_ENTRY = _struct(
    ("Id", S), ("InvoiceNumber", S), ("Vendor", S), ("Account", S),
    ("Amount", T.DecimalType(18, 2)), ("Currency", S), ("EntryDate", T.TimestampType()),
    ("Status", S), ("Description", S),
)

# Bronze tables.
BRONZE_HEADER = T.StructType(
    [T.StructField("run_id", S), T.StructField("source_path", S), T.StructField("ingested_at", T.TimestampType())]
    + [f for f in INVOICE.fields if f.name != "lineItems"]
)
BRONZE_LINE = _struct(
    ("run_id", S), ("ingested_at", T.TimestampType()), ("invoiceId", S), ("vendorName", S),
    ("lineNo", S), ("categoryName", S), ("description", S), ("quantity", D), ("unitPrice", D),
    ("lineTotal", D), ("convertedUnitPrice", D), ("convertedLineTotal", D),
)
BRONZE_EMAIL = _struct(
    ("run_id", S), ("ingested_at", T.TimestampType()), ("ingestionStatus", S), ("reason", S),
    ("email_id", S), ("email_from", S), ("email_from_name", S), ("email_to", S),
    ("email_subject", S), ("email_date", T.DateType()), ("email_preview", S), ("email_body", S),
    ("attachment_count", I),
)
BRONZE_MANIFEST = _struct(
    ("run_id", S), ("file_name", S), ("size_bytes", L), ("modify_time_ms", L),
    ("modify_time", T.TimestampType()),
)
