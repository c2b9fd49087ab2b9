"""Fixed values that must equal the reference's for results to agree.

Everything here is data, stated plainly and in its natural order.
"""

from __future__ import annotations

# --- fixed values: run folders -------------------------------------------
RUN_PREFIX = "run-"
RUN_ID_PATTERN = r"run-\d+"
RUN_LIST_LIMIT = 20
SUPPORTED_DOCUMENT_EXTENSIONS = (".pdf", ".png", ".jpg", ".jpeg")

# --- fixed values: stage classification of run files ----------------------
# (match kind, pattern, stage) checked in this order; anything else is "other".
STAGE_RULES = (
    ("suffix", ".pdf", "ingested"),
    ("suffix", "extract.md", "ocr"),
    ("suffix", "extract.json", "ocr"),
    ("equals", "processing-agentinput.json", "agent_input"),
    ("equals", "processing-agentoutput.json", "agent_output"),
    ("equals", "processing.json", "normalized"),
    ("equals", "invoice.json", "final"),
    ("equals", "result.json", "result"),
    ("equals", "ingestion.json", "ingestion"),
)
OTHER_STAGE = "other"
# Pivot columns of obs_stage_latency, in output order ("ingestion" is
# classified but not selected).
LATENCY_STAGES = ("ingested", "ocr", "agent_input", "agent_output", "normalized", "final", "result")
PIVOT_STAGES = LATENCY_STAGES + ("ingestion",)

# --- fixed values: header columns of invoice.json --------------------------
HEADER_COLUMNS = (
    "fileName", "blobUrl", "invoiceId", "vendorName", "vendorEmail",
    "invoiceDate", "dueDate", "paymentTerms", "currency", "totalAmount",
    "documentType", "extractionStatus", "extractionNotes", "businessName",
    "fromDate", "toDate", "invoiceAmount", "invoiceCurrency",
    "exchangeRate", "convertedInvoiceAmount", "convertedInvoiceCurrency",
)
LINE_NUMERIC_COLUMNS = ("quantity", "unitPrice", "lineTotal", "convertedUnitPrice", "convertedLineTotal")

# --- fixed values: data-quality rules --------------------------------------
LINE_TOTAL_TOLERANCE = 0.01
FX_TOLERANCE_PCT = 0.01
REQUIRED_HEADER_FIELDS = ("invoiceId", "vendorName", "invoiceDate", "totalAmount", "currency")
EXTRACTION_OK = "ok"

# --- fixed values: matching rules R1-R5, the defaults ------------------------------------
RULE_EXACT_PRICE_DELTA = 0.01          # R1: |unit - expected| < 0.01
RULE_TOLERANCE_PERCENT = 10.0          # R2
RULE_TOLERANCE_ABSOLUTE = 50.0         # R2
RULE_HIGH_VALUE_THRESHOLD = 5000.0     # R4

# --- fixed values: currencies ----------------------------------------------
LEDGER_CURRENCY = "AUD"
DEFAULT_MONEY_CURRENCY = "USD"
MISSING_MONEY_TEXT = "—"
FX_SENSITIVITY_UP = 1.05
FX_SENSITIVITY_DOWN = 0.95

# --- fixed values: mapping of the benchmark tables (our own choices) -------
# Region key -> invoice currency.  AFRICA has no FX rate on purpose.
REGION_CURRENCY = ((0, "ZAR"), (1, "USD"), (2, "AUD"), (3, "EUR"), (4, "AUD"))
# Order priority -> (payment terms, due offset in days); PREPAID is due
# before the invoice date.
PRIORITY_TERMS = (
    ("1-URGENT", "PREPAID", -7),
    ("2-HIGH", "NET 14", 14),
    ("3-MEDIUM", "NET 30", 30),
    ("4-NOT SPECIFIED", "NET 30", 30),
    ("5-LOW", "NET 45", 45),
)
# Orders with this status were extracted partially and re-run a week later.
RERUN_ORDER_STATUS = "P"
RERUN_DELAY_DAYS = 7
# (event type, event_id mod 3) -> run file name for the manifest built from
# `events`: every stage occurs, and one file that is none.
EVENT_FILE_NAMES = (
    ("view", 0, "email.pdf"), ("view", 1, "extract.md"), ("view", 2, "email.pdf"),
    ("click", 0, "processing-agentinput.json"), ("click", 1, "processing-agentoutput.json"), ("click", 2, "processing.json"),
    ("signup", 0, "ingestion.json"), ("signup", 1, "ingestion.json"), ("signup", 2, "notes.txt"),
    ("purchase", 0, "invoice.json"), ("purchase", 1, "invoice.json"), ("purchase", 2, "processing.json"),
    ("error", 0, "result.json"), ("error", 1, "result.json"), ("error", 2, "email.pdf"),
)
# The benchmark's rows are too clean to reach every rule, so some are spoiled by
# rule: a value applies where key mod the first number is the second.
FIELD_MISSING = (("invoiceId", 113, 5), ("vendorName", 101, 5), ("invoiceDate", 107, 5),
                 ("totalAmount", 109, 5), ("currency", 103, 5))      # by order key
STILL_FAILED = (17, 3)          # re-runs that fail again, by order key
TOTAL_AS_ORDERED = (10, 7)      # totals that are not the sum of the lines, by order key
UNNAMED_PART = (11, 4)          # lines whose description names no ledger item, by part key
ITEM_NAME_ONLY = (9, 1)         # lines whose description is the item's name alone, by part key
UNLISTED_CATEGORY = (13, 6)     # lines of a category the ledger does not have, by part key
LIST_PRICE = (7, 2)             # lines at the part's list price, by part key
VENDOR_ALIAS = (5, 0)           # ledger items that list a vendor as an alias, by item code
SHARED_CODE = (40, 7)           # ledger items that have the code of the part before theirs, by item position
NO_BUSINESS_NAME = (19, 8)      # documents with an empty businessName, by order key
CORRECTED_BUSINESS = (11, 2)    # re-runs that name the business otherwise, by order key
NO_INVOICE_CURRENCY = (23, 9)   # documents with an empty invoiceCurrency, by order key
UPLOADED_TWICE = (4, 1)         # emails whose first attachment is uploaded a second time, by email id
NO_INGESTION_FILE = (7, 3)      # emails whose run folder has no ingestion.json, by email id
RERUN_DAY = (10, 0)             # days of the month whose run files are written again
LINES_PER_DOCUMENT = 50         # an invoice's lines are written in documents of so many at most
# Generated FX periods for the benchmark years: quarterly, per currency.
FX_GENERATED_FIRST_YEAR = 1994
FX_GENERATED_LAST_YEAR = 2002
FX_GENERATED_BASE = (("USD", 1.55), ("EUR", 1.64))
# Rules files of the benchmark (fields as in the rules table): the shipped one
# and one that a customer has changed, with another limit, other outcomes, a
# person to look at near prices and no rule for prices that are off.
RULE_FIELDS = ("id", "outcome", "humanInLoop", "tolerancePercent", "toleranceAbsolute", "thresholdAmount")
SHIPPED_RULES = (("R1", "matched", None, None, None, None),
                 ("R2", "matched", None, RULE_TOLERANCE_PERCENT, RULE_TOLERANCE_ABSOLUTE, None),
                 ("R3", "review", True, None, None, None),
                 ("R4", "review", True, None, None, RULE_HIGH_VALUE_THRESHOLD),
                 ("R5", "exception", None, None, None, None))
CHANGED_RULES = (("R1", "matched", None, None, None, None),
                 ("R2", "review", True, 2.0, None, None),
                 ("R4", "exception", False, None, None, 20000.0),
                 ("R5", "review", True, None, None, None))
