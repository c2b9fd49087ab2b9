"""Small domain fixtures (invoice headers and lines) covering the edge cases."""

from ledgerlake import schemas

H = [f.name for f in schemas.BRONZE_HEADER.fields]


def header(run_id, invoice_id, vendor="Vendor A", invoice_date="2026-05-10", due_date="2026-06-09",
           currency="USD", total=100.0, status="ok", rate=1.5, converted=150.0, source=None, file_name="a.pdf"):
    row = dict.fromkeys(H)
    row.update(run_id=run_id, source_path=source or f"/inv/{run_id}/invoice.json", fileName=file_name,
               invoiceId=invoice_id, vendorName=vendor, invoiceDate=invoice_date, dueDate=due_date,
               currency=currency, totalAmount=total, extractionStatus=status, exchangeRate=rate,
               convertedInvoiceAmount=converted, businessName=vendor, invoiceCurrency=currency)
    return tuple(row[c] for c in H)


def line(run_id, invoice_id, line_no, total, converted, vendor="Vendor A", category="Hardware",
         description="item", qty=1.0, unit=None, conv_unit=None):
    return (run_id, None, invoice_id, vendor, line_no, category, description, qty,
            unit if unit is not None else total, total, conv_unit if conv_unit is not None else converted, converted)


def frames(spark, headers, lines):
    return (spark.createDataFrame(headers, schemas.BRONZE_HEADER),
            spark.createDataFrame(lines, schemas.BRONZE_LINE))


# Ten dated rates in the shape of the app's rate file (fixed values).
REFERENCE_FX_RATES = (
    ("USD", "AUD", "2025-01-01", "2025-03-31", "1.58"),
    ("USD", "AUD", "2025-04-01", "2025-06-30", "1.56"),
    ("USD", "AUD", "2025-07-01", "2025-09-30", "1.54"),
    ("USD", "AUD", "2025-10-01", "2025-12-31", "1.55"),
    ("USD", "AUD", "2026-01-01", None, "1.57"),
    ("EUR", "AUD", "2025-01-01", "2025-03-31", "1.67"),
    ("EUR", "AUD", "2025-04-01", "2025-06-30", "1.65"),
    ("EUR", "AUD", "2025-07-01", "2025-09-30", "1.63"),
    ("EUR", "AUD", "2025-10-01", "2025-12-31", "1.64"),
    ("EUR", "AUD", "2026-01-01", None, "1.66"),
)


def reference_rates(spark):
    """The rates with their list position."""
    rows = [(*r, i) for i, r in enumerate(REFERENCE_FX_RATES)]
    raw = spark.createDataFrame(rows, "from string, to string, fromDate string, toDate string, rate string, position int")
    return raw.withColumn("rate", raw.rate.cast("decimal(18,6)"))
