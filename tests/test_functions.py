import datetime as dt

from pyspark.sql import functions as F

from ledgerlake.functions import columns as C


def test_run_id_from_path(spark):
    df = spark.createDataFrame([("abfss://x/Files/invoices/run-20260510123000/invoice.json",),
                                ("/data/email-20260510/ingestion.json",), (None,)], "p string")
    got = [r[0] for r in df.select(C.run_id_from_path("p")).collect()]
    assert got == ["run-20260510123000", "", None]


def test_run_id_is_the_last_folder(spark):
    df = spark.createDataFrame([("/data/run-99/invoices/run-7/invoice.json",), ("/data/run-99/notes/invoice.json",)], "p string")
    assert [r[0] for r in df.select(C.run_id_from_path("p")).collect()] == ["run-7", ""]


def test_long_numbers_are_not_cut_in_run_ids(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 2), n) for n in (7, 100_000, 1_000_000, 1_000_009)], "d date, n long")
    got = [r[0] for r in df.select(C.run_id_of("d", "n")).collect()]
    assert got == ["run-20240102000007", "run-20240102100000", "run-202401021000000", "run-202401021000009"]


def test_descriptive_fields(spark):
    df = spark.createDataFrame([("V", "2024-01-01", None, 5.0, "USD")],
                               "vendorName string, invoiceDate string, dueDate string, totalAmount double, currency string")
    r = C.with_descriptive_fields(df).first()
    assert (r["businessName"], r["fromDate"], r["toDate"], r["invoiceAmount"], r["invoiceCurrency"],
            r["convertedInvoiceCurrency"]) == ("V", "2024-01-01", "", 5.0, "USD", "AUD")


def test_stage_classification_order(spark):
    names = ["a.pdf", "x.extract.md", "extract.json", "doc.extracted.json", "processing-agentinput.json",
             "processing-agentoutput.json", "processing.json", "invoice.json", "result.json",
             "ingestion.json", "notes.txt", "scan.png"]
    df = spark.createDataFrame([(n,) for n in names], "file_name string")
    got = dict(df.select("file_name", C.classify_stage("file_name")).collect())
    assert got == {
        "a.pdf": "ingested", "x.extract.md": "ocr", "extract.json": "ocr",
        "doc.extracted.json": "other",  # *.extracted.json is not extract.json
        "processing-agentinput.json": "agent_input", "processing-agentoutput.json": "agent_output",
        "processing.json": "normalized", "invoice.json": "final", "result.json": "result",
        "ingestion.json": "ingestion", "notes.txt": "other", "scan.png": "other"}


def test_supported_documents(spark):
    df = spark.createDataFrame([(n,) for n in ["a.PDF", "b.jpeg", "c.Jpg", "d.png", "e.gif", "pdf"]], "n string")
    got = sorted(r[0] for r in df.filter(C.is_supported_document("n")).collect())
    assert got == ["a.PDF", "b.jpeg", "c.Jpg", "d.png"]


def test_dates_are_lenient(spark):
    df = spark.createDataFrame([("2026-05-10",), ("10/05/2026",), (None,)], "d string")
    got = df.select(C.invoice_month("d").alias("m"), C.due_week("d").alias("w")).collect()
    assert got[0]["m"] == "2026-05" and got[0]["w"] == dt.datetime(2026, 5, 4)  # Monday
    assert got[1]["m"] is None and got[1]["w"] is None
    assert got[2]["m"] is None


def test_format_money(spark):
    df = spark.createDataFrame([(1234.5, "AUD"), (None, "AUD"), (float("nan"), None), (7.0, None), (1e37, None)],
                               "a double, c string")
    got = [r[0] for r in df.select(C.format_money("a", F.col("c"))).collect()]
    assert got[:4] == ["AUD 1234.50", "—", "—", "USD 7.00"]
    assert float(got[4].split()[1]) == 1e37             # too large for the decimal, printed all the same


def test_rounding_modes(spark):
    df = spark.createDataFrame([(2.675,), (0.125,), (-1.005,)], "x double")
    up = [r[0] for r in df.select(C.round_half_up("x")).collect()]
    even = [r[0] for r in df.select(C.round_half_even(F.col("x").cast("decimal(10,3)"))).collect()]
    assert up == [2.68, 0.13, -1.01]
    assert [float(v) for v in even] == [2.68, 0.12, -1.0]


def test_detail_text_skips_nulls(spark):
    df = spark.createDataFrame([(-234.56,), (None,)], "d double")
    got = [r[0] for r in df.select(C.detail_text("diff=", F.col("d"))).collect()]
    assert got == ["diff= -234.56", "diff="]
