import json
import os

from pyspark.sql import functions as F

from ledgerlake.plans import medallion
from ledgerlake.sources import runs

INVOICE = {"invoices": [{
    "fileName": "invoice-1001.pdf", "invoiceId": "INV-1001", "vendorName": "Sample Vendor A",
    "invoiceDate": "2026-05-10", "dueDate": "2026-06-09", "currency": "USD", "totalAmount": 1234.56,
    "extractionStatus": "ok", "exchangeRate": 1.5, "convertedInvoiceAmount": 1851.84,
    "lineItems": [
        {"lineNo": "L1", "categoryName": "Hardware", "description": "Wireless keyboard", "quantity": 4,
         "unitPrice": 150.0, "lineTotal": 600.0, "convertedUnitPrice": 225.0, "convertedLineTotal": 900.0},
        {"lineNo": "L2", "categoryName": "Hardware", "description": "USB-C dock", "quantity": "2",
         "unitPrice": 200.0, "lineTotal": 400.0, "convertedUnitPrice": 300.0, "convertedLineTotal": 600.0}]}]}
INGESTION = {"ingestionStatus": "accepted", "reason": "invoice attached", "email": {
    "id": 42, "from": "billing@example.com", "fromName": "Billing", "to": "ap@example.com",
    "subject": "Invoice", "date": "2026-05-10T09:00:00Z", "preview": "p", "body": "b",
    "attachments": [{"name": "invoice-1001.pdf"}, {"name": "extra.png"}]}}


def _write(path, obj):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        if isinstance(obj, (dict, list)):
            json.dump(obj, f, indent=2)
        else:
            f.write(obj)


def make_root(tmp_path):
    root = str(tmp_path / "invoices")
    _write(f"{root}/run-001/invoice.json", INVOICE)
    rerun = json.loads(json.dumps(INVOICE))
    rerun["invoices"][0]["totalAmount"] = 1000.0
    _write(f"{root}/run-002/invoice.json", rerun)
    _write(f"{root}/run-002/ingestion.json", INGESTION)
    _write(f"{root}/run-002/result.json", {"ingestionStatus": "accepted", "reason": None})
    _write(f"{root}/run-002/invoice-1001.pdf", "%PDF-1.4")
    _write(f"{root}/run-002/invoice-1001.extract.md", "# text")
    _write(f"{root}/run-003/ingestion.json", {"ingestionStatus": "rejected", "reason": "no invoice",
                                              "email": {"date": "not a date"}})
    _write(f"{root}/email-20260510/ingestion.json", INGESTION)   # not a run folder
    return root


def test_discover_and_manifest(spark, tmp_path):
    root = make_root(tmp_path)
    assert sorted(r[0] for r in runs.discover_runs(spark, root).collect()) == ["run-001", "run-002", "run-003"]
    m = runs.run_manifest(spark, root)
    assert m.count() == 7
    r = m.filter(F.col("file_name") == "invoice-1001.pdf").first()
    assert r["run_id"] == "run-002" and r["size_bytes"] == 8 and r["modify_time"] is not None
    assert [x[0] for x in runs.supported_documents(m).select("file_name").collect()] == ["invoice-1001.pdf"]
    assert [x[0] for x in runs.latest_runs(m, 2).collect()] == ["run-003", "run-002"]


def test_read_json_per_run(spark, tmp_path):
    root = make_root(tmp_path)
    header, lines = runs.bronze_invoices(spark, root)
    assert sorted(r[0] for r in header.select("run_id").collect()) == ["run-001", "run-002"]
    assert header.filter(F.col("run_id") == "run-002").first()["totalAmount"] == 1000.0
    assert lines.count() == 4 and lines.filter(F.col("quantity") == 2.0).count() == 2   # "2" cast to double
    missing = runs.read_json_per_run(spark, root, "processing.json", runs.schemas.RESULT_FILE)
    assert missing.count() == 0 and "run_id" in missing.columns
    absent = runs.bronze_invoices(spark, str(tmp_path / "nowhere"))
    assert absent[0].count() == 0 and absent[1].count() == 0


def test_email_and_result(spark, tmp_path):
    root = make_root(tmp_path)
    em = {r["run_id"]: r for r in runs.bronze_ingestion_email(spark, root).collect()}
    assert set(em) == {"run-002", "run-003"}
    assert em["run-002"]["attachment_count"] == 2 and str(em["run-002"]["email_date"]) == "2026-05-10"
    assert em["run-003"]["email_date"] is None and em["run-002"]["email_id"] == "42"
    res = runs.bronze_run_result(spark, root).first()
    assert res["run_id"] == "run-002" and json.loads(res["result_json"]) == {"ingestionStatus": "accepted"}


def test_result_documents_are_kept_whole(spark, tmp_path):
    root = str(tmp_path / "in")
    docs = {"run-1": {"email": {"id": 1, "cc": "c@x", "to": None}, "draft": {"a": [1, 2]}, "invoices": [{"poNumber": "P1", "n": 1.5}]},
            "run-2": {"ingestionStatus": "accepted", "extra": None}}
    for run, doc in docs.items():
        _write(f"{root}/{run}/result.json", doc)
    got = {r["run_id"]: json.loads(r["result_json"]) for r in runs.bronze_run_result(spark, root).collect()}
    assert got == {"run-1": {"email": {"id": 1, "cc": "c@x"}, "draft": {"a": [1, 2]}, "invoices": [{"poNumber": "P1", "n": 1.5}]},
                   "run-2": {"ingestionStatus": "accepted"}}
    assert runs.bronze_run_result(spark, str(tmp_path / "none")).count() == 0


def test_run_id_agrees_with_the_manifest_under_a_run_folder(spark, tmp_path):
    root = str(tmp_path / "run-99" / "invoices")
    _write(f"{root}/run-7/invoice.json", INVOICE)
    header, lines = runs.bronze_invoices(spark, root)
    ids = {r[0] for df in (header, lines, runs.run_manifest(spark, root)) for r in df.select("run_id").collect()}
    assert ids == {"run-7"}


def test_medallion_from_folders(spark, tmp_path):
    root = make_root(tmp_path)
    out = medallion.run_from_folders(spark, root)
    assert out["silver"]["silver_invoice"].count() == 1
    assert out["silver"]["silver_invoice"].first()["run_id"] == "run-002"
    assert spark.table("gold.gold_spend_by_vendor_month").count() == 1
    assert out["silver"]["silver_invoice_lineitem"].count() == 2 and out["bronze"]["bronze_run_result"].count() == 1
    lat = spark.table("obs.obs_stage_latency").filter(F.col("run_id") == "run-002").first()
    assert lat["ingested"] is not None and lat["final"] is not None and lat["agent_input"] is None
    dq = {r["rule"] for r in spark.table("silver.silver_dq_issues").collect()}
    # the re-run's total (1000) equals its lines, but 1000 x 1.5 is not the converted 1851.84
    assert dq == {"fx_inconsistent"}
