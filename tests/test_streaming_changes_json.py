import json
import os
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.functions import jsonops as J
from ledgerlake.operators import changes
from ledgerlake.sources import runs
from ledgerlake.streaming import incremental

from .test_sources import INVOICE, _write


def test_incremental_ingest_reads_only_new_runs(spark, tmp_path):
    root, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    _write(f"{root}/run-001/invoice.json", INVOICE)
    incremental.ingest_invoices(spark, root, out, ck)
    assert spark.read.parquet(os.path.join(out, "bronze_invoice_header")).count() == 1
    _write(f"{root}/run-002/invoice.json", INVOICE)
    incremental.ingest_invoices(spark, root, out, ck)
    h = spark.read.parquet(os.path.join(out, "bronze_invoice_header"))
    assert sorted(r[0] for r in h.select("run_id").collect()) == ["run-001", "run-002"]
    assert spark.read.parquet(os.path.join(out, "bronze_invoice_lineitem")).count() == 4


def test_a_retried_batch_writes_its_rows_once(spark, tmp_path):
    files = spark.createDataFrame([("/x/run-1/invoice.json", json.dumps(INVOICE))], "p string, t string")
    parsed = runs.tagged(files.select("p", J.parse_json("t", schemas.INVOICE_FILE).alias("f")).select("p", "f.invoices"), F.col("p")).drop("p")
    out = str(tmp_path / "out")
    for batch_id in (0, 1, 1):
        incremental.write_tables(parsed, out, batch_id)
    assert spark.read.parquet(f"{out}/bronze_invoice_header").count() == 2
    assert spark.read.parquet(f"{out}/bronze_invoice_lineitem").count() == 4


def test_folders_of_other_names_stay_out_of_the_stream(spark, tmp_path):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    _write(f"{root}/run-7/invoice.json", INVOICE)
    _write(f"{root}/run-old/invoice.json", INVOICE)
    incremental.ingest_invoices(spark, root, out, str(tmp_path / "ck"))
    assert [r[0] for r in spark.read.parquet(f"{out}/bronze_invoice_header").select("run_id").collect()] == ["run-7"]


ENTRY = "Id string, InvoiceNumber string, Vendor string, Account string, Amount decimal(18,2), " \
        "Currency string, EntryDate timestamp, Status string, Description string"


def test_ledger_changes(spark):
    entries = spark.createDataFrame(
        [("a", "INV-1", "Acme", "6000", Decimal("10.00"), "USD", None, "posted", "x"),
         ("b", "INV-2", "Contoso", "6200", Decimal("20.00"), "USD", None, "pending", "y")], ENTRY)
    ch = spark.createDataFrame([
        ("update", "a", None, None, None, Decimal("11.00"), None, None, None, None, 1),
        ("update", "a", None, None, None, None, None, None, "approved", None, 2),
        ("delete", "b", None, None, None, None, None, None, None, None, 3),
        ("update", "b", None, None, None, Decimal("99.00"), None, None, None, None, 4),   # after delete: not found
        ("add", "c", "INV-3", "Fabrikam", "6100", Decimal("5.00"), None, None, None, None, 5),
        ("update", "c", None, None, None, None, "EUR", None, None, None, 6),
        ("update", "zz", None, None, None, Decimal("1.00"), None, None, None, None, 7),    # unknown id
    ], "op string, " + ENTRY + ", seq int")
    got = {r["Id"]: r for r in changes.apply_changes(entries, ch).collect()}
    assert set(got) == {"a", "c"}
    assert got["a"]["Amount"] == Decimal("11.00") and got["a"]["Status"] == "approved" and got["a"]["Vendor"] == "Acme"
    assert got["c"]["Currency"] == "EUR" and got["c"]["Status"] == "pending" and got["c"]["EntryDate"] is not None


def test_extract_agent_json(spark):
    df = spark.createDataFrame([("Here you go:\n```json\n{\"a\": 1,\n \"b\": {\"c\": 2}}\n```\nThanks",),
                                ("no json here",), ("{not json}",)], "t string")
    got = [r[0] for r in df.select(J.parse_agent_json("t", "struct<a:int, b:struct<c:int>>").alias("j")).collect()]
    assert got[0]["a"] == 1 and got[0]["b"]["c"] == 2
    assert got[1] is None
    assert got[2] is None or got[2]["a"] is None


def test_invoice_array_shapes(spark):
    one = {"invoiceId": "INV-1", "totalAmount": 5}
    df = spark.createDataFrame([(json.dumps([one, one]),), (json.dumps({"invoices": [one]}),), (json.dumps(one),),
                                (json.dumps({"x": 1}),), ("garbage",)], "t string")
    got = [len(r["invoices"]) for r in J.with_invoice_array(df, "t").collect()]
    assert got == [2, 1, 1, 0, 0]


def test_unwrap_email(spark):
    df = spark.createDataFrame([(json.dumps({"email": {"subject": "wrapped"}}),),
                                (json.dumps({"subject": "bare"}),)], "t string")
    assert [r[0] for r in df.select(J.unwrap_email("t")["subject"]).collect()] == ["wrapped", "bare"]


def test_attachment_merge(spark):
    emails = spark.createDataFrame(
        [("run-1", [("a.pdf", None, None), ("b.pdf", "old", None), ("c.pdf", None, None)]), ("run-2", None)],
        "run_id string, attachments array<struct<name:string, blobUrl:string, invoiceId:string>>")
    uploads = spark.createDataFrame([("run-1", "a.pdf", "url-a"), ("run-1", "b.pdf", "url-b")],
                                    "run_id string, name string, blobUrl string")
    got = {r["run_id"]: r["attachments"] for r in J.merge_attachment_urls(emails, uploads).collect()}
    assert [(a["name"], a["blobUrl"]) for a in got["run-1"]] == [("a.pdf", "url-a"), ("b.pdf", "url-b"), ("c.pdf", None)]
    assert got["run-2"] is None


def test_overlay_later_nodes_win(spark):
    docs = spark.createDataFrame([
        ("run-1", 1, json.dumps({"email": {"x": 1}, "ingestionStatus": "pending"})),
        ("run-1", 2, json.dumps({"ingestionStatus": "accepted", "invoices": [1, 2]})),
        ("run-1", 3, json.dumps({"LedgerMatched": []}))], "run_id string, stage int, doc string")
    got = {r["node"]: r["value"] for r in J.overlay_nodes(docs, "run_id", ["stage"], "doc").collect()}
    assert got["ingestionStatus"] == '"accepted"' and json.loads(got["email"]) == {"x": 1}
    assert json.loads(got["invoices"]) == [1, 2] and json.loads(got["LedgerMatched"]) == []


def test_overlaid_document_is_rebuilt_on_its_base(spark):
    base = spark.createDataFrame([
        ("r1", "ingestion.json", json.dumps({"email": {"cc": "x", "n": None}, "reason": "a"})),
        ("r1", "result.json", json.dumps({"reason": "b", "draft": [1, {"po\"q": 2.5}]})),
        ("r2", "ingestion.json", json.dumps({"email": {"cc": "y"}, "reason": None})),
        ("r3", "ingestion.json", "not json"), ("r4", "other.json", "{}")], "run_id string, file string, doc string")
    updates = spark.createDataFrame([("r1", 1, json.dumps({"reason": "c"})), ("r1", 2, json.dumps({"reason": "d", "new": True})),
                                     ("r3", 1, json.dumps({"reason": "fresh"}))], "run_id string, step int, doc string")
    nodes = J.result_overlay(base, updates, "run_id", "file", ["step"], "doc")
    got = {r["run_id"]: json.loads(r["document"]) for r in J.overlay_documents(nodes, "run_id").collect()}
    assert got == {"r1": {"reason": "d", "draft": [1, {"po\"q": 2.5}], "new": True},
                   "r2": {"email": {"cc": "y"}, "reason": None}, "r3": {"reason": "fresh"}}


def test_ledger_changes_struct_sequence(spark):
    """Calls ordered by a struct (date, then line): the later line of the
    same day wins, and an update before the last reset is dropped."""
    entries = spark.createDataFrame(
        [("a", "INV-1", "Acme", "6000", Decimal("10.00"), "USD", None, "posted", "x")], ENTRY)
    seq = "struct<d: string, n: int>"
    ch = spark.createDataFrame([
        ("update", "a", Decimal("12.00"), None, {"d": "2024-01-02", "n": 1}),
        ("add", "a", Decimal("30.00"), None, {"d": "2024-01-01", "n": 9}),
        ("delete", "a", None, None, {"d": "2024-01-01", "n": 2}),
        ("update", "a", None, "approved", {"d": "2024-01-01", "n": 3}),   # before the add: dropped
        ("add", "n", Decimal("1.00"), None, {"d": "2024-01-01", "n": 1}),
        ("add", "n", Decimal("2.00"), None, {"d": "2024-01-01", "n": 4}),
    ], f"op string, Id string, Amount decimal(18,2), Status string, seq {seq}")
    for f in ("InvoiceNumber", "Vendor", "Account", "Currency", "Description"):
        ch = ch.withColumn(f, F.lit(None).cast("string"))
    ch = ch.withColumn("EntryDate", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    out = {r["Id"]: r for r in changes.apply_changes(entries, ch).collect()}
    assert out["a"]["Amount"] == Decimal("12.00") and out["a"]["Status"] == "pending"
    assert out["n"]["Amount"] == Decimal("2.00") and out["n"]["Currency"] == "USD"
