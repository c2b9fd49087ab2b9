"""What happens where one key has several rows and where values are empty."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import jsonops as J
from ledgerlake.operators import ledger as L
from ledgerlake.operators import rules as R
from ledgerlake.plans.model import Model
from ledgerlake.sources import driver

from .conftest import SF_SMALL, rows
from .test_plans import _plan

DOCUMENT = "invoiceId string, run_id string, source_path string, fileName string, businessName string, vendorName string, invoiceCurrency string, currency string"


def test_the_last_item_with_a_code_has_the_price(spark):
    items = spark.createDataFrame([("1", 1.0, 1), ("1", 2.0, 3), ("1", 9.0, 2), ("2", 5.0, 4), ("2", None, 5)],
                                  "ledgerCode string, expectedUnitPrice double, item_position int")
    records = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None)], "k string, ledgerCode string")
    assert rows(L.expected_price_lookup(records, items), "k", "ledgerExpectedUnitPrice") == [("a", 2.0), ("b", None), ("c", None)]


def test_the_last_document_names_currency_and_business(spark):
    docs = spark.createDataFrame([
        ("I1", "run-2", "p", "f", "", "Vendor", "", "USD"), ("I1", "run-1", "p", "f", "Old Ltd", "Old", "EUR", "EUR"),
        ("I2", "run-1", "p", "a", "", "", "", ""), ("I3", "run-1", "p", "b", "B", "V", "NZD", "AUD"), ("I3", "run-1", "p", "a", "A", "V", "X", "Y")], DOCUMENT)
    assert rows(L.invoice_currency(docs)) == [("I1", "USD"), ("I2", None), ("I3", "NZD")]
    records = spark.createDataFrame([(i, "1", s, "record", "d", 1.0, "R5", "r") for i, s in (("I1", "exception"), ("I2", "Review"), ("I3", "review"), ("I9", "matched"))],
                                    "invoiceId string, lineNo string, status string, businessName string, lineItemDescription string, lineTotal double, ruleApplied string, reason string")
    assert rows(R.exception_queue(records, docs), "invoiceId", "vendorName", "kind") == [
        ("I1", "Vendor", "exception"), ("I2", "record", "review"), ("I3", "B", "review")]


ATTACHMENTS = "run_id string, attachments array<struct<name:string,blobUrl:string>>"


def test_the_last_upload_of_a_name_counts(spark):
    emails = spark.createDataFrame([("r1", [("a", None), ("b", "own"), ("", "e"), (None, "n"), ("a", "x")]), ("r2", []), ("r3", None), ("r4", [("a", None)])], ATTACHMENTS)
    up = spark.createDataFrame([("r1", "a", "first", 1), ("r1", "a", "last", 2), ("r1", "", "no", 1), ("r2", "a", "u", 1), ("r1", "other", "o", 1)],
                               "run_id string, name string, blobUrl string, position int")
    got = {r["run_id"]: r["attachments"] and [tuple(a) for a in r["attachments"]] for r in J.merge_attachment_urls(emails, up).collect()}
    assert got == {"r1": [("a", "last"), ("b", "own"), ("", "e"), (None, "n"), ("a", "last")], "r2": [], "r3": None, "r4": [("a", None)]}


def test_a_run_with_many_uploads_gathers_only_what_its_emails_name(spark):
    up = spark.range(100_000).select(F.lit("r1").alias("run_id"), F.concat(F.lit("f"), F.col("id").cast("string")).alias("name"),
                                     F.concat(F.lit("u"), F.col("id").cast("string")).alias("blobUrl"), F.lit(1).alias("position"))
    emails = spark.createDataFrame([("r1", [("f7", None), ("f99999", None), ("g", None)])], ATTACHMENTS)
    merged = J.merge_attachment_urls(emails, up)
    assert [a["blobUrl"] for a in merged.first()["attachments"]] == ["u7", "u99999", None]
    plan = _plan(merged)
    assert plan.index("collect_list") < plan.index("LeftSemi")  # the map is built above the semi join


@pytest.mark.parametrize("each", [2, 50])
def test_documents_hold_all_lines_in_order_and_no_more_than_asked(spark, each):
    docs = driver.documents_of(spark, SF_SMALL, each).select("run_id", "invoice.fileName", F.col("invoice.lineItems").alias("l")).collect()
    numbers = [[int(x["lineNo"]) for x in d["l"]] for d in docs if d["l"]]
    assert all(n == sorted(n) and n[-1] - n[0] < each for n in numbers)
    bronze = driver.bronze_lines(spark, SF_SMALL)
    assert sum(map(len, numbers)) == bronze.count()
    orders = driver.bronze_header(spark, SF_SMALL).select("run_id", "fileName").distinct().count()
    assert (len(docs) == orders) if each == 50 else len(docs) > orders


def test_the_mapping_reaches_these_cases(spark):
    m = Model(spark, SF_SMALL)
    assert m.ledger_items.groupBy("ledgerCode").count().where("count > 1").count() > 0
    assert m.bronze_header.where("businessName = ''").count() and m.bronze_header.where("invoiceCurrency = ''").count()
    assert m.bronze_header.where("businessName like '% Ltd'").count()
    assert driver.uploads(m.bronze_email).where("position = 2").count()


def test_the_master_is_left_to_spark_submit():
    code = "from ledgerlake.session import build_session; s = build_session(); print('master', s.sparkContext.master); s.stop()"
    env = {**os.environ, "PYSPARK_SUBMIT_ARGS": "--master local[3] pyspark-shell"}
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, env=env, timeout=120, check=True,
                         cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__)))).stdout
    assert "master local[3]" in out
