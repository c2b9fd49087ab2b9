"""What the layers and the operators over them leave out: shuffles, listings on
the driver, code that the JVM does not compile."""

import re
from contextlib import contextmanager
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import changes as C
from ledgerlake.operators import gold, silver
from ledgerlake.operators import ledger as L
from ledgerlake.operators import rules as R
from ledgerlake.plans.model import Model
from ledgerlake.sources import driver, folders, runs, tables

from .conftest import SF_SMALL, rows
from .fixtures import frames, header, line
from .test_plans import _plan


@contextmanager
def _set(spark, **conf):
    old = {k: spark.conf.get(k.replace("_", ".")) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k.replace("_", "."), v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k.replace("_", "."), v)


def test_silver_shuffles_neither_headers_nor_lines(spark):
    """Bronze lies in buckets of the invoice."""
    m = Model(spark, SF_SMALL)
    with _set(spark, spark_sql_autoBroadcastJoinThreshold="-1"):
        for df in (silver.latest_headers(m.bronze_header), silver.latest_lines(m.bronze_lines, m.silver_invoice)):
            p = _plan(df)
            assert "Exchange" not in p, p
    assert all(len(set(df.inputFiles())) for df in (m.bronze_header, m.bronze_lines, m.silver_invoice, m.silver_lines))


def test_bucketed_silver_keeps_the_lines_of_the_last_run(spark):
    hdr, lines = frames(spark, [header("r1", "A"), header("r2", "A"), header("r1", "B"), header("r1", None)],
                        [line("r1", "A", "1", 1.0, 1.0), line("r2", "A", "1", 2.0, 2.0), line("r2", "A", "1", 2.0, 2.0),
                         line("r1", "B", "1", 3.0, 3.0), line("r2", "B", "1", 4.0, 4.0), line("r1", None, "1", 5.0, 5.0)])
    tables.create_schema(spark, "layertest")
    for name, df in (("h", hdr), ("l", lines)):
        tables.write_buckets(df, f"layertest.{name}", "invoiceId", 3, placed=True, ordered=False)
    got = silver.latest_lines(spark.table("layertest.l"), silver.latest_headers(spark.table("layertest.h")))
    assert rows(got, "run_id", "invoiceId", "lineTotal") == [("r1", "B", 3.0), ("r2", "A", 2.0), ("r2", "A", 2.0)]


def test_classification_is_compiled(spark):
    """HotSpot interprets methods of over 8,000 bytes."""
    items = spark.createDataFrame([("Hardware", "1", "item", 10.0, None, 1)],
                                  "categoryName string, ledgerCode string, itemName string, expectedUnitPrice double, aliases array<string>, item_position int")
    categories = spark.createDataFrame([("Hardware", 1.0, 1.0)], "categoryName string, approvedBudget double, ytdBalance double")
    lines = frames(spark, [], [line("r", "A", "1", 10.0, 10.0)])[1]
    rules = spark.createDataFrame([("R2", "review", True, 2.0, None, None)],
                                  "id string, outcome string, humanInLoop boolean, tolerancePercent double, toleranceAbsolute double, thresholdAmount double")
    explain = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    with _set(spark, spark_sql_adaptive_enabled="false"):
        for rule_set in (R.Thresholds(), R.rules_of(rules)):
            for df in (R.classify_aud(L.match_global(lines, items), rule_set), R.classify_category(L.match_in_category(lines, items, categories), rule_set)):
                sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", df._jdf.queryExecution().explainString(explain))]
                assert sizes and max(sizes) <= 8000, sizes


def test_levels_are_summed_from_the_finest(spark):
    """rows are summed before they are multiplied by the levels."""
    df = spark.createDataFrame([("v", "a", 0.1), ("v", "a", 0.2), ("v", None, 1.0), ("w", "a", None)], "v string, c string, m double")
    out = gold.measures_by_levels(df, ["v", "c"], [["v", "c"], ["v"], []], ["m"])
    assert "HashAggregate" in _plan(out).split("Expand", 1)[1]
    assert rows(out, "level", "v", "c", "sum_m") == rows(spark.createDataFrame([
        (0, "v", "a", 0.3), (0, "v", None, 1.0), (0, "w", "a", None), (1, "v", None, 1.3), (1, "w", None, None), (3, None, None, 1.3)],
        "level long, v string, c string, sum_m double"))


def test_lines_of_documents_are_shuffled_once_by_their_order(spark):
    """F11, F12."""
    with _set(spark, spark_sql_autoBroadcastJoinThreshold="-1"):
        p = _plan(driver.documents_of(spark, SF_SMALL))
    assert "hashpartitioning(l_orderkey" not in p and "hashpartitioning(_inv" in p and ", part" not in "".join(re.findall(r"hashpartitioning\([^)]*\)", p))


ENTRY = "Id string, InvoiceNumber string, Vendor string, Account string, Amount decimal(18,2), Currency string, EntryDate timestamp, Status string, Description string"


def test_merged_entries_are_written_where_the_join_has_them(spark):
    """one file a bucket without a shuffle of the merged entries."""
    spark.sql("CREATE SCHEMA IF NOT EXISTS placedbook")
    entries = spark.range(200).select(*[(F.concat(F.lit("I"), F.col("id").cast("string")) if n == "Id" else F.lit(None).cast(t)).alias(n)
                                        for n, t in (c.split(" ") for c in ENTRY.split(", "))])
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    C.save_entries(entries, "placedbook.opening", n)
    ch = spark.createDataFrame([("update", "I7", Decimal("5.00"), 1), ("delete", "I8", None, 2), ("add", "J", None, 3)], "op string, Id string, Amount decimal(18,2), seq int")
    ch = ch.select("*", *[F.lit(None).cast(t).alias(c) for c, t in (x.split(" ") for x in ENTRY.split(", ")) if c not in ch.columns])
    C.save_entries(C.apply_changes(C.list_entries(spark, "placedbook.opening"), ch), "placedbook.entries", n, merged=True)
    saved = C.list_entries(spark, "placedbook.entries")
    assert saved.count() == 200 and len(saved.inputFiles()) <= n
    assert C.get_entry(spark, "placedbook.entries", "I7").first()["Amount"] == Decimal("5.00")
    assert C.get_entry(spark, "placedbook.entries", "I8").count() == 0 and C.get_entry(spark, "placedbook.entries", "J").count() == 1


@pytest.fixture
def run_root(spark, tmp_path):
    files = spark.createDataFrame([
        ("run-1", "ingestion.json", '{"ingestionStatus": "accepted", "email": {"id": 7, "body": "é\\nx", "attachments": [{"name": "a"}]}}'),
        ("run-1", "a.PDF", "%PDF"), ("run-2", "ingestion.json", "no json"), ("run-2", "result.json", '{"a": null, "b": [1, null], "c": {"d": 1.50}}'),
        ("run-2", "empty.pdf", ""), ("run-2", "_hidden.json", "{}"), ("email-3", "ingestion.json", "{}"), ("run-x", "result.json", "{}")],
        "folder string, file_name string, text string")
    return f"file://{tmp_path}/root", folders.write_run_files(files, f"file://{tmp_path}/root", f"file://{tmp_path}/inventory")


def test_tasks_list_and_read_as_the_file_index_does(spark, run_root):
    """With the folders' names no file status comes to the driver."""
    root, names = run_root
    names = names.select("folder").unionByName(spark.createDataFrame([("run-99",), (None,), ("run-1",)], "folder string"))
    for read in (runs.discover_runs, runs.run_manifest, runs.bronze_ingestion_email, runs.bronze_run_result):
        here, there = read(spark, root, names), read(spark, root)
        same = [c for c in there.columns if c not in ("ingested_at", "modify_time", "modify_time_ms")]
        assert rows(here, *same) == rows(there, *same) and here.columns == there.columns
        assert [f.dataType for f in here.schema] == [f.dataType for f in there.schema]
        assert not any(f.endswith((".json", ".PDF")) for f in here.inputFiles())
    assert runs.run_manifest(spark, root, names).where("modify_time_ms > 0").count() == 4
