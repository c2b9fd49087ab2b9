import json

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import jsonops as J
from ledgerlake.operators import changes as C
from ledgerlake.sources import folders, runs, tables

from .conftest import rows
from .test_plans import _plan
from .test_sources import _write


def test_files_are_written_where_their_rows_say(spark, tmp_path):
    files = spark.createDataFrame(
        [("run-1", "result.json", '{"a":1}'), ("run-2", "x y.PDF", "%"), ("run-2", "empty.txt", None), ("email-1", "ingestion.json", "é"), (None, "lost", ""), ("run-3", None, "")],
        "folder string, file_name string, text string")
    for root in (f"{tmp_path}/a", f"file:{tmp_path}/b"):
        for attempt in "12":  # a second run of the tasks changes nothing
            found = folders.write_run_files(files, root, f"{root}-inventory{attempt}")
        assert rows(found) == [("email-1", "ingestion.json", 2), ("run-1", "result.json", 7), ("run-2", "empty.txt", 0), ("run-2", "x y.PDF", 1)]
    assert (tmp_path / "b" / "run-1" / "result.json").read_text() == '{"a":1}'
    listed = rows(runs.run_manifest(spark, f"{tmp_path}/a"), "run_id", "file_name", "size_bytes")
    assert [(r, f.replace("%20", " "), n) for r, f, n in listed] == [("run-1", "result.json", 7), ("run-2", "x y.PDF", 1)]
    assert folders.write_run_files(files.limit(0), f"{tmp_path}/c", f"{tmp_path}/c-inventory").count() == 0


def test_result_documents_keep_their_own_types(spark, tmp_path):
    docs = {"run-1": {"v": 1, "k": "a", "big": 9007199254740993}, "run-2": {"v": "text", "k": {"z": None, "y": 2.5}},
            "run-3": {"k": [1, None, {"n": None}], "s": 'q":null,"', "t": {}}, "run-4": {"only": None}}
    for run, doc in docs.items():
        _write(f"{tmp_path}/{run}/result.json", doc)
    _write(f"{tmp_path}/run-5/result.json", "{no json")
    got = {r["run_id"]: r["result_json"] for r in runs.bronze_run_result(spark, str(tmp_path)).collect()}
    assert got["run-5"] is None

    def kept(x):
        if isinstance(x, dict):
            return {k: kept(v) for k, v in x.items() if v is not None}
        return [kept(v) for v in x] if isinstance(x, list) else x

    assert {r: json.loads(t) for r, t in got.items() if t} == {r: kept(d) for r, d in docs.items()}
    plan = _plan(runs.bronze_run_result(spark, str(tmp_path)))
    assert plan.count("FileScan json") == 1 and "Exchange" not in plan


@pytest.mark.parametrize("text, want", [
    ('{"a":null}', "{}"), ('{"a":null,"b":1,"c":null}', '{"b":1}'), ('{"b":1,"c":null,"d":2}', '{"b":1,"d":2}'),
    ('[null,{"a":null,"b":null}]', "[null,{}]"), ('{"a\\"":null,"b":"\\":null,"}', '{"b":"\\":null,"}'), ('{"x":"{,","y":null}', '{"x":"{,"}'),
    ('{"null":"null","n":{"m":null}}', '{"null":"null","n":{}}'), ("null", "null"), ('{"a":"' + "\\\\\\n" * 200_000 + '","z":null}', '{"a":"' + "\\\\\\n" * 200_000 + '"}')])
def test_fields_without_a_value_go_and_nothing_else(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(J.without_null_fields(F.col("t"))).first()[0] == want


def test_a_rerun_day_replaces_its_partition_only(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS by_day")
    days = spark.createDataFrame([(d, f"2026-05-0{d}", n) for d in (1, 2, 3) for n in range(5)], "k long, day string, n long")
    days = days.select("k", "n", F.to_date("day").alias("run_date"))
    tables.overwrite_partitions(days, "by_day.t", ["run_date"])
    before = {f for f in spark.table("by_day.t").inputFiles()}
    tables.overwrite_partitions(days.where("k = 2 and n < 2").withColumn("n", F.col("n") * 10), "by_day.t", ["run_date"])
    assert rows(spark.table("by_day.t"), "k", "n") == [(1, n) for n in range(5)] + [(2, 0), (2, 10)] + [(3, n) for n in range(5)]
    kept = {f for f in before if "2026-05-02" not in f}
    assert kept and kept <= set(spark.table("by_day.t").inputFiles())
    some = tables.read_days(spark, "by_day.t", "2026-05-02", "2026-05-02")
    assert some.count() == 2 and all("2026-05-02" in f for f in some.inputFiles())
    pushed = next(line for line in _plan(some).splitlines() if "PartitionFilters" in line)
    assert "run_date" in pushed.split("PartitionFilters", 1)[1]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def _saved(spark, n):
    spark.sql("CREATE SCHEMA IF NOT EXISTS book")
    entries = spark.range(n).select(
        F.concat(F.lit("E-"), F.col("id").cast("string")).alias("Id"), F.lit("i").alias("InvoiceNumber"), F.lit("v").alias("Vendor"),
        F.lit("a").alias("Account"), F.col("id").cast("decimal(18,2)").alias("Amount"), F.lit("AUD").alias("Currency"),
        F.current_timestamp().alias("EntryDate"), F.lit("posted").alias("Status"), F.lit(None).cast("string").alias("Description"))
    C.save_entries(entries, "book.entries")


def test_list_and_get(spark):
    _saved(spark, 100)
    assert C.list_entries(spark, "book.entries").count() == 100
    assert C.get_entry(spark, "book.entries", "E-7").first()["Amount"] == 7 and C.get_entry(spark, "book.entries", "none").count() == 0
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # the plan then names the buckets
    try:
        assert "SelectedBucketsCount: 1 out of 8" in _plan(C.get_entry(spark, "book.entries", "E-7"))
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    asked = spark.createDataFrame([("E-1", 1, "x"), ("E-1", 2, "x"), ("none", 3, "x"), (None, 4, "x")], "Id string, n long, Status string")
    assert rows(C.get_entries(asked, "book.entries"), "n", "found", "Status") == [
        (1, True, "posted"), (2, True, "posted"), (3, False, None), (4, False, None)]


def test_saved_entries_are_merged_and_asked_without_a_shuffle(spark):
    _saved(spark, 100)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        changes = spark.createDataFrame([("update", "E-3", 5, 1)], "op string, Id string, Amount long, seq long").withColumns(
            {f: F.lit(None).cast("string") for f in C.ENTRY_FIELDS if f != "Amount"} | {"Amount": F.col("Amount").cast("decimal(18,2)")})
        merged = C.apply_changes(C.list_entries(spark, "book.entries"), changes)
        asked = C.get_entries(changes.select("Id"), "book.entries")
        for df, scanned in ((merged, "book.entries"), (asked, "book.entries")):
            lines = _plan(df).splitlines()
            at = next(i for i, line in enumerate(lines) if "FileScan" in line and scanned in line)
            depth = lines[at].index("FileScan")
            above = []  # the operators over the scan, up to the join
            for line in reversed(lines[:at]):
                here = len(line) - len(line.lstrip(" :+-*()0123456789"))
                if here < depth:
                    above.append(line.strip(" :+-"))
                    depth = here
                if "Join" in line and here <= depth:
                    break
            assert any("Join" in a for a in above) and not any("Exchange" in a for a in above)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bad_dates_and_large_amounts_are_null(spark):
    invoices = spark.createDataFrame([("I1", "v", "USD", 1e18, "10 May 2026", "f"), ("I2", "v", "USD", 2.5, "2026-05-10", "f")],
                                     "invoiceId string, vendorName string, currency string, convertedInvoiceAmount double, invoiceDate string, fileName string")
    got = {r["Id"]: (r["Amount"], r["EntryDate"]) for r in C.entries_from_invoices(invoices).collect()}
    assert got["I1"] == (None, None) and float(got["I2"][0]) == 2.5 and got["I2"][1] is not None
