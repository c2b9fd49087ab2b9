import json
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlake.operators import ledger as L
from ledgerlake.operators import rules as R

from .fixtures import frames, header, line

# An invented ledger with the traps: an alias that is the vendor's name, an item
# name inside a longer one, a term inside a word of another item.
LEDGER = {
    "currency": "AUD",
    "categories": [
        {"categoryName": "Survey Equipment", "approvedBudget": 950000.0, "ytdBalance": 342400.0, "items": [
            {"ledgerCode": "3101", "itemName": "Northwind Theodolite (per unit / month)", "expectedUnitPrice": 7850.0,
             "aliases": ["Northwind", "NW Theodolite", "Northwind Theodolite Rental", "Northwind Theodolite Rental – Field Kit"]},
            {"ledgerCode": "3102", "itemName": "Northwind Tripod Carbon Set (per unit / month)",
             "expectedUnitPrice": 471.0, "aliases": ["Northwind Tripod", "NW Tripod"]}]},
        {"categoryName": "Harbour Fees", "approvedBudget": 100000.0, "ytdBalance": 25000.0, "items": [
            {"ledgerCode": "3206", "itemName": "Quaymaster Services – Berth Monitoring (monthly)",
             "expectedUnitPrice": 2035.0, "aliases": ["Quaymaster Berth", "Quaymaster Services Berth"]}]},
        {"categoryName": "Contract Labour", "approvedBudget": 50000.0, "ytdBalance": 1000.0, "items": [
            {"ledgerCode": "3301", "itemName": "Dock Inspection (per hour)", "expectedUnitPrice": 480.0,
             "aliases": ["Inspection", "Dock Inspection"]}]},
    ],
    "postedEntries": [],
}


def _ledger(spark, tmp_path):
    p = tmp_path / "ledger.json"
    p.write_text(json.dumps(LEDGER, indent=2))
    return L.flatten_ledger(L.read_ledger_json(spark, str(p)))


def _lines(spark):
    ls = [
        # (run, invoice, lineNo, total, converted, vendor, category, description, qty, unit, conv_unit)
        line("r", "INV-B", "1", 25000.0, 39250.0, "Northwind", "Survey Equipment",
             "Northwind Theodolite Rental – Field Kit", 5.0, 5000.0, 7850.0),
        line("r", "INV-B", "2", 1500.0, 2355.0, "Northwind", "Survey Equipment",
             "Northwind Tripod Carbon Set", 5.0, 300.0, 471.0),
        line("r", "INV-L", "1", 1850.0, 1850.0, "Quaymaster Services", "Harbour Fees",
             "Quaymaster Services – Berth Monitoring", 1.0, 1850.0, 1850.0),
        line("r", "INV-L", "2", 1100.0, 1100.0, "Quaymaster Services", "Contract Labour",
             "Quaymaster Services – Hull Inspection Service", 5.0, 220.0, 220.0),
        line("r", "INV-S", "1", 100.0, 150.0, "Sample Vendor A", "Hardware", "On-site setup", 1.0, 100.0, 150.0),
    ]
    return frames(spark, [header("r", "INV-B")], ls)[1]


def test_flatten_ledger(spark, tmp_path):
    items, cats = _ledger(spark, tmp_path)
    assert items.count() == 4 and cats.count() == 3
    assert L.ledger_aliases(items).count() == 4 + 2 + 2 + 2
    bp = {r["categoryName"]: r for r in L.budget_position(cats, items).collect()}
    assert bp["Survey Equipment"]["remaining"] == 607600.0 and bp["Survey Equipment"]["items"] == 2


def test_golden_aud_classification(spark, tmp_path):
    items, _ = _ledger(spark, tmp_path)
    rec = {(r["invoiceId"], r["lineNo"]): r for r in R.process_lines_aud(_lines(spark), items).collect()}
    assert (rec[("INV-B", "1")]["ledgerCode"], rec[("INV-B", "1")]["ruleApplied"]) == ("3101", "R4")
    assert (rec[("INV-B", "2")]["ledgerCode"], rec[("INV-B", "2")]["ruleApplied"]) == ("3102", "R1")
    assert (rec[("INV-L", "1")]["ledgerCode"], rec[("INV-L", "1")]["ruleApplied"]) == ("3206", "R2")
    assert (rec[("INV-L", "2")]["ledgerCode"], rec[("INV-L", "2")]["ruleApplied"]) == ("3301", "R3")
    s = rec[("INV-S", "1")]
    assert (s["ledgerCode"], s["ruleApplied"], s["status"], s["humanInLoop"]) == (None, "R5", "exception", False)
    assert rec[("INV-B", "1")]["humanInLoop"] and rec[("INV-B", "1")]["status"] == "review"
    assert rec[("INV-L", "2")]["reason"] == \
        "Unit price AUD 220.00 differs from expected AUD 480.00 by AUD 260.00 (tolerance AUD 50.00)."


def test_category_workflow_and_r6(spark, tmp_path):
    items, cats = _ledger(spark, tmp_path)
    res = {(r["invoiceId"], r["lineItemId"]): r for r in R.process_lines_category(_lines(spark), items, cats).collect()}
    assert res[("INV-S", "1")]["ruleApplied"] == "R6"
    assert res[("INV-S", "1")]["reason"] == 'Category "Hardware" is not in the approved ledger.'
    # first item in ledger order whose name/alias is inside the description: alias "Northwind" of 3101
    assert res[("INV-B", "2")]["matchedLedgerItem"] == "Northwind Theodolite (per unit / month)"
    assert res[("INV-B", "1")]["reason"] == "Line total USD 25000.00 exceeds high-value threshold USD 5000.00."
    # in-category substring: "Inspection" inside the hull inspection line
    assert res[("INV-L", "2")]["matchedLedgerItem"] == "Dock Inspection (per hour)"
    # the berth line's description is shorter than the item name -> no match in the browser rule
    assert res[("INV-L", "1")]["ruleApplied"] == "R5"


def test_summary_and_notes(spark, tmp_path):
    items, cats = _ledger(spark, tmp_path)
    res = R.process_lines_category(_lines(spark), items, cats)
    summ = {r["invoiceId"]: tuple(r)[1:] for r in R.outcome_summary(res).collect()}
    assert sum(v[3] for v in summ.values()) == 5
    assert all(v[0] + v[1] + v[2] == v[3] for v in summ.values())
    notes = R.processing_notes(res).filter(F.col("invoiceId") == "INV-S").orderBy("section").collect()
    assert [n["note"] for n in notes][:3] == [
        "Processed 1 line item(s) for invoice INV-S (Sample Vendor A).",
        "0 matched, 0 need review, 1 exception(s).",
        "Sent to exception queue:"]


def test_queues_and_postings(spark, tmp_path):
    items, _ = _ledger(spark, tmp_path)
    recs = R.process_lines_aud(_lines(spark), items)
    invoices = spark.createDataFrame([("INV-B", "Northwind Pty", "Northwind", "USD")],
                                     "invoiceId string, businessName string, vendorName string, invoiceCurrency string")
    q = {(r["invoiceId"], r["lineNo"]): r for r in R.exception_queue(recs, invoices).collect()}
    assert q[("INV-B", "1")]["kind"] == "review" and q[("INV-B", "1")]["vendorName"] == "Northwind Pty"
    assert q[("INV-S", "1")]["kind"] == "exception" and q[("INV-S", "1")]["vendorName"] == "Sample Vendor A"
    assert ("INV-B", "2") not in q
    entries = {r["entry"]: r for r in R.posted_entries(recs).collect()}
    assert entries["INV-B-2"]["amount_text"] == "AUD 2355.00" and "INV-S-1" not in entries
    view = L.posting_view(items, R.posted_lines(recs), L.invoice_currency(invoices))
    by_code = {}
    for r in view.collect():
        by_code.setdefault(r["ledgerCode"], []).append(r)
    assert len(by_code) == 4                                    # every item kept
    assert by_code["3101"][0]["currency"] == "USD"              # invoice currency (J12)
    assert by_code["3301"][0]["currency"] == "AUD"              # ledger currency fallback
    prices = {r["ledgerCode"]: r["ledgerExpectedUnitPrice"] for r in L.expected_price_lookup(recs, items).collect()}
    assert prices["3102"] == 471.0 and prices[None] is None


alphabet = st.text(alphabet="abAB #-", min_size=0, max_size=12)


@settings(max_examples=15, deadline=None)
@given(hays=st.lists(alphabet, min_size=1, max_size=8), needles=st.lists(alphabet, min_size=1, max_size=8))
def test_contains_pairs_matches_brute_force(spark, hays, needles):
    h = spark.createDataFrame([(i, s) for i, s in enumerate(hays)], "hid int, hay string")
    n = spark.createDataFrame([(j, s) for j, s in enumerate(needles)], "nid int, needle string")
    got = [tuple(r) for r in L.contains_pairs(h, "hay", n, "needle").collect()]
    want = {(a, b) for a in hays for b in needles if b and b in a}
    assert set(got) == want and len(got) == len(want)


def test_contains_pairs_random_long_texts(spark):
    rnd = random.Random(7)
    words = ["ring", "gear", "bolt", "small", "red", "brand#2", "brand#25", "widget"]
    hays = [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 6))) for _ in range(60)]
    needles = list(set(words + ["ring gear", "d#2", "l r", "#"]))
    h = spark.createDataFrame(list(enumerate(hays)), "hid int, hay string")
    n = spark.createDataFrame(list(enumerate(needles)), "nid int, needle string")
    got = {tuple(r) for r in L.contains_pairs(h, "hay", n, "needle").collect()}
    assert got == {(a, b) for a in hays for b in needles if b in a}


def test_a_prefix_that_all_terms_share_keys_nothing(spark):
    """150 terms that begin alike: the candidates are the true pairs."""
    terms = [f"brand{i:03d}x" for i in range(150)]
    hays = [f"some {terms[i % 150]} thing {i}" for i in range(600)]
    h = spark.createDataFrame([(x,) for x in hays], "hay string")
    n = spark.createDataFrame([(x,) for x in terms], "needle string")
    candidates, _ = L.candidate_pairs(h, "hay", n, "needle")
    assert L.contains_pairs(h, "hay", n, "needle").count() == 600
    assert candidates.count() <= 1.2 * 600


def test_word_boundaries(spark):
    h = spark.createDataFrame([("support plan",), ("port fees",), ("the a.b\\Ec port",)], "hay string")
    n = spark.createDataFrame([("port",), ("a.b\\Ec",), ("plan",)], "needle string")
    got = {tuple(r) for r in L.contains_pairs(h, "hay", n, "needle", word_boundary=True).collect()}
    assert got == {("port fees", "port"), ("the a.b\\Ec port", "port"), ("the a.b\\Ec port", "a.b\\Ec"), ("support plan", "plan")}
    items = spark.createDataFrame([("Services", "3", "PORT", 30.0, None, 3)],
                                  "categoryName string, ledgerCode string, itemName string, expectedUnitPrice double, aliases array<string>, item_position int")
    lines = spark.createDataFrame([("x1", "Support", "v")], "lineNo string, description string, vendorName string")
    assert L.match_global(lines, items).first()["ledger_item"]["ledgerCode"] == "3"
    assert L.match_global(lines, items, word_boundary=True).first()["ledger_item"] is None


def test_ledger_order_has_no_bound(spark):
    """More categories than an integer product of positions could hold."""
    cats = [{"categoryName": f"c{i}", "approvedBudget": 1.0, "ytdBalance": 0.0,
             "items": [{"ledgerCode": str(i), "itemName": "same item", "expectedUnitPrice": 1.0, "aliases": []}]} for i in range(2201)]
    raw = spark.read.schema(L.schemas.LEDGER_FILE).json(spark.sparkContext.parallelize([json.dumps({"currency": "AUD", "categories": cats})]))
    items, _ = L.flatten_ledger(raw)
    lines = spark.createDataFrame([("1", "the same item", "v")], "lineNo string, description string, vendorName string")
    assert L.match_global(lines, items).first()["ledger_item"]["ledgerCode"] == "0"


def test_rules_file_moves_the_thresholds(spark, tmp_path):
    p = tmp_path / "rules.json"
    p.write_text(json.dumps({"rules": [{"id": "R2", "tolerancePercent": 60, "toleranceAbsolute": 5, "outcome": "matched"},
                                       {"id": "R4", "thresholdAmount": 100000}, {"id": "R9", "name": "x"}]}))
    t = R.thresholds(L.read_rules_json(spark, str(p)))
    assert t == R.Thresholds(60.0, 5.0, 100000.0) and R.thresholds(L.read_rules_json(spark, str(p)).limit(0)) == R.Thresholds()
    items, _ = _ledger(spark, tmp_path)
    matched = L.match_global(_lines(spark), items)
    rec = {(r["invoiceId"], r["lineNo"]): r["ruleApplied"] for r in R.classify_aud(matched, t).collect()}
    assert rec[("INV-B", "1")] == "R1" and rec[("INV-L", "2")] == "R2"


def test_match_global_vendor_fallback_only_for_unmatched_descriptions(spark):
    """A description that matches nothing falls back to its line's vendor;
    the same description under another vendor stays unmatched; a matched
    description ignores the vendor; equality outranks longer containment."""
    items = spark.createDataFrame(
        [("Equipment", "1", "THEODOLITE RENTAL", 10.0, ["Northwind"], 1),
         ("Services", "2", "DOCK SERVICE", 20.0, ["Dock"], 2),
         ("Services", "3", "SUPPORT", 30.0, ["PORT"], 3)],
        "categoryName string, ledgerCode string, itemName string, expectedUnitPrice double, "
        "aliases array<string>, item_position int")
    lines = spark.createDataFrame(
        [("x1", "Harbour dock service", "Northwind Pty"),
         ("x2", "on-site setup", "Northwind Pty"),
         ("x3", "on-site setup", "Acme"),
         ("x4", "Support", "Northwind"),
         ("x5", None, "Acme")],
        "lineNo string, description string, vendorName string")
    out = {r["lineNo"]: r["ledger_item"] for r in L.match_global(lines, items).collect()}
    got = {k: (v["ledgerCode"], v["match_rank"]) if v else None for k, v in out.items()}
    assert got == {"x1": ("2", 1), "x2": ("1", 2), "x3": None, "x4": ("3", 0), "x5": None}
