from pyspark.sql import functions as F

from ledgerlake import constants as K
from ledgerlake.operators import gold, reports
from ledgerlake.operators import rules as R

from .conftest import rows
from .test_plans import _plan

ORDER = (("n", False), ("name", True))


def test_ranks_follow_the_order_across_files(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS reports")
    # a third of the rows have one value of the leading column
    df = spark.range(900).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") % 11).alias("n"),
                                 F.concat(F.lit("x"), (F.col("id") % 40).cast("string")).alias("name"), (F.col("id") % 4).alias("other"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the table is small: keep its ranges apart
    try:
        reports.save_sorted(df, "reports.r", ORDER)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = reports.read_ranked(spark, "reports.r", ORDER)
    want = sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is None, -(r[0] or 0), r[1], r[2]))
    assert [tuple(r[c] for c in df.columns) for r in sorted(got.collect(), key=lambda r: r["rank"])] == want
    assert {r["rank"] for r in got.collect()} == set(range(1, 901))
    assert spark.table("reports.r").select(reports.PART).distinct().count() > 2  # the hot value lies in several files
    for part in spark.table("reports.r").select(reports.PART).distinct().collect():
        some = spark.table("reports.r").where(F.col(reports.PART) == part[0]).collect()
        keys = [(r["n"] is None, -(r["n"] or 0), r["name"], r["other"]) for r in some]
        assert keys == sorted(keys)
    reports.save_sorted(df.limit(0), "reports.none", ORDER)
    assert reports.read_ranked(spark, "reports.none", ORDER).count() == 0


def test_a_preview_is_a_top_n(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("n"), F.col("id").cast("string").alias("name"))
    top = reports.preview(df, ORDER, 3)
    assert rows(top, "rank", "name") == [(1, "19"), (2, "29"), (3, "39")]
    assert "TakeOrderedAndProject" in _plan(top)


RULES = "id string, outcome string, humanInLoop boolean, tolerancePercent double, toleranceAbsolute double, thresholdAmount double"
LINES = """invoiceId string, lineNo string, vendorName string, categoryName string, description string, quantity double, unitPrice double, lineTotal double,
    ledger_category string, ledger_item struct<ledgerCode:string,itemName:string,expectedUnitPrice:double>"""


def classified(spark, rules):
    item = ("1", "desk", 100.0)
    lines = spark.createDataFrame([
        ("exact", "1", "v", "c", "d", 1.0, 100.0, 100.0, "c", item), ("near", "1", "v", "c", "d", 1.0, 101.0, 101.0, "c", item),
        ("off", "1", "v", "c", "d", 1.0, 120.0, 120.0, "c", item), ("high", "1", "v", "c", "d", 99.0, 100.0, 9900.0, "c", item),
        ("no item", "1", "v", "c", "d", 1.0, 1.0, 1.0, "c", None), ("no category", "1", "v", "x", "d", 1.0, 1.0, 1.0, None, None)], LINES)
    t = R.Thresholds() if rules is None else R.rules_of(spark.createDataFrame(rules, RULES))
    return {r["invoiceId"]: (r["ruleApplied"], r["status"], r["humanInLoop"]) for r in R.classify_category(lines, t).collect()}


def test_the_shipped_rules_are_the_defaults(spark):
    assert classified(spark, K.SHIPPED_RULES) == classified(spark, None) == {
        "exact": ("R1", "matched", False), "near": ("R2", "matched", False), "off": ("R2", "matched", False), "high": ("R4", "review", True),
        "no item": ("R5", "exception", False), "no category": ("R6", "exception", False)}


def test_a_changed_rules_table_changes_the_outcome(spark):
    assert classified(spark, K.CHANGED_RULES) == {
        "exact": ("R1", "matched", False), "near": ("R2", "review", True), "off": ("R3", "review", True), "high": ("R1", "matched", False),
        "no item": ("R5", "review", True), "no category": ("R6", "exception", False)}
    # no rules at all: no tolerance and no high value
    assert classified(spark, [("R9", None, None, None, None, None)])["near"] == ("R3", "review", True)
    assert classified(spark, [("R4", None, None, None, None, None)])["exact"] == ("R4", "review", False)


def test_rules_are_read_by_the_query_itself(spark):
    lines = spark.createDataFrame([], LINES)
    assert "Subquery" in _plan(R.classify_category(lines, R.rules_of(spark.createDataFrame(list(K.SHIPPED_RULES), RULES))))


def test_levels_are_summed_in_one_pass(spark):
    df = spark.createDataFrame([("a", "x", 0.1), ("a", "y", 0.2), ("b", "x", None), (None, "x", 1.0)], "v string, c string, quantity double")
    out = gold.measures_by_levels(df, ["v", "c"], [["v", "c"], ["c"], []], ("quantity",))
    assert rows(out, "level", "v", "c", "sum_quantity") == sorted([
        (0, "a", "x", 0.1), (0, "a", "y", 0.2), (0, "b", "x", None), (0, None, "x", 1.0), (2, None, "x", 1.1), (2, None, "y", 0.2), (3, None, None, 1.3)], key=repr)
    assert _plan(out).count("Exchange") == 1


def test_medians_come_from_the_days_sketches(spark):
    lines = spark.range(20_000).select(F.lit("c").alias("categoryName"), (F.col("id") % 30).alias("run_id"), F.col("id").cast("double").alias("convertedUnitPrice"))
    sketches = gold.price_sketches(lines)
    assert sketches.count() == 30
    first, later = sketches.where("day < 20"), sketches.where("day >= 20")  # a later day is only added
    got = gold.medians_of_sketches(first.unionByName(later)).first()
    assert got["prices"] == 20_000 and abs(got["median_unit_price_aud"] - 10_000) < 200
