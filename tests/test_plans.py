"""Physical-plan properties that matter at scale."""

from ledgerlake.operators import changes as C
from ledgerlake.operators import fx, gold, silver
from ledgerlake.operators import ledger as L
from ledgerlake.operators import rules as R
from ledgerlake.plans.model import Model
from ledgerlake.sources import driver

from .conftest import SF_SMALL
from .fixtures import frames, header, line


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fx_lookup_is_broadcast_hash_join(spark):
    inv = Model(spark, SF_SMALL).silver_invoice.select("invoiceId", "currency", "invoiceDate")
    p = _plan(fx.fx_rate_lookup(inv, fx.generated_rates(spark), "currency", "invoiceDate", "rate",
                                known_rate_rows=fx.GENERATED_FX_ROWS))
    assert "BroadcastHashJoin" in p
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_substring_join_has_no_nested_loop(spark):
    m = Model(spark, SF_SMALL)
    for df in (L.match_global(m.silver_lines, m.ledger_items),
               L.match_in_category(m.silver_lines, m.ledger_items, m.ledger_categories)):
        p = _plan(df)
        assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_dq_scans_checked_input_once(spark):
    hs = [header("r1", "A", total=1.0), header("r2", "A", total=2.0)]
    ls = [line("r2", "A", "1", 2.0, 3.0)]
    hdr, lines = frames(spark, hs, ls)
    checked = silver.checked_from_lines(silver.latest_headers(hdr), lines)
    one = _plan(silver.dq_issues(checked, with_timestamp=False))
    assert one.count("Scan ExistingRDD") == _plan(checked).count("Scan ExistingRDD") and "Union" not in one


def test_building_rule_queries_starts_no_job_once_layers_are_written(spark):
    from ledgerlake.plans import registry
    names = ("classify_lines_aud", "processing_notes", "ledger_posting_view", "exception_queue", "unit_price_benchmark",
             "fx_convert", "duplicate_runs", "result_document")
    qs = registry.queries()
    for name in names:
        qs[name](spark, SF_SMALL)           # writes the layers it reads
    spark.sparkContext.setJobGroup("building", "plans only")
    for name in names:
        qs[name](spark, SF_SMALL)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    spark.sparkContext.setJobGroup("default", "")
    assert list(jobs) == []


def test_saved_records_are_read_not_matched_again(spark):
    m = Model(spark, SF_SMALL)
    for df in (R.processing_notes(m.records_category), R.exception_queue(m.records_aud, m.silver_invoice)):
        p = _plan(df)
        assert "part.parquet" not in p and "silver_invoice_lineitem" not in p


def test_change_rows_meet_no_join_before_they_are_aggregated(spark):
    entries = C.entries_from_invoices(Model(spark, SF_SMALL).silver_invoice)
    p = _plan(C.apply_changes(entries, driver.ledger_change_batch(spark, SF_SMALL)))
    assert p.count("Join") == 1


def test_benchmark_lines_are_not_shuffled_by_category(spark):
    m = Model(spark, SF_SMALL)
    p = _plan(gold.unit_price_benchmark(m.silver_lines, m.category_medians))
    assert "BroadcastHashJoin" in p and "hashpartitioning(categoryName" not in p


def test_dedup_limits_before_shuffle(spark):
    p = _plan(Model(spark, SF_SMALL).silver_invoice_fresh)
    # Spark 4 inserts a partial per-key limit ahead of the exchange
    assert p.count("WindowGroupLimit") >= 2


def test_scan_prunes_columns(spark):
    m = Model(spark, SF_SMALL)
    df = m.silver_lines.groupBy("categoryName").count()
    df.collect()
    p = _plan(df)
    scan = [ln for ln in p.splitlines() if "FileScan parquet" in ln][0]
    assert "categoryName" in scan and "description" not in scan and "lineTotal" not in scan
