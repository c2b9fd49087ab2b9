"""The benchmark mapping reaches every rule: the branches are not empty where
the oracle checks compare them."""

import pytest
from pyspark.sql import functions as F

from ledgerlake import constants as K
from ledgerlake.operators import gold, obs, rules, silver
from ledgerlake.plans.model import Model

from .conftest import SF_CHECK


@pytest.fixture(scope="module")
def m(spark):
    return Model(spark, SF_CHECK)


def values(df, column):
    return {r[0] for r in df.select(column).distinct().collect()}


def test_rules_and_ranks(m):
    assert values(m.records_aud, "ruleApplied") == {"R1", "R2", "R3", "R4", "R5"}
    assert values(m.records_category, "ruleApplied") == {"R1", "R2", "R3", "R4", "R5", "R6"}
    assert values(m.matched_global, "ledger_item.match_rank") == {0, 1, 2, None}
    assert values(rules.exception_queue(m.records_aud, m.silver_invoice), "kind") == {"exception", "review"}
    assert values(rules.posted_lines(m.records_aud), "status") == {"matched", "review", "exception"}
    assert values(rules.processing_notes(m.records_category), "section") == {0, 1, 2, 3, 4, 5}


def test_data_quality(m):
    got = values(silver.dq_issues(m.checked, with_timestamp=False), "rule")
    assert got == {"line_total_mismatch", "fx_inconsistent", "extraction_not_ok", "due_before_invoice_date",
                   *[f"null_{c}" for c in K.REQUIRED_HEADER_FIELDS]}
    off = m.checked.where(F.abs("reconcile_diff") > 0.01).count()
    assert 0 < off < 0.3 * m.silver_invoice.count()


def test_stages_and_mails(m):
    assert values(obs.with_stage(m.bronze_manifest), "stage") == {*K.PIVOT_STAGES, K.OTHER_STAGE}
    latency = obs.stage_latency(m.bronze_manifest)
    filled = latency.agg(*[F.count(c).alias(c) for c in gold.LATENCY_MEASURES]).first()
    assert all(n > 0 for n in filled)
    assert values(m.bronze_email, "attachment_count") == {0, 1, 2}
    assert m.bronze_email.where("email_preview is null").count() == 0


def test_a_category_with_one_vendor_is_left_out(spark):
    lines = spark.createDataFrame([("a", "v", 1.0), ("a", "w", 2.0), ("b", "v", 3.0), ("b", None, 4.0), (None, "v", 5.0)],
                                  "categoryName string, vendorName string, convertedUnitPrice double")
    assert values(gold.category_medians(lines), "categoryName") == {"a"}
