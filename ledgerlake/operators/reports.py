"""Reports in their reading order (O1) and previews (O2).

A saved report is range partitioned on its order and sorted within each
range, so it is written and can be read in parallel, with no task that holds
all of it, and a reader of some of the order's values skips the other files.
Ranks are the place within a range after all earlier ranges' rows: one count a
range is summed up, no row meets all others.  A preview is Spark's top-n, each
task keeping n rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: (column, ascending) of each report; ties follow the other columns.
Order = tuple[tuple[str, bool], ...]

# O1: the order in which a report is read.
REPORT_ORDER: dict[str, Order] = {
    "gold_spend_by_vendor_month": (("invoice_month", True), ("total_aud", False)),
    "gold_spend_by_category": (("vendorName", True), ("spend_aud", False)),
    "gold_unit_price_benchmark": (("vs_median_pct", False),),
    "gold_payment_calendar": (("due_week", True),),
    "obs_duplicate_runs": (("run_count", False), ("invoiceId", True), ("run_id", True)),
    "obs_stage_latency": (("run_id", True),),
    "bronze_run_manifest": (("run_id", True), ("modify_time", True)),
    "email_decisions": (("run_id", True),),
    "vendor_summary": (("total_aud", False),),
}
PART = "report_part"


def keys(report: DataFrame, order: Order) -> list[Column]:
    """Sort keys that leave no ties between different rows: the order's
    columns (nulls first ascending, last descending), then all others."""
    named = [F.col(c).asc_nulls_first() if up else F.col(c).desc_nulls_last() for c, up in order]
    return named + [F.col(c).asc_nulls_first() for c in report.columns if c not in dict(order) and c != PART]


def read_sorted(table: DataFrame, name: str) -> DataFrame:
    """O1: a report table in its reading order."""
    return table.orderBy(*keys(table, REPORT_ORDER[name]))


def save_sorted(report: DataFrame, table: str, order: Order) -> None:
    """O1 with S6: the report as a table whose files are consecutive ranges of
    the order, each sorted, numbered in the column ``report_part``."""
    by = keys(report, order)
    (report.repartitionByRange(*by).withColumn(PART, F.spark_partition_id()).sortWithinPartitions(*by)
     .write.mode("overwrite").format("parquet").saveAsTable(table))


def read_ranked(spark: SparkSession, table: str, order: Order) -> DataFrame:
    """A saved report with ``rank``, each row's place in the whole from 1."""
    saved = spark.table(table)
    sizes = saved.groupBy(PART).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    starts = sizes.select(PART, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy(PART).orderBy(*keys(saved, order)))
    return saved.join(starts, PART).withColumn("rank", F.col("_before") + place).drop(PART, "_before")


def preview(table: DataFrame, order: Order, n: int = 20) -> DataFrame:
    """O2: the first ``n`` rows of a table in an order, with their rank."""
    by = keys(table, order)
    return table.orderBy(*by).limit(n).withColumn("rank", F.row_number().over(Window.orderBy(*by)).cast("long"))
