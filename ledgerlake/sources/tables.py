"""Table scans and sinks.

Tables are parquet managed by the session catalog: Delta is not on the
classpath here, so "overwrite with schema overwrite" is a plain
``mode("overwrite")`` save (which replaces the schema too).  Large bronze
tables are partitioned by the run date: a day that is run again replaces its
own partition and no other (:func:`overwrite_partitions`), and a read of some
days prunes the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# of what is written to be read again: zstd files are a quarter smaller than snappy's
COMPRESSION = "zstd"
_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def create_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    """One schema (database) per layer, in the warehouse or at a location."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}" + (f" LOCATION '{location}'" if location else ""))


def write_table(df: DataFrame, name: str, partition_by: list[str] | None = None) -> None:
    """Full overwrite of a managed table."""
    w = df.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """S5."""
    return spark.table(name)


def overwrite_partitions(df: DataFrame, name: str, partition_by: list[str]) -> None:
    """S6 by partition: the partitions that ``df`` has rows for are replaced,
    the others stay; a table that is not there is created.

    Rows are rebalanced by the partition columns first, so a partition is
    written as a few files of the advisory size: AQE merges small partitions'
    rows into one task and splits a hot one over several.
    """
    spark = df.sparkSession
    rows = df.select(*[c for c in df.columns if c not in partition_by], *partition_by).hint("rebalance", *partition_by)
    if not spark.catalog.tableExists(name):
        rows.write.format("parquet").partitionBy(*partition_by).saveAsTable(name)
        return
    before = spark.conf.get(_OVERWRITE_MODE)
    spark.conf.set(_OVERWRITE_MODE, "dynamic")
    try:
        rows.write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(_OVERWRITE_MODE, before)


def read_days(spark: SparkSession, name: str, first: str, last: str, day_col: str = "run_date") -> DataFrame:
    """S5 of some days of a table partitioned by day: the others' files are
    neither listed nor read."""
    day = F.col(day_col)
    return spark.table(name).where(day.between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def write_buckets(df: DataFrame, name: str, key: str, buckets: int | None = None, placed: bool = False,
                  ordered: bool = True) -> None:
    """S6 bucketed and sorted (unless not ``ordered``) by ``key``: later joins on the key need no
    exchange of this table, a lookup of one key reads one bucket.

    ``buckets`` is ``spark.sql.shuffle.partitions`` unless given; size it like
    those, from the bytes.  The rows are shuffled once into their buckets, so
    each bucket is one file.  ``placed`` says that a join or window on the
    key's values has brought them together already: they are not
    shuffled (any rows may be; the more tasks hold a bucket's, the more files).
    """
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (df if placed else df.repartition(n, key)).write.mode("overwrite").format("parquet").option("compression", COMPRESSION).bucketBy(n, key)
    (rows.sortBy(key) if ordered else rows).saveAsTable(name)
