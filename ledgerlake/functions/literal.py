"""Small fixed tables as JVM-side literals.

``spark.createDataFrame(list)`` ships the rows through a Python RDD, so
every query touching the table starts Python workers.  A literal array of
structs expanded with ``inline`` stays in the JVM (and in codegen).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def literal_table(spark: SparkSession, rows, columns: list[tuple[str, str]]) -> DataFrame:
    """Rows of Python values -> DataFrame with the given (name, type) columns."""
    structs = [F.struct(*[F.lit(v).cast(t).alias(n) for (n, t), v in zip(columns, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
