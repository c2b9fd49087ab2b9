"""Broadcast hints only where the size is fixed by construction.

Everything else is left to the planner: tables that are joined often are
written first (see :mod:`ledgerlake.plans.model`), so the planner knows
their bytes and broadcasts them only under
``spark.sql.autoBroadcastJoinThreshold``; AQE decides for the rest from
real shuffle sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a fixed table that may be hinted: small typed rows of about 100 bytes.
FIXED_ROWS = 10_000


def fixed_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a table that has at most ``rows`` rows by the way it is
    built (a literal list, a generated range); a larger one is not hinted."""
    return F.broadcast(df) if rows <= FIXED_ROWS else df
