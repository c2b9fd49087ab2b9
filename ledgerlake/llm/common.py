"""Helpers the operators share: tables handed over in the shared checkpoint
folder, broadcasts behind a size check, text keys and batch sizes."""

from __future__ import annotations

import sys
import uuid

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_folder

# Tasks carry the operators' functions themselves: executors need the public
# libraries, not this repository.
cloudpickle.register_pickle_by_value(sys.modules[__package__])

#: A side is broadcast only when its measured size is within this bound.
BROADCAST_BYTES = 32 << 20

#: Whole documents travel in Arrow batches of at most this many rows / bytes.
BATCH_ROWS, BATCH_BYTES = 512, 16 << 20


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to a fresh folder of this application under
    ``spark.checkpoint.dir`` and read back: the lineage is cut by a table that
    every executor can read, so the loss of an executor never loses it."""
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/llm/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def size_bound(df: DataFrame, row_bytes: Column | int) -> tuple[int, int]:
    """(rows, bytes) of a written table by one aggregate over it."""
    size = F.lit(row_bytes) if isinstance(row_bytes, int) else row_bytes
    n, total = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size.cast("long")), F.lit(0))).first()
    return n, total


def small(df: DataFrame, row_bytes: Column | int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its measured bytes are within ``limit``;
    beyond it the frame is returned as it is, for a shuffle join that AQE may
    split."""
    return F.broadcast(df) if size_bound(df, row_bytes)[1] <= limit else df


def text_key(text: Column) -> Column:
    """128 bits that stand for a text (null is the empty text)."""
    value = F.coalesce(text, F.lit(""))
    return F.struct(F.xxhash64(value).alias("a"), F.xxhash64(F.lit(7), value).alias("b"))


def document_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches: a batch holds whole documents, and some of
    them are long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is the empty text."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if x is None else x for x in column.cast(kind).to_pylist()]


def with_columns_kept(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns that the operator is about to add (names clash
    without regard to case, as Spark resolves them)."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def run_starts(counts: np.ndarray) -> np.ndarray:
    """Offsets at which consecutive runs of the given lengths start."""
    return np.concatenate(([0], np.cumsum(counts)))[:-1] if len(counts) else np.zeros(0, np.int64)
