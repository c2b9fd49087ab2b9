"""Incremental bronze ingestion of new run folders with Structured Streaming.

The batch notebooks re-read every run on every execution.  Here the file
stream source remembers which ``run-*/<file>`` files it has already
processed (in the checkpoint), so each trigger reads only new runs and
appends their rows to the bronze tables.  ``availableNow`` processes what
is there and stops, which suits a scheduled job; the checkpoint lives
under the cluster's ``spark.checkpoint.dir``.  A batch that is retried gets
the same id and overwrites its own ``batch_id=`` partitions, so a failure
between the two table writes duplicates nothing.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from .. import schemas
from ..session import ensure_checkpoint_dir
from ..sources import runs


def write_tables(batch: DataFrame, out_dir: str, batch_id: int) -> None:
    """One batch of parsed invoice files into its partition of both tables.
    The batch is held between the writes, so its files are parsed once."""
    batch.persist()
    try:
        for name, rows in (("bronze_invoice_header", runs.invoice_headers(batch)),
                           ("bronze_invoice_lineitem", runs.invoice_lines(batch))):
            rows.write.mode("overwrite").parquet(posixpath.join(out_dir, name, f"batch_id={batch_id}"))
    finally:
        batch.unpersist()


def ingest_invoices(spark: SparkSession, root: str, out_dir: str, checkpoint: str | None = None,
                    file_name: str = "invoice.json"):
    """Add new runs' invoice headers and lines as parquet under ``out_dir``.

    Returns the finished StreamingQuery (availableNow trigger).
    """
    base = checkpoint or posixpath.join(ensure_checkpoint_dir(spark), "bronze_invoices_stream")
    stream = (spark.readStream.schema(schemas.INVOICE_FILE)
              .option("multiLine", "true")
              .json(posixpath.join(root, f"{K.RUN_PREFIX}*", file_name)))
    stream = runs.tagged(stream, F.col("_metadata.file_path"))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        write_tables(batch, out_dir, batch_id)

    q = (stream.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", base)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return q
