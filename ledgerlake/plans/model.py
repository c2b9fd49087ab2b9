"""The invoice data model over one input folder.

``Model`` wires bronze -> silver -> gold -> obs as plain function calls on
DataFrames (the pipeline's four notebooks in order).

Layers hand over by written tables, as in the reference pipeline (each
notebook reads the previous layer's saved tables).  A table is written the
first time a query asks for it, alone, as parquet in this application's
folder under the cluster's shared ``spark.checkpoint.dir``:

* bronze -- the mapping of the input tables onto the invoice model, as tables
  and as invoice documents with nested lines;
* silver -- latest headers and their lines, from those bronze tables;
* reference data and lookups -- ledger, category medians, the matches of
  distinct texts: their sizes are then known to the planner;
* match records -- every line classified, once for A7 and once for A8, which
  all pages read.

Invoices and their lines lie in buckets of their invoice, in bronze and in
silver: the latest headers, their lines and the ledger's opening entries are
then found bucket by bucket, without shuffling a layer again.

Writing cuts lineage (a lost executor re-reads files instead of recomputing
joins) and lets every later query prune columns on a plain scan.  Apart from
these layer writes, building a query starts no job.  The queries *of* a
layer compute it fresh from the layer below (``bronze_*`` from the input
tables, ``silver_*``/DQ from bronze), so each operator is still executed
when its own query runs.
"""

from __future__ import annotations

import hashlib
import threading
import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators import gold, obs, silver
from ..operators import ledger as L
from ..operators import rules as R
from ..session import scratch_folder
from ..sources import driver, tables

# (application, input folder and its time stamps, table) -> written folder, schema
_WRITTEN: dict[tuple[str, str, str], tuple[str, StructType]] = {}
# one thread of the application writes a layer, the others wait for it
_WRITING = threading.RLock()
INPUTS = ("orders", "lineitem", "part", "customer", "nation", "events", "documents", "labels")


def _input_stamp(spark: SparkSession, sf_dir: str) -> str:
    """Modification times of the input tables, from whatever file system
    holds them: a changed input is mapped anew."""
    conf, path = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path
    times = []
    for name in INPUTS:
        p = path(f"{sf_dir}/{name}.parquet")
        times.append(p.getFileSystem(conf).getFileStatus(p).getModificationTime())
    return hashlib.sha256(repr((sf_dir, times)).encode()).hexdigest()[:16]


def forget_written() -> None:
    """Write all layers anew from here on (for measurements)."""
    _WRITTEN.clear()


class Model:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def _stamp(self) -> str:
        return _input_stamp(self.spark, self.sf_dir)

    def _table(self, name: str, build: Callable[[], DataFrame], by: str | None = None) -> DataFrame:
        """A layer table, written on first use; with ``by`` in buckets of that
        column."""
        key = (self.spark.sparkContext.applicationId, self._stamp, name)
        with _WRITING:
            if key not in _WRITTEN:
                folder, df = f"{scratch_folder(self.spark)}/{self._stamp}", build()
                if by:
                    layer = f"layer_{uuid.uuid4().hex}"
                    tables.create_schema(self.spark, layer, f"{folder}/{layer}")
                    tables.write_buckets(df, f"{layer}.{name}", by, placed=True, ordered=False)
                    path = f"{folder}/{layer}/{name}"
                else:
                    path = f"{folder}/{name}-{uuid.uuid4().hex[:8]}"
                    df.write.parquet(path, compression=tables.COMPRESSION)
                _WRITTEN[key] = (path, df.schema)
        path, schema = _WRITTEN[key]
        if by:
            return self.spark.table(".".join(path.split("/")[-2:]))
        return self.spark.read.schema(schema).parquet(path)

    def _saved(self, name: str, save: Callable[[str], None]) -> str:
        """The name or path of something else that is saved on first use:
        ``save`` is given a fresh name and saves under it."""
        key = (self.spark.sparkContext.applicationId, self._stamp, name)
        with _WRITING:
            if key not in _WRITTEN:
                fresh = f"{name}_{uuid.uuid4().hex}"
                save(fresh)
                _WRITTEN[key] = (fresh, StructType())
        return _WRITTEN[key][0]

    def fresh(self, name: str, df: DataFrame) -> DataFrame:
        """A table of a single query, written anew each time: what reads it
        twice does not compute it twice."""
        path = f"{scratch_folder(self.spark)}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path, compression=tables.COMPRESSION)
        return self.spark.read.schema(df.schema).parquet(path)

    # -- bronze, computed fresh from the input tables ------------------------
    @cached_property
    def bronze_header_fresh(self) -> DataFrame:
        return driver.bronze_header(self.spark, self.sf_dir)

    @cached_property
    def bronze_lines_fresh(self) -> DataFrame:
        return driver.bronze_lines(self.spark, self.sf_dir)

    @cached_property
    def bronze_manifest_fresh(self) -> DataFrame:
        return driver.bronze_manifest(self.spark, self.sf_dir)

    @cached_property
    def bronze_email_fresh(self) -> DataFrame:
        return driver.bronze_email(self.spark, self.sf_dir)

    # -- bronze tables as written (the input of every later layer) -----------
    @cached_property
    def bronze_header(self) -> DataFrame:
        return self._table("bronze_invoice_header", lambda: self.bronze_header_fresh, by="invoiceId")

    @cached_property
    def bronze_lines(self) -> DataFrame:
        return self._table("bronze_invoice_lineitem", lambda: self.bronze_lines_fresh, by="invoiceId")

    @cached_property
    def bronze_manifest(self) -> DataFrame:
        return self._table("bronze_run_manifest", lambda: self.bronze_manifest_fresh)

    @cached_property
    def bronze_email(self) -> DataFrame:
        return self._table("bronze_ingestion_email", lambda: self.bronze_email_fresh)

    @cached_property
    def invoice_documents(self) -> DataFrame:
        """The documents of all runs, with nested lines."""
        return self._table("invoice_documents", lambda: driver.documents_of(self.spark, self.sf_dir))

    # -- silver, computed fresh from bronze ----------------------------------
    @cached_property
    def silver_invoice_fresh(self) -> DataFrame:
        # from the files, as of any table: the query shuffles, the layer below reads the buckets
        self.bronze_header  # noqa: B018 - written by now
        path, schema = _WRITTEN[(self.spark.sparkContext.applicationId, self._stamp, "bronze_invoice_header")]
        return silver.latest_headers(self.spark.read.schema(schema).parquet(path))

    @cached_property
    def silver_lines_fresh(self) -> DataFrame:
        return silver.latest_lines(self.bronze_lines, self.silver_invoice_fresh)

    @cached_property
    def checked(self) -> DataFrame:
        return silver.checked_from_lines(self.silver_invoice_fresh, self.bronze_lines)

    # -- silver tables as written (the input of gold and the rules) ----------
    @cached_property
    def silver_invoice(self) -> DataFrame:
        return self._table("silver_invoice", lambda: silver.latest_headers(self.bronze_header), by="invoiceId")

    @cached_property
    def silver_lines(self) -> DataFrame:
        return self._table("silver_invoice_lineitem", lambda: silver.latest_lines(self.bronze_lines, self.silver_invoice), by="invoiceId")

    # -- reference data and lookups -------------------------------------------
    @cached_property
    def ledger_items(self) -> DataFrame:
        return self._table("ledger_items", lambda: driver.ledger_items(self.spark, self.sf_dir))

    @cached_property
    def ledger_categories(self) -> DataFrame:
        return self._table("ledger_categories", lambda: driver.ledger_categories(self.spark, self.sf_dir))

    @cached_property
    def fx_rates(self) -> DataFrame:
        return driver.fx_rates(self.spark)

    @cached_property
    def category_medians(self) -> DataFrame:
        return self._table("category_medians", lambda: gold.category_medians(self.silver_lines))

    # -- matches and match records (J7, J8, A7, A8) ------------------------------
    @cached_property
    def matched_in_category(self) -> DataFrame:
        lookup = self._table("lookup_category", lambda: L.category_lookup(
            self.silver_lines, self.ledger_items, self.ledger_categories))
        return L.match_in_category(self.silver_lines, self.ledger_items, self.ledger_categories, lookup=lookup)

    @cached_property
    def matched_global(self) -> DataFrame:
        by_desc = self._table("lookup_description", lambda: L.description_lookup(self.silver_lines, self.ledger_items))
        by_vend = self._table("lookup_vendor", lambda: L.vendor_lookup(self.silver_lines, self.ledger_items, by_desc))
        return L.match_global(self.silver_lines, self.ledger_items, by_desc=by_desc, by_vend=by_vend)

    @cached_property
    def records_aud(self) -> DataFrame:
        return self._table("match_records_aud", lambda: R.classify_aud(self.matched_global))

    @cached_property
    def records_category(self) -> DataFrame:
        return self._table("match_records_category", lambda: R.classify_category(self.matched_in_category))

    # -- layers ------------------------------------------------------------
    def silver_tables(self) -> dict[str, DataFrame]:
        return silver.silver(self.bronze_header, self.bronze_lines)

    def gold_tables(self) -> dict[str, DataFrame]:
        return gold.gold(self.silver_invoice, self.silver_lines)

    def obs_tables(self) -> dict[str, DataFrame]:
        return obs.obs(self.bronze_manifest, self.bronze_header)
