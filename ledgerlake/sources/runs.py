"""Run folders of invoice JSON (S1-S4, S9, S10) and the bronze tables read from them.

Layout: ``<root>/run-<digits>/<file>`` -- ingestion.json, invoice.json,
result.json, the uploaded documents, extracts.  Spark lists the root in
parallel (``binaryFile`` for the inventory, the JSON source for content),
but its file index holds the status of every file on the driver.  Where the
folders' names are a table (``folders``: that of what was written), the tasks
list and read them, and nothing of a file passes through the driver.  Without
it keep one root per date and read root by root, or feed the tables from the
stream (:mod:`ledgerlake.streaming.incremental`).

Only ``run-`` folders are taken (other folders, e.g. ``email-<utc>``, are
left out of every table).  No reader infers a schema (that would read
everything twice): invoice.json and ingestion.json have an explicit one, a
file without a field yields nulls; result.json, whose nodes vary by run, is
read whole, as one variant.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from .. import schemas
from ..functions import jsonops as J
from ..functions.columns import is_supported_document, run_id_from_path
from . import folders as run_folders


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def list_run_files(spark: SparkSession, root: str, folders: DataFrame | None = None) -> DataFrame:
    """All files under ``root`` (recursively; with ``folders`` in those):
    path, length, modificationTime.

    The ``content`` column is never selected, so file bodies are not read.
    """
    if folders is not None:
        return run_folders.list_folders(folders, root)
    try:
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
                 .select("path", "length", "modificationTime"))
    except Exception as exc:  # noqa: BLE001 - a missing root means no runs
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            return _empty(spark, T.StructType([T.StructField("path", T.StringType()),
                                               T.StructField("length", T.LongType()),
                                               T.StructField("modificationTime", T.TimestampType())]))
        raise
    return files


def run_manifest(spark: SparkSession, root: str, folders: DataFrame | None = None) -> DataFrame:
    """One row per file in a run folder: run_id, file_name, size, mtime.
    Spark's file scans leave out files of no bytes, so does this."""
    files = list_run_files(spark, root, folders)
    ms = F.unix_millis("modificationTime")
    return (files.withColumn("run_id", run_id_from_path("path")).filter(F.col("run_id") != "")
            .select("run_id",
                    F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"),
                    F.col("length").alias("size_bytes"),
                    ms.alias("modify_time_ms"),
                    F.timestamp_millis(ms).alias("modify_time")))


def discover_runs(spark: SparkSession, root: str, folders: DataFrame | None = None) -> DataFrame:
    """The run folders that hold at least one file."""
    return runs_of(run_manifest(spark, root, folders))


def runs_of(manifest: DataFrame) -> DataFrame:
    """S1 on a manifest: its runs, folders of other names left out."""
    return manifest.filter(F.col("run_id").startswith(K.RUN_PREFIX)).select("run_id").distinct()


def latest_runs(runs: DataFrame, n: int = K.RUN_LIST_LIMIT) -> DataFrame:
    """Run names with the ``run-`` prefix, newest (name descending) first, top n."""
    return (runs_of(runs)
            .orderBy(F.col("run_id").desc()).limit(n))


def supported_documents(manifest: DataFrame) -> DataFrame:
    """Files the pipeline accepts as documents (.pdf .png .jpg .jpeg)."""
    return manifest.filter(is_supported_document("file_name"))


def tagged(raw: DataFrame, path: F.Column) -> DataFrame:
    """P5: records with source_path, run_id and ingested_at; records of files
    outside run folders are dropped."""
    return (raw.withColumn("source_path", path)
            .withColumn("run_id", run_id_from_path("source_path"))
            .filter(F.col("run_id") != "")
            .withColumn("ingested_at", F.current_timestamp()))


def read_json_per_run(spark: SparkSession, root: str, file_name: str, schema: T.StructType | None,
                      multiline: bool = True, folders: DataFrame | None = None) -> DataFrame:
    """S2 + S3: ``<root>/run-*/<file_name>`` for every run that has it.

    Tagged with source_path, run_id (P5) and ingested_at.  Runs without the
    file simply contribute no rows; with no file at all the frame is empty
    with the expected schema.  Without a ``schema`` each document is read
    whole, as the variant ``document`` (null if it is no JSON).  With
    ``folders`` each file is one document, whatever ``multiline`` says.
    """
    if folders is not None:
        named = run_folders.list_folders(folders, root).where(F.regexp_extract("path", r"([^/]+)$", 1) == file_name)
        texts = run_folders.read_texts(named, root)
        if schema is None:
            raw = texts.select("path", F.try_parse_json("text").alias("document"))
        else:
            raw = texts.select("path", J.parse_json("text", schema).alias("_file")).select("path", "_file.*")
        return tagged(raw, F.col("path")).drop("path")
    reader = (spark.read.option("multiLine", str(multiline).lower())
              .option("recursiveFileLookup", "true")
              .option("pathGlobFilter", file_name))
    reader = reader.schema(schema) if schema is not None else reader.option("singleVariantColumn", "document")
    try:
        raw = reader.json(root)
    except Exception as exc:  # noqa: BLE001 - no folder means no rows
        if any(k in str(exc) for k in ("PATH_NOT_FOUND", "does not exist")):
            fields = schema.fields if schema is not None else [T.StructField("document", T.VariantType())]
            return _empty(spark, T.StructType(fields + [T.StructField("source_path", T.StringType()),
                                                        T.StructField("run_id", T.StringType()),
                                                        T.StructField("ingested_at", T.TimestampType())]))
        raise
    return tagged(raw, F.col("_metadata.file_path"))


# --- bronze tables from run folders (P1-P4) ---------------------------------------------
# The table functions take parsed files (run_id, source_path, ingested_at and the
# file's fields), wherever they were read from: folders, a stream or a table.

def invoice_headers(files: DataFrame) -> DataFrame:
    """One row per invoice of the parsed invoice files."""
    inv = J.explode_rows(files.select("run_id", "source_path", "ingested_at", "invoices"), "invoices", "inv")
    return inv.select("run_id", "source_path", "ingested_at", *[F.col(f"inv.{c}").alias(c) for c in K.HEADER_COLUMNS])


def invoice_lines(files: DataFrame) -> DataFrame:
    """One row per invoice line, numeric text cast to double (junk is null)."""
    inv = J.explode_rows(files.select("run_id", "ingested_at", "invoices"), "invoices", "inv")
    lines = J.explode_rows(inv.select("run_id", "ingested_at", F.col("inv.invoiceId").alias("invoiceId"),
                                      F.col("inv.vendorName").alias("vendorName"),
                                      F.col("inv.lineItems").alias("lineItems")), "lineItems", "line")
    return lines.select("run_id", "ingested_at", "invoiceId", "vendorName",
                        *[F.col(f"line.{c}").alias(c) for c in ("lineNo", "categoryName", "description")],
                        *[F.col(f"line.{c}").try_cast("double").alias(c) for c in K.LINE_NUMERIC_COLUMNS])


def ingestion_emails(files: DataFrame) -> DataFrame:
    """Parsed ingestion files flattened; bad dates read as null."""
    return files.select(
        "run_id", "ingested_at", "ingestionStatus", "reason",
        F.col("email.id").cast("string").alias("email_id"),
        F.col("email.from").alias("email_from"),
        F.col("email.fromName").alias("email_from_name"),
        F.col("email.to").alias("email_to"),
        F.col("email.subject").alias("email_subject"),
        F.try_to_date(F.col("email.date")).alias("email_date"),
        F.col("email.preview").alias("email_preview"),
        F.col("email.body").alias("email_body"),
        F.size("email.attachments").alias("attachment_count"))


def bronze_invoices(spark: SparkSession, root: str, multiline: bool = True,
                    file_name: str = "invoice.json") -> tuple[DataFrame, DataFrame]:
    """P1 + P2: (bronze_invoice_header, bronze_invoice_lineitem) from
    invoice.json; with none anywhere both are empty with the bronze schemas."""
    headers = read_json_per_run(spark, root, file_name, schemas.invoice_file(K.HEADER_COLUMNS), multiline)
    lines = read_json_per_run(spark, root, file_name, schemas.invoice_file(("invoiceId", "vendorName", "lineItems")), multiline)
    return invoice_headers(headers), invoice_lines(lines)


def bronze_ingestion_email(spark: SparkSession, root: str, folders: DataFrame | None = None) -> DataFrame:
    """P3 from ingestion.json."""
    return ingestion_emails(read_json_per_run(spark, root, "ingestion.json", schemas.INGESTION_FILE, folders=folders))


def bronze_run_result(spark: SparkSession, root: str, folders: DataFrame | None = None) -> DataFrame:
    """Result.json folded into one JSON string per run: the whole document
    with whatever nodes it has, each as it is, null fields dropped (nulls in
    arrays stay).  Variants keep every run's own types, so a node that is text
    in one run and an object in another is changed in neither."""
    res = read_json_per_run(spark, root, "result.json", None, folders=folders)
    return res.select("run_id", "ingested_at", J.without_null_fields(F.to_json("document")).alias("result_json"))


def bronze_from_runs(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All five bronze tables of a run-folder root."""
    header, lines = bronze_invoices(spark, root)
    return {
        "bronze_invoice_header": header,
        "bronze_invoice_lineitem": lines,
        "bronze_ingestion_email": bronze_ingestion_email(spark, root),
        "bronze_run_result": bronze_run_result(spark, root),
        "bronze_run_manifest": run_manifest(spark, root),
    }
