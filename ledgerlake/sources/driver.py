"""The benchmark tables mapped onto the invoice data model.

The driver's parquet tables (orders, lineitem, part, customer, nation,
events, documents, labels) stand in for folders of invoice-run JSON.  Each
function returns a lazily built frame shaped exactly like the matching
bronze table, so every operator downstream runs unchanged on either input.

Mapping (see README for the rationale):

* invoice header  = orders ⋈ customer ⋈ nation; one invoice per order in
  run ``run-<orderdate yyyyMMdd>``.  Orders with status 'P' were extracted
  partially (status 'failed') and re-run a week later (status 'ok', some
  'failed' again).  Most totals are the sum of the order's lines.
* invoice line    = lineitem ⋈ part ⋈ header (both runs of a re-run order).
* ledger          = part grouped by (p_type, p_name).
* run manifest    = events, one run per (user, day).
* ingestion email = documents ⟕ labels.

The benchmark's rows would never fail a check or miss the ledger, so some
are spoiled by rule (the ``(modulus, remainder)`` pairs in ``constants``):
required fields go missing, descriptions name no item, categories are not in
the ledger, lines are charged at list price.

All joins are equi-joins on keys; the small fixed lookups (region currency,
payment terms, event file names, FX periods, 25 nations) have sizes fixed by
construction and are broadcast; the rest is left to the planner and AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..operators import fx
from ..functions.jsonops import explode_rows
from ..functions.columns import run_id_of, with_descriptive_fields
from ..functions.literal import literal_table
from ..sizing import fixed_broadcast

NATION_ROWS = 25  # by definition of the table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lookup(spark: SparkSession, rows, columns: list[tuple[str, str]]) -> DataFrame:
    return fixed_broadcast(literal_table(spark, rows, columns), len(rows))


def _spoiled(key: str, rule: tuple[int, int]) -> F.Column:
    """Whether a (modulus, remainder) rule of ``constants`` takes a row."""
    return F.pmod(F.col(key), F.lit(rule[0])) == rule[1]


def fx_rates(spark: SparkSession) -> DataFrame:
    return fx.generated_rates(spark)


def _header_first_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region_ccy = _lookup(spark, K.REGION_CURRENCY, [("n_regionkey", "int"), ("currency", "string")])
    terms = _lookup(spark, K.PRIORITY_TERMS, [("o_orderpriority", "string"), ("paymentTerms", "string"),
                                            ("due_days", "int")])
    return (orders
            .join(customer, orders.o_custkey == customer.c_custkey)
            .join(fixed_broadcast(nation, NATION_ROWS), customer.c_nationkey == nation.n_nationkey)
            .join(region_ccy, "n_regionkey", "left")
            .join(terms, "o_orderpriority", "left")
            .select(
                "o_orderkey", "o_orderdate", "o_orderstatus", "c_name", "currency", "paymentTerms",
                "due_days", F.col("o_totalprice").alias("totalAmount")))


def invoice_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (order, run): the first run, plus the re-run of 'P' orders.

    Built with one scan of orders: each order explodes into its run
    delays (0, or 0 and 7 days), instead of a union of two scans.
    """
    first = _header_first_run(spark, sf_dir)
    delays = F.when(F.col("o_orderstatus") == K.RERUN_ORDER_STATUS,
                    F.array(F.lit(0), F.lit(K.RERUN_DELAY_DAYS))).otherwise(F.array(F.lit(0)))
    return (first.withColumn("_delay", F.explode(delays))
            .withColumn("rerun", F.col("_delay") > 0)
            .withColumn("run_day", F.date_add(F.col("o_orderdate").cast("date"), F.col("_delay")))
            .drop("_delay"))


def _invoice_number(order_key: str) -> F.Column:
    """The invoice of an order.  Joins on it leave their rows where a table in
    buckets of invoiceId has them."""
    return F.concat(F.lit("INV-"), F.col(order_key).cast("string"))


def _line_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum of the lines of each order's invoice (map-side partial sums)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice")
    return (li.groupBy(_invoice_number("l_orderkey").alias("_inv"))
            .agg(F.round(F.sum("l_extendedprice"), 2).alias("_lines_total")))


def invoice_header(spark: SparkSession, sf_dir: str, totals: bool = True) -> DataFrame:
    """Bronze header shape (+ ``_inv``, the order's invoice number, for the
    line join, dropped by callers).  Without ``totals`` the amounts are those of the order: the
    line table needs none of them, and the sums are not computed."""
    keys = invoice_keys(spark, sf_dir).withColumn("_inv", _invoice_number("o_orderkey"))
    if totals:
        keys = (keys.join(_line_totals(spark, sf_dir), "_inv", "left")
                .withColumn("totalAmount", F.when(_spoiled("o_orderkey", K.TOTAL_AS_ORDERED), F.col("totalAmount"))
                            .otherwise(F.coalesce("_lines_total", "totalAmount"))).drop("_lines_total"))
    inv_date = F.col("o_orderdate").cast("date")
    h = (keys
         .withColumn("run_id", F.concat(F.lit(K.RUN_PREFIX), F.date_format("run_day", "yyyyMMdd")))
         .withColumn("invoiceDate", F.date_format(inv_date, "yyyy-MM-dd"))
         .withColumn("dueDate", F.date_format(F.date_add(inv_date, F.col("due_days")), "yyyy-MM-dd")))
    # exchangeRate is the invoice-date rate; the converted amount uses the
    # due-date rate, so period changes surface in the FX consistency check.
    h = fx.fx_rate_lookup_many(h, fx_rates(spark), "currency",
                               {"_rate_inv": "invoiceDate", "_rate_due": "dueDate"},
                               known_rate_rows=fx.GENERATED_FX_ROWS)
    h = (h.withColumn("_rate_inv", fx.effective_rate("_rate_inv", "currency"))
          .withColumn("_conv_due", fx.converted_amount("totalAmount", "currency", "_rate_due")))
    order = F.col("o_orderkey").cast("string")
    h = h.withColumns({
        "source_path": F.concat(F.lit("/invoices/"), F.col("run_id"), F.lit("/invoice.json")),
        "fileName": F.concat(F.lit("invoice-"), order, F.lit(".pdf")),
        "invoiceId": _invoice_number("o_orderkey"),
        "vendorName": F.col("c_name")})
    for name, modulus, remainder in K.FIELD_MISSING:
        h = h.withColumn(name, F.when(~_spoiled("o_orderkey", (modulus, remainder)), F.col(name)))
    failed = ((F.col("o_orderstatus") == K.RERUN_ORDER_STATUS)
              & (~F.col("rerun") | _spoiled("o_orderkey", K.STILL_FAILED)))
    h = with_descriptive_fields(h).withColumns({
        "businessName": F.when(_spoiled("o_orderkey", K.NO_BUSINESS_NAME), "")
        .when(F.col("rerun") & _spoiled("o_orderkey", K.CORRECTED_BUSINESS), F.concat("vendorName", F.lit(" Ltd")))
        .otherwise(F.col("businessName")),
        "invoiceCurrency": F.when(_spoiled("o_orderkey", K.NO_INVOICE_CURRENCY), "").otherwise(F.col("invoiceCurrency"))})
    return h.select(
        "_inv", "run_id", "source_path", F.current_timestamp().alias("ingested_at"), "fileName",
        F.lit(None).cast("string").alias("blobUrl"), "invoiceId", "vendorName",
        F.concat(F.lower(F.regexp_replace("c_name", "#", "")), F.lit("@vendor.example")).alias("vendorEmail"),
        "invoiceDate", "dueDate", "paymentTerms", "currency", "totalAmount",
        F.lit("invoice").alias("documentType"),
        F.when(failed, F.lit("failed")).otherwise(F.lit("ok")).alias("extractionStatus"),
        F.when(failed, F.lit("partial extraction")).alias("extractionNotes"),
        "businessName", "fromDate", "toDate", "invoiceAmount", "invoiceCurrency",
        F.col("_rate_inv").cast("double").alias("exchangeRate"),
        F.col("_conv_due").cast("double").alias("convertedInvoiceAmount"),
        "convertedInvoiceCurrency")


def bronze_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return invoice_header(spark, sf_dir).drop("_inv")


def bronze_lines(spark: SparkSession, sf_dir: str, header: DataFrame | None = None) -> DataFrame:
    """Bronze line shape: every lineitem row under every run of its order."""
    h = (header if header is not None else invoice_header(spark, sf_dir, totals=False)).select(
        "_inv", "run_id", "ingested_at", "invoiceId", "vendorName", "exchangeRate")
    return (_priced_lines(spark, sf_dir).withColumn("_inv", _invoice_number("l_orderkey"))
            .join(h, "_inv")
            .select(
                "run_id", "ingested_at", "invoiceId", "vendorName", "lineNo", "categoryName", "description",
                "quantity", "unitPrice", "lineTotal",
                F.round(F.col("unitPrice") * F.col("exchangeRate"), 2).alias("convertedUnitPrice"),
                F.round(F.col("lineTotal") * F.col("exchangeRate"), 2).alias("convertedLineTotal"),
            ))


def _priced_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ part as invoice lines, before their invoice is known."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")
    charged = F.round(F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")), 2)
    return (li.join(part, li.l_partkey == part.p_partkey)
            .select(
                "l_orderkey",
                F.col("l_linenumber").cast("string").alias("lineNo"),
                F.when(_spoiled("p_partkey", K.UNLISTED_CATEGORY), F.concat(F.lit("Unlisted "), "p_type"))
                .otherwise(F.col("p_type")).alias("categoryName"),
                F.when(_spoiled("p_partkey", K.UNNAMED_PART), F.concat(F.lit("Freight charge "), F.col("p_partkey").cast("string")))
                .when(_spoiled("p_partkey", K.ITEM_NAME_ONLY), F.col("p_name"))
                .otherwise(F.concat_ws(" ", "p_name", "p_brand")).alias("description"),
                F.col("l_quantity").alias("quantity"),
                F.when(_spoiled("p_partkey", K.LIST_PRICE), F.col("p_retailprice")).otherwise(charged).alias("unitPrice"),
                F.col("l_extendedprice").alias("lineTotal")))


def bronze_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run manifest shape from events: one run per (user, day)."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    names = _lookup(spark, K.EVENT_FILE_NAMES, [("event_type", "string"), ("slot", "bigint"), ("file_name", "string")])
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return (ev.withColumn("slot", F.pmod(F.col("event_id"), F.lit(3)).cast("bigint"))
            .join(names, ["event_type", "slot"], "left")
            .select(
                run_id_of("ts", "user_id").alias("run_id"),
                F.coalesce("file_name", F.concat("event_type", F.lit(".json"))).alias("file_name"),
                F.floor(F.col("value") * 1000).cast("long").alias("size_bytes"),
                ms.alias("modify_time_ms"),
                F.timestamp_millis(ms).alias("modify_time")))


def bronze_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingestion email shape from documents and their labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    status = (F.when(F.col("quality") == 1, F.lit("accepted"))
              .when(F.col("quality") == 0, F.lit("rejected")))
    reason = (F.when(F.col("toxic") == 1, F.lit("flagged content"))
              .when(F.col("quality") == 0, F.lit("not an invoice"))
              .when(F.col("quality") == 1, F.lit("invoice attached")))
    return (docs.join(labels, "doc_id", "left")
            .select(
                F.concat(F.lit(K.RUN_PREFIX), F.col("doc_id").cast("string")).alias("run_id"),
                F.current_timestamp().alias("ingested_at"),
                status.alias("ingestionStatus"),
                reason.alias("reason"),
                F.col("doc_id").cast("string").alias("email_id"),
                F.concat("source", F.lit("@mail.example")).alias("email_from"),
                F.col("source").alias("email_from_name"),
                F.lit("ap@ledger.example").alias("email_to"),
                F.concat_ws(" ", "lang", F.lit("document"), F.col("doc_id").cast("string")).alias("email_subject"),
                F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 366).cast("int")).alias("email_date"),
                F.substring("text", 1, 80).alias("email_preview"),
                F.col("text").alias("email_body"),
                F.pmod(F.col("doc_id"), F.lit(3)).cast("int").alias("attachment_count")))


def ledger_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat ledger (P22 output shape) derived from part.

    One item per (p_type, p_name): code = smallest part key, expected unit
    price = lowest retail price, one alias = the brand of the first part,
    and for some items a second one, a vendor's name.  ``item_position`` is
    the ledger order (by code).
    """
    code = F.col("item_position").cast("string")
    vendor = F.when(_spoiled("item_position", K.VENDOR_ALIAS), F.concat(F.lit("Customer#"), F.when(
        F.length(code) < 9, F.lpad(code, 9, "0")).otherwise(code)))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")
    return (part.groupBy(F.col("p_type").alias("categoryName"), "p_name")
            .agg(F.min("p_partkey").alias("item_position"),
                 F.min("p_retailprice").alias("expectedUnitPrice"),
                 F.min_by("p_brand", "p_partkey").alias("alias"))
            .select("categoryName",
                    (F.col("item_position") - _spoiled("item_position", K.SHARED_CODE).cast("int")).cast("string").alias("ledgerCode"),
                    F.upper("p_name").alias("itemName"),
                    "expectedUnitPrice",
                    F.array_compact(F.array(F.col("alias"), vendor)).alias("aliases"),
                    "item_position"))


def ledger_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category budget rows derived from part: budget 50x, YTD 20x retail sum."""
    part = table(spark, sf_dir, "part").select("p_type", "p_retailprice")
    return (part.groupBy(F.col("p_type").alias("categoryName"))
            .agg(F.round(F.sum("p_retailprice") * 50, 2).alias("approvedBudget"),
                 F.round(F.sum("p_retailprice") * 20, 2).alias("ytdBalance")))


# --- agent payloads and ledger changes (P4, P13, P14, A10) ----------------------
# The app's agents reply with free text around JSON, in whichever shape the
# model chose; the general ledger is edited one call at a time.  Both are
# derived here row by row from the bronze tables and lineitem, so the
# operators that read them run over the whole tables.

def documents_of(spark: SparkSession, sf_dir: str, lines_each: int = K.LINES_PER_DOCUMENT) -> DataFrame:
    """Invoice documents (run_id, source_path, ingested_at, invoice): the
    lines of an invoice in documents of at most ``lines_each``, by their
    numbers, and one document without lines for an invoice that has none.

    A document's size is bounded by the numbers of its lines, so an invoice
    with any number of lines is only so many documents, and its header is
    written once for all lines of a document.  The lines are gathered before
    they meet the headers: a re-run order has one set of documents' lines.
    They are shuffled once, by their order, which places them for both.
    """
    line = _line_struct()
    part = F.floor((F.col("lineNo").cast("long") - 1) / lines_each)
    lines = (_priced_lines(spark, sf_dir).withColumn("_inv", _invoice_number("l_orderkey")).repartition("_inv")
             .groupBy("_inv", part.alias("part"))
             .agg(F.array_sort(F.collect_list(F.struct(F.col("lineNo").cast("long").alias("at"), line.alias("line")))).alias("_lines")))
    return _documents(invoice_header(spark, sf_dir), lines.select("_inv", F.transform("_lines", lambda x: x["line"]).alias("_lines")))


def line_documents_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice documents as in :func:`documents_of`, one per line: every row of
    lineitem brings its invoice's header along, whatever its number."""
    lines = _priced_lines(spark, sf_dir).select(_invoice_number("l_orderkey").alias("_inv"), F.array(_line_struct()).alias("_lines"))
    return _documents(invoice_header(spark, sf_dir), lines)


_LINE_FIELDS = ("lineNo", "categoryName", "description", "quantity", "unitPrice", "lineTotal")


def _line_struct() -> F.Column:
    return F.struct(*[F.col(c) for c in _LINE_FIELDS])


def _documents(h: DataFrame, lines: DataFrame) -> DataFrame:
    """Headers with each of their orders' ``_lines`` arrays, converted at the
    header's rate; a header without lines once."""
    rate = F.col("exchangeRate")

    def priced(given: F.Column) -> F.Column:
        return F.struct(*[given[c].alias(c) for c in _LINE_FIELDS],
                        F.round(given["unitPrice"] * rate, 2).alias("convertedUnitPrice"),
                        F.round(given["lineTotal"] * rate, 2).alias("convertedLineTotal"))

    joined = h.join(lines, "_inv", "left")
    invoice = F.struct(*K.HEADER_COLUMNS, F.transform("_lines", priced).alias("lineItems"))
    return joined.select("run_id", "source_path", "ingested_at", invoice.alias("invoice"))


def invoice_files(documents: DataFrame) -> DataFrame:
    """The documents as invoice.json texts, ``{"invoices": [...]}``."""
    return documents.select("source_path", "ingested_at",
                            F.to_json(F.struct(F.array("invoice").alias("invoices"))).alias("text"))


def reply_shape() -> F.Column:
    """Payload shape per invoice: short terms reply as a JSON array of
    invoices, NET 30 as an ``{"invoices": [...]}`` object, the rest as one
    bare invoice object (the three shapes P13 accepts)."""
    terms = F.col("invoice.paymentTerms")
    return (F.when(terms.isin("PREPAID", "NET 14"), F.lit("array"))
            .when(terms == "NET 30", F.lit("object"))
            .otherwise(F.lit("single")))


def agent_invoice_replies(documents: DataFrame) -> DataFrame:
    """One agent reply per invoice document, in one of the three shapes and
    wrapped in prose, as the agent's text arrives (null fields left out)."""
    shape, inv = F.col("shape"), F.col("invoice")
    payload = (F.when(shape == "array", F.to_json(F.array(inv)))
               .when(shape == "object", F.to_json(F.struct(F.array(inv).alias("invoices"))))
               .otherwise(F.to_json(inv)))
    return (documents.withColumn("shape", reply_shape())
            .select("run_id", "shape",
                    F.concat(F.lit("Extracted invoice data:\n"), payload, F.lit("\nEnd of reply.")).alias("reply")))


def email_struct() -> F.Column:
    """The email object of an ingestion payload, from bronze email columns."""
    return F.struct(F.col("email_id").cast("long").alias("id"), F.col("email_from").alias("from"),
                    F.col("email_from_name").alias("fromName"), F.col("email_to").alias("to"),
                    F.col("email_subject").alias("subject"),
                    F.date_format("email_date", "yyyy-MM-dd").alias("date"),
                    F.col("email_preview").alias("preview"), F.col("email_body").alias("body"),
                    attachments().alias("attachments"))


def attachments() -> F.Column:
    """The attachments of an email: as many as it counts, named by its id,
    without URLs."""
    return F.transform(F.slice(F.array(F.lit(1), F.lit(2)), 1, F.col("attachment_count")), lambda i: F.struct(
        F.concat(F.lit("invoice-"), F.col("email_id"), F.lit("-"), i.cast("string"), F.lit(".pdf")).alias("name"),
        F.lit(None).cast("string").alias("blobUrl"), F.lit(None).cast("string").alias("invoiceId")))


def uploads(email: DataFrame) -> DataFrame:
    """Uploaded files (run_id, name, blobUrl, position): every email's first
    attachment, of some emails twice."""
    twice = F.pmod(F.col("email_id").cast("long"), F.lit(K.UPLOADED_TWICE[0])) == K.UPLOADED_TWICE[1]
    each = email.filter(F.col("attachment_count") > 0).select(
        "run_id", F.get(attachments(), 0)["name"].alias("name"),
        F.explode(F.when(twice, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("position"))
    return each.withColumn("blobUrl", F.concat(F.lit("https://files.example/"), "run_id", F.lit("/"), F.col("position").cast("string")))


def ingestion_payloads(email: DataFrame) -> DataFrame:
    """Ingestion JSON per email run: decided emails come wrapped
    (``{ingestionStatus, reason, email}``), undecided ones as the raw email
    object the scenarios hold."""
    wrapped = F.to_json(F.struct("ingestionStatus", "reason", email_struct().alias("email")))
    return email.select("run_id", F.col("ingestionStatus").isNotNull().alias("wrapped"),
                        F.when(F.col("ingestionStatus").isNotNull(), wrapped)
                         .otherwise(F.to_json(email_struct())).alias("payload"))


def result_updates(email: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents that make up a run's result.json (run_id, text): the
    ingestion document of every email; the result document that half of the
    decided ones already have (it holds a node of its own and no email
    body); and updates (with their ``step``): a draft for every email, and a
    second status for those with attachments."""
    number = F.col("email_id").cast("long")
    wrapped = F.to_json(F.struct("ingestionStatus", "reason", email_struct().alias("email")))
    ingestion = email.select("run_id", wrapped.alias("text"))
    has_result = F.col("ingestionStatus").isNotNull() & (number % 2 == 0)
    result = email.filter(has_result).select("run_id", F.to_json(F.struct(
        "ingestionStatus", F.struct(F.col("email_subject").alias("title"), number.alias("number")).alias("draft"))).alias("text"))
    draft = email.select("run_id", F.lit(1).alias("step"), F.to_json(F.struct(
        F.struct(F.lit("first").alias("version"), (number % 7).alias("score")).alias("draft"))).alias("text"))
    status = email.filter(F.col("attachment_count") > 0).select("run_id", F.lit(2).alias("step"), F.to_json(F.struct(
        F.lit("processed").alias("ingestionStatus"), F.array(number).alias("invoices"))).alias("text"))
    return ingestion, result, draft.unionByName(status)


def run_files(email: DataFrame) -> DataFrame:
    """Files of run folders (folder, file_name, text), from the emails.

    A decided email is a run: its ingestion.json (some runs have none), a
    result.json for every second one and the PDF of its first attachment.  An
    undecided email lies in an ``email-`` folder, which is no run.  Result
    documents are of four shapes, so a node is text in one run and an object,
    an array or nothing in another; their null fields are written out.
    """
    number = F.col("email_id").cast("long")
    decided = F.col("ingestionStatus").isNotNull()
    as_is = {"ignoreNullFields": "false"}
    none = F.lit(None).cast("string")
    shapes = [
        F.struct("ingestionStatus", F.struct(F.col("email_subject").alias("title"), number.alias("number")).alias("draft"), none.alias("note")),
        F.struct("ingestionStatus", F.col("email_body").alias("draft"), F.lit(1).alias("v")),
        F.struct(F.array(F.to_json(F.struct(number.alias("n"))), none, F.col("email_subject")).alias("draft"),
                 F.lit(9007199254740993).cast("long").alias("v"), email_struct().alias("email")),
        F.struct(none.alias("draft"), F.struct(F.lit('a":null,').alias("k"), F.struct(none.alias("none"), F.lit(True).alias("yes")).alias("deep"))
                 .alias("v"))]
    result = F.to_json(shapes[3], as_is)
    for i, shape in enumerate(shapes[:3]):
        result = F.when(F.pmod(number, F.lit(8)) == 2 * i, F.to_json(shape, as_is)).otherwise(result)
    def file(name, text: F.Column, when: F.Column) -> F.Column:
        return F.when(when, F.struct(name.alias("file_name"), text.alias("text")))

    wrapped = F.to_json(F.struct("ingestionStatus", "reason", email_struct().alias("email")))
    missing = F.pmod(number, F.lit(K.NO_INGESTION_FILE[0])) == K.NO_INGESTION_FILE[1]
    files = F.array(
        file(F.lit("ingestion.json"), F.when(decided, wrapped).otherwise(F.to_json(email_struct())), ~(decided & missing)),
        file(F.lit("result.json"), result, decided & (number % 2 == 0)),
        file(F.concat(F.lit("invoice-"), F.col("email_id"), F.lit(".PDF")), F.lit("%PDF-1.4"), decided & (F.col("attachment_count") > 0)))
    folder = F.when(decided, F.col("run_id")).otherwise(F.concat(F.lit("email-"), F.col("email_id")))
    rows = explode_rows(email.select(folder.alias("folder"), F.filter(files, lambda f: f.isNotNull()).alias("files")), "files", "file")
    return rows.select("folder", "file.file_name", "file.text")


def run_date(run_id: F.Column) -> F.Column:
    """The day in a run id ``run-yyyyMMdd...``; null without one."""
    return F.try_to_date(F.substring(run_id, len(K.RUN_PREFIX) + 1, 8), "yyyyMMdd")


def rerun_files(manifest: DataFrame) -> DataFrame:
    """The manifest rows of the days that are run again: their JSON files, at
    twice the size."""
    modulus, remainder = K.RERUN_DAY
    again = (F.dayofmonth("run_date") % modulus == remainder) & F.col("file_name").endswith(".json")
    return manifest.where(again).withColumn("size_bytes", F.col("size_bytes") * 2)


def ledger_change_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10 change rows from lineitem, one per line, on the invoice entries.

    (returnflag, linestatus) picks the call: R/F deletes the invoice's
    entry, R/O adds it again (re-opened), A updates its amount to the net
    line value (status adjusted), N/F updates only its status (settled),
    N/O adds a new entry per line.  Adds leave Currency and Status null, so
    the add defaults apply.  ``seq`` orders the calls: ship date, then the
    line's keys.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_discount",
        "l_returnflag", "l_linestatus", "l_shipdate")
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    invoice = F.concat(F.lit("INV-"), F.col("l_orderkey").cast("string"))
    new_line = (flag == "N") & (status == "O")
    reopen = (flag == "R") & (status == "O")
    op = (F.when((flag == "R") & (status == "F"), F.lit("delete"))
          .when(reopen | new_line, F.lit("add"))
          .otherwise(F.lit("update")))
    amount = (F.when(flag == "A", F.round(F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount")), 2))
              .when(reopen | new_line, F.col("l_extendedprice")))
    return li.select(
        op.alias("op"),
        F.when(new_line, F.concat(invoice, F.lit("-L"), F.col("l_linenumber").cast("string")))
         .otherwise(invoice).alias("Id"),
        F.when(reopen | new_line, invoice).alias("InvoiceNumber"),
        F.lit(None).cast("string").alias("Vendor"),
        F.when(new_line, F.col("l_partkey").cast("string")).alias("Account"),
        amount.try_cast("decimal(18,2)").alias("Amount"),
        F.lit(None).cast("string").alias("Currency"),
        F.when(reopen | new_line, F.col("l_shipdate")).alias("EntryDate"),
        F.when(flag == "A", F.lit("adjusted")).when((flag == "N") & (status == "F"), F.lit("settled"))
         .alias("Status"),
        F.when(new_line, F.concat(F.lit("line "), F.col("l_linenumber").cast("string")))
         .when(reopen, F.lit("re-opened")).alias("Description"),
        F.struct("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey").alias("seq"))


def fx_rate_submissions(invoices: DataFrame) -> DataFrame:
    """Rate rows as a user would submit them on the FX page (P23 input),
    implied by the kept invoices: per currency and due-date quarter, the
    largest converted / native ratio (4 places).  A currency without a
    rate (no converted amounts) submits a null rate."""
    start = F.date_trunc("quarter", F.try_to_date("dueDate", "yyyy-MM-dd")).cast("date")
    ratio = F.try_divide(F.col("convertedInvoiceAmount"), F.col("totalAmount"))
    return (invoices.select("currency", start.alias("_q"), ratio.alias("_ratio"))
            .groupBy("currency", "_q")
            .agg(F.round(F.max("_ratio"), 4).alias("_rate"), F.count(F.lit(1)).alias("invoices"))
            .select(F.col("currency").alias("from"), F.lit(K.LEDGER_CURRENCY).alias("to"),
                    F.date_format("_q", "yyyy-MM-dd").alias("fromDate"),
                    F.date_format(F.last_day(F.add_months("_q", 2)), "yyyy-MM-dd").alias("toDate"),
                    F.col("_rate").try_cast("decimal(18,6)").alias("rate"), "invoices"))
