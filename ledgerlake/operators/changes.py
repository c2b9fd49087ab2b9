"""General-ledger entry changes (A10) applied as a batch.

The app edits an in-memory list one call at a time (list / get / add /
update / delete).  At scale the same semantics are a keyed merge of a
batch of change rows into the entry table.  Change rows carry ``op``
(add, update, delete), ``Id`` (the app makes a fresh one for each add),
the entry fields, and a sequence number.  Per Id, in sequence order:

* add sets the entry -- defaults Currency USD, Status pending, EntryDate
  now -- and delete removes it; the last of these resets the entry;
* each later update overwrites only the fields it gives (null keeps);
  an update of an unknown or deleted Id changes nothing ("not found").

Per Id one aggregate finds the last reset and, for each field, the last
update that gives it with its sequence number; an update counts if it is
later than the reset.  The aggregate is partial (map-side), so a hot Id
never gathers in one task, and one full outer join on Id merges it into the
entries -- no change row is joined and no per-Id list is collected.

Entries are saved bucketed and sorted by Id (:func:`save_entries`).  The merge
then shuffles the changes alone, however many entries there are, and a get
reads one bucket, or with a batch of Ids no more than the buckets they meet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import write_buckets

ENTRY_FIELDS = ("InvoiceNumber", "Vendor", "Account", "Amount", "Currency", "EntryDate", "Status", "Description")
ADD_DEFAULTS = {"Currency": "USD", "Status": "pending"}


def apply_changes(entries: DataFrame, changes: DataFrame, seq_col: str = "seq") -> DataFrame:
    op, seq = F.lower(F.trim("op")), F.col(seq_col)
    reset = op.isin("add", "delete")
    last = changes.groupBy("Id").agg(
        F.max(F.when(reset, F.struct(seq.alias("seq"), op.alias("op"), *ENTRY_FIELDS))).alias("_r"),
        *[F.max(F.when((op == "update") & F.col(f).isNotNull(), F.struct(seq.alias("seq"), F.col(f).alias("to")))).alias(f"_u_{f}")
          for f in ENTRY_FIELDS])
    old = entries.select("Id", *[F.col(f).alias(f"_o_{f}") for f in ENTRY_FIELDS], F.lit(True).alias("_old"))
    j = old.join(last, "Id", "full_outer")
    r_op = F.col("_r.op")
    exists = (r_op == "add") | (r_op.isNull() & F.col("_old").isNotNull())

    def base(f: str):
        added = F.col(f"_r.{f}")
        if f in ADD_DEFAULTS:
            added = F.coalesce(added, F.lit(ADD_DEFAULTS[f]))
        elif f == "EntryDate":
            added = F.coalesce(added, F.current_timestamp())
        return F.when(r_op == "add", added).otherwise(F.col(f"_o_{f}"))

    def updated(f: str):
        return F.when(F.col("_r").isNull() | (F.col(f"_u_{f}.seq") > F.col("_r.seq")), F.col(f"_u_{f}.to"))

    return j.filter(exists).select("Id", *[F.coalesce(updated(f), base(f)).alias(f) for f in ENTRY_FIELDS])


def entries_from_invoices(invoices: DataFrame, account_col: str = "currency") -> DataFrame:
    """Ledger entries (GeneralLedger shape), one per invoice header: the AUD
    amount posted on the invoice date, status posted.  An amount beyond 16
    digits and a date that is none are null."""
    return invoices.select(
        F.col("invoiceId").alias("Id"),
        F.col("invoiceId").alias("InvoiceNumber"),
        F.col("vendorName").alias("Vendor"),
        F.col(account_col).alias("Account"),
        F.col("convertedInvoiceAmount").try_cast("decimal(18,2)").alias("Amount"),
        F.lit("AUD").alias("Currency"),
        F.try_to_timestamp(F.col("invoiceDate"), F.lit("yyyy-MM-dd")).alias("EntryDate"),
        F.lit("posted").alias("Status"),
        F.col("fileName").alias("Description"))


# --- list and get on saved entries -------------------------------------------------

def save_entries(entries: DataFrame, name: str, buckets: int | None = None, merged: bool = False) -> None:
    """The entries as a table bucketed and sorted by Id.  ``merged``: they come
    from :func:`apply_changes`, whose join has placed them by Id, so they are
    not shuffled again."""
    write_buckets(entries, name, "Id", buckets, placed=merged)


def list_entries(spark: SparkSession, name: str) -> DataFrame:
    """A10 list: all saved entries, in no particular order."""
    return spark.table(name)


def get_entry(spark: SparkSession, name: str, entry_id: str) -> DataFrame:
    """A10 get: the entry with this Id, or no row; one bucket is read."""
    return spark.table(name).where(F.col("Id") == entry_id)


def get_entries(requests: DataFrame, name: str, id_col: str = "Id") -> DataFrame:
    """A10 get for a batch: every request with ``found`` and the entry's
    fields, null where there is none.  Equal requests are answered one by one;
    only the requests are shuffled."""
    entries = requests.sparkSession.table(name).select(F.col("Id").alias("_id"), *ENTRY_FIELDS)
    kept = requests.drop(*ENTRY_FIELDS, "found")
    return (kept.join(entries, F.col(id_col) == F.col("_id"), "left")
            .withColumn("found", F.col("_id").isNotNull()).drop("_id"))
