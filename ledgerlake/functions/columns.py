"""Column expressions shared by the operators.

All of them are built-in Spark expressions, so they compile into the
surrounding whole-stage-codegen span; none needs a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def run_id_from_path(path) -> Column:
    """P5: the ``run-<digits>`` folder a file lies in, or '' when it lies in
    none.  The last folder decides, for JSON tables and manifest alike, so a
    ``run-`` folder above the root does not rename the runs."""
    return F.regexp_extract(_c(path), rf"/({K.RUN_ID_PATTERN})/[^/]+$", 1)


def run_id_of(day, number) -> Column:
    """``run-yyyyMMdd`` and a number padded to six digits; a longer number is
    kept whole."""
    text = _c(number).cast("string")
    return F.concat(F.lit(K.RUN_PREFIX), F.date_format(_c(day), "yyyyMMdd"),
                    F.when(F.length(text) < 6, F.lpad(text, 6, "0")).otherwise(text))


def with_descriptive_fields(invoices: DataFrame) -> DataFrame:
    """businessName, fromDate, toDate (empty without a due date),
    invoiceAmount, invoiceCurrency and convertedInvoiceCurrency from the
    invoice's own fields."""
    return (invoices.withColumn("businessName", F.col("vendorName"))
            .withColumn("fromDate", F.col("invoiceDate"))
            .withColumn("toDate", F.coalesce("dueDate", F.lit("")))
            .withColumn("invoiceAmount", F.col("totalAmount"))
            .withColumn("invoiceCurrency", F.col("currency"))
            .withColumn("convertedInvoiceCurrency", F.lit(K.LEDGER_CURRENCY)))


def classify_stage(file_name) -> Column:
    """File name -> pipeline stage, first matching rule wins."""
    name = _c(file_name)
    expr = None
    for kind, pattern, stage in K.STAGE_RULES:
        cond = name.endswith(pattern) if kind == "suffix" else (name == F.lit(pattern))
        expr = F.when(cond, stage) if expr is None else expr.when(cond, stage)
    return expr.otherwise(K.OTHER_STAGE)


def is_supported_document(file_name) -> Column:
    """.pdf .png .jpg .jpeg in any letter case."""
    exts = "|".join(e.lstrip(".") for e in K.SUPPORTED_DOCUMENT_EXTENSIONS)
    return F.lower(_c(file_name)).rlike(rf"\.({exts})$")


def parse_date(text) -> Column:
    """Lenient ISO date parse: null instead of an ANSI error on bad text."""
    return F.try_to_date(_c(text))


def invoice_month(date_text) -> Column:
    """``yyyy-MM`` of a date string (null when unparsable)."""
    return F.date_format(parse_date(date_text), "yyyy-MM")


def due_week(date_text) -> Column:
    """Monday 00:00 of the week holding the date."""
    return F.date_trunc("week", parse_date(date_text).cast("timestamp"))


def seconds_between(later, earlier) -> Column:
    """Whole-second difference of two timestamps."""
    return F.unix_timestamp(_c(later)) - F.unix_timestamp(_c(earlier))


def round_half_up(x, places: int = 2) -> Column:
    """P10: notebook rounding (HALF_UP on the double)."""
    return F.round(_c(x), places)


def round_half_even(x, places: int = 2) -> Column:
    """P10: banker's rounding, used where the app rounds decimals."""
    return F.bround(_c(x), places)


def detail_text(*parts) -> Column:
    """Space-joined detail text; nulls are skipped like concat_ws.

    String arguments are literals, Column arguments are values.
    """
    return F.concat_ws(" ", *[p if isinstance(p, Column) else F.lit(p) for p in parts])


def money_text(x) -> Column:
    """Fixed two-decimal text of a number (HALF_UP), no grouping separators.

    Rounded and cast through DECIMAL(38,2): the same text as "%.2f" of the
    rounded value, without a java.util.Formatter call per row.  A number too
    large for that prints through the formatter instead of failing.
    """
    rounded = F.round(_c(x), 2)
    return F.coalesce(rounded.try_cast("decimal(38,2)").cast("string"), F.format_string("%.2f", rounded))


def format_money(amount, currency=None) -> Column:
    """``CUR 0.00``; a dash for null or NaN; currency defaults to USD."""
    amt = _c(amount).cast("double")
    if currency is None:
        cur = F.lit(K.DEFAULT_MONEY_CURRENCY)
    else:
        cur = F.coalesce(F.nullif(_c(currency), F.lit("")), F.lit(K.DEFAULT_MONEY_CURRENCY))
    return F.when(amt.isNull() | F.isnan(amt), F.lit(K.MISSING_MONEY_TEXT)) \
        .otherwise(F.concat(cur, F.lit(" "), money_text(amt)))
