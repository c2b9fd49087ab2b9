"""FX rates: period lookup (J4), conversion (J5, J6), validation.

The rate table is reference data: one row per currency pair and period.
The lookup is an as-of / range join written Spark-first: the rate table is
first resolved into disjoint effective segments per currency
(:func:`rate_segments`), so "latest fromDate wins" is decided once, not per
input row.  Segments are listed under every month they touch, so input rows
meet only the segments of their currency and month in an equi-join; at most
one matches, and the input is never de-duplicated.  Daily rates therefore
cost a row no more than 31 comparisons.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from .. import schemas
from ..sizing import fixed_broadcast

RATE_TYPE = T.DecimalType(18, 6)
#: Decimals for products: 20 + 17 digits hold amount x rate without loss.
AMOUNT_TYPE, FACTOR_TYPE = T.DecimalType(20, 6), T.DecimalType(17, 6)
#: Segments are listed by month up to here; later dates use this last month.
HORIZON_YEAR = 2100
_HORIZON = HORIZON_YEAR * 12
_NO_DATE = -1
# Generated FX table: currencies x quarters over the benchmark years.
GENERATED_FX_ROWS = len(K.FX_GENERATED_BASE) * 4 * (K.FX_GENERATED_LAST_YEAR - K.FX_GENERATED_FIRST_YEAR + 1)


def generated_rates(spark: SparkSession) -> DataFrame:
    """Quarterly rates into AUD for the benchmark years, built by rule.

    rate = base + 0.01 * (((year * 4 + quarter) * 3) mod 5 - 2); the last
    quarter is open-ended (toDate null), like the reference table.  Built
    from a range of quarter numbers and a literal per-currency array (no
    join); the size is fixed: currencies x quarters = GENERATED_FX_ROWS.
    """
    quarters = 4 * (K.FX_GENERATED_LAST_YEAR - K.FX_GENERATED_FIRST_YEAR + 1)
    bases = F.array(*[F.struct(F.lit(c).alias("from"), F.lit(float(b)).alias("base"), F.lit(i).alias("ccy_idx"))
                      for i, (c, b) in enumerate(K.FX_GENERATED_BASE)])
    q = spark.range(quarters).select(F.col("id").alias("qi"), F.inline(bases))
    year = F.lit(K.FX_GENERATED_FIRST_YEAR) + (F.col("qi") / 4).cast("int")
    month = (F.col("qi") % 4) * 3 + 1
    start = F.make_date(year, month.cast("int"), F.lit(1))
    step = (((year * 4 + F.col("qi") % 4) * 3) % 5 - 2).cast("double")
    return (q.select(
                F.col("from"), F.lit(K.LEDGER_CURRENCY).alias("to"),
                F.date_format(start, "yyyy-MM-dd").alias("fromDate"),
                F.when(F.col("qi") == quarters - 1, F.lit(None).cast("string"))
                 .otherwise(F.date_format(F.last_day(F.add_months(start, 2)), "yyyy-MM-dd")).alias("toDate"),
                F.round(F.col("base") + F.lit(0.01) * step, 2).cast(RATE_TYPE).alias("rate"),
                (F.col("ccy_idx") * 1000 + F.col("qi")).alias("position")))


def read_rates_json(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """``{rates:[...]}`` documents (files, or lines) -> one row per rate."""
    raw = spark.read.schema(schemas.FX_FILE).option("multiLine", str(multiline).lower()).json(path)
    return raw.select(F.explode("rates").alias("r")).select("r.*")


def validate_rates(rates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split rates into (valid, rejected).

    from, to and fromDate are required (non-blank) and the rate must be
    positive; rejected rows carry the reason.
    """
    def blank(c):
        return F.col(c).isNull() | (F.trim(F.col(c)) == "")
    reason = (F.when(blank("from") | blank("to") | blank("fromDate"),
                     F.lit("From/To currency, From Date and a positive rate are required."))
              .when(F.col("rate").isNull() | (F.col("rate") <= 0),
                    F.lit("From/To currency, From Date and a positive rate are required.")))
    tagged = rates.withColumn("reject_reason", reason)
    valid = (tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason")
             .withColumn("from", F.upper(F.trim("from"))).withColumn("to", F.upper(F.trim("to"))))
    return valid, tagged.filter(F.col("reject_reason").isNotNull())


def replace_rates(spark: SparkSession, new_rates: DataFrame, path: str) -> DataFrame:
    """Whole-table overwrite of the rate table with validated rows."""
    valid, _ = validate_rates(new_rates)
    valid.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _month(date) -> Column:
    """Running number of a date's month, no later than the horizon's."""
    return F.least(F.year(date) * 12 + F.month(date), F.lit(_HORIZON))


def rate_segments(rates: DataFrame, to_currency: str = K.LEDGER_CURRENCY) -> DataFrame:
    """Resolve a rate table into disjoint effective date segments, one row per
    segment and month: (ccy, month, seg_start, seg_end, rate).

    The answer to "rate of currency c on date d" only changes at a period
    start or the day after a period end.  Those boundaries cut each
    currency's time line into segments; each segment takes the rate of the
    covering period with the latest fromDate (text order, as the app sorts).
    One extra row per currency (month -1) answers the no-date case: the
    newest fromDate of all.  Periods meet boundaries by currency and month,
    never all by all.
    """
    p = (rates.filter(F.upper("to") == F.lit(to_currency.upper()))
         .select(F.upper("from").alias("ccy"), F.col("fromDate").alias("fd_text"), F.try_to_date("fromDate").alias("fd"),
                 F.col("toDate").alias("td_text"), F.try_to_date("toDate").alias("td"),
                 F.col("rate").cast(RATE_TYPE).alias("rate")))
    # a period with an unparsable or earlier toDate never matches a date
    dated = p.filter(F.col("fd").isNotNull() & (F.col("td_text").isNull() | (F.col("td") >= F.col("fd"))))
    cuts = dated.select("ccy", F.explode(F.array_compact(F.array("fd", F.date_add("td", 1)))).alias("seg_start")).distinct()
    following = F.lead("seg_start").over(Window.partitionBy("ccy").orderBy("seg_start"))
    cuts = cuts.withColumn("seg_end", F.date_sub(following, 1)).withColumn("month", _month("seg_start"))
    last = F.coalesce(_month("td"), F.lit(_HORIZON))
    covering = dated.select("ccy", "fd_text", "fd", "td", "rate", F.explode(F.sequence(_month("fd"), last)).alias("month"))
    segments = (cuts.join(covering, ["ccy", "month"])
                .filter((F.col("fd") <= F.col("seg_start")) & (F.col("td").isNull() | (F.col("seg_start") <= F.col("td"))))
                .groupBy("ccy", "seg_start", "seg_end").agg(F.max(F.struct("fd_text", "rate")).alias("w"))
                .select("ccy", F.explode(F.sequence(_month("seg_start"), F.coalesce(_month("seg_end"), F.lit(_HORIZON)))).alias("month"),
                        "seg_start", "seg_end", F.col("w.rate").alias("rate")))
    newest = (p.groupBy("ccy").agg(F.max(F.struct("fd_text", "rate")).alias("w"))
              .select("ccy", F.lit(_NO_DATE).alias("month"), F.lit(None).cast("date").alias("seg_start"),
                      F.lit(None).cast("date").alias("seg_end"), F.col("w.rate").alias("rate")))
    return segments.unionByName(newest).filter(F.col("rate").isNotNull())


def segment_rows(rate_rows: int) -> int:
    """Bound on the segment rows of the generated rates: per currency the
    months to the horizon, and two cuts a rate."""
    months = _HORIZON - (K.FX_GENERATED_FIRST_YEAR - 1) * 12
    return len(K.FX_GENERATED_BASE) * (months + 1) + 2 * rate_rows


def fx_rate_lookup_many(df: DataFrame, rates: DataFrame, currency_col: str,
                        dates: dict[str, str | None], to_currency: str = K.LEDGER_CURRENCY,
                        known_rate_rows: int | None = None) -> DataFrame:
    """J4 for one or more dates of each row.

    ``dates`` maps output column -> date column (None = no date).
    Currency compares ignoring case; ``fromDate <= date <= toDate`` with both
    ends inclusive and a null toDate open; the latest fromDate wins; a null
    date takes the newest rate of all.  No rate -> null.

    Plan: an equi-join on (currency, month) with a range condition against
    disjoint segments -- at most one match per row, no de-duplication.  The
    generated rates, whose number is known, are broadcast; other rate tables
    are left to the planner.
    """
    segs = rate_segments(rates, to_currency)
    if known_rate_rows is not None:
        segs = fixed_broadcast(segs, segment_rows(known_rate_rows))
    ccy = F.upper(F.col(currency_col))
    out = df
    for i, (out_col, date_col) in enumerate(dates.items()):
        s = segs.select(*[F.col(c).alias(f"_s{i}_{c}") for c in ("ccy", "month", "seg_start", "seg_end", "rate")])
        on_date = F.try_to_date(F.col(date_col).cast("string")) if date_col else F.lit(None).cast("date")
        d = F.col(f"_s{i}_d")
        out = out.withColumn(f"_s{i}_d", on_date).withColumn(f"_s{i}_m", F.coalesce(_month(d), F.lit(_NO_DATE)))
        within = d.isNull() | ((F.col(f"_s{i}_seg_start") <= d)
                               & (F.col(f"_s{i}_seg_end").isNull() | (d <= F.col(f"_s{i}_seg_end"))))
        out = (out.join(s, (ccy == F.col(f"_s{i}_ccy")) & (F.col(f"_s{i}_m") == F.col(f"_s{i}_month")) & within, "left")
               .withColumn(out_col, F.col(f"_s{i}_rate"))
               .drop(*s.columns, f"_s{i}_d", f"_s{i}_m"))
    return out


def fx_rate_lookup(df: DataFrame, rates: DataFrame, currency_col: str, date_col: str | None,
                   out_col: str = "fx_rate", to_currency: str = K.LEDGER_CURRENCY,
                   known_rate_rows: int | None = None) -> DataFrame:
    """Left lookup of the rate for (currency, date)."""
    return fx_rate_lookup_many(df, rates, currency_col, {out_col: date_col}, to_currency, known_rate_rows)


def same_currency(currency_col: str, to_currency: str = K.LEDGER_CURRENCY) -> Column:
    return F.upper(F.col(currency_col)) == F.lit(to_currency.upper())


def effective_rate(found_rate_col: str, currency_col: str, to_currency: str = K.LEDGER_CURRENCY) -> Column:
    """Rate used by J5: 1 for the same currency, else the looked-up rate."""
    return F.when(same_currency(currency_col, to_currency), F.lit(1).cast(RATE_TYPE)).otherwise(F.col(found_rate_col))


def converted_amount(amount_col: str, currency_col: str, found_rate_col: str,
                     to_currency: str = K.LEDGER_CURRENCY) -> Column:
    """J5 amount: same currency -> the amount as it is; no rate -> null; else
    amount x rate on decimals, rounded half-even to cents once, at the end.
    Amounts of more than 14 digits before the point give null."""
    amount = F.col(amount_col).try_cast(AMOUNT_TYPE)
    product = F.bround(amount * F.col(found_rate_col).try_cast(FACTOR_TYPE), 2)
    return F.when(same_currency(currency_col, to_currency), amount).otherwise(product.try_cast(AMOUNT_TYPE))


def fx_convert(df: DataFrame, rates: DataFrame, amount_col: str, currency_col: str,
               date_col: str | None, to_currency: str = K.LEDGER_CURRENCY,
               rate_col: str = "fx_rate", out_col: str = "converted_amount",
               known_rate_rows: int | None = None) -> DataFrame:
    """Convert ``amount`` into ``to_currency`` at the rate of ``date``."""
    looked = fx_rate_lookup(df, rates, currency_col, date_col, "_fx_found", to_currency, known_rate_rows)
    return (looked
            .withColumn(rate_col, effective_rate("_fx_found", currency_col, to_currency))
            .withColumn(out_col, converted_amount(amount_col, currency_col, "_fx_found", to_currency))
            .drop("_fx_found"))


def convert_first_rate(df: DataFrame, rates: DataFrame, amount_col: str, currency_col: str,
                       out_col: str = "aud_amount", rate_position_col: str = "position",
                       known_rate_rows: int | None = None) -> DataFrame:
    """Browser conversion -- first listed X->AUD rate, date ignored.

    AUD passes through unrounded; no currency or no rate -> null; else
    ``Math.round(amount * rate * 100) / 100``.  ``rates`` must carry the
    list position of each rate.
    """
    first = (rates.filter(F.upper("to") == F.lit(K.LEDGER_CURRENCY))
             .groupBy(F.upper("from").alias("_ccy"))
             .agg(F.min_by(F.col("rate").cast("double"), F.col(rate_position_col)).alias("_first_rate")))
    if known_rate_rows is not None:
        first = fixed_broadcast(first, known_rate_rows)
    ccy = F.upper(F.col(currency_col))
    joined = df.join(first, ccy == first["_ccy"], "left")
    amount = F.col(amount_col).cast("double")
    return (joined.withColumn(
        out_col,
        F.when(F.col(currency_col).isNull(), F.lit(None).cast("double"))
         .when(ccy == F.lit(K.LEDGER_CURRENCY), amount)
         .otherwise(F.floor(amount * F.col("_first_rate") * 100 + F.lit(0.5)) / 100))
        .drop("_ccy", "_first_rate"))
