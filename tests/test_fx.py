from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlake.operators import fx

from .fixtures import reference_rates


def _inv(spark, rows):
    return spark.createDataFrame(rows, "id int, currency string, d string, amount double")


def test_rate_lookup_edges(spark):
    rates = reference_rates(spark)
    df = _inv(spark, [(1, "USD", "2026-05-16", 1.0), (2, "usd", "2025-03-31", 1.0), (3, "USD", "2025-04-01", 1.0),
                      (4, "EUR", "2025-12-31", 1.0), (5, "USD", None, 1.0), (6, "JPY", "2025-05-01", 1.0),
                      (7, "USD", "2024-12-31", 1.0), (8, None, "2025-05-01", 1.0), (9, "USD", "not a date", 1.0)])
    got = {r["id"]: r["rate"] for r in fx.fx_rate_lookup(df, rates, "currency", "d", "rate").collect()}
    assert got[1] == Decimal("1.570000")          # open-ended period
    assert got[2] == Decimal("1.580000")          # toDate inclusive, case-insensitive currency
    assert got[3] == Decimal("1.560000")          # fromDate inclusive
    assert got[4] == Decimal("1.640000")
    assert got[5] == Decimal("1.570000")          # no date -> newest fromDate
    assert got[6] is None and got[7] is None and got[8] is None
    assert got[9] == Decimal("1.570000")          # unparsable date behaves as no date


def test_latest_from_date_wins_on_overlap(spark):
    rates = spark.createDataFrame(
        [("USD", "AUD", "2025-01-01", None, Decimal("1.5")), ("USD", "AUD", "2025-06-01", "2025-06-30", Decimal("1.6"))],
        "from string, to string, fromDate string, toDate string, rate decimal(18,6)")
    df = _inv(spark, [(1, "USD", "2025-06-15", 1.0), (2, "USD", "2025-07-01", 1.0)])
    got = {r["id"]: float(r["rate"]) for r in fx.fx_rate_lookup(df, rates, "currency", "d", "rate").collect()}
    assert got == {1: 1.6, 2: 1.5}


def test_convert_same_currency_and_half_even(spark):
    rates = spark.createDataFrame([("USD", "AUD", "2025-01-01", None, Decimal("1.25"))],
                                  "from string, to string, fromDate string, toDate string, rate decimal(18,6)")
    df = _inv(spark, [(1, "AUD", "2025-02-01", 10.005), (2, "USD", "2025-02-01", 0.5), (3, "USD", "2025-02-01", 0.7),
                      (4, "EUR", "2025-02-01", 3.0)])
    out = fx.fx_convert(df, rates, "amount", "currency", "d", rate_col="rate", out_col="aud")
    got = {r["id"]: (r["rate"], r["aud"]) for r in out.collect()}
    assert got[1][0] == Decimal("1") and got[1][1] == Decimal("10.005")  # AUD: rate 1, the amount as it is
    assert got[2][1] == Decimal("0.62")                                 # 0.625 -> half-even
    assert got[3][1] == Decimal("0.88")                                 # 0.875 -> half-even
    assert got[4] == (None, None)


def test_amounts_keep_their_decimals_until_after_the_rate(spark):
    df = spark.createDataFrame([(1, "AUD", "2026-05-01", 1.0050), (2, "USD", "2026-05-01", 0.015), (3, "USD", "2026-05-01", 0.005),
                                (4, "USD", "2026-05-01", 1e30)], "id int, currency string, d string, amount double")
    out = fx.fx_convert(df, reference_rates(spark), "amount", "currency", "d", out_col="aud")
    got = {r["id"]: r["aud"] for r in out.collect()}
    assert got[1] == Decimal("1.0050") and got[2] == Decimal("0.02") and got[3] == Decimal("0.01")
    assert got[4] is None                       # too large for the decimal: null, not a failed job


def test_daily_rates_and_dates_beyond_the_horizon(spark):
    rows = [("USD", "AUD", f"2025-{m:02d}-{d:02d}", f"2025-{m:02d}-{d:02d}", Decimal(m * 100 + d)) for m in range(1, 13) for d in range(1, 28)]
    rows += [("USD", "AUD", "2026-01-01", None, Decimal(7)), ("EUR", "AUD", "2025-05-01", "2025-04-01", Decimal(9))]
    rates = spark.createDataFrame(rows, "from string, to string, fromDate string, toDate string, rate decimal(18,6)")
    df = _inv(spark, [(1, "USD", "2025-03-09", 1.0), (2, "USD", "2025-03-29", 1.0), (3, "USD", "2525-01-01", 1.0),
                      (4, "USD", "2026-01-01", 1.0), (5, "EUR", "2025-04-15", 1.0)])
    got = {r["id"]: r["rate"] for r in fx.fx_rate_lookup(df, rates, "currency", "d", "rate").collect()}
    assert got == {1: Decimal(309), 2: None, 3: Decimal(7), 4: Decimal(7), 5: None}


def test_golden_eur_invoice(spark):
    df = _inv(spark, [(1, "EUR", "2026-02-01", 32880.0)])
    out = fx.fx_convert(df, reference_rates(spark), "amount", "currency", "d", out_col="aud").collect()[0]
    assert out["aud"] == Decimal("54580.80")


def test_first_rate_conversion(spark):
    rates = reference_rates(spark)
    df = _inv(spark, [(1, "usd", "2026-05-01", 100.0), (2, "AUD", None, 12.345), (3, None, None, 1.0),
                      (4, "JPY", None, 1.0), (5, "USD", None, 0.125)])
    got = {r["id"]: r["aud_amount"] for r in fx.convert_first_rate(df, rates, "amount", "currency").collect()}
    assert got[1] == 158.0          # first listed USD rate (1.58) whatever the date
    assert got[2] == 12.345         # AUD passes through unrounded
    assert got[3] is None and got[4] is None
    assert got[5] == 0.2            # Math.round(19.75) / 100


def test_validate_rates(spark):
    rows = [("usd", "aud", "2025-01-01", None, Decimal("1.5")), ("", "AUD", "2025-01-01", None, Decimal("1.5")),
            ("USD", "AUD", None, None, Decimal("1.5")), ("USD", "AUD", "2025-01-01", None, Decimal("0"))]
    df = spark.createDataFrame(rows, "from string, to string, fromDate string, toDate string, rate decimal(18,6)")
    valid, rejected = fx.validate_rates(df)
    assert [(r["from"], r["to"]) for r in valid.collect()] == [("USD", "AUD")]
    assert rejected.count() == 3


def test_generated_rates_cover_benchmark_dates(spark):
    g = fx.generated_rates(spark)
    assert g.count() == fx.GENERATED_FX_ROWS
    assert g.filter(F.col("toDate").isNull()).count() == 2
    df = _inv(spark, [(1, "USD", "1995-01-01", 1.0), (2, "EUR", "2001-08-01", 1.0)])
    assert all(r["rate"] is not None for r in fx.fx_rate_lookup(df, g, "currency", "d", "rate").collect())
