"""Currency conversion by transaction date (D-06, B-12..B-14, I-11, L-01).

Rates come from a table ``(fx_date, currency, usd_quote)`` meaning
``1 USD = usd_quote units``, so the rate to USD is ``1 / usd_quote``.
Precedence per row: table rate (source ``API``; USD is always 1.0), else
the rate carried in the payload (``PAYLOAD``), else none (``MISSING``).

Nearly all transactions of a day share a few currencies, so (day, currency)
is the hottest key there is and no row is shuffled by it. Rates are packed to
one row a day, a map from currency to rate with at most one entry for each
accepted currency, and the days are broadcast: up to ``BROADCAST_DAYS`` of
them, a bound that the calendar keeps and that is checked. Beyond it the rows
are dealt by day and a salt, the packed days once for each salt. USD is no
lookup at all.

Money is ``decimal(38,9)`` from its text to the tables; rates are ratios and
stay doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from syncforge.functions.casts import MONEY, try_decimal
from syncforge.functions.columns import as_col
from syncforge.schemas import CURRENCY_CODES
from syncforge.session import materialize

API, PAYLOAD, MISSING = "API", "PAYLOAD", "MISSING"
BASE_CURRENCY = "USD"
#: Days that are broadcast: 40 years, at most 163 rates of about 30 bytes each.
BROADCAST_DAYS = 14_610
SALTS = 32


def minor_to_major(amount, exponent) -> Column:
    """B-12: ``amount / 10^exponent`` of an amount's text, exactly: the point is moved in the text.

    A missing or unreadable amount or exponent gives NULL, and so does an
    amount that nine decimals and 29 digits before them do not hold.
    """
    plain = try_decimal(amount).cast("string")
    e = as_col(exponent)
    return F.when(e.isNotNull(), F.concat(plain, F.lit("e"), (-e).cast("string")).try_cast(MONEY))


def in_usd(amount, rate) -> Column:
    """Money times a rate, rounded half up to nine decimals (beyond 19 digits through doubles)."""
    exact = as_col(amount).try_cast("decimal(28,9)") * as_col(rate).try_cast("decimal(25,18)")
    return F.coalesce(exact.try_cast(MONEY), (as_col(amount).cast("double") * as_col(rate)).try_cast(MONEY))


def rates_to_usd(rates: DataFrame) -> DataFrame:
    """One rate per (fx_date, currency). A zero quote yields no rate, and so do
    quotes of one day that differ: such a row falls back to its payload rate
    or is quarantined, instead of taking one of them silently."""
    rate = F.try_divide(F.lit(1.0), F.col("usd_quote").cast("double"))
    return rates.groupBy(
        F.col("fx_date").cast("date").alias("_fx_date"),
        F.upper(F.col("currency")).alias("_fx_cur"),
    ).agg(F.when(F.min(rate) == F.max(rate), F.max(rate)).alias("_api_rate"))


def packed_rates(rates: DataFrame) -> DataFrame:
    """One row a day: ``_fx_date`` and the map ``_rates`` of its accepted currencies."""
    known = rates_to_usd(rates).where(F.col("_fx_date").isNotNull() & F.col("_fx_cur").isin(*CURRENCY_CODES) & F.col("_api_rate").isNotNull())
    return known.groupBy("_fx_date").agg(F.map_from_entries(F.collect_list(F.struct("_fx_cur", "_api_rate"))).alias("_rates"))


def with_day_rates(df: DataFrame, rates: DataFrame, date_col: str) -> DataFrame:
    """``df`` with the map ``_rates`` of its day (NULL without one)."""
    days = materialize(packed_rates(rates))
    if days.count() <= BROADCAST_DAYS:
        return df.join(F.broadcast(days), F.col(date_col) == F.col("_fx_date"), "left").drop("_fx_date")
    salted = days.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own = df.withColumn("_own", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)).cast("int"))
    return own.join(salted, (F.col(date_col) == F.col("_fx_date")) & (F.col("_own") == F.col("_salt")), "left").drop("_fx_date", "_own", "_salt")


def convert_to_usd(
    df: DataFrame,
    rates: DataFrame,
    date_col: str = "fx_date",
    currency_col: str = "original_currency",
    amount_col: str = "original_amount",
    payload_rate_col: str | None = "payload_exchange_rate",
) -> DataFrame:
    """Adds ``exchange_rate``, ``fx_source`` and ``amount_usd`` (B-13); currencies are compared as they are."""
    j = with_day_rates(df, rates, date_col)
    day, currency = F.col(date_col), F.col(currency_col)
    api = F.when(day.isNotNull() & (currency == F.lit(BASE_CURRENCY)), F.lit(1.0)).otherwise(F.try_element_at("_rates", currency))
    payload = F.col(payload_rate_col) if payload_rate_col else F.lit(None).cast("double")
    return (
        j.withColumn("exchange_rate", F.coalesce(api, payload))
        .withColumn(
            "fx_source",
            F.when(api.isNotNull(), F.lit(API)).when(payload.isNotNull(), F.lit(PAYLOAD)).otherwise(F.lit(MISSING)),
        )
        .withColumn("amount_usd", in_usd(amount_col, F.col("exchange_rate")))
        .drop("_rates")
    )
