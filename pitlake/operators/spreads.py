"""Spread estimates and the hybrid intraday frame."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pitlake.functions.clocks import exchange_date
from pitlake.functions.numeric import floor_at_zero, square
from pitlake.operators.adjust import servable

QUOTED = "iex_bbo"
SYNTHETIC = "corwin_schultz"
_K = 3.0 - 2.0 * math.sqrt(2.0)


def spread_inputs(bars: DataFrame) -> DataFrame:
    """Servable daily ranges whose logarithm exists."""
    return servable(bars).filter("high > 0 AND low > 0").select("ticker", "bar_date", "high", "low")


def corwin_schultz(daily: DataFrame) -> DataFrame:
    """(ticker, bar_date, cs_spread) from the ranges of a bar and the one before it.

    Corwin and Schultz (2012), with negative estimates set to zero. A ticker's first bar has no
    estimate. One row per (ticker, bar_date), so windows are bounded by the calendar.
    """
    w = W.partitionBy("ticker").orderBy("bar_date")
    hi, lo = F.ln("high"), F.ln("low")
    pairs = daily.select(
        "ticker", "bar_date", hi.alias("h"), lo.alias("l"),
        F.lag(hi).over(w).alias("h0"), F.lag(lo).over(w).alias("l0"),
    ).filter("h0 IS NOT NULL AND l0 IS NOT NULL")
    beta = square(F.col("h") - F.col("l")) + square(F.col("h0") - F.col("l0"))
    gamma = square(F.greatest("h", "h0") - F.least("l", "l0"))
    alpha = (F.sqrt(beta * 2) - F.sqrt(beta)) / _K - F.sqrt(gamma / _K)
    # 2(e^a - 1)/(e^a + 1) is twice the hyperbolic tangent of a/2
    return pairs.select(
        "ticker", "bar_date", floor_at_zero(F.tanh(alpha / 2) * 2).alias("cs_spread")
    ).filter("cs_spread IS NOT NULL")


def hybrid_intraday(minutes: DataFrame, quote_bars: DataFrame, cs_daily: DataFrame) -> DataFrame:
    """Minute bars with real bid/ask where quoted, else a synthetic pair around the close.

    The fallback spread is that of the minute's exchange-local date, zero when there is none.
    """
    quotes = quote_bars.select("ticker", "minute_ts", "bid_close", "ask_close")
    joined = (
        minutes.select("ticker", "minute_ts", "close", "volume")
        .join(quotes, ["ticker", "minute_ts"], "left")
        .withColumn("bar_date", exchange_date("minute_ts"))
        .join(cs_daily.select("ticker", "bar_date", "cs_spread"), ["ticker", "bar_date"], "left")
    )
    quoted = F.col("bid_close").isNotNull() & F.col("ask_close").isNotNull()
    half = F.greatest(F.coalesce("cs_spread", F.lit(0.0)) / 2, F.lit(0.0))
    return joined.select(
        "ticker", "minute_ts",
        F.when(quoted, F.col("bid_close")).otherwise(F.col("close") * (1 - half)).alias("bid"),
        F.when(quoted, F.col("ask_close")).otherwise(F.col("close") * (1 + half)).alias("ask"),
        "volume",
        F.when(quoted, QUOTED).otherwise(SYNTHETIC).alias("derivation"),
    )


def derivation_mix(intraday: DataFrame) -> DataFrame:
    return intraday.groupBy("derivation").agg(F.count("*").alias("n_rows"))


def regular_hours(minutes: DataFrame, sessions: DataFrame) -> DataFrame:
    """Optional: keep minutes inside their session's open and close."""
    hours = sessions.select(
        F.col("session_date").alias("_day"), "open_utc", "close_utc"
    )
    return (
        minutes.join(hours, exchange_date("minute_ts") == F.col("_day"))
        .filter("minute_ts >= open_utc AND minute_ts < close_utc")
        .select(*minutes.columns)
    )
