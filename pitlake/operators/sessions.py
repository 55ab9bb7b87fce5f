"""Operators over the exchange-session dimension (one row per session)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlake.functions.clocks import EXCHANGE_TZ

# How far back a completed session is looked for, and the full-day closing hour.
LOOKBACK_DAYS = 10
FULL_DAY_CLOSE_HOUR = 16


def half_day(close_utc: Column) -> Column:
    return F.hour(F.from_utc_timestamp(close_utc, EXCHANGE_TZ)) < FULL_DAY_CLOSE_HOUR


def with_half_day(sessions: DataFrame) -> DataFrame:
    return sessions.withColumn("is_half_day", half_day(F.col("close_utc")))


def latest_completed(sessions: DataFrame, now: Column, lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """One row: the newest session closed at or before `now`, null when none is within `lookback_days`."""
    today = F.to_date(now)
    recent = sessions.filter(
        F.col("session_date").between(F.date_sub(today, lookback_days), today)
        & (F.col("close_utc") <= now)
    )
    return recent.agg(F.max("session_date").alias("session_date"))


def sessions_between(sessions: DataFrame, start: str, end: str) -> DataFrame:
    return sessions.filter(
        F.col("session_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    )


def previous_sessions(sessions: DataFrame, reference: str, n: int) -> DataFrame:
    """The last `n` session dates up to `reference`; `n` is the size of the report."""
    past = sessions.filter(F.col("session_date") <= F.lit(reference).cast("date"))
    return past.select("session_date").orderBy(F.desc("session_date")).limit(n)


def sessions_within(sessions: DataFrame, reference: str, days: int) -> DataFrame:
    """Session dates of the trailing `days` calendar days, both ends included."""
    day = F.lit(reference).cast("date")
    return sessions.filter(F.col("session_date").between(F.date_sub(day, days), day)).select(
        "session_date"
    )


def replace_range(
    sessions: DataFrame, fresh: DataFrame, exchange: str, start: str, end: str
) -> DataFrame:
    """The dimension with one exchange's [start, end] replaced by the rows of `fresh` in it."""
    inside = (F.col("exchange") == exchange) & F.col("session_date").between(
        F.lit(start).cast("date"), F.lit(end).cast("date")
    )
    return sessions.filter(~inside).unionByName(fresh.filter(inside).select(*sessions.columns))
