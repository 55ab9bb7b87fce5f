"""Canonical tables to the frozen serving shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def serve_delisted(grave: DataFrame) -> DataFrame:
    return grave.select("ticker", "termination_date", "termination_reason", "terminal_return")


def serve_coverage(metrics: DataFrame) -> DataFrame:
    return metrics.select("audit_window", "coverage")


def serve_sectors(sectors: DataFrame) -> DataFrame:
    return sectors.filter("sector IS NOT NULL").select("ticker", "sector", "industry")


def serve_intraday(intraday: DataFrame) -> DataFrame:
    """`minute` is naive UTC."""
    return intraday.select(
        "ticker", F.col("minute_ts").cast("timestamp_ntz").alias("minute"), "bid", "ask",
        "volume", "derivation",
    )
