"""Work lists over the landing manifest: what to fetch, what to build, what was done."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MANIFEST_KEY = ["dataset", "source", "request_key"]


def pending_requests(candidates: DataFrame, manifest: DataFrame) -> DataFrame:
    """Candidate requests that have no landed payload: nothing is fetched twice."""
    return candidates.join(manifest.select(*MANIFEST_KEY), MANIFEST_KEY, "left_anti")


def needs_history(
    universe: DataFrame, manifest: DataFrame, dataset: str = "yf_daily", source: str = "yfinance"
) -> DataFrame:
    """Universe tickers without any deep-history payload (`TICKER:history:...`)."""
    parts = F.split("request_key", ":")
    held = (
        manifest.filter((F.col("dataset") == dataset) & (F.col("source") == source))
        .filter(parts[1] == "history")
        .filter(F.size(parts) >= 3)
        .select(parts[0].alias("ticker"))
    )
    return universe.join(held, "ticker", "left_anti")


def missing_sectors(universe: DataFrame, sectors: DataFrame, cik_map: DataFrame) -> DataFrame:
    """Universe tickers with no sector row yet that the ticker-to-CIK map knows."""
    return (
        universe.select("ticker")
        .join(sectors.select("ticker"), "ticker", "left_anti")
        .join(cik_map.select("ticker", "cik"), "ticker")
    )


QUEUED = ("dataset", "request_key", "path")


def landed_for_date(
    manifest: DataFrame, datasets: Sequence[str], trade_date: str, columns: Sequence[str] = QUEUED
) -> DataFrame:
    """The build queue of one trade date: request keys end in its ISO form."""
    return manifest.filter(
        F.col("dataset").isin(*datasets) & F.col("request_key").endswith(f":{trade_date}")
    ).select(*columns)


def unprocessed(manifest: DataFrame, marks: DataFrame, dataset: str, columns: Sequence[str] = QUEUED) -> DataFrame:
    """Payloads of a dataset with no processing mark."""
    queue = manifest.filter(F.col("dataset") == dataset).select(*columns)
    return queue.join(marks, ["dataset", "request_key"], "left_anti")


def mark_processed(queue: DataFrame, processed_at: Column) -> DataFrame:
    return queue.select("dataset", "request_key", processed_at.alias("processed_at"))


def first_writer_wins(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Rows to append: keys not in `target`, and one row per key under `order` within the batch."""
    w = W.partitionBy(*keys).orderBy(*order)
    fresh = incoming.join(target.select(*keys), list(keys), "left_anti")
    return fresh.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
