"""Configuration dimensions: the universe, the intraday watchlist and the SIC ranges.

These are hand-kept lists of at most a few hundred entries; YAML files are read on the driver when a
YAML reader is installed, plain Python lists always work.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

try:
    import yaml
except ImportError:  # plain lists still work
    yaml = None


def read_yaml(path: str) -> dict:
    if yaml is None:
        raise RuntimeError("reading YAML configuration needs a YAML package; pass lists instead")
    return yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}


def universe(spark: SparkSession, entries: Iterable[Mapping[str, str] | str]) -> DataFrame:
    """(ticker, role); the role defaults to `member`."""
    rows = []
    for e in entries:
        item = {"ticker": e} if isinstance(e, str) else e
        rows.append((str(item["ticker"]).upper(), str(item.get("role", "member"))))
    if not rows:
        raise ValueError("the universe is empty")
    return spark.createDataFrame(rows, "ticker string, role string")


def watchlist(spark: SparkSession, tickers: Iterable[str]) -> DataFrame:
    rows = [(str(t).upper(),) for t in tickers]
    if not rows:
        raise ValueError("the watchlist is empty")
    return spark.createDataFrame(rows, "ticker string")


def sic_ranges(entries: Iterable[Mapping[str, object]]) -> list[tuple[int, int, str]]:
    """Ranges in list order, for `sector_of`."""
    rows = [(int(r["lo"]), int(r["hi"]), str(r["sector"])) for r in entries]
    if not rows:
        raise ValueError("the SIC map is empty")
    return rows
