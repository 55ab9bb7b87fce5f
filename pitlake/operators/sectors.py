"""SIC codes to sector labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Inclusive SIC ranges and their sector; the first match from the top wins.
SIC_RANGES = [
    (3570, 3579, "XLK"),
    (3600, 3699, "XLK"),
    (7370, 7379, "XLK"),
    (2700, 2799, "XLC"),
    (4800, 4899, "XLC"),
    (7800, 7899, "XLC"),
    (2830, 2839, "XLV"),
    (3840, 3859, "XLV"),
    (8000, 8099, "XLV"),
    (6000, 6499, "XLF"),
    (6700, 6799, "XLF"),
    (6500, 6599, "XLRE"),
    (1300, 1399, "XLE"),
    (2900, 2999, "XLE"),
    (1000, 1299, "XLB"),
    (2600, 2699, "XLB"),
    (2800, 2829, "XLB"),
    (2840, 2899, "XLB"),
    (3200, 3399, "XLB"),
    (2000, 2199, "XLP"),
    (5400, 5499, "XLP"),
    (5912, 5912, "XLP"),
    (2300, 2399, "XLY"),
    (3700, 3719, "XLY"),
    (5000, 5999, "XLY"),
    (7000, 7299, "XLY"),
    (5800, 5899, "XLY"),
    (4900, 4999, "XLU"),
    (1500, 1799, "XLI"),
    (3400, 3569, "XLI"),
    (3580, 3599, "XLI"),
    (3720, 3799, "XLI"),
    (4000, 4799, "XLI"),
    (8700, 8799, "XLI"),
]


def sector_of(sic: Column, ranges: list[tuple[int, int, str]] | None = None) -> Column:
    """Sector of a SIC code given as text; blank or non-numeric codes have none.

    The list is configuration of a few dozen entries, so it becomes one CASE expression: no join, and
    the first matching branch wins as the list demands.
    """
    code = F.trim(sic.cast("string")).try_cast("int")
    chain = None
    for low, high, sector in ranges or SIC_RANGES:
        hit = code.between(low, high)
        chain = F.when(hit, sector) if chain is None else chain.when(hit, sector)
    return chain


def sector_projection(
    submissions: DataFrame, known: DataFrame, now: Column,
    ranges: list[tuple[int, int, str]] | None = None,
) -> DataFrame:
    """Sector rows for submissions of tickers not known yet; the later request key wins.

    submissions: (request_key `ticker:cik`, sic, industry).
    """
    parts = F.split("request_key", ":", 2)
    keyed = submissions.select(
        parts[0].alias("ticker"), parts[1].alias("cik"), "request_key",
        F.nullif(F.col("sic").cast("string"), F.lit("")).alias("sic"), "industry",
    ).join(known.select("ticker"), "ticker", "left_anti")
    w = W.partitionBy("ticker").orderBy(F.desc("request_key"))
    return (
        keyed.withColumn("_rn", F.row_number().over(w))
        .filter("_rn = 1")
        .select(
            "ticker", "cik", "sic", sector_of(F.col("sic"), ranges).alias("sector"), "industry",
            F.lit("edgar").alias("source"), now.alias("updated_at"),
        )
    )
