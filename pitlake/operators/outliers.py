"""MAD screen: a wild return from a lone vendor is quarantined, a confirmed one survives."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Deviations beyond K times the MAD are flagged once MIN_RETURNS returns exist.
K = 15.0
MIN_RETURNS = 30


def mad_screen(voted: DataFrame) -> DataFrame:
    """Adds mad_flag; single-source flagged rows become quarantined.

    Input has one row per (ticker, bar_date), so a ticker's window holds at most one row per calendar
    day. Lag, both medians and the count share one exchange on ticker.
    """
    ordered = W.partitionBy("ticker").orderBy("bar_date")
    whole = W.partitionBy("ticker")
    log_close = F.ln("close")
    deviation = F.abs(F.col("_ret") - F.col("_mid"))
    wild = (
        (F.col("_n") >= MIN_RETURNS)
        & (F.col("_spread") > 0)
        & (deviation > K * F.col("_spread"))
    )
    flagged = (
        voted.withColumn("_ret", log_close - F.lag(log_close).over(ordered))
        .withColumns({"_mid": F.median("_ret").over(whole), "_n": F.count("_ret").over(whole)})
        .withColumn("_spread", F.median(deviation).over(whole))
        .withColumn("mad_flag", F.coalesce(wild, F.lit(False)))
    )
    lone = F.col("mad_flag") & F.col("single_source")
    return flagged.withColumn(
        "grade", F.when(lone, F.lit("quarantined")).otherwise(F.col("grade"))
    ).drop("_ret", "_mid", "_n", "_spread")
