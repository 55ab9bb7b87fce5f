"""Quote ticks to per-minute bid/ask bars.

A session of one name can hold most of a night's ticks, so no step orders a whole session. Ticks
with equal timestamps stand for zero time except the last, so they collapse first (map-side combine);
stand times are then found inside short slices of a bucket, and the tick that closes a slice is
settled on slice summaries, the one that closes a bucket on bucket summaries. Each window therefore
sees a bounded number of rows: microseconds in a slice, slices in a bucket, buckets in a session.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SLICES = 60  # slices per bucket: one second for the usual one-minute bucket


def two_sided(quotes: DataFrame) -> DataFrame:
    """Drops quotes with an empty side; a missing price counts as zero."""
    return quotes.filter("bid > 0 AND ask > 0")


def _stand(until: Column, since: Column) -> Column:
    return F.greatest(until - since, F.lit(0)).cast("double")


QUOTE_BAR = [
    "ticker", "minute_ts", "bid_close", "ask_close", "bid_twm", "ask_twm", "n_quotes",
]


def bucket_of(ts: Column, bucket_seconds: int) -> Column:
    """Start of the bucket an instant falls in."""
    us = F.unix_micros(ts)
    return F.timestamp_micros(us - F.pmod(us, F.lit(bucket_seconds * 1_000_000)))


def quote_bars(quotes: DataFrame, sessions: DataFrame, bucket_seconds: int = 60) -> DataFrame:
    """(ticker, minute_ts, bid_close, ask_close, bid_twm, ask_twm, n_quotes)."""
    return session_quote_bars(quotes, sessions, bucket_seconds).select(*QUOTE_BAR)


def session_quote_bars(quotes: DataFrame, sessions: DataFrame, bucket_seconds: int) -> DataFrame:
    """Quote bars with their session_date.

    quotes: (ticker, session_date, ts, pos, bid, ask), `pos` breaking ties of equal `ts`.
    sessions: (session_date, close_utc). Sessions without a row are skipped.
    A quote stands until the next one, at most to the end of its bucket; the last quote of a session
    stands until the close.
    """
    width = bucket_seconds * 1_000_000
    slice_us = max(width // SLICES, 1)
    name = ["ticker", "session_date"]
    us = F.unix_micros("ts")
    ticks = (
        two_sided(quotes)
        .join(sessions.select("session_date"), "session_date", "left_semi")
        .groupBy(*name, us.alias("us"))
        .agg(
            F.max_by("bid", "pos").alias("bid"),
            F.max_by("ask", "pos").alias("ask"),
            F.count("*").alias("n"),
        )
        .withColumn("bucket", F.col("us") - F.pmod("us", F.lit(width)))
        .withColumn("slice", F.col("us") - F.pmod("us", F.lit(slice_us)))
    )
    in_slice = W.partitionBy(*name, "bucket", "slice").orderBy("us")
    weight = _stand(F.col("next_us"), F.col("us"))
    slices = (
        ticks.withColumn("next_us", F.lead("us").over(in_slice))
        # the closing tick of a slice has no successor yet: it carries no weight here
        .withColumn("w", F.coalesce(weight, F.lit(0.0)))
        .groupBy(*name, "bucket", "slice")
        .agg(
            F.sum(F.col("bid") * F.col("w")).alias("bid_w"),
            F.sum(F.col("ask") * F.col("w")).alias("ask_w"),
            F.sum("w").alias("w"),
            F.sum("n").alias("n"),
            F.min("us").alias("first_us"),
            F.max("us").alias("last_us"),
            F.max_by("bid", "us").alias("bid"),
            F.max_by("ask", "us").alias("ask"),
        )
    )
    in_bucket = W.partitionBy(*name, "bucket").orderBy("slice")
    settled = F.coalesce(_stand(F.col("next_us"), F.col("last_us")), F.lit(0.0))
    buckets = (
        slices.withColumn("next_us", F.lead("first_us").over(in_bucket))
        .withColumn("tail", settled)
        .groupBy(*name, "bucket")
        .agg(
            F.sum(F.col("bid_w") + F.col("bid") * F.col("tail")).alias("bid_w"),
            F.sum(F.col("ask_w") + F.col("ask") * F.col("tail")).alias("ask_w"),
            F.sum(F.col("w") + F.col("tail")).alias("w"),
            F.sum("n").alias("n"),
            F.max("last_us").alias("last_us"),
            F.max_by("bid", "last_us").alias("bid"),
            F.max_by("ask", "last_us").alias("ask"),
        )
    )
    in_session = W.partitionBy(*name).orderBy("bucket")
    bucket_end = F.col("bucket") + F.lit(width)
    until = F.when(F.col("is_last"), F.least(F.col("close_us"), bucket_end)).otherwise(bucket_end)
    closes = sessions.select("session_date", F.unix_micros("close_utc").alias("close_us"))
    final = (
        buckets.withColumn("is_last", F.lead("bucket").over(in_session).isNull())
        .join(closes, "session_date")
        .withColumn("tail", _stand(until, F.col("last_us")))
        .withColumn("all_w", F.greatest(F.col("w") + F.col("tail"), F.lit(1.0)))
    )
    return final.select(
        "session_date",
        "ticker",
        F.timestamp_micros("bucket").alias("minute_ts"),
        F.col("bid").alias("bid_close"),
        F.col("ask").alias("ask_close"),
        ((F.col("bid_w") + F.col("bid") * F.col("tail")) / F.col("all_w")).alias("bid_twm"),
        ((F.col("ask_w") + F.col("ask") * F.col("tail")) / F.col("all_w")).alias("ask_twm"),
        F.col("n").cast("int").alias("n_quotes"),
    )


def quote_buckets(quotes: DataFrame, bucket_seconds: int = 60) -> DataFrame:
    """Last bid/ask and count per bucket, without weights: one aggregation, no windows."""
    width = bucket_seconds * 1_000_000
    us = F.unix_micros("ts")
    order = F.struct(us.alias("us"), F.col("pos"))
    return (
        two_sided(quotes)
        .groupBy("ticker", (us - F.pmod(us, F.lit(width))).alias("bucket"))
        .agg(
            F.max_by("bid", order).alias("bid_close"),
            F.max_by("ask", order).alias("ask_close"),
            F.count("*").cast("int").alias("n_quotes"),
        )
        .select(
            "ticker", F.timestamp_micros("bucket").alias("minute_ts"), "bid_close", "ask_close",
            "n_quotes",
        )
    )
