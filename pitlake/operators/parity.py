"""Parity against another vendor: a drift alarm, never a rewrite."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlake.operators.adjust import servable

# Fields compared with their relative tolerance, sample size and age limit in days.
TOLERANCE = {"open": 0.001, "high": 0.001, "low": 0.001, "close": 0.001, "volume": 0.05}
SAMPLE_SIZE = 25
WINDOW_DAYS = 600


def parity_sample(bars: DataFrame, trade_date: str, n: int = SAMPLE_SIZE) -> DataFrame:
    """A repeatable sample of recent servable bars, seeded by trade date (a sampling operator)."""
    day = F.lit(trade_date).cast("date")
    recent = servable(bars).filter(F.col("bar_date") >= F.date_sub(day, WINDOW_DAYS))
    draw = F.sha2(F.concat_ws("|", F.lit(trade_date), "ticker", F.col("bar_date").cast("string")), 256)
    return recent.select("ticker", "bar_date", *TOLERANCE).orderBy(
        draw, "ticker", "bar_date"
    ).limit(n)


def parity_scores(ours: DataFrame, theirs: DataFrame, sample_date: str) -> DataFrame:
    """One row per bar and field: relative difference and whether it is within tolerance.

    Both values missing agree; one missing is a breach without a difference.
    """
    key = ["ticker", "bar_date"]
    peer = theirs.select(*key, *[F.col(f).alias(f"their_{f}") for f in TOLERANCE])
    pairs = ours.select(*key, *TOLERANCE).join(peer, key, "left")
    cells = F.array(
        *[
            F.struct(
                F.lit(f).alias("field"), F.col(f).alias("ours"),
                F.col(f"their_{f}").alias("theirs"), F.lit(tol).alias("tol"),
            )
            for f, tol in TOLERANCE.items()
        ]
    )
    a, b = F.col("ours"), F.col("theirs")
    midpoint = (F.abs(a) + F.abs(b)) / 2
    rel = F.abs(a - b) / F.when(midpoint == 0, 1.0).otherwise(midpoint)
    return (
        pairs.select(*key, F.explode(cells).alias("c"))
        .select(*key, "c.*")
        .withColumn("rel_diff", rel)
        .select(
            F.lit(sample_date).cast("date").alias("sample_date"), *key, "field", "ours", "theirs",
            "rel_diff",
            F.coalesce(F.col("rel_diff") <= F.col("tol"), a.isNull() & b.isNull()).alias("within_tol"),
        )
    )


def replace_sample(scores: DataFrame, fresh: DataFrame, sample_date: str) -> DataFrame:
    """The score store with one sample date replaced."""
    other = F.col("sample_date") != F.lit(sample_date).cast("date")
    return scores.filter(other).unionByName(fresh.select(*scores.columns))


def parity_worst(scores: DataFrame) -> DataFrame:
    """Largest relative difference of the latest sample; one row, null without scores."""
    worst = scores.groupBy("sample_date").agg(F.max("rel_diff").alias("worst"))
    return worst.agg(F.max_by("worst", "sample_date").alias("worst_rel_diff"))
