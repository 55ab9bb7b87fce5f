"""Survivorship: listing snapshots to delistings, terminal returns and coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pitlake.operators.adjust import servable

# The ten-year audit window in days and how many directory files make a date complete.
AUDIT_DAYS = 3653
DIRECTORY_SOURCES = 2


def complete_dates(snapshots: DataFrame) -> DataFrame:
    """Snapshot dates where both directory files landed."""
    return (
        snapshots.groupBy("snapshot_date")
        .agg(F.count_distinct("source").alias("_n"))
        .filter(F.col("_n") == DIRECTORY_SOURCES)
        .select("snapshot_date")
    )


def disappearances(snapshots: DataFrame) -> DataFrame:
    """(ticker, termination_date): the first complete date after a ticker's last complete sighting.

    Pairing every complete date with its successor makes the forward lookup an equi-join, and the
    latest date, which has none, drops out with the tickers still listed.
    """
    dates = complete_dates(snapshots)
    # one row per snapshot date: a calendar-bounded global order
    following = dates.withColumn(
        "termination_date",
        F.lead("snapshot_date").over(W.partitionBy(F.lit(0)).orderBy("snapshot_date")),
    )
    last_seen = (
        snapshots.select("ticker", "snapshot_date")
        .join(dates, "snapshot_date", "left_semi")
        .groupBy("ticker")
        .agg(F.max("snapshot_date").alias("snapshot_date"))
    )
    return (
        last_seen.join(following, "snapshot_date")
        .filter("termination_date IS NOT NULL")
        .select("ticker", "termination_date")
    )


def union_by_authority(delisted: DataFrame, diff: DataFrame) -> DataFrame:
    """Vendor list first, then the diff: the best-ranked row per ticker wins.

    `delisted` may carry `position`, its order in the vendor list; earlier rows win.
    """
    position = F.col("position") if "position" in delisted.columns else F.lit(0)
    vendor = delisted.select(
        "ticker", "termination_date", F.lit("polygon").alias("detection_source"),
        F.lit(0).alias("_rank"), position.cast("bigint").alias("_pos"),
    )
    seen = diff.select(
        "ticker", "termination_date", F.lit("symbol_dirs_diff").alias("detection_source"),
        F.lit(1).alias("_rank"), F.lit(0).cast("bigint").alias("_pos"),
    )
    w = W.partitionBy("ticker").orderBy("_rank", "_pos", "termination_date")
    return (
        vendor.unionByName(seen)
        .withColumn("_rn", F.row_number().over(w))
        .filter("_rn = 1")
        .select("ticker", "termination_date", "detection_source")
    )


def terminal_returns(grave: DataFrame, bars: DataFrame) -> DataFrame:
    """Adds terminal_return: the simple return of the last servable bar up to termination.

    Only the last two bars of a dead ticker matter: the rank filter drops the others before the
    shuffle.
    """
    ends = grave.select("ticker", "termination_date")
    prices = servable(bars).select("ticker", "bar_date", "close")
    newest_first = W.partitionBy("ticker").orderBy(F.desc("bar_date"))
    last_two = (
        prices.join(ends, "ticker")
        .filter("bar_date <= termination_date")
        .withColumn("_rn", F.row_number().over(newest_first))
        .filter("_rn <= 2")
    )
    last, before = F.max_by("close", "bar_date"), F.min_by("close", "bar_date")
    returns = last_two.groupBy("ticker").agg(
        F.when(F.count("*") == 2, F.try_divide(last, before) - 1.0).alias("terminal_return")
    )
    return grave.join(returns, "ticker", "left")


def with_first_seen(grave: DataFrame, previous: DataFrame, now: Column) -> DataFrame:
    """Keeps first_seen of a known (ticker, termination_date), else stamps `now`."""
    before = previous.select("ticker", "termination_date", F.col("first_seen").alias("_first"))
    return (
        grave.join(before, ["ticker", "termination_date"], "left")
        .withColumn("first_seen", F.coalesce("_first", now))
        .drop("_first")
    )


def graveyard(
    snapshots: DataFrame, delisted: DataFrame, bars: DataFrame, previous: DataFrame, now: Column
) -> DataFrame:
    """The delisting projection, rebuilt whole from its inputs."""
    dead = terminal_returns(union_by_authority(delisted, disappearances(snapshots)), bars)
    return with_first_seen(dead, previous, now).select(
        "ticker", "termination_date",
        F.lit("unknown").alias("termination_reason"),
        F.lit("pending").alias("reason_confidence"),
        F.lit(None).cast("string").alias("reason_source"),
        "terminal_return", "detection_source", "first_seen",
    )


def coverage(
    grave: DataFrame, bars: DataFrame, snapshots: DataFrame, trade_date: str, now: Column
) -> DataFrame:
    """Share of delisted tickers with any current bar, per audit window; 1.0 when none is due.

    Bars are reduced to the distinct tickers of the graveyard before they meet it.
    """
    day = F.lit(trade_date).cast("date")
    go_live = snapshots.agg(F.coalesce(F.min("snapshot_date"), day)).scalar()
    windows = {"10y": F.date_sub(day, AUDIT_DAYS), "since_golive": go_live}
    held = (
        bars.filter("is_current").select("ticker")
        .join(grave.select("ticker"), "ticker", "left_semi")
        .distinct()
        .withColumn("_held", F.lit(True))
    )
    names = grave.select("ticker", "termination_date").join(held, "ticker", "left")
    for name, start in windows.items():
        names = names.withColumn(f"_in_{name}", F.col("termination_date") >= start)
    totals = names.agg(
        *[F.count_if(F.col(f"_in_{w}")).alias(f"due_{w}") for w in windows],
        *[F.count_if(F.col(f"_in_{w}") & F.col("_held")).alias(f"held_{w}") for w in windows],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(w).alias("audit_window"), start.alias("window_start"),
                F.col(f"due_{w}").cast("int").alias("expected_n"),
                F.col(f"held_{w}").cast("int").alias("covered_n"),
            )
            for w, start in windows.items()
        ]
    )
    share = F.when(F.col("expected_n") == 0, 1.0).otherwise(
        F.try_divide(F.col("covered_n").cast("double"), F.col("expected_n"))
    )
    return (
        totals.select(F.explode(rows).alias("r"))
        .select("r.*")
        .withColumns({"coverage": share, "computed_at": now})
    )
