"""Cross-source voting on daily bars.

One row per (ticker, bar_date) comes from conditional aggregation: partial sums form on the map side,
so copies of a hot key collapse before the only shuffle, and no full outer joins are needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pitlake.functions.numeric import any_of, relative_difference

# Vendor order (consolidated-volume vendors first) and vote tolerances.
SOURCES = ("yfinance", "stooq", "alpaca_iex")
CLOSE_TOLERANCE = 0.001
VOLUME_TOLERANCE = 0.05

FIELDS = ("open", "high", "low", "close", "volume")
KEY = ("ticker", "bar_date")
RECENCY = ("knowledge_time", "written_at", "payload_hash")


def daily_events(events: DataFrame) -> DataFrame:
    return events.filter(F.col("interval") == "1d")


def latest_observation(
    events: DataFrame, keys: tuple[str, ...] = ("source", *KEY), order: tuple[str, ...] = RECENCY,
) -> DataFrame:
    """Newest row per key under a total order.

    The rank filter is pushed below the shuffle by Spark (group limit), so only one candidate per
    key and map task moves.
    """
    w = W.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in order])
    return events.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def source_pivot(observations: DataFrame) -> DataFrame:
    """One row per (ticker, bar_date) with `<field>_<source>` columns; unknown sources drop out."""
    known = observations.filter(F.col("source").isin(*SOURCES))
    cells = [
        F.max(F.when(F.col("source") == s, F.col(f))).alias(f"{f}_{s}")
        for s in SOURCES for f in FIELDS
    ]
    return known.groupBy(*KEY).agg(*cells)


def latest_pivot(events: DataFrame) -> DataFrame:
    """`source_pivot(latest_observation(daily_events(events)))` with a single shuffle.

    Each source's newest bar is picked inside the per-key aggregation, so one exchange on
    (ticker, bar_date) with map-side combine replaces two.
    """
    bar = F.struct(*FIELDS)
    recency = F.struct(*RECENCY)
    picks = [
        F.max_by(bar, F.when(F.col("source") == s, recency)).alias(s) for s in SOURCES
    ]
    known = daily_events(events).filter(F.col("source").isin(*SOURCES))
    return known.groupBy(*KEY).agg(*picks).select(
        *KEY, *[F.col(f"{s}.{f}").alias(f"{f}_{s}") for s in SOURCES for f in FIELDS]
    )


def _present(source: str) -> Column:
    return F.col(f"close_{source}").isNotNull()


def _agree(a: str, b: str) -> Column:
    diff = relative_difference(F.col(f"close_{a}"), F.col(f"close_{b}"), 1e-12)
    return F.coalesce(diff <= CLOSE_TOLERANCE, F.lit(False))


def backed_by(source: str) -> str:
    """Name of the flag that a source's close agrees with some other source's."""
    return f"backed_{source}"


def with_agreement(pivot: DataFrame) -> DataFrame:
    """Adds n_sources and, per source, whether another one agrees with its close."""
    backed = {
        backed_by(s): any_of(*[_agree(s, other) for other in SOURCES if other != s]) for s in SOURCES
    }
    return pivot.withColumns({"n_sources": sum(_present(s).cast("int") for s in SOURCES), **backed})


def with_verdict(agreement: DataFrame) -> DataFrame:
    """Adds verdict and the source whose bar is kept (conflicts keep one as a record)."""
    yf, st, al = SOURCES
    n = F.col("n_sources")
    backed = {s: F.col(backed_by(s)) for s in SOURCES}
    verdict = (
        F.when(n == 0, "empty")
        .when((n == 1) & _present(al), "alpaca_only_skipped")
        .when(n == 1, "single_source")
        .when(any_of(*backed.values()), "confirmed")
        .otherwise("conflict")
    )
    # the first source backed by an agreeing peer, else the first consolidated vendor present
    chosen = F.coalesce(
        *[F.when(backed[s], F.lit(s)) for s in SOURCES],
        F.when(_present(yf), F.lit(yf)),
        F.when(_present(st), F.lit(st)),
    )
    return agreement.withColumns({"verdict": verdict, "chosen_source": chosen})


def with_choice(voted: DataFrame) -> DataFrame:
    """Adds the chosen OHLCV and the volume vote. IEX volume never counts."""
    yf, st, _ = SOURCES
    prices = {
        f: F.coalesce(
            *[F.when(F.col("chosen_source") == s, F.col(f"{f}_{s}")) for s in SOURCES]
        )
        for f in FIELDS[:-1]
    }
    v_yf, v_st = F.col(f"volume_{yf}"), F.col(f"volume_{st}")
    volume = F.when(F.col("chosen_source") == yf, F.coalesce(v_yf, v_st)).otherwise(
        F.coalesce(v_st, v_yf)
    )
    # null when either vendor has no volume: the comparison itself yields null
    both = v_yf.isNotNull() & v_st.isNotNull()
    agrees = F.when(both, relative_difference(v_yf, v_st, 1.0) <= VOLUME_TOLERANCE)
    return voted.withColumns({**prices, "volume": volume, "volume_agrees": agrees})


def with_grade(chosen: DataFrame) -> DataFrame:
    """Adds grade, single_source and the comma list of sources present."""
    verdict = F.col("verdict")
    volume_failed = F.coalesce(~F.col("volume_agrees"), F.lit(False))
    grade = (
        F.when((verdict == "confirmed") & volume_failed, "degraded")
        .when(verdict == "confirmed", "good")
        .when(verdict == "single_source", "degraded")
        .when(verdict == "conflict", "quarantined")
    )
    names = F.concat_ws(",", *[F.when(_present(s), F.lit(s)) for s in SOURCES])
    return chosen.withColumns(
        {"grade": grade, "single_source": verdict == "single_source", "source_set": names}
    )


VOTED_COLUMNS = [
    *KEY, *FIELDS, "source_set", "grade", "single_source", "verdict", "chosen_source",
    "n_sources", "close_stooq", "close_yfinance", "close_alpaca", "volume_agrees",
]


def vote_pivot(pivot: DataFrame) -> DataFrame:
    """The whole vote from a source pivot; empty and IEX-only keys are removed."""
    graded = with_grade(with_choice(with_verdict(with_agreement(pivot))))
    return (
        graded.filter(~F.col("verdict").isin("empty", "alpaca_only_skipped"))
        .withColumnRenamed("close_alpaca_iex", "close_alpaca")
        .select(*VOTED_COLUMNS)
    )


def vote_bars(observations: DataFrame) -> DataFrame:
    """Vote on the latest observation per source: one graded row per (ticker, bar_date)."""
    return vote_pivot(source_pivot(observations))


def iex_only_keys(observations: DataFrame) -> DataFrame:
    """Keys only IEX reported: counted, never canonized."""
    return (
        observations.groupBy(*KEY)
        .agg(F.bool_and(F.col("source") == "alpaca_iex").alias("_only"))
        .filter("_only")
        .select(*KEY)
    )


def iex_only_count(observations: DataFrame) -> DataFrame:
    return iex_only_keys(observations).agg(F.count("*").alias("iex_only"))


def vote_audit(screened: DataFrame, voted_at: Column) -> DataFrame:
    """The audit projection kept beside the canonical bars."""
    return screened.select(
        *KEY, "verdict", "n_sources", "chosen_source", "close_stooq", "close_yfinance",
        "close_alpaca", "volume_agrees", "mad_flag", voted_at.alias("voted_at"),
    )
