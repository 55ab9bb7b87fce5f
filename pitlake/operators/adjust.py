"""Point-in-time price adjustment.

Two opposite corrections live here. Vendors serve prices already divided by later splits;
`reverse_splits` restores what was printed on the day. Serving multiplies raw prices by the factors
that were both effective and known on the bar's own day, so a served value never moves afterwards.

Bars hold one row per (ticker, bar_date), so rows per ticker are bounded by the calendar and windows over a
ticker are safe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pitlake.functions.clocks import exchange_date
from pitlake.operators.asof import last_before, lookup_step, remaining_steps, running_steps

PRICES = ("open", "high", "low", "close")


def servable(bars: DataFrame) -> DataFrame:
    """Current versions that were not quarantined."""
    return bars.filter(F.col("is_current") & (F.col("grade") != "quarantined"))


def current_splits(actions: DataFrame) -> DataFrame:
    return actions.filter(
        F.col("is_current") & (F.col("action_type") == "split") & (F.col("ratio") > 0)
    ).select("ticker", "ex_date", "ratio")


def _with_later_splits(bars: DataFrame, splits: DataFrame) -> DataFrame:
    logs = splits.select("ticker", "ex_date", F.ln("ratio").alias("_log"))
    steps = remaining_steps(logs, "ticker", "ex_date", ["_log"])
    return (
        lookup_step(bars, steps, "ticker", "bar_date")
        .withColumn("reversal_factor", F.coalesce(F.exp("_log"), F.lit(1.0)))
        .drop("_log")
    )


def reverse_splits(bars: DataFrame, splits: DataFrame) -> DataFrame:
    """Vendor-adjusted bars to raw bars; adds reversal_factor, the product of later ratios."""
    later = F.col("reversal_factor")
    return _with_later_splits(bars, splits).withColumns(
        {**{p: F.col(p) * later for p in PRICES}, "volume": F.col("volume") / later}
    )


def apply_splits(raw: DataFrame, splits: DataFrame) -> DataFrame:
    """The vendor's view of raw bars: the inverse of `reverse_splits`."""
    later = F.col("reversal_factor")
    return (
        _with_later_splits(raw, splits)
        .withColumns({**{p: F.col(p) / later for p in PRICES}, "volume": F.col("volume") * later})
        .drop("reversal_factor")
    )


def prior_close(bars: DataFrame, ex_dates: DataFrame) -> DataFrame:
    """(ticker, ex_date, prior_close): last servable close strictly before each ex-date."""
    return last_before(
        ex_dates, servable(bars), "ticker", "ex_date", "bar_date", "close"
    ).withColumnRenamed("close", "prior_close")


BAR_ROW, ACTION_ROW = 1, 0


def _on_one_line(bars: DataFrame, actions: DataFrame, *fields: str) -> DataFrame:
    """Servable bars and current actions of a ticker in one frame, with `factor` and `factor_type` on actions.

    All that follows reads it through windows over the ticker, which share the one exchange made here; a ticker
    has a bar a day and few actions, so its rows are bounded by the calendar. Actions stand before the bar of
    their day, so the prior close is the last one before the row. `at` is the bar's date or the ex-date.
    """
    action = F.col("action_type")
    counted = actions.filter(
        F.col("is_current") & (((action == "split") & (F.col("ratio") > 0)) | ((action == "dividend") & (F.col("cash_amount") > 0)))
    ).select(
        "ticker", F.col("ex_date").alias("at"), F.lit(ACTION_ROW).alias("kind"), action.alias("factor_type"),
        F.when(action == "split", F.col("ratio")).alias("ratio"), F.when(action == "dividend", F.col("cash_amount")).alias("cash"),
        "knowledge_time",
    )
    held = servable(bars).select("ticker", F.col("bar_date").alias("at"), F.lit(BAR_ROW).alias("kind"), "close", *fields)
    rows = held.unionByName(counted, allowMissingColumns=True)
    before = W.partitionBy("ticker").orderBy("at", "kind").rowsBetween(W.unboundedPreceding, -1)
    seen = F.last(F.when(F.col("kind") == BAR_ROW, F.struct("close")), ignorenulls=True).over(before)
    prior = F.col("prior.close")
    paid = F.when(F.col("at").isNotNull() & (prior > F.col("cash")), prior / (prior - F.col("cash")))
    return (
        rows.withColumn("prior", seen)
        .withColumn("factor", F.coalesce("ratio", F.when(F.col("factor_type") == "dividend", paid)))
        .filter((F.col("kind") == BAR_ROW) | F.col("factor").isNotNull())
        .drop("prior", "ratio", "cash")
    )


def adjustment_factors(bars: DataFrame, actions: DataFrame) -> DataFrame:
    """One factor per current action: the split ratio, or prior / (prior - cash) for a dividend.

    A dividend with no earlier bar, or one at least as large as the prior close, has no factor.
    """
    return _on_one_line(bars, actions).filter(F.col("kind") == ACTION_ROW).select(
        "ticker", F.col("at").alias("ex_date"), "factor_type", "factor", "knowledge_time"
    )


def knowable_from(ex_date: str = "ex_date") -> Column:
    """The day a factor starts to count: the later of its ex-date and the exchange date it became known."""
    return F.greatest(ex_date, exchange_date("knowledge_time"))


def cumulative_factors(factors: DataFrame) -> DataFrame:
    """Intervals of the running product of all factors and of split factors.

    A factor starts to count on the later of its ex-date and the exchange date it became known.
    """
    log = F.ln("factor")
    active = factors.filter("knowledge_time IS NOT NULL").select(
        "ticker",
        knowable_from().alias("active_from"),
        log.alias("log_all"),
        F.when(F.col("factor_type") == "split", log).otherwise(0.0).alias("log_split"),
    )
    return running_steps(active, "ticker", "active_from", ["log_all", "log_split"])


def adjust_with(bars: DataFrame, steps: DataFrame) -> DataFrame:
    """Daily serving shape from bars and the intervals of `cumulative_factors`."""
    needed = servable(bars).select("ticker", "bar_date", *PRICES, "volume")
    return _served(lookup_step(needed, steps, "ticker", "bar_date"), "bar_date")


def _served(rows: DataFrame, at: str) -> DataFrame:
    cum = F.coalesce(F.exp("log_all"), F.lit(1.0))
    split_cum = F.coalesce(F.exp("log_split"), F.lit(1.0))
    return rows.select(
        "ticker",
        F.col(at).alias("effective_date"),
        *[(F.col(p) * cum).alias(p) for p in PRICES],
        (F.col("volume") / split_cum).alias("volume"),
    )


def pit_adjusted(bars: DataFrame, actions: DataFrame) -> DataFrame:
    """Point-in-time adjusted daily bars, from canonical bars and corporate actions.

    Bars and actions meet in one exchange on the ticker: prior closes, factors and their running products are
    windows over it. `adjust_with` is the way for stored factors, which need not move the bars.
    """
    lined = _on_one_line(bars, actions, *[p for p in PRICES if p != "close"], "volume").withColumn(
        "from", F.when(F.col("kind") == BAR_ROW, F.col("at")).otherwise(knowable_from("at"))
    ).filter((F.col("kind") == BAR_ROW) | F.col("knowledge_time").isNotNull())
    # peers of a day belong to its frame, so a factor counts for the bar of the day it starts on
    upto = W.partitionBy("ticker").orderBy("from").rangeBetween(W.unboundedPreceding, W.currentRow)
    log = F.ln("factor")
    summed = lined.withColumns({
        "log_all": F.sum(log).over(upto),
        "log_split": F.sum(F.when(F.col("factor_type") == "split", log)).over(upto),
    })
    return _served(summed.filter(F.col("kind") == BAR_ROW), "at")


def factor_trail(requests: DataFrame, factors: DataFrame) -> DataFrame:
    """Show your work: every factor of the requested (ticker, bar_date) with its applied flag."""
    known = exchange_date("knowledge_time")
    return requests.select("ticker", "bar_date").join(factors, "ticker").select(
        "ticker", "bar_date", "ex_date", "factor_type", "factor", "knowledge_time",
        known.alias("known_date"),
        ((F.col("ex_date") <= F.col("bar_date")) & (known <= F.col("bar_date"))).alias("applied"),
    )


def pit_audit(bars: DataFrame, factors: DataFrame, requests: DataFrame, active_from: Column | None = None) -> DataFrame:
    """Per requested bar: raw close, cumulative factor, adjusted close, and the look-ahead check.

    Requests, bars and factors of a ticker meet in one exchange; counts and products are windows over it.
    `active_from` is the day each factor starts to count in the frame that is audited, the later of ex-date and
    knowledge unless a frame was served otherwise. `no_lookahead` is true when the newest stamp among the factors
    applied was known by the end of the bar's day: factors that count from their ex-date, known or not, show.
    """
    asked = requests.select("ticker", F.col("bar_date").alias("at")).withColumn("kind", F.lit("asked"))
    raw = servable(bars).select("ticker", F.col("bar_date").alias("at"), "close", F.lit("bar").alias("kind"))
    counted = factors.select(
        "ticker", F.when(F.col("knowledge_time").isNotNull(), knowable_from() if active_from is None else active_from).alias("at"),
        F.lit("factor").alias("kind"), "factor", exchange_date("knowledge_time").alias("known"),
    )
    rows = asked.unionByName(raw, allowMissingColumns=True).unionByName(counted, allowMissingColumns=True)
    ticker, day = W.partitionBy("ticker"), W.partitionBy("ticker", "at")
    upto = ticker.orderBy("at").rangeBetween(W.unboundedPreceding, W.currentRow)
    # a factor without a day is none that counts, nor is a bar without one looked up
    counts = (F.col("kind") == "factor") & F.col("at").isNotNull()
    cum = F.coalesce(F.exp("log"), F.lit(1.0))
    seen = rows.withColumns({
        "log": F.sum(F.when(counts, F.ln("factor"))).over(upto),
        "n_applied": F.count(F.when(counts, 1)).over(upto),
        "newest": F.max(F.when(counts, F.col("known"))).over(upto),
        "n_factors": F.count(F.when(F.col("kind") == "factor", 1)).over(ticker),
        "raw_close": F.max("close").over(day),
    })
    return seen.filter("kind = 'asked'").select(
        "ticker", F.col("at").alias("bar_date"), "raw_close", cum.alias("cum_factor"),
        (F.col("raw_close") * cum).alias("adjusted_close"), "n_factors", "n_applied",
        F.coalesce(F.col("newest") <= F.col("at"), F.lit(True)).alias("no_lookahead"),
    ).distinct()


def served_lookahead(served: DataFrame, bars: DataFrame, factors: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """Served bars whose close is not the raw close times the factors known by that day.

    The product is multiplied up in date order along the ticker, apart from the sums of logarithms and the
    intervals that served the bars: a factor that leaked in early, or went missing, shows.
    """
    given = served.select("ticker", F.col("effective_date").alias("at"), "close", F.lit("served").alias("kind"))
    raw = servable(bars).select("ticker", F.col("bar_date").alias("at"), F.col("close").alias("raw_close"), F.lit("bar").alias("kind"))
    known = factors.filter("knowledge_time IS NOT NULL").select(
        "ticker", knowable_from().alias("at"), "factor", F.lit("factor").alias("kind")
    )
    rows = given.unionByName(raw, allowMissingColumns=True).unionByName(known, allowMissingColumns=True)
    upto = W.partitionBy("ticker").orderBy("at").rangeBetween(W.unboundedPreceding, W.currentRow)
    due = F.max("raw_close").over(W.partitionBy("ticker", "at")) * F.coalesce(F.product("factor").over(upto), F.lit(1.0))
    off = F.abs(F.col("close") - F.col("due_close")) > tolerance * F.abs(F.col("due_close"))
    return rows.withColumn("due_close", due).filter("kind = 'served'").filter(
        F.coalesce(off, F.col("close").isNotNull() | F.col("due_close").isNotNull())
    ).select("ticker", F.col("at").alias("effective_date"), "close", "due_close")
