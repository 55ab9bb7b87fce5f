from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import at, d, rows
from pitlake import schemas
from pitlake.operators import adjust

BAR = "ticker string, bar_date date, open double, high double, low double, close double, volume double"


def vendor(spark, closes):
    return spark.createDataFrame(
        [("AAPL", d(day), c, c, c, c, 1000.0) for day, c in closes], BAR
    )


def splits(spark, *items):
    return spark.createDataFrame([("AAPL", d(x), r) for x, r in items], "ticker string, ex_date date, ratio double")


def canonical(spark, closes, **over):
    base = vendor(spark, closes)
    stamp = F.lit("2000-01-01").cast("timestamp")
    cols = {
        "source_set": F.lit("stooq"), "grade": F.lit("good"), "single_source": F.lit(False),
        "payload_hash": F.lit("h"), "knowledge_time": stamp, "valid_from": stamp,
        "valid_to": F.lit(None).cast("timestamp"), "is_current": F.lit(True), "revision_seq": F.lit(1),
    }
    return base.withColumns({**cols, **over})


def actions(spark, *items):
    """(type, ex_date, ratio, cash, known) -> corporate actions of AAPL."""
    data = [
        ("AAPL", k, d(ex), ratio, cash, None, "single_source", "polygon", "h", at(known), at(known), None, True, 1)
        for k, ex, ratio, cash, known in items
    ]
    return spark.createDataFrame(data, schemas.CORPORATE_ACTIONS)


def test_four_for_one_split_restores_the_printed_price(spark):
    bars = vendor(spark, [("2020-08-28", 124.8075), ("2020-08-31", 129.04)])
    raw = adjust.reverse_splits(bars, splits(spark, ("2020-08-31", 4.0)))
    got = rows(raw, "bar_date", F.round("close", 6), F.round("volume", 6), F.round("reversal_factor", 9))
    assert got == [
        (d("2020-08-28"), 499.23, 250.0, 4.0), (d("2020-08-31"), 129.04, 1000.0, 1.0),
    ]


def test_stacked_splits_multiply(spark):
    bars = vendor(spark, [("2020-01-01", 1.0), ("2020-02-01", 1.0), ("2020-03-01", 1.0)])
    raw = adjust.reverse_splits(bars, splits(spark, ("2020-02-01", 2.0), ("2020-03-01", 3.0)))
    assert [r[1] for r in rows(raw, "bar_date", F.round("reversal_factor", 9))] == [6.0, 3.0, 1.0]


def test_other_tickers_and_no_splits_stay_as_they_are(spark):
    bars = vendor(spark, [("2020-01-01", 5.0)])
    foreign = splits(spark, ("2021-01-01", 2.0)).withColumn("ticker", F.lit("MSFT"))
    assert rows(adjust.reverse_splits(bars, foreign), "close", "reversal_factor") == [(5.0, 1.0)]
    assert rows(adjust.reverse_splits(bars, foreign.limit(0)), "close", "reversal_factor") == [(5.0, 1.0)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.integers(1, 300), st.sampled_from([2.0, 3.0, 4.0, 0.5, 0.1, 1.5])),
        min_size=0, max_size=4, unique_by=lambda s: s[0],
    )
)
def test_apply_then_reverse_is_identity(spark, stack):
    day = F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int"))
    px = F.lit(100.0) + F.col("id")
    bars = spark.range(0, 320, 20).select(
        F.lit("AAPL").alias("ticker"), day.alias("bar_date"), px.alias("open"), (px + 1).alias("high"),
        (px - 1).alias("low"), px.alias("close"), F.lit(1e6).alias("volume"),
    )
    some = spark.createDataFrame([(off, r) for off, r in stack], "off int, ratio double").select(
        F.lit("AAPL").alias("ticker"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.col("off")).alias("ex_date"), "ratio",
    )
    back = adjust.reverse_splits(adjust.apply_splits(bars, some), some)
    worst = back.withColumnRenamed("close", "again").join(bars.select("bar_date", "close"), "bar_date").agg(
        F.max(F.abs(F.col("again") / F.col("close") - 1))
    ).first()[0]
    assert worst < 1e-9


def served(spark, bars, acts):
    return rows(adjust.pit_adjusted(bars, acts), "effective_date", F.round("close", 6), F.round("volume", 6))


def test_split_counts_from_its_ex_date(spark):
    bars = canonical(spark, [("2020-08-28", 499.23), ("2020-08-31", 129.04)])
    acts = actions(spark, ("split", "2020-08-31", 4.0, None, "2020-09-01 03:59:59"))
    assert served(spark, bars, acts) == [
        (d("2020-08-28"), 499.23, 1000.0), (d("2020-08-31"), 516.16, 250.0),
    ]


def test_dividend_is_a_price_factor_only(spark):
    bars = canonical(spark, [("2020-08-28", 100.0), ("2020-08-31", 99.0)])
    acts = actions(spark, ("dividend", "2020-08-31", None, 1.0, "2020-09-01 03:59:59"))
    assert served(spark, bars, acts) == [
        (d("2020-08-28"), 100.0, 1000.0), (d("2020-08-31"), 100.0, 1000.0),
    ]


def test_late_knowledge_leaves_earlier_days_alone(spark):
    bars = canonical(spark, [("2020-08-28", 200.0), ("2020-09-16", 210.0)])
    acts = actions(spark, ("split", "2020-08-20", 2.0, None, "2020-09-15 12:00:00"))
    assert served(spark, bars, acts) == [
        (d("2020-08-28"), 200.0, 1000.0), (d("2020-09-16"), 420.0, 500.0),
    ]
    without = served(spark, bars, acts.limit(0))
    assert served(spark, bars, acts)[0] == without[0]


def test_knowledge_is_judged_on_the_exchange_date(spark):
    # 03:30 UTC on the 1st is still the 31st in New York
    bars = canonical(spark, [("2020-08-31", 10.0)])
    acts = actions(spark, ("split", "2020-08-31", 2.0, None, "2020-09-01 03:30:00"))
    assert served(spark, bars, acts)[0][1] == 20.0
    later = actions(spark, ("split", "2020-08-31", 2.0, None, "2020-09-01 04:30:00"))
    assert served(spark, bars, later)[0][1] == 10.0


def test_dividends_without_a_usable_prior_close_have_no_factor(spark):
    bars = canonical(spark, [("2020-08-28", 1.0), ("2020-08-31", 99.0)])
    acts = actions(
        spark,
        ("dividend", "2020-08-28", None, 0.5, "2020-08-28 12:00:00"),  # no earlier bar
        ("dividend", "2020-08-31", None, 1.0, "2020-08-31 12:00:00"),  # not below the prior close
        ("dividend", "2020-09-30", None, 1.0, "2020-09-30 12:00:00"),
    )
    got = rows(adjust.adjustment_factors(bars, acts), "ex_date", F.round("factor", 9))
    assert got == [(d("2020-09-30"), round(99 / 98, 9))]


def test_prior_close_skips_quarantined_and_closed_rows(spark):
    good = canonical(spark, [("2020-01-02", 10.0)])
    bad = canonical(spark, [("2020-01-03", 77.0)], grade=F.lit("quarantined"))
    old = canonical(spark, [("2020-01-04", 88.0)], is_current=F.lit(False))
    ex = spark.createDataFrame([("AAPL", d("2020-01-05")), ("AAPL", d("2020-01-02")), ("AAPL", d("2021-01-05"))],
                               "ticker string, ex_date date")
    got = rows(adjust.prior_close(good.unionByName(bad).unionByName(old), ex))
    assert got == [("AAPL", d("2020-01-05"), 10.0), ("AAPL", d("2021-01-05"), 10.0)]


def test_audit_shows_its_work(spark):
    bars = canonical(spark, [("2020-08-28", 499.23), ("2020-08-31", 129.04)])
    acts = actions(
        spark, ("split", "2020-08-31", 4.0, None, "2020-09-01 03:59:59"),
        ("split", "2020-08-01", 2.0, None, "2021-01-01 00:00:00"),
    )
    factors = adjust.adjustment_factors(bars, acts)
    asked = bars.select("ticker", "bar_date").unionByName(
        spark.createDataFrame([("AAPL", d("2020-12-25"))], "ticker string, bar_date date")
    )
    got = rows(
        adjust.pit_audit(bars, factors, asked), "bar_date", "raw_close", F.round("adjusted_close", 6),
        "n_factors", "n_applied", "no_lookahead",
    )
    assert got == [
        (d("2020-08-28"), 499.23, 499.23, 2, 0, True),
        (d("2020-08-31"), 129.04, 516.16, 2, 1, True),
        (d("2020-12-25"), None, None, 2, 1, True),
    ]


def test_a_leaking_factor_shows_in_the_served_frame(spark):
    bars = canonical(spark, [("2020-08-28", 499.23), ("2020-08-31", 129.04)])
    acts = actions(spark, ("split", "2020-08-31", 4.0, None, "2020-09-01 03:59:59"))
    factors = adjust.adjustment_factors(bars, acts)
    clean = adjust.adjust_with(bars, adjust.cumulative_factors(factors))
    assert adjust.served_lookahead(clean, bars, factors).count() == 0
    early = factors.withColumns({"ex_date": F.lit("2020-08-01").cast("date"), "knowledge_time": F.lit("2020-08-02").cast("timestamp")})
    leaked = adjust.adjust_with(bars, adjust.cumulative_factors(early))
    assert rows(adjust.served_lookahead(leaked, bars, factors), "effective_date") == [(d("2020-08-28"),)]


def test_interval_lookup_matches_brute_force(spark):
    """Random facts and factors: the interval join equals a filtered product."""
    import random

    rng = random.Random(7)
    closes = [(f"2020-{m:02d}-{dd:02d}", float(rng.randint(50, 150))) for m in range(1, 7) for dd in range(1, 28, 3)]
    acts = [
        ("split", f"2020-{rng.randint(1, 6):02d}-{rng.randint(1, 28):02d}", rng.choice([2.0, 0.5, 3.0]), None,
         f"2020-{rng.randint(1, 6):02d}-{rng.randint(1, 28):02d} 15:00:00")
        for _ in range(8)
    ]
    got = dict((r[0], r[1]) for r in served(spark, canonical(spark, closes), actions(spark, *acts)))
    for day, close in closes:
        cum = 1.0
        for _, ex, ratio, _, known in acts:
            if ex <= day and known[:10] <= day:
                cum *= ratio
        assert got[d(day)] == pytest.approx(close * cum, rel=1e-6)


def test_one_ticker_holding_most_rows(spark):
    """A hot ticker beside many small ones gives the same values as each alone."""
    day = F.date_add(F.lit("1990-01-01").cast("date"), F.col("id").cast("int"))
    hot = spark.range(9000).select(F.lit("HOT").alias("ticker"), day.alias("bar_date"))
    cold = spark.range(300).select(F.concat(F.lit("T"), F.col("id") % 30).alias("ticker"), day.alias("bar_date"))
    bars = hot.unionByName(cold).select(
        "ticker", "bar_date", *[F.lit(10.0).alias(c) for c in ("open", "high", "low", "close")],
        F.lit(100.0).alias("volume"),
    )
    ratio = spark.range(40).select(
        F.lit("HOT").alias("ticker"), F.date_add(F.lit("1990-01-01").cast("date"), (F.col("id") * 200).cast("int")).alias("ex_date"),
        F.lit(2.0).alias("ratio"),
    )
    out = adjust.reverse_splits(bars, ratio)
    assert out.count() == 9300
    first = out.filter("ticker = 'HOT' AND bar_date = '1990-01-01'").first()
    assert first.reversal_factor == pytest.approx(2.0**39)
    assert out.filter("ticker <> 'HOT'").agg(F.max("reversal_factor")).first()[0] == 1.0
