from __future__ import annotations

import math
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import at, d, rows
from pitlake.operators import quotes, sessions, spreads

TICK = "ticker string, session_date date, ts timestamp, pos bigint, bid double, ask double"
CLOSE = "2024-07-08 20:00:00"


def ticks(spark, *items):
    return spark.createDataFrame(
        [("X", d("2024-07-08"), at(f"2024-07-08 {t}"), i, b, a) for i, (t, b, a) in enumerate(items)], TICK
    )


def day(spark, close=CLOSE):
    return spark.createDataFrame([(d("2024-07-08"), at(close))], "session_date date, close_utc timestamp")


def bars(spark, q, close=CLOSE, width=60):
    return rows(quotes.quote_bars(q, day(spark, close), width))


def test_three_quotes_in_two_minutes(spark):
    q = ticks(spark, ("14:30:10", 10.0, 10.1), ("14:30:40", 10.05, 10.15), ("14:31:30", 10.2, 10.3), ("14:31:40", 0.0, 9.0))
    first, second = bars(spark, q)
    assert first[:4] == ("X", at("2024-07-08 14:30:00"), 10.05, 10.15) and first[6] == 2
    assert first[4] == pytest.approx((10 * 30 + 10.05 * 20) / 50)
    assert first[5] == pytest.approx((10.1 * 30 + 10.15 * 20) / 50)
    assert second[4] == pytest.approx(10.2) and second[6] == 1


def test_quotes_after_the_close_weigh_nothing(spark):
    ((_, _, bid, _, twm, _, n),) = bars(spark, ticks(spark, ("20:00:30", 5.0, 6.0)))
    assert (bid, twm, n) == (5.0, 0.0, 1)


def test_session_close_caps_the_last_quote_only(spark):
    q = ticks(spark, ("19:59:20", 1.0, 2.0), ("19:59:50", 3.0, 4.0))
    ((_, _, _, _, twm, _, _),) = bars(spark, q, "2024-07-08 19:59:55")
    assert twm == pytest.approx((1 * 30 + 3 * 5) / 35)


def test_sessions_without_a_row_are_skipped(spark):
    other = spark.createDataFrame([(d("2024-07-09"), at(CLOSE))], "session_date date, close_utc timestamp")
    assert quotes.quote_bars(ticks(spark, ("14:30:10", 1.0, 2.0)), other).count() == 0


def brute_force(data, close, width):
    """Stand times straight from the definition."""
    data = sorted((q for q in data if q[1] > 0 and q[2] > 0), key=lambda q: (q[0], q[3]))
    out = {}
    for i, (ts, bid, ask, _) in enumerate(data):
        start = ts - timedelta(seconds=(ts.hour * 3600 + ts.minute * 60 + ts.second) % width, microseconds=ts.microsecond)
        until = min(data[i + 1][0] if i + 1 < len(data) else close, start + timedelta(seconds=width))
        w = max(0, int((until - ts) / timedelta(microseconds=1)))
        b = out.setdefault(start, [0.0, 0.0, 0, 0, 0, 0])
        b[0] += bid * w
        b[1] += ask * w
        b[2] += w
        b[3:] = [bid, ask, b[5] + 1]
    return {k: (v[3], v[4], v[0] / max(v[2], 1), v[1] / max(v[2], 1), v[5]) for k, v in out.items()}


@pytest.mark.parametrize("width, seed", [(60, 1), (60, 2), (5, 3), (3600, 4)])
def test_sliced_stand_times_match_the_definition(spark, width, seed):
    rng = random.Random(seed)
    base = at("2024-07-08 19:00:00")
    data = []
    for i in range(1500):
        t = base + timedelta(microseconds=rng.choice([rng.randrange(0, 3_700_000_000), rng.randrange(0, 40) * 90_000_000]))
        data.append((t, rng.choice([0.0, rng.uniform(1, 9)]) if rng.random() < 0.2 else rng.uniform(1, 9), rng.uniform(9, 10), i))
    q = spark.createDataFrame([("X", d("2024-07-08"), t, p, b, a) for t, b, a, p in data], TICK).repartition(5)
    want = brute_force(data, at(CLOSE), width)
    got = {r[1]: r[2:] for r in rows(quotes.quote_bars(q, day(spark), width))}
    assert got.keys() == want.keys()
    for key, values in want.items():
        assert got[key] == pytest.approx(values, rel=1e-9), key


def test_hot_timestamp_collapses(spark):
    """Copies of one instant are one tick with the last price and the full count."""
    q = spark.range(50_000).select(
        F.lit("X").alias("ticker"), F.lit("2024-07-08").cast("date").alias("session_date"),
        F.lit("2024-07-08 14:30:00").cast("timestamp").alias("ts"), F.col("id").alias("pos"),
        (F.col("id") + 1).cast("double").alias("bid"), (F.col("id") + 2).cast("double").alias("ask"),
    )
    ((_, _, bid, ask, twm, _, n),) = bars(spark, q)
    assert (bid, ask, twm, n) == (50_000.0, 50_001.0, 50_000.0, 50_000)


def ranges(spark, *items):
    return spark.createDataFrame([("X", d(day_), h, lo) for day_, h, lo in items], "ticker string, bar_date date, high double, low double")


def test_corwin_schultz(spark):
    steady = ranges(spark, ("2024-01-01", 101.0, 99.0), ("2024-01-02", 101.0, 99.0))
    ((_, day_, s),) = rows(spreads.corwin_schultz(steady))
    assert day_ == d("2024-01-02")
    # equal ranges: alpha has the closed form of the paper
    beta, gamma = 2 * math.log(101 / 99) ** 2, math.log(101 / 99) ** 2
    k = 3 - 2 * math.sqrt(2)
    a = (math.sqrt(2 * beta) - math.sqrt(beta)) / k - math.sqrt(gamma / k)
    assert s == pytest.approx(2 * (math.exp(a) - 1) / (1 + math.exp(a))) and s == pytest.approx(0.02, abs=1e-3)
    gap = ranges(spark, ("2024-01-01", 101.0, 99.0), ("2024-01-02", 151.0, 149.0))
    assert rows(spreads.corwin_schultz(gap), "cs_spread") == [(0.0,)]
    flat = ranges(spark, ("2024-01-01", 100.0, 100.0), ("2024-01-02", 100.0, 100.0))
    assert rows(spreads.corwin_schultz(flat), "cs_spread") == [(0.0,)]


def test_hybrid_frame(spark):
    m = spark.createDataFrame(
        [("X", at("2024-07-08 14:30:00"), 100.0, 5.0), ("X", at("2024-07-08 14:31:00"), 100.5, 6.0), ("X", at("2024-07-09 02:00:00"), 100.5, 7.0)],
        "ticker string, minute_ts timestamp, close double, volume double",
    )
    q = spark.createDataFrame(
        [("X", at("2024-07-08 14:30:00"), 99.0, 101.0), ("X", at("2024-07-08 15:00:00"), 1.0, 2.0)],
        "ticker string, minute_ts timestamp, bid_close double, ask_close double",
    )
    cs = spark.createDataFrame([("X", d("2024-07-08"), 0.01)], "ticker string, bar_date date, cs_spread double")
    h = spreads.hybrid_intraday(m, q, cs)
    got = rows(h, "bid", "ask", "volume", "derivation")
    assert (99.0, 101.0, 5.0, "iex_bbo") in got and len(got) == 3
    synthetic = [g for g in got if g[3] == "corwin_schultz"]
    # 02:00 UTC on the 9th is still the 8th in New York
    assert all(g[0] == pytest.approx(99.9975) and g[1] == pytest.approx(101.0025) for g in synthetic)
    assert rows(spreads.derivation_mix(h)) == [("corwin_schultz", 2), ("iex_bbo", 1)]
    none = spreads.hybrid_intraday(m, q.limit(0), cs.limit(0))
    assert rows(none.filter("bid <> ask")) == []


def calendar(spark):
    data = [
        ("XNYS", d(x), at(f"{x} 14:30:00"), at(f"{x} {c}"), False)
        for x, c in (("2024-07-01", "20:00:00"), ("2024-07-02", "20:00:00"), ("2024-07-03", "17:00:00"), ("2024-07-05", "20:00:00"))
    ]
    return spark.createDataFrame(data, "exchange string, session_date date, open_utc timestamp, close_utc timestamp, is_half_day boolean")


def test_sessions(spark):
    cal = calendar(spark)
    t = lambda x: F.lit(x).cast("timestamp")
    assert sessions.latest_completed(cal, t("2024-07-05 19:59:59")).first()[0] == d("2024-07-03")
    assert sessions.latest_completed(cal, t("2024-07-05 20:00:00")).first()[0] == d("2024-07-05")
    assert sessions.latest_completed(cal, t("2024-09-05 20:00:00")).first()[0] is None
    assert rows(sessions.previous_sessions(cal, "2024-07-04", 2)) == [(d("2024-07-02"),), (d("2024-07-03"),)]
    assert rows(sessions.sessions_within(cal, "2024-07-04", 2)) == [(d("2024-07-02"),), (d("2024-07-03"),)]
    assert rows(sessions.with_half_day(cal).filter("is_half_day"), "session_date") == [(d("2024-07-03"),)]
    swapped = sessions.replace_range(cal, cal.filter("session_date = '2024-07-02'"), "XNYS", "2024-07-02", "2024-07-03")
    assert rows(swapped, "session_date") == [(d("2024-07-01"),), (d("2024-07-02"),), (d("2024-07-05"),)]


def test_regular_hours(spark):
    m = spark.createDataFrame([("X", at(f"2024-07-03 {h}")) for h in ("14:29:00", "14:30:00", "16:59:00", "17:00:00")], "ticker string, minute_ts timestamp")
    assert spreads.regular_hours(m, calendar(spark)).count() == 2
