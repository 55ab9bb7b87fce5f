from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import at, d, rows
from pitlake import schemas
from pitlake.operators import deadletters, outliers, voting

OBS = "source string, ticker string, bar_date date, open double, high double, low double, close double, volume double"


def obs(spark, *items):
    return spark.createDataFrame(
        [(s, t, d(day), c, c, c, c, v) for s, t, day, c, v in items], OBS
    )


def voted(spark, *items):
    return [r.asDict() for r in voting.vote_bars(obs(spark, *items)).collect()]


DAY = "2024-03-01"


@pytest.mark.parametrize(
    "closes, verdict, grade, chosen, sources",
    [
        ({"yfinance": 100.0, "stooq": 100.05, "alpaca_iex": 100.02}, "confirmed", "good", "yfinance", "yfinance,stooq,alpaca_iex"),
        ({"stooq": 1000.0, "yfinance": 1001.0}, "confirmed", "good", "yfinance", "yfinance,stooq"),
        ({"stooq": 1000.0, "yfinance": 1002.5}, "conflict", "quarantined", "yfinance", "yfinance,stooq"),
        ({"yfinance": 200.0, "stooq": 100.0, "alpaca_iex": 100.01}, "confirmed", "good", "stooq", "yfinance,stooq,alpaca_iex"),
        ({"stooq": 100.0}, "single_source", "degraded", "stooq", "stooq"),
        ({"yfinance": 100.0}, "single_source", "degraded", "yfinance", "yfinance"),
        ({"stooq": 100.0, "alpaca_iex": 150.0}, "conflict", "quarantined", "stooq", "stooq,alpaca_iex"),
    ],
)
def test_truth_table(spark, closes, verdict, grade, chosen, sources):
    (row,) = voted(spark, *[(s, "A", DAY, c, 1000.0) for s, c in closes.items()])
    assert (row["verdict"], row["grade"], row["chosen_source"], row["source_set"]) == (verdict, grade, chosen, sources)
    assert row["close"] == closes[chosen]
    assert row["single_source"] == (verdict == "single_source")
    assert row["n_sources"] == len(closes)


def test_iex_only_bars_are_counted_not_kept(spark):
    only = obs(spark, ("alpaca_iex", "A", DAY, 1.0, 1.0), ("alpaca_iex", "B", DAY, 1.0, 1.0), ("stooq", "B", DAY, 1.0, 1.0))
    assert [r[0] for r in rows(voting.vote_bars(only), "ticker")] == ["B"]
    assert voting.iex_only_count(only).first()[0] == 1


def test_volume_vote_degrades_and_iex_volume_never_counts(spark):
    (row,) = voted(spark, ("yfinance", "A", DAY, 100.0, 1000.0), ("stooq", "A", DAY, 100.0, 1200.0))
    assert (row["verdict"], row["grade"], row["volume_agrees"], row["volume"]) == ("confirmed", "degraded", False, 1000.0)
    (row,) = voted(spark, ("yfinance", "A", DAY, 100.0, None), ("alpaca_iex", "A", DAY, 100.0, 5.0))
    assert (row["grade"], row["volume_agrees"], row["volume"]) == ("good", None, None)
    (row,) = voted(spark, ("yfinance", "A", DAY, 100.0, None), ("stooq", "A", DAY, 100.0, 7.0))
    assert (row["grade"], row["volume_agrees"], row["volume"]) == ("good", None, 7.0)


def test_unknown_sources_do_not_vote(spark):
    (row,) = voted(spark, ("yfinance", "A", DAY, 100.0, 1.0), ("rumour", "A", DAY, 100.0, 1.0))
    assert row["verdict"] == "single_source"


def test_row_order_does_not_matter(spark):
    items = [(s, t, f"2024-03-{day:02d}", 100.0 + day + (s == "stooq") * 0.3 * (day % 3), 10.0)
             for s in voting.SOURCES for t in ("A", "B") for day in range(1, 15)]
    straight, shuffled = obs(spark, *items), obs(spark, *reversed(items)).repartition(7)
    assert rows(voting.vote_bars(straight)) == rows(voting.vote_bars(shuffled))


def event(source, day, close, written, digest, interval="1d"):
    return ("e", source, "A", interval, d(day), close, close, close, close, 1.0, False, 1.0,
            at("2024-03-01 04:59:59"), at(written), digest, "k")


def events(spark, *items):
    return spark.createDataFrame([event(*i) for i in items], schemas.BAR_EVENTS)


def test_latest_observation_breaks_ties_by_write_time_then_hash(spark):
    ev = events(
        spark,
        ("stooq", DAY, 1.0, "2024-03-02 00:00:00", "z"), ("stooq", DAY, 2.0, "2024-03-03 00:00:00", "a"),
        ("stooq", DAY, 3.0, "2024-03-03 00:00:00", "b"), ("stooq", DAY, 9.0, "2024-03-09 00:00:00", "z", "1m"),
        ("yfinance", DAY, 5.0, "2024-03-01 00:00:00", "q"),
    )
    latest = voting.latest_observation(voting.daily_events(ev))
    assert rows(latest, "source", "close") == [("stooq", 3.0), ("yfinance", 5.0)]
    assert rows(voting.latest_pivot(ev)) == rows(voting.source_pivot(latest))


def test_copies_of_one_hot_key_collapse(spark):
    ev = events(spark, ("stooq", DAY, 1.0, "2024-03-02 00:00:00", "a"))
    copies = ev.crossJoin(spark.range(20000)).withColumn(
        "close", F.col("id").cast("double")
    ).withColumn("payload_hash", F.format_string("%08d", "id")).drop("id")
    assert rows(voting.latest_pivot(copies), "close_stooq") == [(19999.0,)]
    assert rows(voting.latest_observation(copies), "close") == [(19999.0,)]


def walk(spark, n, spike, single):
    rng = random.Random(3)
    closes = [100.0 + rng.uniform(-1, 1) for _ in range(n)]
    closes[spike] *= 3
    data = [("A", d("2024-01-01").replace(month=1 + i // 28, day=1 + i % 28), c, "good", single) for i, c in enumerate(closes)]
    return spark.createDataFrame(data, "ticker string, bar_date date, close double, grade string, single_source boolean")


def test_mad_quarantines_lone_spikes_only(spark):
    lone = outliers.mad_screen(walk(spark, 60, 30, True))
    assert sorted(r[0].day for r in lone.filter("mad_flag").select("bar_date").collect()) == [3, 4]
    assert lone.filter("grade = 'quarantined'").count() == 2
    agreed = outliers.mad_screen(walk(spark, 60, 30, False))
    assert agreed.filter("mad_flag").count() == 2 and agreed.filter("grade <> 'good'").count() == 0


def test_mad_is_quiet_on_short_or_flat_series(spark):
    assert outliers.mad_screen(walk(spark, 20, 10, True)).filter("mad_flag").count() == 0
    flat = walk(spark, 60, 30, True).withColumn("close", F.lit(5.0))
    assert outliers.mad_screen(flat).filter("mad_flag").count() == 0


def letters(spark, *items):
    return spark.createDataFrame(
        [(i, "j", None, k, None, c, "x", at(seen), 0, at(done) if done else None) for i, k, c, seen, done in items],
        schemas.DEAD_LETTER,
    )


def test_conflict_letters_once_per_key(spark):
    now = F.lit("2024-04-01").cast("timestamp")
    screened = voting.vote_bars(
        obs(spark, *[(s, t, DAY, c, 1.0) for t in "ABC" for s, c in (("stooq", 1.0), ("yfinance", 2.0))])
    )
    held = letters(
        spark, (1, f"A:{DAY}", "vote_conflict", "2024-03-02 00:00:00", None),
        (2, f"B:{DAY}", "vote_conflict", "2024-03-02 00:00:00", "2024-03-03 00:00:00"),
    )
    fresh = deadletters.conflict_letters(screened, held, now)
    assert rows(fresh, "request_key") == [(f"B:{DAY}",), (f"C:{DAY}",)]
    assert rows(deadletters.conflict_letters(screened, held, now, limit=1), "request_key") == []
    assert fresh.first().detail == "no two closes agree (stooq 1.0, yfinance 2.0, alpaca None)"


def test_letter_views(spark):
    held = letters(
        spark, (1, "k1", "x", "2024-03-02 00:00:00", None), (2, "k2", "x", "2024-03-05 00:00:00", None),
        (3, "k3", "x", "2024-03-06 00:00:00", "2024-03-07 00:00:00"),
    )
    assert [r.id for r in deadletters.open_letters(held, 5).collect()] == [2, 1]
    assert deadletters.open_depth(held).first()[0] == 2
    done = deadletters.resolve_letters(held, held.filter("id = 2").select("id"), F.lit("2024-04-01").cast("timestamp"))
    assert deadletters.open_depth(done).first()[0] == 1
    asked = spark.createDataFrame([("k1",), ("k3",)], "request_key string")
    assert rows(deadletters.open_for(held, asked)) == [("k1",)]
