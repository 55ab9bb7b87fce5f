from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from conftest import at, d, rows
from pitlake import schemas
from pitlake.functions.clocks import end_of_day_knowledge
from pitlake.functions.hashing import with_action_hash, with_bar_hash
from pitlake.operators import fingerprint, history

STATE = "k string, v double, payload_hash string, knowledge_time timestamp, valid_from timestamp, valid_to timestamp, is_current boolean, revision_seq int"


def night(spark, *items):
    return spark.createDataFrame(
        [(k, float(len(h)), h, at("2024-01-01 00:00:00")) for k, h in items],
        "k string, v double, payload_hash string, knowledge_time timestamp",
    )


def merge(spark, state, incoming, when=None):
    rk = F.lit(when).cast("timestamp") if when else None
    new, counts = history.merge_history(state, incoming, ["k"], ["v"], rk)
    c = counts.first()
    return new, (c.revised, c.inserted, c.unchanged)


def test_new_unchanged_revised(spark):
    state = spark.createDataFrame([], STATE)
    state, counts = merge(spark, state, night(spark, ("a", "h1")), "2024-02-01")
    assert counts == (0, 1, 0)
    assert rows(state, "valid_from", "revision_seq") == [(at("2024-01-01 00:00:00"), 1)]
    state, counts = merge(spark, state, night(spark, ("a", "h1")), "2024-02-02")
    assert counts == (0, 0, 1)
    state, counts = merge(spark, state, night(spark, ("a", "h2")), "2024-02-03")
    assert counts == (1, 1, 0)
    assert rows(state, "revision_seq", "payload_hash", "valid_from", "valid_to", "is_current") == [
        (1, "h1", at("2024-01-01 00:00:00"), at("2024-02-03 00:00:00"), False),
        (2, "h2", at("2024-02-03 00:00:00"), None, True),
    ]


def test_absent_keys_stay(spark):
    state, _ = merge(spark, spark.createDataFrame([], STATE), night(spark, ("a", "h1"), ("b", "h1")))
    state, counts = merge(spark, state, night(spark, ("a", "h2")), "2024-02-01")
    assert counts == (1, 1, 0)
    assert rows(state.filter("is_current"), "k", "payload_hash") == [("a", "h2"), ("b", "h1")]


def test_reopen_after_the_highest_sequence(spark):
    t = at("2024-01-01 00:00:00")
    closed = spark.createDataFrame(
        [("a", 1.0, "h1", t, t, t, False, 1), ("a", 1.0, "h9", t, t, t, False, 4)], STATE
    )
    state, counts = merge(spark, closed, night(spark, ("a", "h1")), "2024-02-01")
    assert counts == (0, 1, 0)
    assert rows(state.filter("is_current"), "revision_seq", "valid_from") == [(5, at("2024-02-01 00:00:00"))]
    assert state.count() == 3


def test_revision_without_detection_time_uses_its_own_stamp(spark):
    state, _ = merge(spark, spark.createDataFrame([], STATE), night(spark, ("a", "h1")))
    state, _ = merge(spark, state, night(spark, ("a", "h2")))
    assert rows(state.filter("is_current"), "valid_from") == [(at("2024-01-01 00:00:00"),)]


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="payload_hash"):
        history.merge_history(
            spark.createDataFrame([], STATE), night(spark, ("a", "h")).drop("payload_hash"), ["k"], ["v"]
        )


def test_last_per_key(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", 2), ("b", 1)], "k string, o int")
    assert rows(history.last_per_key(df, ["k"], ["o"])) == [("a", 3), ("b", 1)]


def bar(spark, close, day="2024-03-01"):
    return spark.createDataFrame(
        [("AAPL", d(day), close, close, close, close, 10.0)],
        "ticker string, bar_date date, open double, high double, low double, close double, volume double",
    )


def test_two_nights_and_time_travel(spark):
    empty = schemas.empty(spark, schemas.BARS_DAILY)
    when = lambda t: F.lit(t).cast("timestamp")
    first, _ = history.upsert_bars(empty, bar(spark, 210.0), revision_knowledge=when("2024-03-02 02:00:00"))
    second, counts = history.upsert_bars(first, bar(spark, 209.4), revision_knowledge=when("2024-03-03 02:00:00"))
    assert counts.first().asDict() == {"revised": 1, "inserted": 1, "unchanged": 0}
    assert rows(second, "revision_seq", "is_current") == [(1, False), (2, True)]
    asked = spark.createDataFrame(
        [("AAPL", d("2024-03-01"), at(t)) for t in ("2024-03-01 00:00:00", "2024-03-02 12:00:00", "2024-03-03 02:00:00")],
        "ticker string, bar_date date, as_of timestamp",
    )
    got = rows(history.bars_asof(second, asked), "as_of", "close", "revision_seq")
    assert got == [(at("2024-03-02 12:00:00"), 210.0, 1), (at("2024-03-03 02:00:00"), 209.4, 2)]


def python_digest(values):
    canon = {k: f"{v:.6f}" if isinstance(v, float) else v for k, v in values.items()}
    return hashlib.sha256(json.dumps(canon, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def test_bar_hash_is_sha256_of_sorted_json(spark):
    b = bar(spark, 1.25).withColumns({"source_set": F.lit("stooq"), "grade": F.lit("good"), "single_source": F.lit(True)})
    got = with_bar_hash(b).first().payload_hash
    want = {c: 1.25 for c in ("open", "high", "low", "close")} | {
        "volume": 10.0, "source_set": "stooq", "grade": "good", "single_source": True}
    assert got == python_digest(want)


def test_hash_ignores_noise_and_sees_changes(spark):
    h = lambda c: with_bar_hash(bar(spark, c)).first().payload_hash
    assert h(0.3) == h(0.1 + 0.2)
    assert h(0.0) == h(-0.0)
    assert h(1.0) != h(1.00001)
    assert len({h(1e300), h(-1e300), h(1e29), h(1e-9)}) == 4
    assert len({h(float("nan")), h(float("inf")), h(float("-inf")), h(None), h(0.0)}) == 5
    degraded = with_bar_hash(bar(spark, 1.0).withColumn("grade", F.lit("degraded"))).first().payload_hash
    good = with_bar_hash(bar(spark, 1.0).withColumn("grade", F.lit("good"))).first().payload_hash
    assert degraded != good


def test_action_hash_skips_declared_date(spark):
    base = spark.createDataFrame(
        [("A", "split", d("2020-01-01"), 2.0, None)],
        "ticker string, action_type string, ex_date date, ratio double, cash_amount double",
    )
    a = with_action_hash(base.withColumn("declared_date", F.lit("2019-12-01").cast("date"))).first().payload_hash
    b = with_action_hash(base.withColumn("declared_date", F.lit(None).cast("date"))).first().payload_hash
    assert a == b == python_digest({"ticker": "A", "type": "split", "ex": "2020-01-01", "ratio": 2.0, "cash": None})


def test_knowledge_stamp_across_daylight_saving(spark):
    days = ["2024-03-09", "2024-03-10", "2024-07-01", "2024-11-03", "2024-12-31"]
    df = spark.createDataFrame([(d(x),) for x in days], "day date").select(end_of_day_knowledge("day").alias("k"))
    assert [r.k.isoformat(" ") for r in df.collect()] == [
        "2024-03-10 04:59:59", "2024-03-11 03:59:59", "2024-07-02 03:59:59", "2024-11-04 04:59:59",
        "2025-01-01 04:59:59",
    ]


def test_fingerprint_ignores_order_and_sees_copies(spark):
    one = bar(spark, 1.0)
    two = one.unionByName(bar(spark, 2.0, "2024-03-02"))
    cols = one.columns
    f = lambda df: fingerprint.table_fingerprint(df, cols, "t").first().digest
    assert f(two) == f(two.orderBy(F.desc("bar_date")).repartition(3))
    assert len({f(one), f(two), f(two.unionByName(one)), f(one.limit(0))}) == 4


def belief(ticker, day, close, written="2024-07-10"):
    return (ticker, d(day), close, close, close, close, 1.0, "stooq", "degraded", True, written)


def bars_frame(spark, *rows_):
    from pitlake.operators import history

    df = spark.createDataFrame(
        list(rows_), "ticker string, bar_date date, open double, high double, low double, close double, volume double, "
        "source_set string, grade string, single_source boolean, written string",
    )
    return history.stamp_bars(df)


def test_repeated_incoming_keys_leave_one_current_version(spark, root):
    from pitlake.plans.lake import Lake

    lake = Lake(spark, root)
    twice = bars_frame(spark, belief("A", "2024-07-01", 1.0), belief("A", "2024-07-01", 2.0), belief("B", "2024-07-01", 3.0))
    assert lake.merge("bars_daily", twice, None) == {"revised": 0, "inserted": 2, "unchanged": 0}
    assert lake.read("bars_daily").filter("is_current").count() == 2


def test_a_merge_writes_only_months_that_change(spark, root):
    from pathlib import Path

    from pyspark.sql import functions as F

    from pitlake.plans.lake import Lake

    lake, at_night = Lake(spark, root), F.lit("2024-08-02").cast("timestamp")
    first = bars_frame(spark, belief("A", "2024-06-03", 1.0), belief("A", "2024-07-01", 2.0), belief("B", "2024-07-01", 3.0))
    lake.merge("bars_daily", first, None)
    assert lake.merge("bars_daily", first, at_night) == {"revised": 0, "inserted": 0, "unchanged": 3}
    assert lake.version("bars_daily") == 1 and not Path(f"{root}/tables/bars_daily/version=2").exists()
    second = bars_frame(spark, belief("A", "2024-06-03", 1.0), belief("A", "2024-07-01", 2.5), belief("C", "2024-07-02", 4.0))
    assert lake.merge("bars_daily", second, at_night) == {"revised": 1, "inserted": 2, "unchanged": 1}
    assert [p.name for p in Path(f"{root}/tables/bars_daily/version=2").glob("period=*")] == ["period=2024-07"]
    state = lake.read("bars_daily")
    assert rows(state.filter("is_current"), "ticker", "bar_date", "close") == [
        ("A", d("2024-06-03"), 1.0), ("A", d("2024-07-01"), 2.5), ("B", d("2024-07-01"), 3.0), ("C", d("2024-07-02"), 4.0)]
    assert rows(state.filter("NOT is_current"), "ticker", "close", "revision_seq") == [("A", 2.0, 1)]
    assert lake.vacuum("bars_daily") == [f"{root}/tables/bars_daily/version=1/period=2024-07/is_current=true"]
