"""Nights over a lake on scratch folders: landing to published snapshot, revisions, replay, failure."""

from __future__ import annotations

import gzip
import json
from datetime import date, datetime, timedelta
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import at, d, rows
from pitlake import schemas
from pitlake.operators import fingerprint
from pitlake.operators.contracts import ContractViolation
from pitlake.plans import nightly
from pitlake.plans.lake import Lake, publish, read_snapshot, register_views
from pitlake.sources import events, landing
from test_sources import NASDAQ, OTHER, frame, land


def ts(text):
    return F.lit(text).cast("timestamp")


def csv(closes):
    return ("Date,Open,High,Low,Close,Volume\n" + "".join(f"{x},{c},{c},{c},{c},1000\n" for x, c in closes)).encode()


def json_bars(closes):
    return json.dumps({"bars": [{"t": f"{x}T20:00:00Z", "o": c, "h": c, "l": c, "c": c, "v": 5} for x, c in closes]}).encode()


DAYS = [(date(2024, 7, 1) + timedelta(days=i)).isoformat() for i in range(5)]


@pytest.fixture(scope="module")
def night(spark, tmp_path_factory):
    """One full night: every payload kind landed, built, voted, sealed and published."""
    root = str(tmp_path_factory.mktemp("spark-night"))
    zone = f"{root}/landing"
    # AAPL splits 2:1 on the third day: vendors serve halved prices before it
    vendor = [(x, 50.0) for x in DAYS[:2]] + [(x, 51.0) for x in DAYS[2:]]
    printed = [(x, 100.0) for x in DAYS[:2]] + [(x, 51.0) for x in DAYS[2:]]
    stamps = pa.array([datetime.fromisoformat(x) for x in DAYS], pa.timestamp("us"))
    px = [c for _, c in vendor]
    land(zone, "polygon_splits", "polygon", "AAPL:2024-07-08", json.dumps({"status": "OK", "results": [
        {"execution_date": DAYS[2], "split_from": 1, "split_to": 2, "ticker": "AAPL"}]}).encode(), "json")
    land(zone, "stooq_daily", "stooq", "AAPL:2024-07-08", csv(vendor), "csv")
    land(zone, "stooq_daily", "stooq", "CLASH:2024-07-08", csv([(DAYS[0], 10.0)]), "csv")
    land(zone, "stooq_daily", "stooq", "BAD:2024-07-08", b"<html>", "csv")
    land(zone, "yf_daily", "yfinance", "AAPL:2024-07-08", frame(
        {"Date": stamps, "Open": px, "High": px, "Low": px, "Close": px, "Volume": [1000.0] * 5}), "parquet")
    land(zone, "alpaca_daily", "alpaca_iex", "AAPL:2024-07-08", json_bars(printed), "json")
    land(zone, "alpaca_daily", "alpaca_iex", "CLASH:2024-07-08", json_bars([(DAYS[0], 99.0)]), "json")
    gone = "\n".join(x for x in NASDAQ.splitlines() if not x.startswith("aapl"))
    for day, text in (("2024-07-05", NASDAQ), ("2024-07-08", gone)):
        land(zone, "symbol_dirs", "nasdaqtrader", f"nasdaqlisted:{day}", text.encode(), "txt", day)
        land(zone, "symbol_dirs", "nasdaqtrader", f"otherlisted:{day}", OTHER.encode(), "txt", day)
    land(zone, "polygon_delisted", "polygon", "delisted:2024-07-08", gzip.compress(json.dumps(
        {"results": [{"ticker": "DOOM", "delisted_utc": "2024-07-01"}]}).encode()), "json.gz")
    minutes = pa.array([datetime(2024, 7, 3, 10, 30), datetime(2024, 7, 3, 10, 31)], pa.timestamp("us"))
    ones = [51.0, 51.0]
    land(zone, "minute_bars", "yfinance", "AAPL:2024-07-03", frame(
        {"Datetime": minutes, "Open": ones, "High": ones, "Low": ones, "Close": ones, "Volume": [1, 2]}), "parquet")
    land(zone, "quote_ticks", "alpaca_iex", "AAPL:2024-07-03", gzip.compress(json.dumps({"quotes": [
        {"t": "2024-07-03T14:30:10Z", "bp": 50.9, "ap": 51.1}]}).encode()), "json.gz")
    land(zone, "edgar_submissions", "edgar", "AAPL:320193", b'{"sic":"3571","sicDescription":"Computers"}', "json")
    lake = Lake(spark, f"{root}/tables", root)
    build(spark, lake, zone, "2024-07-08 23:00:00")
    counts = nightly.vote_and_seal(lake, ts("2024-07-08 23:30:00"))
    rest = sources(spark, zone)
    nightly.universe_seal(lake, rest["directories"], rest["delisted"], "2024-07-08", ts("2024-07-08 23:40:00"))
    nightly.intraday_seal(lake, rest["minute_payloads"], rest["quote_fragments"], rest["sessions"], ts("2024-07-08 23:41:00"))
    nightly.sector_seal(lake, rest["submissions"], ts("2024-07-08 23:42:00"))
    nightly.gap_ledger_seal(lake, rest["universe"], ts("2024-07-08 23:43:00"))
    published = nightly.publish_night(lake, "2024-07-08", ts("2024-07-08 23:45:00"))
    return {"lake": lake, "root": root, "zone": zone, "counts": counts, "published": published}


def build(spark, lake, zone, now):
    nightly.build_actions(lake, landing.scan_text(spark, zone, "polygon_splits"), ts(now))
    nightly.build_csv_bars(lake, landing.scan_text(spark, zone, "stooq_daily"), ts(now))
    nightly.build_frame_bars(lake, landing.scan_bytes(spark, zone, "yf_daily"), ts(now))
    nightly.build_json_bars(lake, landing.scan_text(spark, zone, "alpaca_daily"), ts(now))


def sources(spark, zone):
    return {
        "directories": landing.scan_text(spark, zone, "symbol_dirs"),
        "delisted": landing.scan_text(spark, zone, "polygon_delisted"),
        "minute_payloads": landing.scan_bytes(spark, zone, "minute_bars"),
        "quote_fragments": landing.scan_records(spark, zone, "quote_ticks"),
        "sessions": spark.createDataFrame([(d("2024-07-03"), at("2024-07-03 17:00:00"))], "session_date date, close_utc timestamp"),
        "submissions": landing.scan_text(spark, zone, "edgar_submissions"),
        "universe": spark.createDataFrame([("AAPL",), ("SPY",)], "ticker string"),
    }


def test_votes_and_history(night):
    lake = night["lake"]
    assert night["counts"] == {"revised": 0, "inserted": 6, "unchanged": 0}
    bars = lake.read("bars_daily")
    assert rows(bars.filter("ticker = 'AAPL'"), "close", "volume", "grade", "source_set") == [
        (100.0, 500.0, "good", "yfinance,stooq,alpaca_iex")] * 2 + [(51.0, 1000.0, "good", "yfinance,stooq,alpaca_iex")] * 3
    assert rows(bars.filter("ticker = 'CLASH'"), "grade") == [("quarantined",)]
    assert lake.read("vote_results").count() == 6
    letters = lake.read("dead_letter")
    assert rows(letters, "error_class", "source", "request_key") == [
        ("schema_drift", "stooq", "BAD:2024-07-08"), ("vote_conflict", None, f"CLASH:{DAYS[0]}")]
    assert len({r.id for r in letters.collect()}) == 2


def test_published_snapshot(spark, night):
    lake = night["lake"]
    assert night["published"]["daily_ohlcv"] == 5
    daily = read_snapshot(lake, "daily_ohlcv")
    assert rows(daily, "effective_date", F.round("close", 6)) == [(d(x), 100.0) for x in DAYS[:2]] + [(d(x), 102.0) for x in DAYS[2:]]
    assert rows(read_snapshot(lake, "delisted"), "ticker", "termination_date") == [("AAPL", d("2024-07-08")), ("DOOM", d("2024-07-01"))]
    assert rows(read_snapshot(lake, "sectors")) == [("AAPL", "XLK", "Computers")]
    intraday = rows(read_snapshot(lake, "intraday"), "minute", "bid", "ask", "derivation")
    assert intraday == [(datetime(2024, 7, 3, 14, 30), 50.9, 51.1, "iex_bbo"), (datetime(2024, 7, 3, 14, 31), 51.0, 51.0, "corwin_schultz")]
    assert read_snapshot(lake, "gap_ledger").count() == 8
    assert rows(read_snapshot(lake, "serving_meta"), "sealed_trade_date", "schema_version") == [(d("2024-07-08"), 1)]
    views = register_views(lake, ["daily_ohlcv", "coverage"], "t_")
    assert spark.sql(f"SELECT * FROM {views[0]} WHERE ticker = 'AAPL'").count() == 5


def test_running_again_changes_nothing(spark, night):
    lake, rest = night["lake"], sources(spark, night["zone"])
    before = {n: rows(lake.read(n)) for n in ("bars_minute", "quote_bars_1m", "universe_snapshots", "sectors", "dead_letter")}
    assert nightly.vote_and_seal(lake, ts("2024-07-09 23:30:00")) == {"revised": 0, "inserted": 0, "unchanged": 6}
    nightly.load_snapshots(lake, rest["directories"], ts("2024-07-09 23:40:00"))
    nightly.intraday_seal(lake, rest["minute_payloads"], rest["quote_fragments"], rest["sessions"], ts("2024-07-09 23:41:00"))
    nightly.sector_seal(lake, rest["submissions"], ts("2024-07-09 23:42:00"))
    after = {n: rows(lake.read(n)) for n in before}
    assert after == before


def test_rebuild_equals_live_and_tolerates_copies(spark, night, root):
    live = night["lake"]
    again = Lake(spark, f"{root}/tables", night["root"])
    everything = {**sources(spark, night["zone"]), "trade_date": "2024-07-08", "now": ts("2024-07-08 23:30:00")}
    nightly.rebuild(again, **everything)

    def prints(lake):
        return rows(fingerprint.state_fingerprint(lake.read("bars_daily"), lake.read("corporate_actions")))

    assert prints(again) == prints(live)
    for name in ("daily_ohlcv", "delisted", "coverage", "intraday", "sectors"):
        assert rows(read_snapshot(again, name)) == rows(read_snapshot(live, name)), name
    with pytest.raises(ValueError, match="empty table root"):
        nightly.rebuild(again, **everything)
    # the same events stored twice replay to the same state
    doubled = f"{root}/doubled"
    for kind in ("bar_events", "action_events"):
        seen = events.scan(spark, night["root"], kind)
        events.append(doubled, kind, seen.unionByName(seen))
    copy = Lake(spark, f"{doubled}/tables", doubled)
    nightly.replay_actions(copy)
    nightly.vote_and_seal(copy, ts("2024-07-08 23:30:00"))
    assert prints(copy) == prints(live)


def test_a_revision_opens_at_detection_and_keeps_closed_files(spark, root):
    lake = Lake(spark, root)
    for close, now in ((210.0, "2024-07-02 01:00:00"), (209.0, "2024-07-03 01:00:00"), (208.0, "2024-07-04 01:00:00")):
        land(f"{root}/l{close}", "stooq_daily", "stooq", "A:1", csv([("2024-07-01", close)]), "csv")
        nightly.build_csv_bars(lake, landing.scan_text(spark, f"{root}/l{close}", "stooq_daily"), ts(now))
        nightly.vote_and_seal(lake, ts(now))
    got = rows(lake.read("bars_daily"), "revision_seq", "close", "valid_from", "valid_to", "is_current")
    assert got == [
        (1, 210.0, at("2024-07-02 03:59:59"), at("2024-07-03 01:00:00"), False),
        (2, 209.0, at("2024-07-03 01:00:00"), at("2024-07-04 01:00:00"), False),
        (3, 208.0, at("2024-07-04 01:00:00"), None, True),
    ]
    # each closed version was written by the merge that closed it, once
    for version, n in ((1, 0), (2, 1), (3, 1)):
        folder = Path(root) / f"tables/bars_daily/version={version}/period=2024-07/is_current=false"
        assert (spark.read.parquet(str(folder)).count() if folder.exists() else 0) == n


def test_violation_keeps_the_old_snapshot(spark, root):
    lake = Lake(spark, root)
    good = spark.createDataFrame([("10y", 1.0)], schemas.SERVING["coverage"])
    publish(lake, {"coverage": good}, "2024-07-01", ts("2024-07-01"))
    with pytest.raises(ContractViolation):
        publish(lake, {"coverage": good.withColumn("coverage", F.lit(2.0))}, "2024-07-02", ts("2024-07-02"))
    assert rows(read_snapshot(lake, "coverage")) == [("10y", 1.0)]
    assert rows(read_snapshot(lake, "serving_meta"), "sealed_trade_date") == [(d("2024-07-01"),)]


def test_dead_sources_publish_a_valid_empty_snapshot(spark, root):
    """No payload at all: every table is empty and typed, and the contract still holds."""
    lake = Lake(spark, root)
    none = spark.createDataFrame([], "landing_key string, dataset string, request_key string, ticker string, text string")
    frames = spark.createDataFrame([], "landing_key string, dataset string, request_key string, ticker string, content binary")
    ticks = spark.createDataFrame([], "landing_key string, dataset string, request_key string, ticker string, fragment string, pos bigint")
    nightly.rebuild(
        lake, directories=none, delisted=none, minute_payloads=frames, quote_fragments=ticks,
        sessions=spark.createDataFrame([], "session_date date, close_utc timestamp"), submissions=none,
        universe=spark.createDataFrame([("A",)], "ticker string"), trade_date="2024-07-08", now=ts("2024-07-08"),
    )
    assert read_snapshot(lake, "daily_ohlcv").count() == 0
    assert rows(read_snapshot(lake, "coverage")) == [("10y", 1.0), ("since_golive", 1.0)]
    with pytest.raises(LookupError):
        read_snapshot(Lake(spark, f"{root}/elsewhere"), "coverage")
