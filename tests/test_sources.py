from __future__ import annotations

import gzip
import hashlib
import json
import re
from datetime import UTC, date, datetime
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import at, d, rows
from pitlake import schemas
from pitlake.sources import actions, config, daily, edgar, events, landing, listings, minute
from pitlake.sources.drift import SchemaDrift, strict


def land(root, dataset, source, key, payload: bytes, ext, day="2024-07-08"):
    """A landed payload file, named as the landing zone names it."""
    slug = re.sub("[^A-Za-z0-9_-]+", "_", key)[:80]
    digest = hashlib.sha256(key.encode()).hexdigest()[:16]
    path = Path(root) / dataset / f"date={day}" / f"source={source}" / f"{slug}.{digest}.{ext}"
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(payload)
    return path


def texts(spark, *items, dataset="d"):
    data = [(f"{dataset}:s:{k}", dataset, k, k.split(":")[0], t) for k, t in items]
    return spark.createDataFrame(data, "landing_key string, dataset string, request_key string, ticker string, text string")


def problems(parsed):
    return {r.landing_key.split(":", 2)[2]: r.detail for r in parsed.rejects.collect()}


def test_csv_bars(spark):
    parsed = daily.parse_csv_bars(
        texts(
            spark,
            ("aapl", "Date,Open,High,Low,Close,Volume\r\n2024-01-02,1,2,0.5,1.5,100\r\n2024-01-03,,,,,\r\n\r\n"),
            ("SWAP", "Close,Date,Low,High,Open\n9,2024-01-02,7,8,6\n"),
            ("QUOT", '"Date","Open, first",Open,High,Low,"Close"\n"2024-01-02","a, ""b""","1",2,0.5,"1.5"\n'),
            ("HEAD", "Date,Open,High,Low\n2024-01-02,1,2,3\n"),
            ("HTML", "<html>blocked</html>"), ("NONE", "Date,Open,High,Low,Close\n"), ("VOID", ""),
            ("JUNK", "Date,Open,High,Low,Close\n2024-01-02,1,1,1,1\n2024-01-03,1,1,1,n/a\n"),
        )
    )
    assert rows(parsed.good.drop("landing_key")) == [
        ("AAPL", d("2024-01-02"), 1.0, 2.0, 0.5, 1.5, 100.0), ("QUOT", d("2024-01-02"), 1.0, 2.0, 0.5, 1.5, None),
        ("SWAP", d("2024-01-02"), 6.0, 8.0, 7.0, 9.0, None),
    ]
    bad = problems(parsed)
    assert bad.keys() == {"HEAD", "HTML", "NONE", "VOID", "JUNK"}
    assert bad["HEAD"] == "missing columns Close" and bad["NONE"] == "parsed to zero rows"
    with pytest.raises(SchemaDrift):
        strict(parsed)


def test_json_bars(spark):
    bar = {"t": "2024-07-02T02:00:00Z", "o": 1, "h": "2.5", "l": 1, "c": 2, "v": 10}
    parsed = daily.parse_json_bars(
        texts(
            spark, ("a", json.dumps({"bars": [bar]})), ("NULL", '{"bars":null}'), ("EMPTY", '{"bars":[]}'),
            ("NOKEY", '{"x":1}'), ("TEXT", "oops"), ("HOLE", json.dumps({"bars": [bar, {**bar, "c": None}]})),
        )
    )
    assert rows(parsed.good.drop("landing_key")) == [("A", d("2024-07-01"), 1.0, 2.5, 1.0, 2.0, 10.0)]
    assert problems(parsed) == {
        "NOKEY": "daily payload missing 'bars'", "TEXT": "daily payload not JSON", "HOLE": "malformed bar row"}
    assert strict(daily.parse_json_bars(texts(spark, ("EMPTY", '{"bars":[]}')))).count() == 0


def test_quote_ticks_from_gzip_files(spark, root):
    quotes = [
        {"t": "2024-07-08T14:30:10.123456789Z", "bp": 10.0, "ap": 10.1, "c": ["R"]}, {"t": "2024-07-08T14:30:40Z", "bp": None, "ap": 1.0},
        {"t": "2024-07-08T14:30:40Z", "ap": 1.0}, {"t": "2024-07-08T14:30:50Z", "bp": 10.2, "ap": 10.3},
    ]
    for key, body in {
        "X:2024-07-08": {"quotes": quotes, "symbol": "X"}, "E:2024-07-08": {"quotes": []}, "N:2024-07-08": {"quotes": None},
        "M:2024-07-08": {"other": 1}, "B:2024-07-08": {"quotes": [quotes[0], {"bp": 1, "ap": 2}]},
    }.items():
        land(root, "quote_ticks", "alpaca_iex", key, gzip.compress(json.dumps(body).encode()), "json.gz")
    fragments = landing.scan_records(spark, root, "quote_ticks")
    parsed = minute.parse_quote_fragments(fragments)
    assert rows(parsed.good, "ticker", "ts", "bid", "ask") == [
        ("X", datetime(2024, 7, 8, 14, 30, 10, 123456), 10.0, 10.1), ("X", at("2024-07-08 14:30:50"), 10.2, 10.3)]
    ordered = [r.bid for r in parsed.good.orderBy("pos").collect()]
    assert ordered == [10.0, 10.2]
    assert {r.landing_key.split(":")[2]: r.detail for r in parsed.rejects.collect()} == {
        "N": "quote payload missing 'quotes'", "M": "quote payload missing 'quotes'", "B": "malformed quote"}


def test_payloads_that_are_not_one_whole_list_are_rejected(spark):
    one, two = '{"t":"2024-07-08T14:30:10Z","bp":1.0,"ap":2.0}', '{"t":"2024-07-08T14:30:11Z","bp":1.0,"ap":2.0}'
    cases = {
        "WHOLE": f'{{"symbol":"X","quotes": [{one} , {two}],"next":null}}\n', "EMPTY": '{"quotes":[],"n":1}',
        "OPENLIST": f'{{"quotes":[{one},{two}', "OPENENV": f'{{"quotes":[{one}]', "COMMA": f'{{"quotes":[{one},]}}',
        "HALF": f'{{"quotes":[{one},{two[:-12]}', "NESTED": f'{{"quotes":[{one[:-1]},"x":{{"y":1}}}}]}}',
        "STRING": f'{{"quotes":[{one[:-1]},"x":"}}"}}]}}', "TWICE": f'{{"quotes":[{one}]}}{{"quotes":[{two}]}}',
        "BARE": f"[{one}]", "TAIL": f'{{"quotes":[{one}]}} and more', "NOCOMMA": f'{{"quotes":[{one} {two}]}}',
    }
    texts = spark.createDataFrame([(f"q:s:{k}", k, v) for k, v in cases.items()], "landing_key string, ticker string, text string")
    parsed = minute.parse_quote_fragments(minute.fragments_of(texts))
    assert {r.ticker for r in parsed.good.collect()} == {"WHOLE"} and parsed.good.count() == 2
    assert {r.landing_key.split(":")[2] for r in parsed.rejects.collect()} == set(cases) - {"WHOLE", "EMPTY"}


def test_record_positions_follow_a_split_file(spark, root):
    body = {"quotes": [{"t": "2024-07-08T14:30:10Z", "bp": float(i + 1), "ap": 1.0} for i in range(120_000)]}
    land(root, "q", "s", "X:2024-07-08", json.dumps(body).encode(), "json")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
    try:
        frags = landing.scan_records(spark, root, "q")
        assert frags.rdd.getNumPartitions() > 1
        got = minute.parse_quote_fragments(frags).good
        # the bids count up along the file: so must their positions
        broken = got.selectExpr("bid - lag(bid) OVER (ORDER BY pos) AS step").filter("step <> 1").count()
        assert (got.count(), broken) == (120_000, 0)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_actions(spark):
    split = {"execution_date": "2020-08-31", "split_from": 1, "split_to": 4, "ticker": "AAPL"}
    paid = {"ex_dividend_date": "2024-02-09T00:00", "cash_amount": 0.24, "declaration_date": "soon"}
    now = F.lit("2024-08-01").cast("timestamp")
    s = actions.parse_actions(
        texts(
            spark, ("aapl", json.dumps({"status": "OK", "results": [split]})), ("NONE", '{"status":"OK"}'), ("NOST", "{}"),
            ("TEXT", "no"), ("ZERO", json.dumps({"status": "OK", "results": [{**split, "split_from": 0}]})), dataset=actions.SPLITS,
        ), now,
    )
    assert rows(s.good, "ticker", "action_type", "ex_date", "ratio", "cash_amount", "knowledge_time", "landing_key") == [
        ("AAPL", "split", d("2020-08-31"), 4.0, None, at("2020-09-01 03:59:59"), "polygon_splits:s:aapl")]
    assert problems(s).keys() == {"NOST", "TEXT", "ZERO"}
    v = actions.parse_actions(
        texts(spark, ("AAPL", json.dumps({"status": "OK", "results": [paid]})),
              ("HOLE", json.dumps({"status": "OK", "results": [{"cash_amount": 1}]})), dataset=actions.DIVIDENDS), now)
    assert rows(v.good, "ex_date", "ratio", "cash_amount", "declared_date") == [(d("2024-02-09"), None, 0.24, None)]
    assert problems(v) == {"HOLE": "row missing ex_dividend_date/cash_amount"}
    assert events.action_envelope(s.good).columns == schemas.names(schemas.ACTION_EVENTS)


NASDAQ = """Symbol|Security Name|Market Category|Test Issue|Financial Status|Round Lot Size|ETF|NextShares
aapl|Apple Inc.|Q|N|N|100|N|N
QQQ|Trust|G|N|N|100|Y|N
ZTEST|Test|G|Y|N|100|N|N
QQQ|Again|G|N|N|100|N|N
short|line
File Creation Time: 0708202418:01|||||||
"""
OTHER = """ACT Symbol|Security Name|Exchange|CQS Symbol|ETF|Round Lot Size|Test Issue|NASDAQ Symbol
BRK.B|Berkshire|N|BRK.B|N|100|N|BRK.B
"""


def test_directories(spark):
    parsed = listings.parse_directories(
        texts(
            spark, ("nasdaqlisted:2024-07-08", NASDAQ), ("otherlisted:2024-07-08", OTHER), ("martian:2024-07-08", NASDAQ),
            ("otherlisted:2024-07-09", NASDAQ), ("nasdaqlisted:2024-07-10", "<html>"), ("nasdaqlisted:2024-07-11", NASDAQ.splitlines()[0] + "\n"),
        )
    )
    assert rows(parsed.good.drop("landing_key")) == [
        ("nasdaqlisted", d("2024-07-08"), "AAPL", "Apple Inc.", "NASDAQ", False),
        ("nasdaqlisted", d("2024-07-08"), "QQQ", "Trust", "NASDAQ", True),
        ("otherlisted", d("2024-07-08"), "BRK.B", "Berkshire", "N", False),
    ]
    assert problems(parsed).keys() == {"martian:2024-07-08", "otherlisted:2024-07-09", "nasdaqlisted:2024-07-10", "nasdaqlisted:2024-07-11"}


def test_newest_delisted_list(spark):
    old = json.dumps({"results": [{"ticker": "OLD", "delisted_utc": "2020-01-01"}]})
    new = json.dumps({"results": [{"ticker": "doom", "delisted_utc": "2024-07-01T00:00:00Z"}, {"ticker": "X"}, {"delisted_utc": "2024-01-01"}], "complete": True})
    parsed = listings.parse_delisted(listings.newest_payload(texts(spark, ("delisted:2024-07-01", old), ("delisted:2024-07-08", new))))
    assert rows(parsed.good, "ticker", "termination_date", "position") == [("DOOM", d("2024-07-01"), 0)]


def test_edgar(spark):
    subs = edgar.parse_submissions(texts(spark, ("A:1", '{"sic":"3571","sicDescription":"Computers"}'), ("B:2", "<"), ("C:3", "{}")))
    assert rows(subs.good, "request_key", "sic", "industry") == [("A:1", "3571", "Computers"), ("C:3", None, None)]
    assert problems(subs).keys() == {"B:2"}
    ciks = edgar.parse_cik_map(texts(spark, ("m", '{"0":{"cik_str":320193,"ticker":"aapl","title":"Apple"}}'), ("e", "{}"), ("c", '{"0":{"cik":1}}')))
    assert rows(ciks.good, "ticker", "cik") == [("AAPL", 320193)]
    assert problems(ciks).keys() == {"e", "c"}


def frame(columns) -> bytes:
    sink = pa.BufferOutputStream()
    pq.write_table(pa.table(columns), sink)
    return sink.getvalue().to_pybytes()


def prices(suffix="", n=2, **extra):
    return {**extra, **{f"{c}{suffix}": [float(i + 1) for i in range(n)] for c in ("Open", "High", "Low", "Close")}}


def test_daily_frames(spark, root):
    days = [date(2024, 1, 2), date(2024, 1, 3)]
    stamps = pa.array([datetime(2024, 1, 2), datetime(2024, 1, 3)], pa.timestamp("ns"))
    land(root, "yf_daily", "yfinance", "AAPL:2024-07-08", frame(prices("_AAPL", Date=stamps, Volume_AAPL=[10, 20], **{"Adj Close_AAPL": [0.5, 0.6]})), "parquet")
    land(root, "yf_daily", "yfinance", "BRK.B:history:2024-07-08", frame(prices(Date=days)), "parquet")
    land(root, "yf_daily", "yfinance", "MISS:2024-07-08", frame({"Date": days, "Open": [1.0, 2.0]}), "parquet")
    land(root, "yf_daily", "yfinance", "JUNK:2024-07-08", b"not parquet", "parquet")
    land(root, "yf_daily", "yfinance", "NULL:2024-07-08", frame(prices(Date=days) | {"Close": pa.nulls(2, pa.float64())}), "parquet")
    payloads = landing.scan_bytes(spark, root, "yf_daily")
    parsed = daily.parse_frame_bars(payloads)
    assert rows(parsed.good, "ticker", "bar_date", "close", "volume", "adj_close") == [
        ("AAPL", d("2024-01-02"), 1.0, 10.0, 0.5), ("AAPL", d("2024-01-03"), 2.0, 20.0, 0.6),
        ("BRK.B", d("2024-01-02"), 1.0, None, None), ("BRK.B", d("2024-01-03"), 2.0, None, None)]
    assert {k.split(":")[0] for k in problems(parsed)} == {"MISS", "JUNK", "NULL"}


def test_minute_frames(spark, root):
    naive = pa.array([datetime(2024, 7, 8, 9, 30), datetime(2024, 1, 8, 9, 30)], pa.timestamp("us"))
    zoned = pa.array([datetime(2024, 7, 8, 13, 30, tzinfo=UTC), datetime(2024, 7, 8, 13, 31, tzinfo=UTC)], pa.timestamp("us", tz="America/New_York"))
    land(root, "minute_bars", "yfinance", "N:2024-07-08", frame(prices(Datetime=naive)), "parquet")
    land(root, "minute_bars", "yfinance", "Z:2024-07-08", frame(prices("_Z", Datetime=zoned, Volume_Z=[1, 2])), "parquet")
    land(root, "minute_bars", "yfinance", "T:2024-07-08", frame(prices(Datetime=["a", "b"])), "parquet")
    parsed = minute.parse_frame_minutes(landing.scan_bytes(spark, root, "minute_bars"))
    assert rows(parsed.good, "ticker", "minute_ts", "volume") == [
        ("N", at("2024-01-08 14:30:00"), None), ("N", at("2024-07-08 13:30:00"), None),
        ("Z", at("2024-07-08 13:30:00"), 1.0), ("Z", at("2024-07-08 13:31:00"), 2.0)]
    assert len(problems(parsed)) == 1


def test_landing_scan_and_manifest(spark, root):
    keys = ["AAPL:2024-07-08", "BRK.B:2024-07-08", "AAPL:history:2024-07-08", "BRK.B:history:2024-07-08"]
    for i, key in enumerate(keys):
        land(root, "stooq_daily", "stooq", key, b"x" * (i + 1), "csv")
    scanned = landing.scan_text(spark, root, "stooq_daily")
    assert {r[0] for r in rows(scanned, "request_key")} == set(keys)
    assert rows(scanned.filter("request_key = 'BRK.B:2024-07-08'"), "ticker", "landing_key", "partition_date") == [
        ("BRK.B", "stooq_daily:stooq:BRK.B:2024-07-08", d("2024-07-08"))]
    manifest = landing.build_manifest(spark, root, "stooq_daily", F.lit("2024-08-01").cast("timestamp"))
    assert manifest.columns == schemas.names(schemas.LANDING_MANIFEST)
    one = manifest.filter("request_key = 'BRK.B:2024-07-08'").first()
    assert (one.n_bytes, one.payload_hash) == (2, hashlib.sha256(b"xx").hexdigest())
    hollow = manifest.withColumn("n_bytes", F.when(F.col("request_key") == keys[0], 0).otherwise(1))
    assert rows(landing.empty_payloads(hollow), "landing_key") == [(f"stooq_daily:stooq:{keys[0]}",)]
    queue = spark.createDataFrame([("stooq_daily", keys[0])], "dataset string, request_key string")
    assert landing.only_queued(scanned, queue).count() == 1
    odd = scanned.withColumn("request_key", F.lit(None).cast("string"))
    assert {r[0] for r in rows(landing.keyed_by_manifest(odd, manifest), "request_key")} == set(keys)
    name = spark.range(1).select(landing.file_name(F.lit("BRK.B:2024-07-08"), "csv")).first()[0]
    assert name == Path(one.path).name


def test_event_store(spark, root):
    assert events.scan(spark, root, "bar_events").count() == 0
    with pytest.raises(ValueError, match="unknown event type"):
        events.scan(spark, root, "rumours")
    raw = spark.createDataFrame(
        [("A", d("2024-01-02"), 1.0, 1.0, 1.0, 1.0, 1.0, "k")],
        "ticker string, bar_date date, open double, high double, low double, close double, volume double, landing_key string",
    )
    batch = events.bar_envelope(raw, "stooq", True, F.lit("2024-08-01").cast("timestamp"))
    assert events.append(root, "bar_events", batch) and events.append(root, "bar_events", batch)
    assert not events.append(root, "bar_events", batch.limit(0))
    with pytest.raises(ValueError, match="close"):
        events.append(root, "bar_events", batch.drop("close"))
    stored = events.scan(spark, root, "bar_events")
    assert stored.count() == 2 and stored.columns == schemas.names(schemas.BAR_EVENTS)
    assert rows(stored.distinct(), "interval", "reversal_factor", "knowledge_time")[0] == ("1d", 1.0, at("2024-01-03 04:59:59"))
    plan = stored.filter("interval = '1d'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(interval" in plan


def test_config(spark):
    assert rows(config.universe(spark, ["spy", {"ticker": "x", "role": "benchmark"}])) == [("SPY", "member"), ("X", "benchmark")]
    assert rows(config.watchlist(spark, ["qqq"])) == [("QQQ",)]
    assert config.sic_ranges([{"lo": "1", "hi": 2, "sector": "Z"}]) == [(1, 2, "Z")]
    for bad in (lambda: config.universe(spark, []), lambda: config.watchlist(spark, []), lambda: config.sic_ranges([])):
        with pytest.raises(ValueError):
            bad()


def test_keys_are_never_null_or_shared(spark, root):
    keys = ["v:" + "k" * 200 + str(k) for k in range(3)] + ["a b/c", "xü:history:x", "A:x:y:z"]
    for key in keys:
        land(root, "odd", "v", key, key.encode(), "txt")
    scanned = landing.scan_text(spark, root, "odd")
    assert scanned.filter("request_key IS NULL OR landing_key IS NULL").count() == 0
    assert scanned.select("landing_key").distinct().count() == len(keys)
    manifest = scanned.select("path", F.col("text").alias("request_key"))
    assert {r.request_key for r in landing.keyed_by_manifest(scanned, manifest).collect()} == set(keys)
    some = manifest.filter("request_key LIKE 'v:%'")
    assert landing.unlisted(scanned, some).count() == 3


def test_scans_open_only_the_days_asked_for(spark, root):
    land(root, "days", "v", "A:1", b"x", "txt")
    scan = landing.scan_text(spark, root, "days", ("1990-01-01", "1990-01-02"))
    assert scan.count() == 0 and landing.scan_text(spark, root, "days").count() == 1
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan or "date" in plan.split("PartitionFilters")[1][:200]
