"""What runs a batch or a night at a time: only touched parts are read and replaced, and nothing is lost by order."""

from __future__ import annotations

import gzip
import json
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import at, d, rows
from pitlake import schemas
from pitlake.operators import quotes, voting
from pitlake.plans import nightly
from pitlake.plans.lake import Lake
from pitlake.sources import events, landing, parity
from pitlake.streaming import market
from test_quality import event
from test_sources import land, texts


def ts(text):
    return F.lit(text).cast("timestamp")


def part_files(root, name):
    return {str(p): p.stat().st_mtime_ns for p in Path(root).glob(f"tables/{name}/**/*.parquet")}


def partition_filters(df):
    return df._jdf.queryExecution().executedPlan().toString().split("PartitionFilters:")[1].split("]")[0]


def bar(ticker, source, day, close, written, tag):
    e = list(event(source, day, close, written, tag))
    e[schemas.names(schemas.BAR_EVENTS).index("ticker")] = ticker
    return tuple(e)


@pytest.fixture
def voted(spark, root):
    """Two seals over four tickers in four buckets; the second brings a revision of one."""
    lake = Lake(spark, root)
    tickers, seen = [], set()
    for k in range(200):
        b = spark.range(1).select(events.bucket_of(F.lit(f"T{k}"))).first()[0] if len(tickers) < 4 else None
        if b is not None and b not in seen:
            seen.add(b)
            tickers.append(f"T{k}")
    first = [bar(t, s, f"2024-03-{day:02d}", 10.0 + day, "2024-04-01 00:00:00", "h") for t in tickers for day in (1, 2) for s in ("stooq", "yfinance")]
    events.append(root, "bar_events", spark.createDataFrame(first, schemas.BAR_EVENTS))
    nightly.vote_and_seal(lake, ts("2024-04-01"))
    return lake, tickers


def test_a_seal_replaces_only_the_buckets_it_touches(spark, voted):
    lake, tickers = voted
    before = {n: part_files(lake.root, n) for n in ("latest_observations", "beliefs", "vote_results")}
    assert all(len(lake.parts(n)) == 4 for n in before)
    late = [bar(tickers[0], s, "2024-03-02", 99.0, "2024-04-02 00:00:00", "i") for s in ("stooq", "yfinance")]
    events.append(lake.events_root, "bar_events", spark.createDataFrame(late, schemas.BAR_EVENTS))
    assert nightly.vote_and_seal(lake, ts("2024-04-02")) == {"revised": 1, "inserted": 1, "unchanged": 7}
    mine = str(spark.range(1).select(events.bucket_of(F.lit(tickers[0]))).first()[0])
    for name, files in before.items():
        after = part_files(lake.root, name)
        assert files.items() <= after.items()  # nothing rewritten in place
        assert all(f"/part={mine}/" in p for p in after.keys() - files.keys())
        assert [v for p, v in lake.parts(name).items() if p != mine] == [1, 1, 1]
    # the whole vote over all events says the same
    everything = voting.latest_pivot(events.scan(spark, lake.events_root, "bar_events"))
    want = rows(voting.vote_pivot(everything), "ticker", "bar_date", "close", "grade")
    assert rows(lake.read("bars_daily").filter("is_current"), "ticker", "bar_date", "close", "grade") == want
    assert rows(lake.read("vote_results"), "ticker", "bar_date", "voted_at") == [
        (t, d(f"2024-03-{k:02d}"), at("2024-04-02 00:00:00" if t == tickers[0] else "2024-04-01 00:00:00"))
        for t in sorted(tickers) for k in (1, 2)
    ]


def test_reads_open_only_the_folders_asked_for(spark, voted):
    lake, tickers = voted
    some = sorted(lake.parts("latest_observations"))[:1]
    read = lake.read_parts("latest_observations", some)
    assert read.count() and all(f"/part={some[0]}/" in f for f in read.inputFiles())
    assert "part#" in partition_filters(read)
    bucket = int(some[0])
    scan = events.scan(spark, lake.events_root, "bar_events", [bucket])
    assert "bucket#" in partition_filters(scan)
    assert rows(scan.select("ticker").distinct()) == rows(lake.read_parts("latest_observations", some).select("ticker").distinct())


def test_a_broken_seal_is_made_good_by_the_next(spark, voted, monkeypatch):
    lake, tickers = voted
    late = [bar(tickers[1], s, "2024-03-05", 7.0, "2024-04-02 00:00:00", "i") for s in ("stooq", "yfinance")]
    events.append(lake.events_root, "bar_events", spark.createDataFrame(late, schemas.BAR_EVENTS))
    with monkeypatch.context() as m:
        m.setattr(nightly.voting, "vote_audit", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            nightly.vote_and_seal(lake, ts("2024-04-02"))
    assert nightly.vote_and_seal(lake, ts("2024-04-03"))["inserted"] == 0  # merged already, told of now
    assert lake.read("vote_results").count() == 9
    assert rows(lake.read("bars_daily").filter(F.col("bar_date") == "2024-03-05"), "revision_seq", "close") == [(1, 7.0)]
    assert nightly.vote_and_seal(lake, ts("2024-04-04")) == {"revised": 0, "inserted": 0, "unchanged": 9}


TWO_DAYS = ("2024-07-08", "2024-07-09")


def ticks(spark, *items):
    return spark.createDataFrame(
        [("X", d(t[:10]), at(t), i, b, a) for i, t, b, a in items], market.TICKS
    )


def test_only_touched_sessions_are_replaced(spark, root):
    lake = Lake(spark, root)
    sessions = spark.createDataFrame([(d(x), at(f"{x} 20:00:00")) for x in TWO_DAYS], "session_date date, close_utc timestamp")
    run = market.weighted_touched(lake, sessions)
    both = [(0, "2024-07-08 14:30:10", 1.0, 2.0), (1, "2024-07-09 14:30:10", 3.0, 4.0)]
    run(ticks(spark, *both), 0)
    before = part_files(root, "live_quote_bars")
    late = [(2, "2024-07-09 14:30:05", 5.0, 6.0)]
    run(ticks(spark, *late), 1)
    after = part_files(root, "live_quote_bars")
    assert before.items() <= after.items() and after.keys() - before.keys()
    assert all("part=2024-07-09" in p for p in after.keys() - before.keys())
    assert lake.parts("live_quote_bars") == {"2024-07-08": 1, "2024-07-09": 2}
    want = rows(quotes.quote_bars(ticks(spark, *both, *late), sessions))
    assert rows(lake.read("live_quote_bars", market.LIVE_BARS), *quotes.QUOTE_BAR) == want
    # a retry of the batch replaces its own folder of ticks
    run(ticks(spark, *late), 1)
    assert market.stored_batches(spark, f"{root}/ticks", market.TICKS).count() == 3
    assert rows(lake.read("live_quote_bars", market.LIVE_BARS), *quotes.QUOTE_BAR) == want
    read = market.stored_batches(spark, f"{root}/ticks", market.TICKS, [date(2024, 7, 9)])
    assert "session_date#" in partition_filters(read) and read.count() == 2


def test_late_ticks_give_the_batch_answer(spark, root):
    lake = Lake(spark, root)
    run = market.bucket_partials(lake)
    parts = [
        [(5, "2024-07-08 14:31:59", 5.0, 6.0), (9, "2024-07-08 16:00:00", 7.0, 8.0)],
        [(1, "2024-07-08 14:31:10", 1.0, 2.0), (2, "2024-07-08 14:30:00", 9.0, 9.5), (3, "2024-07-08 14:30:01", 0.0, 9.5)],
        [(6, "2024-07-08 14:31:59", 5.5, 6.5), (4, "2024-07-07 23:59:59", 3.0, 4.0)],
    ]
    for i, part in enumerate(parts):
        run(ticks(spark, *part), i)
        want = rows(quotes.quote_buckets(ticks(spark, *[t for p in parts[: i + 1] for t in p])))
        assert rows(market.merged_buckets(lake)) == want
    run(ticks(spark, *parts[1]), 1)
    assert rows(market.merged_buckets(lake)) == want
    assert rows(market.merged_buckets(lake, dates=[date(2024, 7, 7)]), "bid_close") == [(3.0,)]


def test_the_first_writer_stays_however_late_others_come(spark, root):
    lake, ddl = Lake(spark, root), "ticker string, minute_ts timestamp, close double, n int"
    run = market.minute_partials(lake, ["n"])

    def batch(*items):
        return spark.createDataFrame([("A", at(f"2024-07-08 {m}"), c, n) for m, c, n in items], ddl)

    run(batch(("14:31:00", 1.0, 2), ("14:31:00", 9.0, 1)), 0)
    run(batch(("14:31:00", 5.0, 0), ("14:30:00", 2.0, 0)), 1)
    want = [(at("2024-07-08 14:30:00"), 2.0), (at("2024-07-08 14:31:00"), 9.0)]
    assert rows(market.merged_minutes(lake, ddl), "minute_ts", "close") == want
    run(batch(("14:31:00", 5.0, 0), ("14:30:00", 2.0, 0)), 1)
    assert rows(market.merged_minutes(lake, ddl), "minute_ts", "close") == want


def manifest_of(spark, *items):
    """(dataset, source, key, path, day, n_bytes)"""
    data = [(ds, s, k, "h", str(p), "", n, d(day), at("2024-07-08 20:00:00"), at("2024-07-08 20:00:00")) for ds, s, k, p, day, n in items]
    return spark.createDataFrame(data, schemas.LANDING_MANIFEST)


CSV = b"Date,Open,High,Low,Close,Volume\n2024-07-01,1,1,1,1,10\n"


def test_a_night_is_built_from_the_manifest(spark, root):
    zone = f"{root}/landing"
    odd = "B.F/UN~" + "x" * 90 + ":2024-07-08"  # no slug gives this key back
    paths = [
        ("stooq_daily", "stooq", odd, land(zone, "stooq_daily", "stooq", odd, CSV, "csv"), "2024-07-08", len(CSV)),
        ("stooq_daily", "stooq", "OLD:2024-07-05", land(zone, "stooq_daily", "stooq", "OLD:2024-07-05", CSV, "csv", "2024-07-05"), "2024-07-05", len(CSV)),
        ("stooq_daily", "stooq", "GONE:2024-07-08", f"{zone}/stooq_daily/date=2024-07-08/source=stooq/GONE.0.csv", "2024-07-08", 5),
        ("stooq_daily", "stooq", "VOID:2024-07-08", land(zone, "stooq_daily", "stooq", "VOID:2024-07-08", b"", "csv"), "2024-07-08", 0),
    ]
    land(zone, "stooq_daily", "stooq", "STRANGER:2024-07-08", CSV, "csv")
    manifest = manifest_of(spark, *paths)
    lake = Lake(spark, f"{root}/tables", root)
    queue = nightly.build_night(lake, zone, manifest, "2024-07-08", ts("2024-07-08 23:00:00"))
    assert rows(queue, "request_key") == sorted([(odd,), ("GONE:2024-07-08",), ("VOID:2024-07-08",)])
    got = events.scan(spark, root, "bar_events")
    assert rows(got, "ticker", "landing_key") == [(odd.split(":")[0].upper(), f"stooq_daily:stooq:{odd}")]
    letters = {r.request_key: r.detail for r in lake.read("dead_letter").collect()}
    assert letters["GONE:2024-07-08"] == "payload is not where the manifest has it" and letters["VOID:2024-07-08"] == "empty payload"
    stranger = [k for k in letters if k.startswith("file:STRANGER")]
    assert len(stranger) == 1 and len(letters) == 3
    # other days' folders are not even listed
    opened = landing.queued_text(spark, zone, queue, "stooq_daily").inputFiles()
    assert all("date=2024-07-08" in f for f in opened if "/landing/" in f)
    assert landing.queued_text(spark, zone, queue.filter("request_key = 'none'"), "stooq_daily").count() == 0


def test_quote_ties_go_to_the_earlier_session(spark, root):
    """Two payloads of a name hold a tick of the same minute: the one landed for the earlier session stands."""
    zone = f"{root}/landing"
    items = []
    for day, price, n in (("2024-07-03", 50.0, 3), ("2024-07-05", 70.0, 1)):
        body = {"quotes": [{"t": f"2024-07-03T14:30:{10 + k}Z", "bp": price, "ap": price + 1} for k in range(n)]}
        raw = gzip.compress(json.dumps(body).encode())
        items.append(("quote_ticks", "alpaca_iex", f"AAPL:{day}", land(zone, "quote_ticks", "alpaca_iex", f"AAPL:{day}", raw, "json.gz"), "2024-07-08", len(raw)))
    sessions = spark.createDataFrame([(d(x), at(f"{x} 20:00:00")) for x in ("2024-07-03", "2024-07-05")], "session_date date, close_utc timestamp")
    lake = Lake(spark, f"{root}/tables", root)
    nightly.seal_intraday_night(lake, zone, manifest_of(spark, *items), sessions, ts("2024-07-08 23:00:00"))
    # the thinner bar of the later session would win by its count
    assert rows(lake.read("quote_bars_1m"), "bid_close", "n_quotes") == [(50.0, 3)]
    nightly.seal_intraday_night(lake, zone, manifest_of(spark, *items), sessions, ts("2024-07-09 23:00:00"))
    assert lake.version("quote_bars_1m") == 2 and lake.read("quote_bars_1m").count() == 1


def test_only_changed_sessions_are_projected(spark, root):
    lake = Lake(spark, root)

    def minutes(*items):
        return spark.createDataFrame(
            [("A", at(t), c, c, c, c, 1.0, "yfinance", at(t)) for t, c in items], schemas.BARS_MINUTE
        )

    lake.write("bars_minute", minutes(("2024-07-08 14:30:00", 1.0), ("2024-07-09 14:30:00", 2.0)))
    assert nightly.project_intraday(lake) == ["2024-07-08", "2024-07-09"]
    before = part_files(root, "serving_intraday")
    lake.write("bars_minute", minutes(("2024-07-09 14:31:00", 3.0)))
    assert nightly.project_intraday(lake) == ["2024-07-09"]
    assert before.items() <= part_files(root, "serving_intraday").items()
    assert rows(lake.read("serving_intraday"), "minute_ts", "bid") == [
        (at("2024-07-08 14:30:00"), 1.0), (at("2024-07-09 14:30:00"), 2.0), (at("2024-07-09 14:31:00"), 3.0)]
    assert nightly.project_intraday(lake) == []


def test_parity_payloads(spark):
    parsed = parity.parse_parity(texts(
        spark, ("a:2024-07-01:2024-07-08", '{"status":"OK","results":[{"o":1,"h":2,"l":0.5,"c":1.5,"v":10},{"o":9}]}'),
        ("B:2024-07-01:2024-07-08", '{"status":"OK"}'), ("C:2024-07-01:2024-07-08", '{"status":"OK","results":[{"c":2}]}'),
        ("D:2024-07-01:2024-07-08", '{"results":[]}'), ("E:2024-07-01:2024-07-08", "<html>"), ("F", '{"status":"OK"}'),
        ("G:2024-07-01:2024-07-08", '{"status":"OK","results":[{"c":"x"}]}'),
    ))
    assert rows(parsed.good.drop("landing_key")) == [
        ("A", d("2024-07-01"), 1.0, 2.0, 0.5, 1.5, 10.0), ("B", d("2024-07-01"), None, None, None, None, None),
        ("C", d("2024-07-01"), None, None, None, 2.0, None),
    ]
    assert {r.landing_key[4:5]: r.detail for r in parsed.rejects.collect()} == {
        "D": "aggregates missing 'status'", "E": "aggregates not JSON", "F": "request key names no bar", "G": "malformed aggregate"}


def test_parity_of_a_night_replaces_its_sample(spark, root):
    lake = Lake(spark, root)
    sources = [bar("A", s, "2024-07-01", 10.0, "2024-07-02 00:00:00", "h") for s in ("stooq", "yfinance")]
    events.append(root, "bar_events", spark.createDataFrame(sources, schemas.BAR_EVENTS))
    nightly.vote_and_seal(lake, ts("2024-07-02"))
    ours = lake.read("bars_daily").first()

    def landed(close):
        body = {"status": "OK", "results": [{"o": ours.open, "h": ours.high, "l": ours.low, "c": close, "v": ours.volume}]}
        return texts(spark, ("A:2024-07-01:2024-07-08", json.dumps(body)), dataset="polygon_parity")

    assert nightly.parity_seal(lake, landed(12.0), "2024-07-08", ts("2024-07-08")) == {"bars_checked": 1, "field_breaches": 1}
    assert nightly.parity_seal(lake, landed(10.0), "2024-07-08", ts("2024-07-08")) == {"bars_checked": 1, "field_breaches": 0}
    assert lake.read("parity_scores").count() == 5
    assert nightly.parity_seal(lake, landed(10.0), "2024-07-15", ts("2024-07-15"))["bars_checked"] == 1
    assert lake.read("parity_scores").count() == 10
