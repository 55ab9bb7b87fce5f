from __future__ import annotations

from pyspark.sql import functions as F

from conftest import at, d, rows
from pitlake import schemas
from pitlake.operators import quotes
from pitlake.plans import nightly
from pitlake.plans.lake import Lake
from pitlake.sources import events
from pitlake.streaming import market
from test_quality import event


def drain(writer):
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()


def put(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def ticks(spark, *items):
    return spark.createDataFrame(
        [("X", d("2024-07-08"), at(f"2024-07-08 {t}"), i, b, a) for i, t, b, a in items], market.TICKS
    )


def test_each_payload_once(spark, root):
    source = f"{root}/in"
    put(spark.createDataFrame([("x",)], "v string"), f"{root}/other")
    spark.createDataFrame([("one",)], "value string").coalesce(1).write.mode("append").text(source)
    seen = []

    def run(batch, _):
        seen.extend(r.text for r in batch.collect())

    stream = market.payload_stream(spark, source)
    drain(market.start_each_batch(stream, run, f"{root}/cp"))
    spark.createDataFrame([("two",)], "value string").coalesce(1).write.mode("append").text(source)
    drain(market.start_each_batch(market.payload_stream(spark, source), run, f"{root}/cp"))
    assert [s.strip() for s in seen] == ["one", "two"]


def test_minute_buckets_wait_for_the_watermark(spark, root):
    put(ticks(spark, (0, "14:30:10", 1.0, 2.0), (1, "14:30:50", 3.0, 4.0), (2, "14:30:55", 0.0, 9.0), (3, "14:31:05", 5.0, 6.0)), f"{root}/in")
    put(ticks(spark, (4, "15:30:00", 7.0, 8.0)), f"{root}/in")
    stream = market.minute_buckets(market.parquet_stream(spark, f"{root}/in", market.TICKS, 1))
    q = stream.writeStream.format("memory").queryName("buckets").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    got = rows(spark.table("buckets"), "minute_ts", "bid_close", "ask_close", "n_quotes")
    assert got == [(at("2024-07-08 14:30:00"), 3.0, 4.0, 2), (at("2024-07-08 14:31:00"), 5.0, 6.0, 1)]


def test_first_minutes_win(spark, root):
    row = lambda v: spark.createDataFrame([("A", at("2024-07-08 14:30:00"), v)], "ticker string, minute_ts timestamp, close double")
    put(row(1.0), f"{root}/in")
    stream = market.first_minutes(market.parquet_stream(spark, f"{root}/in", "ticker string, minute_ts timestamp, close double", 1))
    sink, cp = f"{root}/out", f"{root}/cp"
    drain(stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", cp))
    put(row(2.0), f"{root}/in")
    drain(stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", cp))
    assert rows(spark.read.parquet(sink), "close") == [(1.0,)]


def test_streamed_votes_equal_the_nightly_vote(spark, root):
    lake = Lake(spark, f"{root}/live")
    first = [event(s, f"2024-03-{day:02d}", 100.0 + day, "2024-04-01 00:00:00", "h1") for day in range(1, 6) for s in ("stooq", "yfinance")]
    second = [event("stooq", "2024-03-02", 500.0, "2024-04-02 00:00:00", "h2"), event("yfinance", "2024-03-09", 9.0, "2024-04-02 00:00:00", "h3")]
    for i, batch in enumerate((first, second)):
        put(spark.createDataFrame(batch, schemas.BAR_EVENTS), f"{root}/in")
        stream = market.parquet_stream(spark, f"{root}/in", schemas.BAR_EVENTS)
        drain(market.start_each_batch(stream, market.vote_touched(lake), f"{root}/cp"))
    batch_lake = Lake(spark, f"{root}/batch")
    events.append(batch_lake.events_root, "bar_events", spark.createDataFrame(first, schemas.BAR_EVENTS))
    nightly.vote_and_seal(batch_lake, F.lit("2024-04-01").cast("timestamp"))
    events.append(batch_lake.events_root, "bar_events", spark.createDataFrame(second, schemas.BAR_EVENTS))
    nightly.vote_and_seal(batch_lake, F.lit("2024-04-02").cast("timestamp"))
    assert rows(lake.read("bars_daily")) == rows(batch_lake.read("bars_daily"))
    # a retried batch is a no-op
    n = lake.read("bars_daily").count()
    market.vote_touched(lake)(spark.createDataFrame(second, schemas.BAR_EVENTS), 7)
    assert lake.read("bars_daily").count() == n
    assert events.scan(spark, lake.events_root, "bar_events").count() == len(first) + len(second)


def test_streamed_weights_equal_the_batch(spark, root):
    lake = Lake(spark, root)
    session = spark.createDataFrame([(d("2024-07-08"), at("2024-07-08 14:32:30"))], "session_date date, close_utc timestamp")
    parts = [
        [(0, "14:30:10", 1.0, 2.0), (1, "14:32:05", 3.0, 4.0)],  # the close cuts the last bucket
        [(2, "14:30:40", 5.0, 6.0)],  # a late tick
        [(3, "14:33:10", 7.0, 8.0)],  # a new last quote: the earlier one now stands to its bucket's end
    ]
    run = market.weighted_touched(lake, session)
    for i, part in enumerate(parts):
        run(ticks(spark, *part), i)
        so_far = ticks(spark, *[t for p in parts[: i + 1] for t in p])
        want = rows(quotes.quote_bars(so_far, session))
        assert rows(lake.read("live_quote_bars", market.LIVE_BARS), *quotes.QUOTE_BAR) == want, i
    run(ticks(spark, *parts[2]), 2)  # a retried batch replaces itself
    assert rows(lake.read("live_quote_bars", market.LIVE_BARS), *quotes.QUOTE_BAR) == want


def test_minutes_append_once(spark, root):
    lake = Lake(spark, root)
    m = spark.createDataFrame(
        [("A", at("2024-07-08 14:30:00"), 1.0, 1.0, 1.0, 1.0, 1.0, "yfinance", at("2024-07-08 14:30:00"))], schemas.BARS_MINUTE
    )
    run = market.append_minutes(lake)
    run(m, 0)
    run(m.withColumn("close", F.lit(9.0)), 1)
    assert rows(lake.read("bars_minute"), "close") == [(1.0,)]
