"""Market-data tables derived from the star-schema test tables.

Every derivation is integer arithmetic and a handful of decimal multipliers, so any SQL engine gets
the same values. Reads name the columns they need, which prunes the scans and skips schema inference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlake.functions.clocks import end_of_day_knowledge
from pitlake.session import pin_utc

TABLES = {
    "part": "p_partkey bigint, p_brand string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_quantity double, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint",
    "supplier": "s_suppkey bigint",
    "events": "event_id bigint, ts timestamp_ntz, event_type string, value double",
}
TRADE_DATE = "2002-01-31"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin_utc(spark).read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def ts(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One synthetic daily bar per (brand, ship date): ticker, bar_date, k, bn, dn, px, vol.

    k seeds the variations, bn numbers the ticker, dn the day.
    """
    parts = table(spark, sf_dir, "part").withColumnRenamed("p_brand", "ticker")
    lines = table(spark, sf_dir, "lineitem")
    day = F.to_date("l_shipdate")
    return (
        lines.join(parts, lines.l_partkey == parts.p_partkey)
        .groupBy("ticker", day.alias("bar_date"))
        .agg(F.min("l_orderkey").alias("k"), (F.sum("l_quantity") * 1000).alias("vol"))
        .withColumn("bn", F.substring("ticker", 7, 9).cast("int"))
        .withColumn("dn", F.date_diff("bar_date", F.lit("1995-01-01").cast("date")))
        .withColumn("px", (F.lit(1000) + (F.col("dn") * 7 + F.col("bn") * 13) % 11) / F.lit(10.0))
    )


def _k(n: int) -> Column:
    return F.col("k") % n == 0


def observations(spark: SparkSession, sf_dir: str, night: int = 1) -> DataFrame:
    """(source, ticker, bar_date, open..volume, k): what three vendors reported for each bar.

    On night 2 one vendor has revised some closes.
    """
    px, vol = F.col("px"), F.col("vol")
    revised = F.when(_k(41), 1.001).otherwise(1.0) if night == 2 else F.lit(1.0)

    def cell(source: str, keep: Column, close: Column, volume: Column) -> Column:
        return F.when(
            keep, F.struct(F.lit(source).alias("source"), close.alias("c"), volume.alias("volume"))
        )

    vendors = F.array(
        cell("yfinance", ~_k(20), px * F.when(_k(97), 3.0).otherwise(1.0), vol),
        cell(
            "stooq", ~_k(3), px * F.when(_k(31), 1.02).otherwise(1.0005) * revised,
            vol * F.when(_k(13), 1.2).otherwise(1.02),
        ),
        cell("alpaca_iex", ~_k(7), px * F.when(_k(31), 1.04).otherwise(1.0002), vol * 0.02),
    )
    return (
        base(spark, sf_dir)
        .select("ticker", "bar_date", "k", F.explode(F.filter(vendors, lambda v: v.isNotNull())).alias("v"))
        .select(
            "v.source", "ticker", "bar_date",
            (F.col("v.c") * 0.99).alias("open"), (F.col("v.c") * 1.01).alias("high"),
            (F.col("v.c") * 0.98).alias("low"), F.col("v.c").alias("close"), "v.volume", "k",
        )
    )


def bar_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations as events: some written twice, some tied on write time and told apart by hash,
    some of another interval."""
    obs = observations(spark, sf_dir)
    version = F.explode(
        F.filter(
            F.array(F.lit(0), F.when(_k(41), 1), F.when(_k(43), 2), F.when(_k(47), 3)),
            lambda v: v.isNotNull(),
        )
    )
    v = F.col("v")
    scale = F.when(v == 1, 1.001).when(v == 2, 0.999).when(v == 3, 7.0).otherwise(1.0)
    prices = {c: F.col(c) * scale for c in ("open", "high", "low", "close")}
    return (
        obs.withColumn("v", version)
        .withColumns(prices)
        .withColumns(
            {
                "interval": F.when(v == 3, "1m").otherwise("1d"),
                "knowledge_time": end_of_day_knowledge("bar_date"),
                "written_at": F.when(v == 1, ts("2002-01-02")).otherwise(ts("2002-01-01")),
                # the tie of v=0 and v=2 falls either way
                "payload_hash": F.concat_ws(
                    "-", F.lit("h"), F.when(v == 2, F.col("k") % 2 * 9).otherwise(F.lit(5))
                ),
            }
        )
    )


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical daily bars: mostly good, some quarantined, some with a closed earlier version."""
    version = F.explode(F.when(_k(29), F.array(F.lit(2), F.lit(1))).otherwise(F.array(F.lit(1))))
    stale = F.col("_closed")
    close = F.col("px") * F.when(stale, 0.5).otherwise(1.0)
    known = end_of_day_knowledge("bar_date")
    revised_at = ts("2002-01-02")
    return (
        base(spark, sf_dir)
        .withColumn("revision_seq", version)
        .withColumn("_closed", _k(29) & (F.col("revision_seq") == 1))
        .select(
            "ticker", "bar_date",
            (close * 0.99).alias("open"), (close * 1.01).alias("high"),
            (close * 0.98).alias("low"), close.alias("close"), F.col("vol").alias("volume"),
            F.when(_k(3), "yfinance").otherwise("yfinance,stooq").alias("source_set"),
            F.when(_k(53), "quarantined").when(_k(3), "degraded").otherwise("good").alias("grade"),
            _k(3).alias("single_source"),
            F.concat_ws("-", F.lit("h"), "revision_seq").alias("payload_hash"),
            F.when(F.col("revision_seq") == 2, revised_at).otherwise(known).alias("knowledge_time"),
            F.when(F.col("revision_seq") == 2, revised_at).otherwise(known).alias("valid_from"),
            F.when(stale, revised_at).alias("valid_to"),
            (~stale).alias("is_current"),
            "revision_seq",
            "k",
        )
    )


def _tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "part").select(F.col("p_brand").alias("ticker")).distinct()
        .withColumn("bn", F.substring("ticker", 7, 9).cast("int"))
    )


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corporate actions: two splits per ticker (the second known a month late), a superseded split,
    and quarterly dividends for every third ticker."""
    bn = F.col("bn")
    day1 = F.date_add(F.lit("1997-01-01").cast("date"), bn * 5)
    day2 = F.date_add(F.lit("1999-06-01").cast("date"), bn * 3)

    def split(ex: Column, ratio: Column, known: Column, live: Column) -> Column:
        return F.struct(
            ex.alias("ex_date"), ratio.alias("ratio"), known.alias("known"), live.alias("live")
        )

    splits = (
        _tickers(spark, sf_dir)
        .select(
            "ticker",
            F.explode(
                F.array(
                    split(day1, F.lit(2.0), day1, F.lit(True)),
                    split(day2, F.when(bn % 2 == 0, 3.0).otherwise(0.5), F.date_add(day2, 30), F.lit(True)),
                    split(day1, F.lit(5.0), day1, F.lit(False)),
                )
            ).alias("s"),
        )
        .select(
            "ticker", F.lit("split").alias("action_type"), "s.ex_date", "s.ratio",
            F.lit(None).cast("double").alias("cash_amount"), F.col("s.known").alias("known"),
            F.col("s.live").alias("is_current"),
        )
    )
    dividends = (
        base(spark, sf_dir).filter(bn % 3 == 0)
        .select("ticker", "bn", F.to_date(F.date_trunc("quarter", F.col("bar_date"))).alias("ex_date"))
        .distinct()
        .select(
            "ticker", F.lit("dividend").alias("action_type"), "ex_date",
            F.lit(None).cast("double").alias("ratio"),
            ((bn + 25) / F.lit(100.0)).alias("cash_amount"), F.col("ex_date").alias("known"),
            F.lit(True).alias("is_current"),
        )
    )
    stamp = end_of_day_knowledge("known")
    return splits.unionByName(dividends).select(
        "ticker", "action_type", "ex_date", "ratio", "cash_amount",
        F.lit(None).cast("date").alias("declared_date"),
        F.lit("single_source").alias("confidence"), F.lit("polygon").alias("source_set"),
        F.concat_ws("-", F.lit("a"), F.coalesce("ratio", "cash_amount").cast("string")).alias("payload_hash"),
        stamp.alias("knowledge_time"), stamp.alias("valid_from"),
        F.when(~F.col("is_current"), ts("2002-01-02")).alias("valid_to"),
        "is_current", F.lit(1).alias("revision_seq"),
    )


def action_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Action observations: every action seen on the first night, a third of them amended later."""
    live = actions(spark, sf_dir).filter("is_current")
    seen = F.explode(
        F.when(F.dayofmonth("ex_date") % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
            F.array(F.lit(0))
        )
    )
    scale = F.when(F.col("v") == 1, 2.0).otherwise(1.0)
    return (
        live.select("ticker", "action_type", "ex_date", "ratio", "cash_amount", "declared_date",
                    "knowledge_time", seen.alias("v"))
        .withColumns({"ratio": F.col("ratio") * scale, "cash_amount": F.col("cash_amount") * scale})
        .withColumn("written_at", F.when(F.col("v") == 1, ts("2002-01-02")).otherwise(ts("2002-01-01")))
        .withColumn(
            "payload_hash",
            F.concat_ws("-", F.lit("a"), F.coalesce("ratio", "cash_amount").cast("string")),
        )
    )


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quote ticks of the events table."""
    return quotes_of(table(spark, sf_dir, "events"))


def quotes_of(events: DataFrame) -> DataFrame:
    """Quote ticks: one name per event type; some tied on the hour, some with an empty side."""
    at = F.col("ts").cast("timestamp")
    return events.select(
        F.col("event_type").alias("ticker"),
        F.to_date("ts").alias("session_date"),
        F.when(F.col("event_id") % 4 == 0, F.date_trunc("hour", at)).otherwise(at).alias("ts"),
        F.col("event_id").alias("pos"),
        F.when(F.col("event_id") % 11 == 0, 0.0).otherwise(F.col("value")).alias("bid"),
        (F.col("value") * 1.001).alias("ask"),
    )


def quote_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of the quote days; every seventh day is no session."""
    day = F.col("session_date")
    return (
        table(spark, sf_dir, "events").select(F.to_date("ts").alias("session_date")).distinct()
        .filter(F.dayofmonth(day) % 7 != 0)
        .select(
            day,
            F.timestamp_seconds(
                F.unix_timestamp(day.cast("timestamp"))
                + F.when(F.dayofmonth(day) == 3, 18 * 3600).otherwise(21 * 3600)
            ).alias("close_utc"),
        )
    )


def minutes(spark: SparkSession, sf_dir: str, bucket_seconds: int = 3600) -> DataFrame:
    """Bars per (event type, bucket) of the events outside every third id."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    width = F.lit(bucket_seconds * 1_000_000)
    return (
        table(spark, sf_dir, "events").filter(F.col("event_id") % 3 != 2)
        .groupBy(F.col("event_type").alias("ticker"), (us - F.pmod(us, width)).alias("b"))
        .agg(
            F.max_by("value", F.struct(us.alias("us"), F.col("event_id"))).alias("close"),
            F.sum("value").alias("volume"),
        )
        .select("ticker", F.timestamp_micros("b").alias("minute_ts"), "close", "volume")
    )


def event_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily high/low per event type, as canonical bars."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("ticker"), F.to_date("ts").alias("bar_date"))
        .agg(F.max("value").alias("high"), F.min("value").alias("low"))
        .withColumns({"is_current": F.lit(True), "grade": F.lit("good")})
    )


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing snapshots per quarter from two directories; one directory is missing in some."""
    quarter = F.to_date(F.date_trunc("quarter", "o_orderdate"))
    nasdaq = F.col("o_orderkey") % 2 == 0
    return (
        table(spark, sf_dir, "orders")
        .select(
            F.when(nasdaq, "nasdaqlisted").otherwise("otherlisted").alias("source"),
            quarter.alias("snapshot_date"),
            F.concat(F.lit("C"), F.col("o_custkey")).alias("ticker"),
        )
        .filter(~((F.col("source") == "otherlisted") & (F.month("snapshot_date") == 7)))
        .distinct()
    )


def delisted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vendor's delisted list: some customers and every ticker of the daily bars, some twice."""
    c = F.col("c_custkey")
    customers = (
        table(spark, sf_dir, "customer").filter(c % 50 == 0)
        .select(
            F.concat(F.lit("C"), c).alias("ticker"),
            F.date_add(F.lit("1999-01-01").cast("date"), (c % 500).cast("int")).alias("termination_date"),
            c.alias("position"),
        )
    )
    twice = F.explode(F.array(F.lit(0), F.lit(1)))
    brands = _tickers(spark, sf_dir).withColumn("v", twice).select(
        "ticker",
        F.date_add(F.lit("1999-01-01").cast("date"), F.col("bn") * 40 + F.col("v") * 7).alias("termination_date"),
        (F.col("bn") + F.col("v") * 1000).cast("bigint").alias("position"),
    )
    return customers.unionByName(brands)


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exchange sessions on every order date; the third of a month closes early."""
    day = F.col("session_date")
    start = F.unix_timestamp(day.cast("timestamp"))
    early = F.dayofmonth(day) == 3
    return (
        table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("session_date")).distinct()
        .select(
            F.lit("XNYS").alias("exchange"), day,
            F.timestamp_seconds(start + 14 * 3600 + 1800).alias("open_utc"),
            F.timestamp_seconds(start + F.when(early, 18 * 3600).otherwise(21 * 3600)).alias("close_utc"),
            early.alias("is_half_day"),
        )
    )


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company filings: one per supplier, some with a blank or odd code, some filed twice."""
    s = F.col("s_suppkey")
    twice = F.explode(F.when(s % 10 == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    code = (F.lit(1000) + (s * 137) % 8000 + F.col("v")).cast("string")
    return table(spark, sf_dir, "supplier").withColumn("v", twice).select(
        F.concat(F.lit("S"), s, F.lit(":"), F.lit(100000) + s + F.col("v") * 500000).alias("request_key"),
        F.when(s % 13 == 5, "").when(s % 17 == 4, "garbage").otherwise(code).alias("sic"),
        F.concat(F.lit("industry "), s % 7).alias("industry"),
    )


def parity_peer(spark: SparkSession, sf_dir: str, held: DataFrame | None = None) -> DataFrame:
    """Another vendor's bars: close to ours, some off, some with a missing close."""
    off = F.when(_k(17), 1.01).otherwise(1.0002)
    rows = bars(spark, sf_dir) if held is None else held
    return rows.filter("is_current").select(
        "ticker", "bar_date", "open", "high", "low",
        F.when(~_k(23), F.col("close") * off).alias("close"), "volume",
    )


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed payloads: most (ticker, date) requests, some tickers with a history payload."""
    day = F.col("bar_date").cast("string")
    tag = F.when(_k(997), "history:").otherwise("")
    return base(spark, sf_dir).filter(~_k(5)).select(
        F.lit("yf_daily").alias("dataset"), F.lit("yfinance").alias("source"),
        F.concat("ticker", F.lit(":"), tag, day).alias("request_key"),
        F.concat(F.lit("landing/yf_daily/"), "ticker", F.lit("/"), day).alias("path"),
        "ticker", "bar_date", "k",
    )


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("bar_date").cast("string")
    return base(spark, sf_dir).select(
        F.lit("yf_daily").alias("dataset"), F.lit("yfinance").alias("source"),
        F.concat("ticker", F.lit(":"), day).alias("request_key"),
    )
