"""Listing payloads: pipe-delimited symbol directories and a vendor's delisted list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pitlake.sources.actions import lenient_date
from pitlake.sources.daily import cell, first_line
from pitlake.sources.drift import Parsed, first_problem, judge

# The symbol column of each directory kind, and the exchange of the one that omits it.
SYMBOL_COLUMN = {"nasdaqlisted": "Symbol", "otherlisted": "ACT Symbol"}
IMPLIED_EXCHANGE = {"nasdaqlisted": "NASDAQ"}


def _by_kind(values: dict[str, str]):
    out = F.lit(None).cast("string")
    for kind, value in values.items():
        out = F.when(F.col("source") == kind, value).otherwise(out)
    return out


def parse_directories(payloads: DataFrame) -> Parsed:
    """Symbol directories -> (landing_key, source, snapshot_date, ticker, security_name, exchange,
    is_etf).

    payloads: (landing_key, request_key `kind:date`, text). The footer, test issues and ragged lines
    go; a ticker listed twice keeps its first line.
    """
    head = F.transform(F.split("head", r"\|"), F.trim)
    symbol = _by_kind(SYMBOL_COLUMN)
    needed = F.array(symbol, F.lit("Security Name"), F.lit("Test Issue"))
    named = payloads.select(
        "landing_key",
        F.split_part("request_key", F.lit(":"), F.lit(1)).alias("source"),
        F.split_part("request_key", F.lit(":"), F.lit(2)).try_cast("date").alias("snapshot_date"),
        first_line(F.col("text")).alias("head"),
        F.ltrim("text").alias("text"),
    )
    columns = {
        "symbol": symbol, "name": F.lit("Security Name"), "test": F.lit("Test Issue"),
        "etf": F.lit("ETF"), "exchange": F.lit("Exchange"),
    }
    headed = named.select(
        "landing_key", "source", "snapshot_date", "head",
        F.size(head).alias("width"),
        F.array_join(F.array_except(needed, head), ",").alias("missing"),
        *[F.array_position(head, c).alias(f"at_{k}") for k, c in columns.items()],
        F.split("text", r"\r?\n").alias("lines"),
    )
    lines = headed.select(
        *[c for c in headed.columns if c != "lines"], F.posexplode("lines").alias("pos", "line")
    )
    parts = F.split("line", r"\|")
    footer = F.lower("line").contains("file creation time")
    cells = lines.select(
        "landing_key", "source", "snapshot_date", "head", "missing", "pos",
        ((F.col("pos") > 0) & (F.trim("line") != "") & ~footer & (F.size(parts) >= F.col("width"))).alias("data"),
        *[cell(parts, F.col(f"at_{k}")).alias(k) for k in columns],
    )
    rows = cells.select(
        "landing_key", "source", "snapshot_date", "head", "missing", "pos",
        F.upper("symbol").alias("ticker"),
        F.coalesce("name", F.lit("")).alias("security_name"),
        F.coalesce(_by_kind(IMPLIED_EXCHANGE), F.col("exchange")).alias("exchange"),
        F.coalesce(F.upper("etf") == "Y", F.lit(False)).alias("is_etf"),
        (
            F.col("data") & F.col("symbol").isNotNull()
            & (F.coalesce(F.upper("test"), F.lit("")) != "Y")
        ).alias("kept"),
    )
    parsed = judge(
        rows,
        first_problem(
            (F.bool_or(~F.col("source").isin(*SYMBOL_COLUMN)), "unknown symbol-dir kind"),
            (F.bool_or(F.col("snapshot_date").isNull()), "no snapshot date in request key"),
            (F.bool_or(~F.col("head").contains("|")), "not pipe-delimited"),
            (F.max("missing") != "", F.concat(F.lit("missing columns "), F.max("missing"))),
            (F.count_if("kept") == 0, "parsed to zero rows"),
        ),
    )
    w = W.partitionBy("landing_key", "ticker").orderBy("pos")
    first = (
        parsed.good.filter("kept")
        .withColumn("_rn", F.row_number().over(w))
        .filter("_rn = 1")
        .select("landing_key", "source", "snapshot_date", "ticker", "security_name", "exchange", "is_etf")
    )
    return Parsed(first, parsed.rejects)


def newest_payload(payloads: DataFrame) -> DataFrame:
    """The payload with the greatest request key."""
    return payloads.filter(F.col("request_key") == payloads.agg(F.max("request_key")).scalar())


def parse_delisted(payloads: DataFrame) -> Parsed:
    """`{"results":[{ticker, delisted_utc}]}` -> (landing_key, ticker, termination_date, position).

    Rows lacking either value are skipped; a date that cannot be read is drift.
    """
    body = F.from_json("text", "results array<struct<ticker string, delisted_utc string>>")
    opened = payloads.select(
        "landing_key",
        F.json_object_keys("text").isNull().alias("not_json"),
        body["results"].alias("results"),
    )
    results = opened.select(
        "landing_key", "not_json", F.posexplode_outer("results").alias("position", "r")
    )
    filled = (F.col("r.ticker") != "") & (F.col("r.delisted_utc") != "")
    rows = results.select(
        "landing_key", "not_json",
        F.upper("r.ticker").alias("ticker"),
        lenient_date(F.col("r.delisted_utc")).alias("termination_date"),
        F.col("position").cast("bigint").alias("position"),
        F.coalesce(filled, F.lit(False)).alias("data"),
    )
    parsed = judge(
        rows,
        first_problem(
            (F.bool_or("not_json"), "delisted payload not JSON"),
            (F.bool_or(F.col("data") & F.col("termination_date").isNull()), "malformed delisted_utc"),
        ),
    )
    return Parsed(
        parsed.good.filter("data").select("landing_key", "ticker", "termination_date", "position"),
        parsed.rejects,
    )
