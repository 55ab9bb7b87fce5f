"""Company filings metadata: per-company submissions and the ticker-to-CIK map."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlake.sources.drift import Parsed, first_problem, split_parsed


def parse_submissions(payloads: DataFrame) -> Parsed:
    """`{"sic","sicDescription"}` -> (landing_key, request_key, sic, industry)."""
    body = F.from_json("text", "sic string, sicDescription string")
    parsed = payloads.select(
        "landing_key", "request_key", body.alias("b"), F.json_object_keys("text").alias("keys")
    ).withColumn("problem", first_problem((F.col("keys").isNull(), "submissions not JSON")))
    good, rejects = split_parsed(parsed)
    return Parsed(
        good.select(
            "landing_key", "request_key", "b.sic", F.col("b.sicDescription").alias("industry")
        ),
        rejects,
    )


def parse_cik_map(payloads: DataFrame) -> Parsed:
    """`{"0":{cik_str,ticker,title}, ...}` -> (landing_key, ticker, cik).

    An empty object or entries without both keys is drift.
    """
    body = F.from_json("text", "map<string, struct<cik_str string, ticker string>>")
    entries = F.map_values(body)
    bad = F.exists("entries", lambda e: e["ticker"].isNull() | e["cik_str"].try_cast("bigint").isNull())
    parsed = payloads.select("landing_key", entries.alias("entries")).withColumn(
        "problem",
        first_problem(
            (F.col("entries").isNull() | (F.size("entries") == 0), "ticker map empty or unexpected"),
            (bad, "ticker map shape changed"),
        ),
    )
    good, rejects = split_parsed(parsed)
    rows = good.select("landing_key", F.explode("entries").alias("e")).select(
        "landing_key", F.upper("e.ticker").alias("ticker"), F.col("e.cik_str").cast("bigint").alias("cik")
    )
    return Parsed(rows, rejects)
