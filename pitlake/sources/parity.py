"""End-of-day aggregates of the comparison vendor, one payload per sampled bar."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlake.sources.drift import Parsed, first_problem, once, split_payloads

FIELDS = {"o": "open", "h": "high", "l": "low", "c": "close", "v": "volume"}
AGGREGATE = ["landing_key", "ticker", "bar_date", *FIELDS.values()]


def parse_parity(payloads: DataFrame) -> Parsed:
    """`{"status", "results":[{o,h,l,c,v}]}` -> (landing_key, ticker, bar_date, open..volume).

    payloads: (landing_key, request_key, text), the request key being `ticker:bar_date:trade_date`. The first
    result counts. No results, and a field that is absent, give nulls. A payload that is not JSON or has no
    `status`, a key without a date and a value that is no number are drift.
    """
    keys = F.json_object_keys("text")
    body = F.from_json("text", "results array<struct<o string, h string, l string, c string, v string>>")
    part = F.split("request_key", ":")
    first = F.get(body["results"], F.lit(0))
    opened = payloads.select(
        "landing_key", F.upper(F.get(part, F.lit(0))).alias("ticker"), F.get(part, F.lit(1)).try_cast("date").alias("day"),
        keys.isNull().alias("not_json"), (~F.array_contains(keys, "status")).alias("no_status"),
        once(F.struct(*[first[k].alias(k) for k in FIELDS])).alias("raw"),
    )
    values = {name: F.col(f"raw.{k}").try_cast("double") for k, name in FIELDS.items()}
    unreadable = F.greatest(*[(F.col(f"raw.{k}").isNotNull() & values[n].isNull()) for k, n in FIELDS.items()])
    problem = first_problem(
        (F.col("not_json"), "aggregates not JSON"),
        (F.col("no_status"), "aggregates missing 'status'"),
        (F.col("day").isNull(), "request key names no bar"),
        (unreadable, "malformed aggregate"),
    )
    row = F.array(F.struct(F.col("day").alias("bar_date"), *[v.alias(n) for n, v in values.items()]))
    return split_payloads(opened, problem, row, AGGREGATE)
