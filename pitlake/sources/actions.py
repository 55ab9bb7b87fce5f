"""Corporate-action payloads (JSON) to action events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlake.functions.clocks import end_of_day_knowledge
from pitlake.functions.hashing import with_action_hash
from pitlake.sources.drift import Parsed, first_problem, judge

SPLITS = "polygon_splits"
DIVIDENDS = "polygon_dividends"

_BODY = (
    "results array<struct<execution_date string, split_from string, split_to string, "
    "ex_dividend_date string, cash_amount string, declaration_date string>>"
)


def lenient_date(text: Column) -> Column:
    """The leading ISO date of a text, null when there is none."""
    return F.substring(text, 1, 10).try_cast("date")


def parse_actions(payloads: DataFrame, written_at: Column) -> Parsed:
    """Split and dividend payloads -> action event rows (without event_id).

    payloads: (landing_key, dataset, ticker, text). A split ratio is to/from. A payload that is not
    JSON, has no `status`, or holds a row without its date or amounts is drift; no results is fine.
    """
    is_split = F.col("dataset") == SPLITS
    body = F.from_json("text", _BODY)
    keys = F.json_object_keys("text")
    opened = payloads.select(
        "landing_key", "dataset", F.upper("ticker").alias("ticker"),
        keys.isNull().alias("not_json"),
        (~F.array_contains(keys, "status")).alias("no_status"),
        body["results"].alias("results"),
    )
    results = opened.select(
        "landing_key", "dataset", "ticker", "not_json", "no_status",
        F.explode_outer("results").alias("r"),
    )
    to, frm = F.col("r.split_to").try_cast("double"), F.col("r.split_from").try_cast("double")
    rows = results.select(
        "landing_key", "ticker", "not_json", "no_status",
        F.col("r").isNotNull().alias("data"),
        is_split.alias("is_split"),
        F.when(is_split, "split").otherwise("dividend").alias("action_type"),
        lenient_date(
            F.when(is_split, F.col("r.execution_date")).otherwise(F.col("r.ex_dividend_date"))
        ).alias("ex_date"),
        F.when(is_split & (to != 0), F.try_divide(to, frm)).alias("ratio"),
        F.when(~is_split, F.col("r.cash_amount").try_cast("double")).alias("cash_amount"),
        F.when(~is_split, lenient_date(F.col("r.declaration_date"))).alias("declared_date"),
    )
    amount = F.coalesce("ratio", "cash_amount")
    bad = F.bool_or(F.col("data") & (F.col("ex_date").isNull() | amount.isNull()))
    parsed = judge(
        rows,
        first_problem(
            (F.bool_or("not_json"), "not JSON"),
            (F.bool_or("no_status"), "missing 'status'"),
            (bad & F.bool_or("is_split"), "row missing execution_date/split_from/split_to"),
            (bad, "row missing ex_dividend_date/cash_amount"),
        ),
    )
    actions = parsed.good.filter("data").select(
        F.lit("polygon").alias("source"), "ticker", "action_type", "ex_date", "ratio",
        "cash_amount", "declared_date",
        end_of_day_knowledge(F.col("ex_date")).alias("knowledge_time"),
        written_at.alias("written_at"), "landing_key",
    )
    return Parsed(with_action_hash(actions), parsed.rejects)
