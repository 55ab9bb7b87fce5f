"""Shapes of plans that the operators promise: exchanges, scans and joins of frames that lie in files."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from pitlake import schemas
from pitlake.operators import adjust
from pitlake.sources import daily
from test_adjust import actions, canonical
from test_sources import texts


@pytest.fixture
def stored(spark, root):
    """Bars and actions as files, large enough for the planner that it broadcasts neither."""
    canonical(spark, [("2020-08-28", 100.0), ("2020-08-31", 99.0)]).write.parquet(f"{root}/bars")
    actions(spark, ("dividend", "2020-08-31", None, 1.0, "2020-09-01 03:59:59"), ("split", "2020-08-31", 2.0, None, "2020-09-01 03:59:59")).write.parquet(f"{root}/actions")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield spark.read.schema(schemas.BARS_DAILY).parquet(f"{root}/bars"), spark.read.schema(schemas.CORPORATE_ACTIONS).parquet(f"{root}/actions")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def count(df, node):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(rf"(?m)^[ :+*\-()\d]*{node}\b", plan))


def test_adjustment_moves_bars_and_actions_once(stored):
    bars, acts = stored
    served = adjust.pit_adjusted(bars, acts)
    assert count(served, "Exchange") == 1 and count(served, "FileScan") == 2
    assert count(served, "SortMergeJoin") == count(served, "BroadcastHashJoin") == 0
    factors = adjust.adjustment_factors(bars, acts)
    assert count(factors, "Exchange") == 1
    assert count(adjust.prior_close(bars, acts), "Exchange") == 1


def test_the_audit_moves_requests_bars_and_factors_once(stored):
    bars, acts = stored
    factors = adjust.adjustment_factors(bars, acts)
    # one exchange for the factors, one for the audit
    assert count(adjust.pit_audit(bars, factors, bars), "Exchange") <= 3
    assert count(adjust.pit_audit(bars, factors, bars), "SortMergeJoin") == 0


def test_the_flag_is_false_where_a_factor_counts_before_it_was_known(spark):
    bars = canonical(spark, [("2020-08-28", 1.0), ("2020-09-02", 2.0), ("2020-09-20", 3.0)])
    acts = actions(spark, ("split", "2020-09-01", 2.0, None, "2020-09-15 12:00:00"))
    factors = adjust.adjustment_factors(bars, acts)
    leak = adjust.pit_audit(bars, factors, bars, active_from=F.col("ex_date"))
    assert [r.no_lookahead for r in leak.orderBy("bar_date").collect()] == [True, False, True]
    assert adjust.pit_audit(bars, factors, bars).filter("NOT no_lookahead").count() == 0


def test_verdicts_need_no_shuffle(spark):
    payloads = texts(spark, ("A", "Date,Open,High,Low,Close\n2024-01-02,1,1,1,1\n"))
    for parse in (daily.parse_csv_bars, daily.parse_json_bars):
        parsed = parse(payloads)
        for df in parsed:
            assert count(df, "Exchange") == count(df, "BroadcastHashJoin") == count(df, "SortMergeJoin") == 0
