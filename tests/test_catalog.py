"""The registered queries against their SQL, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from pitlake.plans import catalog
from verify import TABLES, normalized

SF = "/root/testdata/sf0.001"
# a query from every part of the package; verify.py runs all of them
CHECKED = [
    "adjustment_factors", "pit_audit", "vote_latest", "mad_screen", "scd2_second_night", "graveyard",
    "coverage", "quote_twm", "hybrid_intraday", "parity_scores", "sector_projection", "state_fingerprint",
    "parse_csv_bars", "parse_quote_ticks", "stream_quote_buckets",
]

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert catalog.QUERIES.keys() == catalog.ORACLES.keys()
    assert catalog.QUERIES.keys() <= entry_points.queries().keys()
    assert catalog.ORACLES.keys() <= entry_points.oracle_sql().keys()


def test_every_oracle_binds(duck):
    for name, sql in entry_points.oracle_sql().items():
        assert duck.execute(f"DESCRIBE {sql}").fetchall(), name


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["ticker", "effective_date", "open", "high", "low", "close", "volume"]
    assert df.count() > 0


@pytest.mark.parametrize("name", CHECKED)
def test_same_values(spark, duck, name):
    got = entry_points.queries()[name](spark, SF).toPandas()
    want = duck.execute(entry_points.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) > 0 and normalized(got) == normalized(want)


def test_plans_avoid_products_and_python(spark):
    """No query pairs all rows, and none but the Parquet payload readers leaves the JVM."""
    for name, query in catalog.QUERIES.items():
        if name.startswith(("stream_", "parse_frame_")):
            continue
        plan = query(spark, SF)._jdf.queryExecution().executedPlan().toString()
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEval", "InPandas", "BatchEvalPython"):
            assert bad not in plan, (name, bad)


def test_scans_read_only_what_they_need(spark):
    plan = entry_points.queries()["quote_twm"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double>" in plan
    plan = entry_points.queries()["complete_dates"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan
