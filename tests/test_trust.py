from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import at, d, rows
from pitlake import schemas
from pitlake.operators import contracts, gaps, parity, sectors, serving, worklists


def now():
    return F.lit("2024-08-01").cast("timestamp")


def test_sic_map(spark):
    codes = ["3571", "6022", "2834", "9999", None, "garbage", "", " 6022 ", "5850", "5912", "7370", "3571.0"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "i int, sic string")
    got = [r.s for r in df.select("i", sectors.sector_of(F.col("sic")).alias("s")).orderBy("i").collect()]
    assert got == ["XLK", "XLF", "XLV", None, None, None, None, "XLF", "XLY", "XLP", "XLK", None]


def test_sector_projection_skips_known_and_takes_the_later_key(spark):
    subs = spark.createDataFrame(
        [("A:1", "3571", "x"), ("A:2", "6022", "y"), ("B:9", "", "z"), ("C:5", "6022", "w")],
        "request_key string, sic string, industry string",
    )
    known = spark.createDataFrame([("C",)], "ticker string")
    got = rows(sectors.sector_projection(subs, known, now()), "ticker", "cik", "sic", "sector", "industry")
    assert got == [("A", "2", "6022", "XLF", "y"), ("B", "9", None, None, "z")]


BARS = "ticker string, bar_date date, open double, high double, low double, close double, volume double"


def test_parity(spark):
    ours = spark.createDataFrame([("A", d("2024-01-01"), 100.0, 0.0, 1.0, None, 100.0), ("B", d("2024-01-01"), 1.0, 1.0, 1.0, 1.0, 1.0)], BARS)
    theirs = spark.createDataFrame([("A", d("2024-01-01"), 100.2, 0.0, None, None, 104.0)], BARS)
    scores = parity.parity_scores(ours, theirs, "2024-02-01")
    got = {(r[1], r[3]): (None if r[6] is None else round(r[6], 6), r[7]) for r in rows(scores)}
    assert got["A", "open"] == (round(0.2 / 100.1, 6), False)
    assert got["A", "high"] == (0.0, True)
    assert got["A", "low"] == (None, False)
    assert got["A", "close"] == (None, True)
    assert got["A", "volume"] == (round(4 / 102, 6), True)
    assert got["B", "open"] == (None, False)
    old = scores.withColumn("sample_date", F.lit("2024-01-25").cast("date")).withColumn("rel_diff", F.lit(9.0))
    assert parity.parity_worst(scores.unionByName(old)).first()[0] == pytest.approx(4 / 102)
    assert parity.parity_worst(scores.limit(0)).first()[0] is None
    assert parity.replace_sample(scores.unionByName(old), scores, "2024-02-01").count() == 20


def test_parity_sample_is_repeatable(spark):
    b = spark.range(200).select(
        F.lit("A").alias("ticker"), F.date_sub(F.lit("2024-07-01").cast("date"), F.col("id").cast("int") * 10).alias("bar_date"),
        *[F.lit(1.0).alias(c) for c in ("open", "high", "low", "close", "volume")],
        F.lit(True).alias("is_current"), F.lit("good").alias("grade"),
    )
    one, two = parity.parity_sample(b, "2024-07-01"), parity.parity_sample(b.repartition(5), "2024-07-01")
    assert rows(one) == rows(two) and one.count() == 25
    assert one.agg(F.min("bar_date")).first()[0] >= d("2022-11-09")
    assert rows(one) != rows(parity.parity_sample(b, "2024-07-02"))


def ledger(spark, **given):
    shapes = {
        "intraday": schemas.SERVING_INTRADAY, "bars": schemas.BARS_DAILY, "coverage": schemas.COVERAGE_METRICS,
        "grave": schemas.GRAVEYARD, "universe": "ticker string", "sectors": schemas.SECTORS,
        "parity": schemas.PARITY_SCORES, "health": schemas.SOURCE_HEALTH,
    }
    frames = {k: given.get(k, schemas.empty(spark, v)) for k, v in shapes.items()}
    out = gaps.gap_ledger(gaps.gap_metrics(**frames), now())
    return {r.gap_key: (r.metric, r.severity) for r in out.collect()}


def test_empty_ledger_blocks_on_coverage(spark):
    got = ledger(spark)
    assert len(got) == 8
    assert got["delisted_coverage_10y"] == (None, "blocker")
    assert got["intraday_iex_bbo_share"] == (None, "warn")
    assert got["daily_quarantined_count"] == (0.0, "info")
    assert got["parity_worst_rel_diff"] == (None, "info")


def test_ledger_measures(spark):
    t = at("2024-01-01 00:00:00")
    bar = lambda grade, single: ("A", d("2024-01-01"), 1.0, 1.0, 1.0, 1.0, 1.0, "s", grade, single, "h", t, t, None, True, 1)
    got = ledger(
        spark,
        bars=spark.createDataFrame([bar("degraded", True), bar("quarantined", True), bar("good", False)], schemas.BARS_DAILY),
        universe=spark.createDataFrame([("A",), ("B",), ("C",)], "ticker string"),
        sectors=spark.createDataFrame([("A", "1", "1", "XLK", "i", "edgar", t), ("B", "1", None, None, None, "edgar", t)], schemas.SECTORS),
        health=spark.createDataFrame([("s", "open"), ("t", "closed")], schemas.SOURCE_HEALTH),
        coverage=spark.createDataFrame([("10y", d("2014-01-01"), 10, 10, 1.0, t)], schemas.COVERAGE_METRICS),
    )
    assert got["daily_single_source_share"][1] == "warn"
    assert got["daily_quarantined_count"] == (1.0, "warn")
    assert got["sectors_missing_count"] == (2.0, "info")
    assert got["sources_circuit_open"] == (1.0, "warn")
    assert got["delisted_coverage_10y"] == (1.0, "info")


def served(spark, *items):
    return spark.createDataFrame(
        [(t, d(day) if day else None, 1.0, h, lo, c, 1.0) for t, day, h, lo, c in items], schemas.SERVING["daily_ohlcv"]
    )


def test_daily_contract(spark):
    good = served(spark, ("A", "2024-01-01", 2.0, 1.0, 1.0), ("A", "2024-01-02", 2.0, 1.0, 1.0))
    assert contracts.assert_contract("daily_ohlcv", good) == 2
    for bad in (
        good.unionByName(good), served(spark, ("A", None, 2.0, 1.0, 1.0)), served(spark, ("A", "2024-01-01", 2.0, 1.0, None)),
        served(spark, ("A", "2024-01-01", 1.0, 2.0, 1.0)), good.withColumn("close", F.col("close").cast("float")),
        good.withColumnRenamed("close", "last"),
    ):
        with pytest.raises(contracts.ContractViolation):
            contracts.assert_contract("daily_ohlcv", bad)
    # null keys still count as rows of their own
    assert contracts.check_daily(served(spark, (None, None, 2.0, 1.0, 1.0))).first().n_keys == 1


def test_other_contracts(spark):
    delisted = spark.createDataFrame([("A", d("2024-01-01"), "unknown", None)], schemas.SERVING["delisted"])
    assert contracts.assert_contract("delisted", delisted) == 1
    with pytest.raises(contracts.ContractViolation):
        contracts.assert_contract("delisted", delisted.withColumn("termination_reason", F.lit("bored")))
    cov = spark.createDataFrame([("10y", 0.5)], schemas.SERVING["coverage"])
    assert contracts.assert_contract("coverage", cov) == 1
    for bad in (cov.limit(0), cov.withColumn("coverage", F.lit(1.5))):
        with pytest.raises(contracts.ContractViolation):
            contracts.assert_contract("coverage", bad)
    sec = spark.createDataFrame([("A", "XLK", None)], schemas.SERVING["sectors"])
    assert contracts.assert_contract("sectors", sec) == 1
    for bad in (sec.unionByName(sec), sec.withColumn("sector", F.lit(None).cast("string"))):
        with pytest.raises(contracts.ContractViolation):
            contracts.assert_contract("sectors", bad)
    intra = serving.serve_intraday(
        spark.createDataFrame([("A", at("2024-01-01 15:00:00"), 1.0, 2.0, 3.0, "iex_bbo")], schemas.SERVING_INTRADAY)
    )
    assert contracts.assert_contract("intraday", intra) == 1
    for bad in (intra.withColumn("bid", F.lit(3.0)), intra.withColumn("derivation", F.lit("guess")), intra.unionByName(intra)):
        with pytest.raises(contracts.ContractViolation):
            contracts.assert_contract("intraday", bad)


def test_work_lists(spark):
    key = "dataset string, source string, request_key string"
    landed = spark.createDataFrame(
        [("yf_daily", "yfinance", k, "p") for k in ("A:history:2024-01-01", "B:2024-01-01", "B:2024-01-02")] + [("x", "y", "C:history:1", "p")],
        key + ", path string",
    )
    asked = spark.createDataFrame([("yf_daily", "yfinance", "B:2024-01-01"), ("yf_daily", "yfinance", "C:2024-01-01")], key)
    assert rows(worklists.pending_requests(asked, landed), "request_key") == [("C:2024-01-01",)]
    universe = spark.createDataFrame([("A",), ("B",), ("C",)], "ticker string")
    assert rows(worklists.needs_history(universe, landed)) == [("B",), ("C",)]
    assert rows(worklists.landed_for_date(landed, ["yf_daily"], "2024-01-01"), "request_key") == [("A:history:2024-01-01",), ("B:2024-01-01",)]
    marks = worklists.mark_processed(landed.filter("request_key LIKE 'B%'"), now())
    assert rows(worklists.unprocessed(landed, marks, "yf_daily"), "request_key") == [("A:history:2024-01-01",)]
    sec = spark.createDataFrame([("A",)], "ticker string")
    ciks = spark.createDataFrame([("A", 1), ("B", 2)], "ticker string, cik int")
    assert rows(worklists.missing_sectors(universe, sec, ciks)) == [("B", 2)]
    have = spark.createDataFrame([("A", 1)], "k string, v int")
    batch = spark.createDataFrame([("A", 9), ("B", 7), ("B", 3)], "k string, v int")
    assert rows(worklists.first_writer_wins(have, batch, ["k"], ["v"])) == [("B", 3)]
