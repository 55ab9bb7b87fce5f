from __future__ import annotations

from pyspark.sql import functions as F

from conftest import at, d, rows
from pitlake import schemas
from pitlake.operators import listings

D1, D2, D3, D4 = "2024-07-01", "2024-07-02", "2024-07-03", "2024-07-06"
BOTH = ("nasdaqlisted", "otherlisted")
NOW = "2024-08-01 00:00:00"


def now():
    return F.lit(NOW).cast("timestamp")


def snaps(spark, *items):
    """(date, sources, tickers): every listed ticker appears in the first source."""
    data = []
    for day, sources, tickers in items:
        data += [(sources[0], d(day), t) for t in tickers]
        data += [(s, d(day), "OTHER") for s in sources[1:]]
    return spark.createDataFrame(data, "source string, snapshot_date date, ticker string")


def bars(spark, *items):
    return spark.createDataFrame(
        [(t, d(day), c, grade, True) for t, day, c, grade in items],
        "ticker string, bar_date date, close double, grade string, is_current boolean",
    )


def test_gone_relisted_and_half_snapshots(spark):
    gone = snaps(spark, (D1, BOTH, ["KEEP", "DOOMD"]), (D2, BOTH, ["KEEP"]))
    assert rows(listings.disappearances(gone)) == [("DOOMD", d(D2))]
    back = gone.unionByName(snaps(spark, (D3, BOTH, ["KEEP", "DOOMD"])))
    assert rows(listings.disappearances(back)) == []
    half = snaps(spark, (D1, BOTH, ["KEEP", "DOOMD"]), (D2, BOTH[:1], ["KEEP"]))
    assert rows(listings.disappearances(half)) == []
    assert rows(listings.complete_dates(half)) == [(d(D1),)]


def test_a_gap_of_nights_is_one_step(spark):
    s = snaps(spark, (D1, BOTH, ["A", "B"]), (D2, BOTH[:1], ["A"]), (D4, BOTH, ["A"]))
    assert rows(listings.disappearances(s)) == [("B", d(D4))]


def test_vendor_date_wins_and_first_row_counts(spark):
    vendor = spark.createDataFrame(
        [("X", d(D1), 0), ("X", d(D3), 1)], "ticker string, termination_date date, position int"
    )
    diff = spark.createDataFrame([("X", d(D4)), ("Y", d(D4))], "ticker string, termination_date date")
    assert rows(listings.union_by_authority(vendor, diff)) == [
        ("X", d(D1), "polygon"), ("Y", d(D4), "symbol_dirs_diff"),
    ]


def test_terminal_return(spark):
    grave = spark.createDataFrame(
        [(t, d(D3)) for t in ("DROP", "ONE", "NONE", "LATE")], "ticker string, termination_date date"
    )
    b = bars(
        spark, ("DROP", D1, 10.0, "good"), ("DROP", D2, 8.0, "good"), ("DROP", D4, 1.0, "good"),
        ("ONE", D1, 5.0, "good"), ("LATE", D1, 10.0, "good"), ("LATE", D2, 99.0, "quarantined"),
        ("LATE", D3, 5.0, "good"), ("ELSE", D1, 1.0, "good"),
    )
    got = dict((r[0], r[2]) for r in rows(listings.terminal_returns(grave, b)))
    assert round(got.pop("DROP"), 9) == -0.2
    assert got == {"ONE": None, "NONE": None, "LATE": -0.5}


def test_first_seen_is_stable(spark):
    grave = spark.createDataFrame([("A", d(D1)), ("B", d(D1))], "ticker string, termination_date date")
    before = spark.createDataFrame(
        [("A", d(D1), at("2020-01-01 00:00:00")), ("B", d(D2), at("2020-01-01 00:00:00"))],
        "ticker string, termination_date date, first_seen timestamp",
    )
    assert rows(listings.with_first_seen(grave, before, now()), "ticker", "first_seen") == [
        ("A", at("2020-01-01 00:00:00")), ("B", at(NOW)),
    ]


def test_coverage_windows(spark):
    grave = spark.createDataFrame(
        [("A", d("2024-07-05")), ("B", d("2024-07-05")), ("C", d("2020-01-01")), ("D", d("1990-01-01"))],
        "ticker string, termination_date date",
    )
    s = snaps(spark, (D1, BOTH, ["A"]))
    b = bars(spark, ("A", D1, 1.0, "quarantined"), ("C", D1, 1.0, "good"), ("C", D2, 1.0, "good"))
    got = rows(listings.coverage(grave, b, s, "2024-07-31", now()), "audit_window", "window_start", "expected_n", "covered_n", F.round("coverage", 6))
    assert got == [
        ("10y", d("2014-07-31"), 3, 2, round(2 / 3, 6)), ("since_golive", d(D1), 2, 1, 0.5),
    ]


def test_coverage_of_nothing_passes(spark):
    got = rows(
        listings.coverage(
            spark.createDataFrame([], "ticker string, termination_date date"),
            spark.createDataFrame([], "ticker string, bar_date date, is_current boolean"),
            spark.createDataFrame([], "source string, snapshot_date date, ticker string"), "2024-07-31", now(),
        ),
        "audit_window", "window_start", "expected_n", "coverage",
    )
    assert got == [("10y", d("2014-07-31"), 0, 1.0), ("since_golive", d("2024-07-31"), 0, 1.0)]


def test_empty_inputs_give_typed_empty_frames(spark):
    none = spark.createDataFrame([], "source string, snapshot_date date, ticker string")
    grave = listings.graveyard(
        none, spark.createDataFrame([], "ticker string, termination_date date"),
        schemas.empty(spark, schemas.BARS_DAILY), schemas.empty(spark, schemas.GRAVEYARD), now(),
    )
    assert grave.count() == 0
    assert grave.columns == schemas.names(schemas.GRAVEYARD)
