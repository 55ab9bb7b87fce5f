"""Registered queries of compositions: landed files, sealing, publishing, payload streams.

Each writes what it reads back into the shared folder, from the given tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlake import schemas
from pitlake.operators import adjust, fingerprint, serving
from pitlake.operators.contracts import ContractViolation
from pitlake.plans import fixtures as fx
from pitlake.plans import nightly
from pitlake.plans.catalog import _coverage as coverage_of
from pitlake.plans.catalog import now, query
from pitlake.plans.lake import Lake, publish, read_snapshot
from pitlake.plans.oracle import OHLCV, day, rnd
from pitlake.plans.scratch import scratch, staged
from pitlake.sources import daily, landing, minute
from pitlake.sources import events as event_store
from pitlake.streaming import market


def _landed(df: DataFrame, name: str, dataset: str, kind: str) -> str:
    """A landing root with one file per month of `df` (date, ...), under the month's first day."""
    root = scratch(df.sparkSession, name)
    files = df.withColumns({"source": F.lit("s"), "date": F.trunc("date", "month")}).repartition("date")
    getattr(files.sortWithinPartitions("date").write.partitionBy("date", "source"), kind)(f"{root}/{dataset}")
    return root


def _order_lines(spark, d):
    return fx.table(spark, d, "orders").select(
        F.col("o_orderdate").cast("date").alias("date"), F.concat_ws(",", "o_orderkey", "o_custkey").alias("value")
    )


@query(
    f"""SELECT {day("CAST(date_trunc('month', o_orderdate) AS DATE)", 'partition_date')}, 1 AS n_files,
          sum(strlen(CAST(o_orderkey AS VARCHAR)) + strlen(CAST(o_custkey AS VARCHAR)) + 2)::BIGINT AS n_bytes
        FROM orders GROUP BY 1"""
)
def landed_manifest(spark, d):
    """Manifest of text payloads, one per month."""
    root = _landed(_order_lines(spark, d), "landing", "lines", "text")
    manifest = landing.build_manifest(spark, root, "lines", now())
    return manifest.groupBy("partition_date").agg(
        F.count_distinct("request_key").alias("n_files"), F.sum("n_bytes").alias("n_bytes")
    )


@query(
    f"""SELECT {day("CAST(date_trunc('month', o_orderdate) AS DATE)", 'partition_date')}, count(*) AS n_lines FROM orders
        WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1995-01-01' AND DATE '1995-06-30' GROUP BY 1"""
)
def landed_days(spark, d):
    """Payloads of half a year: the scan opens the folders of those days only."""
    root = _landed(_order_lines(spark, d), "landing", "lines", "text")
    texts = landing.scan_text(spark, root, "lines", ("1995-01-01", "1995-06-30"))
    return texts.select("partition_date", (F.size(F.split("text", "\n")) - 1).cast("long").alias("n_lines"))


@query(
    f"""SELECT {day('bar_date')}, count(*) AS n, round(sum(close), 3) + 0e0 AS close, round(sum(volume), 3) + 0e0 AS volume
        FROM live_bars GROUP BY 1""",
    digits=3,
)
def parse_frame_daily(spark, d):
    """Daily bars as Parquet payloads of a month each."""
    bars = adjust.servable(fx.bars(spark, d))
    frame = bars.select(
        F.col("bar_date").alias("date"), F.col("bar_date").cast("timestamp_ntz").alias("Date_X"),
        *[F.col(c).alias(f"{c.capitalize()}_X") for c in OHLCV],
    )
    root = _landed(frame, "frames", "yf_daily", "parquet")
    parsed = daily.parse_frame_bars(landing.scan_bytes(spark, root, "yf_daily")).good
    return parsed.groupBy("bar_date").agg(
        F.count("*").alias("n"), F.round(F.sum("close"), 3).alias("close"), F.round(F.sum("volume"), 3).alias("volume")
    )


@query(
    f"""SELECT {day('bar_date')}, count(*) AS n, round(sum(close), 3) + 0e0 AS close FROM live_bars GROUP BY 1""",
    digits=3,
)
def parse_frame_minutes(spark, d):
    """The same bars as minute frames stamped at ten, exchange time."""
    bars = adjust.servable(fx.bars(spark, d))
    frame = bars.select(
        F.col("bar_date").alias("date"),
        (F.col("bar_date").cast("timestamp_ntz") + F.expr("INTERVAL '10' HOUR")).alias("Datetime"),
        *[F.col(c).alias(c.capitalize()) for c in OHLCV],
    )
    root = _landed(frame, "frames", "minute_bars", "parquet")
    parsed = minute.parse_frame_minutes(landing.scan_bytes(spark, root, "minute_bars")).good
    at = F.from_utc_timestamp("minute_ts", "America/New_York")
    return parsed.filter(F.date_format(at, "HH:mm") == "10:00").groupBy(at.cast("date").alias("bar_date")).agg(
        F.count("*").alias("n"), F.round(F.sum("close"), 3).alias("close")
    )


@query("SELECT count(DISTINCT date_trunc('month', o_orderdate)) AS n_payloads, count(*) AS n_lines FROM orders")
def stream_payloads(spark, d):
    """Payload files streamed whole, each once, some per micro-batch."""
    root = _landed(_order_lines(spark, d), "landing", "lines", "text")
    stream = market.payload_stream(spark, f"{root}/lines", files_per_batch=30)
    (
        stream.writeStream.format("parquet").option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    )
    return spark.read.schema(stream.schema).parquet(f"{root}/out").agg(
        F.count_distinct("path").alias("n_payloads"),
        F.sum(F.size(F.split("text", "\n")) - 1).cast("long").alias("n_lines"),
    )


@query(
    f"SELECT ticker, {day('bar_date')}, {rnd('close', digits=8)}, grade, single_source FROM screened_latest",
    digits=8, bools=("single_source",),
)
def seal_votes(spark, d):
    """Bar events appended to the store, voted and sealed twice: the second seal changes nothing."""
    lake = Lake(spark, scratch(spark, "seal"))
    rows = fx.bar_events(spark, d).withColumns(
        {
            "event_id": F.uuid(), "vendor_adjusted": F.lit(False), "reversal_factor": F.lit(1.0),
            "landing_key": F.lit("k"),
        }
    )
    event_store.append(lake.events_root, "bar_events", rows.select(*schemas.names(schemas.BAR_EVENTS)))
    nightly.vote_and_seal(lake, now())
    nightly.vote_and_seal(lake, now())
    return lake.read("bars_daily").filter("is_current AND revision_seq = 1").select(
        "ticker", "bar_date", "close", "grade", "single_source"
    )


@query(f"SELECT ticker, {day('effective_date')}, {rnd(*OHLCV, digits=4)} FROM pit", digits=4)
def published_daily(spark, d):
    """The daily serving table after the contract gate, read from the published snapshot."""
    lake = Lake(spark, scratch(spark, "publish"))
    bars = fx.bars(spark, d)
    publish(lake, {"daily_ohlcv": adjust.pit_adjusted(bars, fx.actions(spark, d))}, "2002-01-31", now())
    return read_snapshot(lake, "daily_ohlcv")


@query("SELECT audit_window, round(covered_n / CAST(expected_n AS DOUBLE), 6) + 0e0 AS coverage FROM coverage_rows")
def gate_keeps_snapshot(spark, d):
    """Coverage as published, after a second publish whose coverage breaks the contract has been refused."""
    lake = Lake(spark, scratch(spark, "gate"))
    good = serving.serve_coverage(coverage_of(spark, d))
    publish(lake, {"coverage": good}, "2002-01-31", now())
    try:
        publish(lake, {"coverage": read_snapshot(lake, "coverage").withColumn("coverage", F.lit(2.0))}, "2002-02-01", now())
    except ContractViolation:
        return read_snapshot(lake, "coverage")
    raise AssertionError("a broken snapshot was published")


@query(
    f"""SELECT {day("DATE '2002-01-31'", 'sealed_trade_date')}, 1 AS schema_version, count(*) AS n_windows FROM coverage_rows"""
)
def serving_metadata(spark, d):
    """What a snapshot says of itself, beside the rows it was published with."""
    lake = Lake(spark, scratch(spark, "meta"))
    publish(lake, {"coverage": serving.serve_coverage(coverage_of(spark, d))}, "2002-01-31", now())
    n = read_snapshot(lake, "coverage").agg(F.count("*").alias("n_windows"))
    return read_snapshot(lake, "serving_meta").select("sealed_trade_date", "schema_version", n.scalar().alias("n_windows"))


@query(
    """SELECT 'bars_daily' AS name, (SELECT count(*) FROM screened_latest) AS n_rows, TRUE AS equal
       UNION ALL SELECT 'corporate_actions', (SELECT count(*) FROM actions WHERE is_current), TRUE""",
    bools=("equal",),
)
def rebuild_equals_live(spark, d):
    """Two nights of events, sealed as they came, against a rebuild of the empty tables from all events at once."""
    root = scratch(spark, "rebuild")
    live, again = Lake(spark, f"{root}/live", root), Lake(spark, f"{root}/again", root)
    extra = {"event_id": F.uuid(), "landing_key": F.lit("k")}
    bars = staged(fx.bar_events(spark, d).withColumns({**extra, "vendor_adjusted": F.lit(False), "reversal_factor": F.lit(1.0)}), "events")
    acts = fx.action_events(spark, d).withColumns({**extra, "source": F.lit("polygon")})
    first = F.col("written_at") == fx.ts("2002-01-01")
    for night in (first, ~first):  # the second brings what was revised
        event_store.append(root, "bar_events", bars.filter(night))
        event_store.append(root, "action_events", acts.filter(night))
        nightly.replay_actions(live)
        nightly.vote_and_seal(live, now())
    nightly.replay_actions(again)
    nightly.vote_and_seal(again, now())

    # a revision is known from its detection on, which a rebuild has not seen; all else is the same
    def prints(lake):
        tables = {"bars_daily": fingerprint.BAR_STATE, "corporate_actions": fingerprint.ACTION_STATE}
        each = [
            fingerprint.table_fingerprint(lake.read(n).filter("is_current"), [c for c in kept if c != "knowledge_time"], n)
            for n, kept in tables.items()
        ]
        return each[0].unionByName(each[1])

    return prints(live).withColumnRenamed("digest", "live").join(
        prints(again).withColumnRenamed("digest", "again"), ["table_name", "n_rows"]
    ).select(F.col("table_name").alias("name"), "n_rows", (F.col("live") == F.col("again")).alias("equal"))
