"""The batch operators run incrementally.

A stream reads each landed payload or tick once. Where a bucket's result depends on later ticks, or a
key's on its whole history, a micro-batch recomputes the buckets or keys it touched with the batch
operator, so stream and batch agree by construction.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from pitlake import schemas
from pitlake.operators import worklists
from pitlake.operators.quotes import bucket_of, session_quote_bars, two_sided
from pitlake.plans import nightly
from pitlake.plans.lake import Lake
from pitlake.sources import events


def payload_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """New payload files, each whole and exactly once (the checkpoint remembers them)."""
    return (
        spark.readStream.format("text")
        .option("wholetext", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(path)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    )


def parquet_stream(
    spark: SparkSession, path: str, ddl: str, files_per_batch: int = 1000
) -> DataFrame:
    """New Parquet files of a known schema."""
    return (
        spark.readStream.schema(schemas.struct(ddl))
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def minute_buckets(ticks: DataFrame, delay: str = "10 minutes", width: str = "1 minute") -> DataFrame:
    """Last bid/ask and quote count per bucket, emitted once the watermark has passed it.

    ticks: (ticker, ts, pos, bid, ask). State is one row per open (ticker, bucket).
    """
    order = F.struct("ts", "pos")
    return (
        two_sided(ticks)
        .withWatermark("ts", delay)
        .groupBy("ticker", F.window("ts", width).alias("w"))
        .agg(
            F.max_by("bid", order).alias("bid_close"),
            F.max_by("ask", order).alias("ask_close"),
            F.count("*").cast("int").alias("n_quotes"),
        )
        .select("ticker", F.col("w.start").alias("minute_ts"), "bid_close", "ask_close", "n_quotes")
    )


def first_minutes(minutes: DataFrame, delay: str = "1 day") -> DataFrame:
    """First writer wins per (ticker, minute) among rows the watermark still admits."""
    return minutes.withWatermark("minute_ts", delay).dropDuplicatesWithinWatermark(
        ["ticker", "minute_ts"]
    )


def vote_touched(lake: Lake) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` body: store bar events, then re-vote the tickers of the batch and merge.

    The batch's buckets, as literals, limit what is read of the event store (to see which events it has) and
    of the latest observations. Re-running a batch changes nothing: its lot is named by the batch id, events
    already stored are skipped, and folding the same observations in again is a no-op.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark, root = batch.sparkSession, lake.events_root
        brought = batch.agg(
            F.collect_set(events.bucket_of(F.col("ticker"))).alias("buckets"), F.max("written_at").alias("detected")
        ).first()
        if brought.detected is None:
            return
        stored = events.scan(spark, root, "bar_events", brought.buckets)
        identity = ["source", "ticker", "bar_date", "interval", "written_at", "payload_hash"]
        lot = f"stream-{batch_id}"
        # a lot of this name is from an earlier try of the batch: it stays as it is
        if events.lots(spark, root, "bar_events").filter(F.col("lot") == lot).isEmpty():
            events.append(root, "bar_events", batch.join(stored.select(*identity), identity, "left_anti"), lot)
        # detection time: the newest write among what the batch brought
        nightly.seal_observations(lake, batch, F.lit(brought.detected))
        nightly.mark_folded(lake, [lot])

    return run


TICKS = "ticker string, session_date date, ts timestamp, pos bigint, bid double, ask double"
LIVE_BARS = schemas.QUOTE_BARS + ", session_date date"


def _store_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Rows under (session_date, batch): a retried batch replaces its own folders and no others."""
    rows.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "session_date", "batch"
    ).parquet(path)


def stored_batches(spark: SparkSession, path: str, ddl: str, dates: Sequence[date] | None = None) -> DataFrame:
    """What `_store_batch` has kept, of the sessions named if any, with the batch that brought it."""
    rows = spark.read.schema(schemas.struct(ddl + ", batch bigint")).parquet(path)
    return rows if dates is None else rows.filter(F.col("session_date").isin(list(dates)))


def weighted_touched(
    lake: Lake, sessions: DataFrame, bucket_seconds: int = 60
) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` body keeping time-weighted quote bars (`live_quote_bars`) right.

    A tick changes its own bucket and, as a session's new last quote, the bucket that was last before.
    Only those buckets are recomputed from the stored ticks. Ticks and bars lie by session: the sessions of a
    batch (at most the calendar's) are literals, so no other session is read, and only theirs are replaced.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        path = f"{lake.root}/ticks"
        _store_batch(batch.select(*schemas.names(TICKS)), path, batch_id)
        dates = [r.session_date for r in batch.select("session_date").distinct().collect() if r.session_date is not None]
        if not dates:
            return
        parts = [x.isoformat() for x in dates]
        minute = bucket_of(F.col("ts"), bucket_seconds)
        ticks = stored_batches(batch.sparkSession, path, TICKS, dates).withColumn("minute_ts", minute)
        bucket = ["ticker", "session_date", "minute_ts"]
        name = bucket[:2]
        stored = lake.read_parts("live_quote_bars", parts, LIVE_BARS)
        arrived = batch.withColumn("minute_ts", minute).select(*bucket)
        was_last = (
            stored.join(arrived, name, "left_semi").groupBy(*name).agg(F.max("minute_ts").alias("minute_ts"))
        )
        touched = arrived.unionByName(was_last.select(*bucket)).distinct()
        bars = session_quote_bars(
            ticks.join(touched, bucket, "left_semi"), sessions, bucket_seconds
        ).withColumn("knowledge_time", F.col("minute_ts"))
        kept = stored.join(touched, bucket, "left_anti")
        lake.write_parts(
            "live_quote_bars", kept.unionByName(bars.select(*kept.columns)), F.col("session_date"), parts, LIVE_BARS
        )

    return run


BUCKET_PARTIALS = (
    "ticker string, minute_ts timestamp, last_ts timestamp, last_pos bigint, bid_close double, ask_close double, "
    "n_quotes bigint, session_date date"
)


def bucket_partials(lake: Lake, name: str = "bucket_partials", width: str = "1 minute") -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` body: what each batch says about each bucket, beside what earlier batches said.

    No watermark and so no tick that is too late: `merged_buckets` puts the batches' partial results
    together, whatever order the ticks came in, for buckets that are still open too. Each batch
    writes as many rows as it touches buckets, and replaces them when it is retried.
    """
    order = F.struct("ts", "pos")

    def run(batch: DataFrame, batch_id: int) -> None:
        partial = (
            two_sided(batch).groupBy("ticker", F.window("ts", width)["start"].alias("minute_ts")).agg(
                F.max_by(F.struct("ts", "pos", "bid", "ask"), order).alias("last"), F.count("*").alias("n_quotes")
            )
        )
        _store_batch(partial.select(
            "ticker", "minute_ts", F.col("last.ts").alias("last_ts"), F.col("last.pos").alias("last_pos"),
            F.col("last.bid").alias("bid_close"), F.col("last.ask").alias("ask_close"), "n_quotes",
            F.to_date("minute_ts").alias("session_date"),
        ), f"{lake.root}/{name}", batch_id)

    return run


def merged_buckets(lake: Lake, name: str = "bucket_partials", dates: Sequence[date] | None = None) -> DataFrame:
    """Last bid/ask and quote count per bucket from all that came so far: the batch operator's answer."""
    order = F.struct("last_ts", "last_pos")
    return stored_batches(lake.spark, f"{lake.root}/{name}", BUCKET_PARTIALS, dates).groupBy("ticker", "minute_ts").agg(
        F.max_by("bid_close", order).alias("bid_close"), F.max_by("ask_close", order).alias("ask_close"),
        F.sum("n_quotes").cast("int").alias("n_quotes"),
    )


def minute_partials(lake: Lake, order: Sequence[str], name: str = "minute_partials") -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` body for minute bars of which the first to come counts, however late.

    Within a batch the first under `order` (landing order) is kept, across batches the earliest batch's.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        row = F.struct(*batch.columns)
        first = batch.groupBy("ticker", "minute_ts").agg(F.min_by(row, F.struct(*order)).alias("row")).select("row.*")
        _store_batch(first.withColumn("session_date", F.to_date("minute_ts")), f"{lake.root}/{name}", batch_id)

    return run


def merged_minutes(lake: Lake, ddl: str, name: str = "minute_partials", dates: Sequence[date] | None = None) -> DataFrame:
    """The first writer's row per (ticker, minute) of all that came so far."""
    rows = stored_batches(lake.spark, f"{lake.root}/{name}", ddl + ", session_date date", dates)
    return rows.groupBy("ticker", "minute_ts").agg(
        F.min_by(F.struct(*schemas.names(ddl)), "batch").alias("row")
    ).select("row.*")


def append_minutes(lake: Lake) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` body: first-writer-wins append to the stored minute bars."""

    def run(batch: DataFrame, batch_id: int) -> None:
        stored = lake.read("bars_minute")
        fresh = worklists.first_writer_wins(stored, batch, ["ticker", "minute_ts"], ["knowledge_time"])
        lake.write("bars_minute", fresh)

    return run


def start_each_batch(
    stream: DataFrame, run: Callable[[DataFrame, int], None], checkpoint: str
) -> DataStreamWriter:
    """A writer for `run`, to be started by the caller with the trigger it wants."""
    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
