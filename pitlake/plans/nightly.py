"""The night's work as compositions of operators over a lake.

Each step reads committed tables, computes with DataFrames and commits its results; clocks come in as
arguments. `rebuild` runs the same steps on an empty table root over the same events and payloads.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlake import schemas
from pitlake.operators import (
    adjust, deadletters, gaps, history, listings, outliers, parity, quotes, sectors, serving, spreads,
    voting, worklists,
)
from pitlake.plans.lake import Lake, publish
from pitlake.plans.scratch import staged
from pitlake.sources import actions as action_source
from pitlake.sources import daily, edgar, events, landing, minute
from pitlake.sources import parity as parity_source
from pitlake.sources import listings as listing_source
from pitlake.sources.drift import Parsed, drift_letters

SCREENED = ", ".join(
    ["ticker string, bar_date date, open double, high double, low double, close double, volume double",
     "source_set string, grade string, single_source boolean, verdict string, chosen_source string",
     "n_sources int, close_stooq double, close_yfinance double, close_alpaca double",
     "volume_agrees boolean, mad_flag boolean"]
)
PROCESSED = "dataset string, request_key string, processed_at timestamp"
FOLDED = "lot string"
PROJECTED = "name string, version int"
REJECTS = "landing_key string, error_class string, detail string"


def add_letters(lake: Lake, letters: DataFrame) -> None:
    """Append dead letters with fresh ids; a request with an open letter of that class gets no second one."""
    stored = lake.read("dead_letter")
    told = stored.filter("resolved_at IS NULL").select(
        F.col("request_key").alias("_key"), F.col("error_class").alias("_class"), F.col("source").alias("_source")
    )
    letters = letters.join(
        told,
        F.col("request_key").eqNullSafe(F.col("_key")) & F.col("error_class").eqNullSafe(F.col("_class"))
        & F.col("source").eqNullSafe(F.col("_source")),
        "left_anti",
    )
    letters = staged(letters, "letters")
    if letters.isEmpty():
        return
    start = stored.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    ids = F.lit(start + 1) + F.monotonically_increasing_id()
    numbered = letters.withColumn("id", ids).select(*stored.columns)
    lake.write("dead_letter", stored.unionByName(numbered))


def accept(lake: Lake, parsed: Parsed, job_name: str, now: Column) -> DataFrame:
    """Good rows of a parse; its rejects become dead letters."""
    add_letters(lake, drift_letters(parsed.rejects, job_name, now))
    return parsed.good


def build_actions(lake: Lake, payloads: DataFrame, now: Column) -> dict[str, int]:
    """Corporate-action payloads to events and canonical history."""
    parsed = accept(lake, action_source.parse_actions(payloads, now), "build_actions", now)
    batch = events.action_envelope(parsed)
    events.append(lake.events_root, "action_events", batch)
    # several payloads of a night may carry one action: the newest wins
    return lake.merge("corporate_actions", _as_actions(history.latest_actions(batch)), None)


def _as_actions(batch: DataFrame) -> DataFrame:
    return batch.withColumns(
        {"confidence": F.lit("single_source"), "source_set": F.lit("polygon")}
    )


def build_csv_bars(lake: Lake, payloads: DataFrame, now: Column) -> bool:
    """Vendor-adjusted CSV bars, made raw again, to events."""
    rows = accept(lake, daily.parse_csv_bars(payloads), "build_daily_bars", now)
    return _append_adjusted(lake, rows, "stooq", now)


def build_frame_bars(lake: Lake, payloads: DataFrame, now: Column) -> bool:
    """Vendor-adjusted Parquet bars, made raw again, to events."""
    rows = accept(lake, daily.parse_frame_bars(payloads), "build_daily_incrementals", now)
    return _append_adjusted(lake, rows.drop("adj_close"), "yfinance", now)


def build_json_bars(lake: Lake, payloads: DataFrame, now: Column) -> bool:
    """Raw IEX bars to events."""
    rows = accept(lake, daily.parse_json_bars(payloads), "build_daily_incrementals", now)
    return events.append(
        lake.events_root, "bar_events", events.bar_envelope(rows, "alpaca_iex", False, now)
    )


def _append_adjusted(lake: Lake, rows: DataFrame, source: str, now: Column) -> bool:
    raw = adjust.reverse_splits(rows, adjust.current_splits(lake.read("corporate_actions")))
    return events.append(lake.events_root, "bar_events", events.bar_envelope(raw, source, True, now))


def vote_and_seal(lake: Lake, now: Column) -> dict[str, int]:
    """Vote over the latest observations and merge the outcome into canonical history.

    Only event lots that no earlier seal has folded in are read; an empty table root has folded none, so there
    this is the replay. `unchanged` counts every voted key that opened no version.
    """
    folded = lake.read("folded_lots", FOLDED)
    fresh = [r.lot for r in events.lots(lake.spark, lake.events_root, "bar_events").join(folded, "lot", "left_anti").collect()]
    counts = seal_observations(lake, events.scan_lots(lake.spark, lake.events_root, "bar_events", fresh), now)
    mark_folded(lake, fresh)
    return {**counts, "unchanged": lake.read("vote_results").count() - counts["inserted"]}


def mark_folded(lake: Lake, lots: list[str]) -> None:
    if lots:
        lake.write("folded_lots", lake.spark.createDataFrame([(x,) for x in lots], FOLDED), FOLDED)


def seal_observations(lake: Lake, arrived: DataFrame, now: Column) -> dict[str, int]:
    """Fold bar events into the latest observations, vote the tickers they touch again, merge what changed.

    `latest_observations` holds the newest row per (source, ticker, bar_date), stored by bucket of the ticker:
    only the buckets of `arrived` are read and replaced. The screen looks at a ticker's whole history, so tickers
    are the unit of the vote; `beliefs` has what was merged last, so only other outcomes reach the merge, and
    only their months are read there. The same events again change nothing, after a broken run too: beliefs
    are stored after the merge, and a version merged already is a no-op.
    """
    daily_rows = voting.daily_events(arrived).select(*schemas.names(schemas.LATEST_OBSERVATIONS))
    part = events.bucket_of(F.col("ticker"))
    buckets = [str(r.part) for r in daily_rows.select(part.alias("part")).distinct().collect()]
    if not buckets:
        return {"revised": 0, "inserted": 0}
    touched = staged(daily_rows.select("ticker").distinct(), "touched")
    known = lake.read_parts("latest_observations", buckets)
    newest = voting.latest_observation(known.unionByName(daily_rows))
    lake.write_parts("latest_observations", newest, part, buckets)
    observed = lake.read_parts("latest_observations", buckets).join(touched, "ticker", "left_semi")
    # the vote is stored once: history, audit table and dead letters all read it from there
    screened = lake.write("screened", outliers.mad_screen(voting.vote_pivot(voting.source_pivot(observed))), SCREENED)
    beliefs = history.stamp_bars(screened.select(*history.BAR_KEY, *history.BAR_VALUES))
    held = lake.read_parts("beliefs", buckets)
    changed = staged(beliefs.join(held, [*history.BAR_KEY, "payload_hash"], "left_anti"), "changed-beliefs")
    counts = lake.merge("bars_daily", changed, now)

    def replace(name: str, rows: DataFrame) -> None:
        others = lake.read_parts(name, buckets).join(touched, "ticker", "left_anti")
        lake.write_parts(name, others.unionByName(rows.select(*others.columns)), part, buckets)

    replace("beliefs", beliefs)
    replace("vote_results", voting.vote_audit(screened, now))
    add_letters(lake, deadletters.conflict_letters(screened, lake.read("dead_letter"), now))
    return {k: counts[k] for k in ("revised", "inserted")}


def load_snapshots(lake: Lake, payloads: DataFrame, now: Column) -> DataFrame:
    """Directory payloads of (kind, date) pairs not stored yet join the snapshot table."""
    stored = lake.read("universe_snapshots")
    rows = accept(lake, listing_source.parse_directories(payloads), "universe_seal", now)
    fresh = rows.join(
        stored.select("source", "snapshot_date").distinct(), ["source", "snapshot_date"], "left_anti"
    )
    added = worklists.first_writer_wins(
        stored, fresh, ["source", "snapshot_date", "ticker"], ["landing_key"]
    )
    return lake.write("universe_snapshots", added)


def universe_seal(
    lake: Lake, directories: DataFrame, delisted: DataFrame, trade_date: str, now: Column
) -> None:
    """Snapshots to graveyard, terminal returns and coverage."""
    snapshots = load_snapshots(lake, directories, now)
    newest = listing_source.newest_payload(delisted)
    vendor = accept(lake, listing_source.parse_delisted(newest), "universe_seal", now)
    bars = lake.read("bars_daily")
    grave = lake.write(
        "graveyard", listings.graveyard(snapshots, vendor, bars, lake.read("graveyard"), now)
    )
    lake.write("coverage_metrics", listings.coverage(grave, bars, snapshots, trade_date, now))


def intraday_seal(
    lake: Lake, minute_payloads: DataFrame, quote_fragments: DataFrame, sessions: DataFrame,
    now: Column,
) -> None:
    """New minute and quote payloads to stored bars, then the whole hybrid frame again.

    minute_payloads carry (dataset, request_key, landing_key, ticker, content); quote_fragments the
    record fragments with request_key `ticker:session_date`. Each payload is processed once.
    """
    marks = lake.read("intraday_processed", PROCESSED)
    done = ["dataset", "request_key"]
    new_minutes = minute_payloads.join(marks, done, "left_anti")
    new_quotes = quote_fragments.join(marks, done, "left_anti")

    minute_parsed = minute.parse_frame_minutes(new_minutes)
    bars = accept(lake, minute_parsed, "intraday_seal", now).withColumns(
        {"source": F.lit("yfinance"), "knowledge_time": F.col("minute_ts")}
    )
    lake.write(
        "bars_minute",
        worklists.first_writer_wins(
            lake.read("bars_minute"), bars, ["ticker", "minute_ts"], ["landing_key"]
        ),
    )

    # verdicts are stored so the ticks are read just twice: once to judge, once to use
    rejects = lake.write("quote_rejects", minute.quote_rejects(new_quotes), REJECTS)
    add_letters(lake, drift_letters(rejects, "intraday_seal", now))
    ticks = minute.quote_rows(new_quotes, rejects).withColumn(
        "session_date", F.substring_index("landing_key", ":", -1).try_cast("date")
    )
    quoted = quotes.session_quote_bars(ticks, sessions, 60).withColumn("knowledge_time", F.col("minute_ts"))
    # payloads of a name land session by session: of two bars for a minute the earlier session's stands
    lake.write(
        "quote_bars_1m",
        worklists.first_writer_wins(
            lake.read("quote_bars_1m"), quoted, ["ticker", "minute_ts"], ["session_date"]
        ),
    )
    # a rejected payload stays unmarked: a later parser gets to see it again
    bad = rejects.select("landing_key").unionByName(minute_parsed.rejects.select("landing_key"))
    seen = (
        new_minutes.select(*done, "landing_key").unionByName(new_quotes.select(*done, "landing_key")).distinct()
        .join(bad, "landing_key", "left_anti").select(*done)
    )
    lake.write("intraday_processed", worklists.mark_processed(seen, now), PROCESSED)
    project_intraday(lake)


def project_intraday(lake: Lake) -> list[str]:
    """Bring `serving_intraday` up to date: only sessions whose inputs changed since the last time are projected.

    These are the exchange dates of minutes and quotes in versions not projected yet, and of daily spreads that
    differ from those used then. A late quote, minute or revised bar so replaces its own sessions.
    """
    day = F.from_utc_timestamp("minute_ts", "America/New_York").cast("date")
    spreads_now = spreads.corwin_schultz(spreads.spread_inputs(lake.read("bars_daily")))
    used = lake.read("cs_spreads")
    changed = spreads_now.select("ticker", "bar_date", "cs_spread").exceptAll(used).unionByName(
        used.exceptAll(spreads_now.select("ticker", "bar_date", "cs_spread"))
    )
    done = lake.read("projected_versions", PROJECTED).groupBy("name").agg(F.max("version").alias("version"))
    since = {r.name: r.version for r in done.collect()}
    upto = {name: lake.version(name) for name in ("bars_minute", "quote_bars_1m")}
    arrived = [lake.added(name, since.get(name, 0)).select(day.alias("day")) for name in upto]
    # dates come to the driver: at most the calendar's
    dates = sorted({r.day for r in arrived[0].unionByName(arrived[1]).unionByName(
        changed.select(F.col("bar_date").alias("day"))
    ).distinct().collect() if r.day is not None})
    if dates:
        start, end = (F.to_utc_timestamp(F.lit(x).cast("timestamp_ntz"), "America/New_York") for x in (dates[0], dates[-1] + timedelta(days=1)))
        # the span as literals reaches the scans; which of its days are meant is decided per row
        within = (F.col("minute_ts") >= start) & (F.col("minute_ts") < end) & day.isin(dates)
        hybrid = spreads.hybrid_intraday(
            lake.read("bars_minute").filter(within), lake.read("quote_bars_1m").filter(within), spreads_now
        )
        lake.write_parts("serving_intraday", hybrid, day, [x.isoformat() for x in dates])
    lake.write("cs_spreads", spreads_now) if dates else None
    lake.write("projected_versions", lake.spark.createDataFrame(list(upto.items()), PROJECTED), PROJECTED)
    return [x.isoformat() for x in dates]


def sector_seal(lake: Lake, submissions: DataFrame, now: Column) -> None:
    """Filings of tickers without a sector row join the sector table."""
    known = lake.read("sectors")
    rows = accept(lake, edgar.parse_submissions(submissions), "sector_seal", now)
    lake.write("sectors", sectors.sector_projection(rows, known, now))


def parity_seal(lake: Lake, payloads: DataFrame, trade_date: str, now: Column) -> dict[str, int]:
    """Score the trade date's sample of bars against the vendor's aggregates of them, in place of an earlier try.

    A sampled bar without a payload that parsed is not scored; an aggregate without results is a breach.
    """
    theirs = accept(lake, parity_source.parse_parity(payloads), "parity_sample", now)
    sample = parity.parity_sample(lake.read("bars_daily"), trade_date)
    scored = parity.parity_scores(sample.join(theirs, ["ticker", "bar_date"], "left_semi"), theirs, trade_date)
    stored = lake.write("parity_scores", parity.replace_sample(lake.read("parity_scores"), scored, trade_date))
    counts = stored.filter(F.col("sample_date") == F.lit(trade_date).cast("date")).agg(
        F.count_distinct("ticker", "bar_date").alias("bars_checked"), F.count_if(~F.col("within_tol")).alias("field_breaches")
    )
    return counts.first().asDict()


def build_night(lake: Lake, root: str, manifest: DataFrame, trade_date: str, now: Column) -> DataFrame:
    """Everything that landed for a trade date, from the manifest's queue, to events; rejects to dead letters.

    The queue's dates name the folders that are opened, the manifest the keys. What the manifest and the folders
    disagree on becomes a letter too. Returns the queue.
    """
    spark = lake.spark
    builders = {
        "polygon_splits": build_actions, "polygon_dividends": build_actions, "stooq_daily": build_csv_bars,
        "yf_daily": build_frame_bars, "alpaca_daily": build_json_bars,
    }
    # actions first: vendor bars are made raw again by current splits
    queue = staged(worklists.landed_for_date(manifest, list(builders), trade_date, landing.QUEUE), "queue")
    present = {r.dataset for r in queue.select("dataset").distinct().collect()}
    for dataset in [x for x in builders if x in present]:
        add_letters(lake, drift_letters(landing.queue_rejects(spark, root, queue, dataset, manifest), "build_night", now))
        scan = landing.queued_bytes if dataset == "yf_daily" else landing.queued_text
        builders[dataset](lake, scan(spark, root, queue, dataset), now)
    return queue


def seal_intraday_night(
    lake: Lake, root: str, manifest: DataFrame, sessions: DataFrame, now: Column,
) -> None:
    """`intraday_seal` over the payloads that the manifest has and no earlier seal has processed."""
    marks = lake.read("intraday_processed", PROCESSED)

    def queue(dataset: str) -> DataFrame:
        return worklists.unprocessed(manifest, marks, dataset, landing.QUEUE)

    intraday_seal(
        lake, landing.queued_bytes(lake.spark, root, queue("minute_bars"), "minute_bars"),
        landing.queued_records(lake.spark, root, queue("quote_ticks"), "quote_ticks"), sessions, now,
    )


def gap_ledger_seal(lake: Lake, universe: DataFrame, now: Column) -> None:
    metrics = gaps.gap_metrics(
        lake.read("serving_intraday"), lake.read("bars_daily"), lake.read("coverage_metrics"),
        lake.read("graveyard"), universe, lake.read("sectors"), lake.read("parity_scores"),
        lake.read("source_health"),
    )
    lake.write("gap_ledger", gaps.gap_ledger(metrics, now))


FACTOR_STEPS = "ticker string, step_from date, step_to date, log_all double, log_split double"


def serving_tables(lake: Lake) -> dict[str, DataFrame]:
    """The frozen serving shapes.

    Factor intervals are stored first, so the planner knows their true size when it decides whether
    bars must move to meet them.
    """
    bars = lake.read("bars_daily")
    steps = lake.write(
        "factor_steps",
        adjust.cumulative_factors(adjust.adjustment_factors(bars, lake.read("corporate_actions"))),
        FACTOR_STEPS,
    )
    return {
        "daily_ohlcv": adjust.adjust_with(bars, steps),
        "delisted": serving.serve_delisted(lake.read("graveyard")),
        "coverage": serving.serve_coverage(lake.read("coverage_metrics")),
        "intraday": serving.serve_intraday(lake.read("serving_intraday")),
        "sectors": serving.serve_sectors(lake.read("sectors")),
        "gap_ledger": lake.read("gap_ledger"),
    }


def publish_night(lake: Lake, trade_date: str, now: Column) -> dict[str, int]:
    return publish(lake, serving_tables(lake), trade_date, now)


def replay_actions(lake: Lake) -> dict[str, int]:
    """Latest action observations into an empty or earlier history."""
    seen = events.scan(lake.spark, lake.events_root, "action_events")
    return lake.merge("corporate_actions", _as_actions(history.latest_actions(seen)), None)


def rebuild(
    lake: Lake, *, directories: DataFrame, delisted: DataFrame, minute_payloads: DataFrame,
    quote_fragments: DataFrame, sessions: DataFrame, submissions: DataFrame, universe: DataFrame,
    trade_date: str, now: Column, parity: DataFrame | None = None,
) -> dict[str, int]:
    """Replay events and payloads into `lake`, whose table root must be empty.

    Parity scores are a record, not a projection: pass the old ones to keep them.
    """
    if lake.version("bars_daily") or lake.version("corporate_actions"):
        raise ValueError("rebuild needs an empty table root")
    if parity is not None:
        lake.write("parity_scores", parity)
    replay_actions(lake)
    counts = vote_and_seal(lake, now)
    universe_seal(lake, directories, delisted, trade_date, now)
    intraday_seal(lake, minute_payloads, quote_fragments, sessions, now)
    sector_seal(lake, submissions, now)
    gap_ledger_seal(lake, universe, now)
    publish_night(lake, trade_date, now)
    return counts


