"""Stored tables and frozen serving shapes, as DDL strings Spark parses."""

from __future__ import annotations

from pyspark.sql.types import StructType

BAR_EVENTS = (
    "event_id string, source string, ticker string, interval string, bar_date date, "
    "open double, high double, low double, close double, volume double, "
    "vendor_adjusted boolean, reversal_factor double, knowledge_time timestamp, "
    "written_at timestamp, payload_hash string, landing_key string"
)
ACTION_EVENTS = (
    "event_id string, source string, ticker string, action_type string, ex_date date, "
    "ratio double, cash_amount double, declared_date date, knowledge_time timestamp, "
    "written_at timestamp, payload_hash string, landing_key string"
)
HISTORY_COLUMNS = (
    "payload_hash string, knowledge_time timestamp, valid_from timestamp, "
    "valid_to timestamp, is_current boolean, revision_seq int"
)
BARS_DAILY = (
    "ticker string, bar_date date, open double, high double, low double, close double, "
    "volume double, source_set string, grade string, single_source boolean, " + HISTORY_COLUMNS
)
CORPORATE_ACTIONS = (
    "ticker string, action_type string, ex_date date, ratio double, cash_amount double, "
    "declared_date date, confidence string, source_set string, " + HISTORY_COLUMNS
)
VOTE_RESULTS = (
    "ticker string, bar_date date, verdict string, n_sources int, chosen_source string, "
    "close_stooq double, close_yfinance double, close_alpaca double, volume_agrees boolean, "
    "mad_flag boolean, voted_at timestamp"
)
UNIVERSE_SNAPSHOTS = (
    "source string, snapshot_date date, ticker string, security_name string, exchange string, "
    "is_etf boolean"
)
GRAVEYARD = (
    "ticker string, termination_date date, termination_reason string, reason_confidence string, "
    "reason_source string, terminal_return double, detection_source string, first_seen timestamp"
)
COVERAGE_METRICS = (
    "audit_window string, window_start date, expected_n int, covered_n int, coverage double, "
    "computed_at timestamp"
)
BARS_MINUTE = (
    "ticker string, minute_ts timestamp, open double, high double, low double, close double, "
    "volume double, source string, knowledge_time timestamp"
)
QUOTE_BARS = (
    "ticker string, minute_ts timestamp, bid_close double, ask_close double, bid_twm double, "
    "ask_twm double, n_quotes int, knowledge_time timestamp"
)
SERVING_INTRADAY = (
    "ticker string, minute_ts timestamp, bid double, ask double, volume double, derivation string"
)
PARITY_SCORES = (
    "sample_date date, ticker string, bar_date date, field string, ours double, theirs double, "
    "rel_diff double, within_tol boolean"
)
SECTORS = (
    "ticker string, cik string, sic string, sector string, industry string, source string, "
    "updated_at timestamp"
)
GAP_LEDGER = (
    "gap_key string, description string, metric double, unit string, severity string, "
    "updated_at timestamp"
)
LANDING_MANIFEST = (
    "dataset string, source string, request_key string, payload_hash string, path string, "
    "content_type string, n_bytes bigint, partition_date date, knowledge_time timestamp, "
    "written_at timestamp"
)
DEAD_LETTER = (
    "id bigint, job_name string, source string, request_key string, payload_path string, "
    "error_class string, detail string, first_seen timestamp, retry_count int, "
    "resolved_at timestamp"
)
MARKET_SESSIONS = (
    "exchange string, session_date date, open_utc timestamp, close_utc timestamp, "
    "is_half_day boolean"
)
SOURCE_HEALTH = "source string, state string"

# Maintained by the incremental vote, by bucket of the ticker.
LATEST_OBSERVATIONS = (
    "source string, ticker string, interval string, bar_date date, open double, high double, low double, "
    "close double, volume double, knowledge_time timestamp, written_at timestamp, payload_hash string"
)
BELIEFS = "ticker string, bar_date date, payload_hash string"
CS_SPREADS = "ticker string, bar_date date, cs_spread double"

EVENT_TABLES = {"bar_events": BAR_EVENTS, "action_events": ACTION_EVENTS}
CANONICAL_TABLES = {
    "bars_daily": BARS_DAILY,
    "corporate_actions": CORPORATE_ACTIONS,
    "vote_results": VOTE_RESULTS,
    "universe_snapshots": UNIVERSE_SNAPSHOTS,
    "graveyard": GRAVEYARD,
    "coverage_metrics": COVERAGE_METRICS,
    "bars_minute": BARS_MINUTE,
    "quote_bars_1m": QUOTE_BARS,
    "serving_intraday": SERVING_INTRADAY,
    "parity_scores": PARITY_SCORES,
    "sectors": SECTORS,
    "gap_ledger": GAP_LEDGER,
    "landing_manifest": LANDING_MANIFEST,
    "dead_letter": DEAD_LETTER,
    "market_sessions": MARKET_SESSIONS,
    "source_health": SOURCE_HEALTH,
    "latest_observations": LATEST_OBSERVATIONS,
    "beliefs": BELIEFS,
    "cs_spreads": CS_SPREADS,
}

# Frozen serving shapes: additive-only, never renamed or retyped.
SERVING = {
    "daily_ohlcv": (
        "ticker string, effective_date date, open double, high double, low double, "
        "close double, volume double"
    ),
    "delisted": (
        "ticker string, termination_date date, termination_reason string, terminal_return double"
    ),
    "coverage": "audit_window string, coverage double",
    "sectors": "ticker string, sector string, industry string",
    "intraday": (
        "ticker string, minute timestamp_ntz, bid double, ask double, volume double, "
        "derivation string"
    ),
}


def struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def names(ddl: str) -> list[str]:
    return struct(ddl).fieldNames()


def empty(spark, ddl: str):
    """A typed empty frame: what every operator gives for empty input."""
    return spark.createDataFrame([], struct(ddl))
