"""Registered queries: each operator over tables derived from the given ones.

`QUERIES` maps a name to a callable (spark, sf_dir) -> DataFrame, `ORACLES` to the SQL another engine
runs on the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlake import schemas
from pitlake.functions.hashing import with_action_hash, with_bar_hash
from pitlake.operators import (
    adjust, contracts, deadletters, fingerprint, gaps, history, listings, outliers, parity, quotes,
    sectors, serving, sessions, spreads, voting, worklists,
)
from pitlake.plans import fixtures as fx
from pitlake.plans.oracle import OHLCV, VOTE_OUT, as_text, day, rnd, us, with_ctes
from pitlake.plans.lake import Lake
from pitlake.plans.present import present
from pitlake.plans.scratch import scratch, staged
from pitlake.sources import actions, daily, edgar, minute
from pitlake.sources import events as event_store
from pitlake.sources import listings as listing_source
from pitlake.streaming import market

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}



def now():
    return fx.ts("2002-02-01")


def query(
    sql: str | None = None, digits: int = 6, bools: tuple[str, ...] = (), stamps: tuple[str, ...] = (),
):
    """Register a query under its function name, with its oracle when it has one.

    `bools` and `stamps` name the flag and instant columns, compared as text.
    """

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = lambda spark, sf_dir: present(fn(spark, sf_dir), digits)
        if sql is not None:
            ORACLES[fn.__name__] = with_ctes(as_text(sql, bools, stamps))
        return fn

    return register


# --- point-in-time adjustment ---------------------------------------------------------------


@query(
    f"SELECT ticker, {day('effective_date')}, {rnd(*OHLCV, digits=4)} FROM pit", digits=4
)
def pit_adjusted_daily(spark, d):
    return adjust.pit_adjusted(fx.bars(spark, d), fx.actions(spark, d))


@query(
    f"SELECT ticker, {day('ex_date')}, factor_type, {rnd('factor')}, {day('known', 'known_date')} FROM factors"
)
def adjustment_factors(spark, d):
    factors = adjust.adjustment_factors(fx.bars(spark, d), fx.actions(spark, d))
    known = adjust.exchange_date("knowledge_time").alias("known_date")
    return factors.select("ticker", "ex_date", "factor_type", "factor", known)


@query(f"SELECT ticker, {day('ex_date')}, {rnd('prior_close')} FROM priors")
def prior_close_asof(spark, d):
    dividends = fx.actions(spark, d).filter("action_type = 'dividend'")
    return adjust.prior_close(fx.bars(spark, d), dividends)


@query(
    f"SELECT ticker, {day('bar_date')}, {rnd('open * f', digits=4).replace('AS open * f', 'AS open')}, "
    "round(high * f, 4) + 0e0 AS high, round(low * f, 4) + 0e0 AS low, "
    "round(close * f, 4) + 0e0 AS close, round(volume / f, 4) + 0e0 AS volume, "
    "round(f, 4) + 0e0 AS reversal_factor FROM reversal",
    digits=4,
)
def split_reversal(spark, d):
    current = fx.bars(spark, d).filter("is_current").select("ticker", "bar_date", *OHLCV)
    return adjust.reverse_splits(current, adjust.current_splits(fx.actions(spark, d)))


@query(
    f"SELECT ticker, {day('bar_date')}, round(open / f, 3) + 0e0 AS open, round(high / f, 3) + 0e0 AS high, "
    "round(low / f, 3) + 0e0 AS low, round(close / f, 3) + 0e0 AS close, "
    "round(volume * f, 3) + 0e0 AS volume FROM reversal",
    digits=3,
)
def split_apply(spark, d):
    current = fx.bars(spark, d).filter("is_current").select("ticker", "bar_date", *OHLCV)
    return adjust.apply_splits(current, adjust.current_splits(fx.actions(spark, d)))


@query(f"SELECT ticker, {day('ex_date')}, {rnd('ratio')} FROM split_rows WHERE is_current AND ratio > 0")
def current_splits(spark, d):
    return adjust.current_splits(fx.actions(spark, d))


@query(
    f"""SELECT r.ticker, {day('r.bar_date')}, round(raw_close, 4) + 0e0 AS raw_close,
          round(coalesce(exp(sum(ln(factor)) FILTER (WHERE hit)), 1e0), 4) + 0e0 AS cum_factor,
          round(raw_close * coalesce(exp(sum(ln(factor)) FILTER (WHERE hit)), 1e0), 4) + 0e0 AS adjusted_close,
          count(f.ticker) AS n_factors, count(*) FILTER (WHERE hit) AS n_applied,
          coalesce(bool_and(known <= r.bar_date) FILTER (WHERE hit), TRUE) AS no_lookahead
        FROM (SELECT b.ticker, b.bar_date, l.close AS raw_close
              FROM (SELECT DISTINCT ticker, bar_date FROM bars) b
              LEFT JOIN live_bars l ON l.ticker = b.ticker AND l.bar_date = b.bar_date) r
        LEFT JOIN (SELECT *, TRUE AS one FROM factors) f ON f.ticker = r.ticker
        CROSS JOIN LATERAL (SELECT f.ex_date <= r.bar_date AND known <= r.bar_date AS hit) h
        GROUP BY r.ticker, r.bar_date, raw_close""",
    digits=4,
    bools=("no_lookahead",),
)
def pit_audit(spark, d):
    bars = fx.bars(spark, d)
    factors = adjust.adjustment_factors(bars, fx.actions(spark, d))
    return adjust.pit_audit(bars, factors, bars)


@query(
    f"""SELECT r.ticker, {day('r.bar_date')}, count(f.ticker) FILTER (WHERE f.ex_date <= r.bar_date) AS n_applied,
          round(coalesce(exp(sum(ln(factor)) FILTER (WHERE f.ex_date <= r.bar_date)), 1e0), 4) + 0e0 AS cum_factor,
          coalesce(bool_and(known <= r.bar_date) FILTER (WHERE f.ex_date <= r.bar_date), TRUE) AS no_lookahead
        FROM (SELECT DISTINCT ticker, bar_date FROM bars) r LEFT JOIN factors f ON f.ticker = r.ticker
        GROUP BY r.ticker, r.bar_date""",
    digits=4,
    bools=("no_lookahead",),
)
def pit_audit_of_a_leak(spark, d):
    """The audit of a frame whose factors count from their ex-date, known or not: the flag tells where they leak."""
    bars = fx.bars(spark, d)
    factors = adjust.adjustment_factors(bars, fx.actions(spark, d))
    audit = adjust.pit_audit(bars, factors, bars, active_from=F.col("ex_date"))
    return audit.select("ticker", "bar_date", "n_applied", "cum_factor", "no_lookahead")


@query(
    f"""SELECT b.ticker, {day('b.bar_date')}, {day('f.ex_date')}, factor_type, round(factor, 6) + 0e0 AS factor,
          f.ex_date <= b.bar_date AND known <= b.bar_date AS applied
        FROM live_bars b JOIN factors f ON f.ticker = b.ticker""",
    bools=("applied",),
)
def factor_trail(spark, d):
    # the requests an operator asks about: an input table, here every servable bar
    bars = fx.bars(spark, d)
    factors = adjust.adjustment_factors(bars, fx.actions(spark, d))
    asked = adjust.servable(bars).select("ticker", "bar_date")
    return adjust.factor_trail(asked, factors).drop("knowledge_time", "known_date")


@query(
    """SELECT count(*) AS n_bars,
          count(*) FILTER (WHERE p.close IS NOT DISTINCT FROM due OR abs(p.close - due) <= 1e-6 * abs(due)) AS n_clean
        FROM pit p JOIN (
          SELECT b.ticker, b.bar_date, b.close * coalesce(exp(sum(ln(factor)) FILTER (
                   WHERE f.ex_date <= b.bar_date AND known <= b.bar_date)), 1e0) AS due
          FROM (SELECT ticker, bar_date, close FROM live_bars) b LEFT JOIN factors f ON f.ticker = b.ticker
          GROUP BY b.ticker, b.bar_date, b.close) r ON r.ticker = p.ticker AND r.bar_date = p.effective_date"""
)
def no_lookahead(spark, d):
    """The served frame against the product of factors known by each day."""
    bars = fx.bars(spark, d)
    factors = staged(adjust.adjustment_factors(bars, fx.actions(spark, d)), "factors")
    served = adjust.adjust_with(bars, adjust.cumulative_factors(factors))
    leaks = adjust.served_lookahead(served, bars, factors, 1e-6)
    seen = served.select(F.lit(1).alias("bar"), F.lit(0).alias("leak")).unionByName(
        leaks.select(F.lit(0).alias("bar"), F.lit(1).alias("leak"))
    )
    return seen.agg(F.sum("bar").alias("n_bars"), (F.sum("bar") - F.sum("leak")).alias("n_clean"))


@query(f"SELECT ticker, {day('bar_date')}, {rnd('close', 'volume')}, grade FROM live_bars")
def servable_bars(spark, d):
    return adjust.servable(fx.bars(spark, d)).select("ticker", "bar_date", "close", "volume", "grade")


# --- cross-source quality -------------------------------------------------------------------


@query(
    f"SELECT source, ticker, {day('bar_date')}, {rnd('close', 'volume', digits=8)}, payload_hash FROM latest",
    digits=8,
)
def latest_observation(spark, d):
    return voting.latest_observation(voting.daily_events(fx.bar_events(spark, d))).select(
        "source", "ticker", "bar_date", "close", "volume", "payload_hash"
    )


_CELLS = [f"{f}_{s}" for s in voting.SOURCES for f in OHLCV]


@query(f"SELECT ticker, {day('bar_date')}, {rnd(*_CELLS, digits=8)} FROM wide", digits=8)
def source_pivot(spark, d):
    return voting.source_pivot(fx.observations(spark, d))


@query(f"SELECT ticker, {day('bar_date')}, {rnd(*_CELLS, digits=8)} FROM wide_latest", digits=8)
def latest_pivot(spark, d):
    return voting.latest_pivot(fx.bar_events(spark, d))


@query(
    f"SELECT ticker, {day('bar_date')}, CAST(n_sources AS BIGINT) AS n_sources, "
    "backed_yfinance, backed_stooq, backed_alpaca_iex FROM agree",
    bools=("backed_yfinance", "backed_stooq", "backed_alpaca_iex"),
)
def close_agreement(spark, d):
    return voting.with_agreement(voting.source_pivot(fx.observations(spark, d))).select(
        "ticker", "bar_date", "n_sources", *[voting.backed_by(s) for s in voting.SOURCES]
    )


def _verdicts(spark, d):
    return voting.with_verdict(voting.with_agreement(voting.source_pivot(fx.observations(spark, d))))


@query("SELECT verdict, count(*) AS n_rows FROM verdicts GROUP BY verdict")
def vote_verdict(spark, d):
    return _verdicts(spark, d).groupBy("verdict").agg(F.count("*").alias("n_rows"))


@query(f"SELECT ticker, {day('bar_date')}, verdict, chosen_source FROM verdicts")
def vote_choice(spark, d):
    return _verdicts(spark, d).select("ticker", "bar_date", "verdict", "chosen_source")


@query(f"SELECT ticker, {day('bar_date')}, {rnd('volume')}, volume_agrees FROM voted", bools=("volume_agrees",))
def volume_vote(spark, d):
    return voting.vote_bars(fx.observations(spark, d)).select(
        "ticker", "bar_date", "volume", "volume_agrees"
    )


@query("SELECT verdict, grade, single_source, count(*) AS n_rows FROM voted GROUP BY ALL", bools=("single_source",))
def vote_grade(spark, d):
    return voting.vote_bars(fx.observations(spark, d)).groupBy(
        "verdict", "grade", "single_source"
    ).agg(F.count("*").alias("n_rows"))


@query("SELECT source_set, count(*) AS n_rows FROM voted GROUP BY ALL")
def source_set(spark, d):
    return voting.vote_bars(fx.observations(spark, d)).groupBy("source_set").agg(
        F.count("*").alias("n_rows")
    )


@query(f"SELECT {VOTE_OUT} FROM voted", digits=8, bools=("single_source", "volume_agrees",))
def vote_bars(spark, d):
    return voting.vote_bars(fx.observations(spark, d))


@query(f"SELECT {VOTE_OUT} FROM voted_latest", digits=8, bools=("single_source", "volume_agrees",))
def vote_latest(spark, d):
    return voting.vote_pivot(voting.latest_pivot(fx.bar_events(spark, d)))


@query(
    """SELECT count(*) AS iex_only FROM (
         SELECT ticker, bar_date FROM obs GROUP BY ALL
         HAVING count(DISTINCT source) = 1 AND min(source) = 'alpaca_iex')"""
)
def iex_only_count(spark, d):
    return voting.iex_only_count(fx.observations(spark, d))


@query(f"SELECT ticker, {day('bar_date')}, {rnd('close', digits=8)}, grade, single_source, mad_flag FROM screened", digits=8, bools=("single_source", "mad_flag",))
def mad_screen(spark, d):
    return outliers.mad_screen(voting.vote_bars(fx.observations(spark, d))).select(
        "ticker", "bar_date", "close", "grade", "single_source", "mad_flag"
    )


@query(
    f"""SELECT ticker, {day('bar_date')}, verdict, CAST(n_sources AS BIGINT) AS n_sources, chosen_source,
          {rnd('close_stooq', 'close_yfinance', 'close_alpaca', digits=8)}, volume_agrees, mad_flag,
          epoch_us(TIMESTAMP '2002-02-01') AS voted_at FROM screened""",
    digits=8,
    bools=("volume_agrees", "mad_flag",), stamps=("voted_at",),
)
def vote_audit(spark, d):
    return voting.vote_audit(outliers.mad_screen(voting.vote_bars(fx.observations(spark, d))), now())


# --- dead letters ---------------------------------------------------------------------------


def _letters(spark, d):
    """Letters of every conflict, half of them resolved, numbered by day and ticker."""
    conflicts = voting.vote_bars(fx.observations(spark, d)).filter("verdict = 'conflict'")
    day_no = F.dayofmonth("bar_date")
    number = F.substring("ticker", 7, 9).cast("bigint")
    order = F.date_diff("bar_date", F.lit("1995-01-01").cast("date")) * 1000 + number
    return conflicts.select(
        order.alias("id"), "ticker", "bar_date",
        F.lit("vote_and_seal").alias("job_name"), F.lit(None).cast("string").alias("source"),
        F.concat_ws(":", "ticker", F.col("bar_date").cast("string")).alias("request_key"),
        F.lit(None).cast("string").alias("payload_path"),
        F.lit(deadletters.VOTE_CONFLICT).alias("error_class"), F.lit("seen").alias("detail"),
        F.timestamp_seconds(F.lit(1009843200) + day_no * 86400).alias("first_seen"),
        F.lit(0).alias("retry_count"),
        F.when(day_no % 2 == 0, fx.ts("2002-03-01")).alias("resolved_at"),
    )


@query(
    f"""SELECT v.ticker || ':' || CAST(v.bar_date AS VARCHAR) AS request_key, 'vote_conflict' AS error_class,
          'vote_and_seal' AS job_name, epoch_us(TIMESTAMP '2002-02-01') AS first_seen
        FROM voted v WHERE verdict = 'conflict'
          AND NOT EXISTS (SELECT 1 FROM letters l WHERE l.ticker = v.ticker AND l.bar_date = v.bar_date
                          AND l.resolved_at IS NULL)""",
    stamps=("first_seen",),
)
def conflict_dead_letters(spark, d):
    voted = voting.vote_bars(fx.observations(spark, d))
    return deadletters.conflict_letters(voted, _letters(spark, d), now()).select(
        "request_key", "error_class", "job_name", "first_seen"
    )


@query("SELECT count(*) AS open_depth FROM letters WHERE resolved_at IS NULL")
def dead_letter_depth(spark, d):
    return deadletters.open_depth(_letters(spark, d))


@query(
    f"""SELECT id, request_key, {us('first_seen')} FROM letters WHERE resolved_at IS NULL
        ORDER BY first_seen DESC, id DESC LIMIT 50""",
    stamps=("first_seen",),
)
def dead_letter_open(spark, d):
    return deadletters.open_letters(_letters(spark, d)).select("id", "request_key", "first_seen")


@query(
    """SELECT id, epoch_us(CASE WHEN id % 3 = 0 THEN TIMESTAMP '2002-02-01' ELSE resolved_at END) AS resolved_at
       FROM letters""",
    stamps=("resolved_at",),
)
def dead_letter_resolve(spark, d):
    letters = _letters(spark, d)
    done = deadletters.resolve_letters(letters, letters.filter("id % 3 = 0").select("id"), now())
    return done.select("id", "resolved_at")


# --- canonical history ----------------------------------------------------------------------


@query(
    f"""SELECT ticker, {day('bar_date')},
          epoch_us(timezone('America/New_York', bar_date + INTERVAL '23:59:59')) AS knowledge_time FROM base""",
    stamps=("knowledge_time",),
)
def knowledge_stamp(spark, d):
    return history.with_bar_knowledge(fx.base(spark, d).select("ticker", "bar_date"))


@query(
    f"""SELECT ticker, {day('bar_date')},
          sha256('{{"close":"' || format('{{:.6f}}', px) || '","single_source":'
                 || CASE WHEN k % 3 = 0 THEN 'true' ELSE 'false' END
                 || ',"volume":"' || format('{{:.6f}}', vol) || '"}}') AS payload_hash FROM base"""
)
def content_hash(spark, d):
    rows = fx.base(spark, d).select(
        "ticker", "bar_date", F.col("px").alias("close"), F.col("vol").alias("volume"),
        (F.col("k") % 3 == 0).alias("single_source"),
    )
    return with_bar_hash(rows).select("ticker", "bar_date", "payload_hash")


@query(
    f"""SELECT ticker, action_type, {day('ex_date')},
          sha256('{{"cash":' || coalesce('"' || format('{{:.6f}}', cash_amount) || '"', 'null')
                 || ',"ex":"' || CAST(ex_date AS VARCHAR) || '","ratio":'
                 || coalesce('"' || format('{{:.6f}}', ratio) || '"', 'null')
                 || ',"ticker":"' || ticker || '","type":"' || action_type || '"}}') AS payload_hash
        FROM actions WHERE is_current"""
)
def action_hash(spark, d):
    live = fx.actions(spark, d).filter("is_current")
    return with_action_hash(live).select("ticker", "action_type", "ex_date", "payload_hash")


def _night(spark, d, night):
    screened = outliers.mad_screen(voting.vote_bars(fx.observations(spark, d, night)))
    return history.stamp_bars(screened.select(*history.BAR_KEY, *history.BAR_VALUES))


def _merge_nights(spark, d):
    first, _ = history.merge_history(
        schemas.empty(spark, schemas.BARS_DAILY), _night(spark, d, 1), history.BAR_KEY,
        history.BAR_VALUES,
    )
    # the first night is stored before the second reads it, as in a lake
    return history.merge_history(
        staged(first, "night"), _night(spark, d, 2), history.BAR_KEY, history.BAR_VALUES, now()
    )


_VERSION = ["ticker", "bar_date", "close", "grade", "valid_from", "valid_to", "is_current", "revision_seq"]


@query(
    f"""SELECT ticker, {day('bar_date')}, {rnd('close', digits=8)}, grade,
          epoch_us(timezone('America/New_York', bar_date + INTERVAL '23:59:59')) AS valid_from,
          CAST(NULL AS BIGINT) AS valid_to, TRUE AS is_current, CAST(1 AS BIGINT) AS revision_seq FROM screened""",
    digits=8,
    bools=("is_current",), stamps=("valid_from", "valid_to",),
)
def scd2_first_load(spark, d):
    state, _ = history.merge_history(
        schemas.empty(spark, schemas.BARS_DAILY), _night(spark, d, 1), history.BAR_KEY,
        history.BAR_VALUES, now(),
    )
    return state.select(*_VERSION)


@query(
    f"""SELECT ticker, {day('bar_date')}, {rnd('close', digits=8)}, grade, {us('valid_from')}, {us('valid_to')},
          is_current, CAST(revision_seq AS BIGINT) AS revision_seq FROM two_nights""",
    digits=8,
    bools=("is_current",), stamps=("valid_from", "valid_to",),
)
def scd2_second_night(spark, d):
    state, _ = _merge_nights(spark, d)
    return state.select(*_VERSION)


@query(
    """SELECT count(*) FILTER (WHERE is_revised) AS revised, count(*) FILTER (WHERE is_revised OR is_new) AS inserted,
         count(*) FILTER (WHERE NOT is_revised AND NOT is_new AND NOT is_absent) AS unchanged FROM nights"""
)
def scd2_counts(spark, d):
    _, counts = _merge_nights(spark, d)
    return counts


@query(
    f"""SELECT ticker, {day('bar_date')}, {rnd('close')}, {us('valid_from')}, {us('valid_to')}, is_current,
          CAST(revision_seq AS BIGINT) AS revision_seq
        FROM (SELECT ticker, bar_date, close, valid_from,
                     CASE WHEN k % 19 = 0 THEN coalesce(valid_to, TIMESTAMP '2002-01-05') ELSE valid_to END AS valid_to,
                     is_current AND k % 19 <> 0 AS is_current, revision_seq FROM bars
              UNION ALL
              SELECT ticker, bar_date, close, TIMESTAMP '2002-02-01', NULL, TRUE, revision_seq + 1
              FROM bars WHERE is_current AND k % 19 = 0)""",
    bools=("is_current",), stamps=("valid_from", "valid_to",),
)
def scd2_reopen(spark, d):
    """Keys whose versions are all closed reopen after their highest sequence."""
    bars = fx.bars(spark, d)
    closed = F.col("k") % 19 == 0
    existing = bars.withColumns(
        {
            "valid_to": F.when(closed, F.coalesce("valid_to", fx.ts("2002-01-05"))).otherwise(F.col("valid_to")),
            "is_current": F.col("is_current") & ~closed,
        }
    )
    state, _ = history.merge_history(
        existing, bars.filter("is_current"), history.BAR_KEY, history.BAR_VALUES, now()
    )
    return state.select(*[c for c in _VERSION if c != "grade"])


@query(
    f"""SELECT b.ticker, {day('b.bar_date')}, epoch_us(r.as_of) AS as_of, round(b.close, 6) + 0e0 AS close,
          CAST(b.revision_seq AS BIGINT) AS revision_seq
        FROM (SELECT DISTINCT ticker, bar_date, TIMESTAMP '2002-01-01' + to_days(CAST(k % 3 AS INTEGER)) AS as_of FROM bars) r
        JOIN bars b ON b.ticker = r.ticker AND b.bar_date = r.bar_date
          AND b.valid_from <= r.as_of AND (b.valid_to IS NULL OR b.valid_to > r.as_of)""",
    stamps=("as_of",),
)
def bars_asof(spark, d):
    bars = fx.bars(spark, d)
    as_of = F.timestamp_seconds(F.lit(1009843200) + (F.col("k") % 3) * 86400)
    asked = bars.select("ticker", "bar_date", as_of.alias("as_of")).distinct()
    return history.bars_asof(bars, asked)


@query(
    f"""SELECT ticker, action_type, {day('ex_date')}, {rnd('ratio', 'cash_amount')}, CAST(1 AS BIGINT) AS revision_seq,
          TRUE AS is_current
        FROM (SELECT *, row_number() OVER (PARTITION BY ticker, action_type, ex_date ORDER BY v DESC) AS rn
              FROM action_events) WHERE rn = 1""",
    bools=("is_current",),
)
def actions_replay(spark, d):
    state, _ = history.upsert_actions(
        schemas.empty(spark, schemas.CORPORATE_ACTIONS),
        history.latest_actions(fx.action_events(spark, d)),
    )
    return state.select(*history.ACTION_KEY, "ratio", "cash_amount", "revision_seq", "is_current")


@query(
    f"""SELECT ticker, {day('bar_date')}, {rnd('close')}, grade, source_set, single_source
        FROM (SELECT ticker, bar_date, px AS close, 'degraded' AS grade, 'stooq' AS source_set, TRUE AS single_source FROM base)""",
    bools=("single_source",),
)
def upsert_bars(spark, d):
    raw = fx.bars(spark, d).filter("is_current")
    state, _ = history.upsert_bars(schemas.empty(spark, schemas.BARS_DAILY), raw)
    return state.select("ticker", "bar_date", "close", "grade", "source_set", "single_source")


def _lanes(fold: str) -> str:
    lane = "CAST('0x' || substr(h, {at}, 8) AS BIGINT)"
    return " || '|' || ".join(f"CAST({fold}({lane.format(at=8 * k + 1)}) AS VARCHAR)" for k in range(8))


@query(
    f"""SELECT name AS table_name, count(*) AS n_rows,
          sha256(CAST(count(*) AS VARCHAR) || '|' || {_lanes('sum')} || '|' || {_lanes('bit_xor')}) AS digest
        FROM (
          SELECT 'bars_daily' AS name, sha256(
            '{{"bar_date":"' || CAST(bar_date AS VARCHAR) || '","close":"' || format('{{:.6f}}', close)
            || '","grade":"' || grade || '","high":"' || format('{{:.6f}}', high)
            || '","knowledge_time":"' || strftime(valid_from, '%Y-%m-%dT%H:%M:%S.%fZ')
            || '","low":"' || format('{{:.6f}}', low) || '","open":"' || format('{{:.6f}}', open)
            || '","payload_hash":"h-' || CAST(revision_seq AS VARCHAR) || '","single_source":'
            || CASE WHEN single_source THEN 'true' ELSE 'false' END || ',"source_set":"' || source_set
            || '","ticker":"' || ticker || '","volume":"' || format('{{:.6f}}', volume) || '"}}') AS h
          FROM bars WHERE is_current
          UNION ALL
          SELECT 'corporate_actions', sha256(
            '{{"action_type":"' || action_type || '","cash_amount":' || coalesce('"' || format('{{:.6f}}', cash_amount) || '"', 'null')
            || ',"confidence":"single_source","ex_date":"' || CAST(ex_date AS VARCHAR) || '","knowledge_time":"'
            || strftime(timezone('UTC', timezone('America/New_York', known + INTERVAL '23:59:59')), '%Y-%m-%dT%H:%M:%S.%fZ')
            || '","payload_hash":"a-' || CAST(coalesce(ratio, cash_amount) AS VARCHAR) || '","ratio":'
            || coalesce('"' || format('{{:.6f}}', ratio) || '"', 'null') || ',"ticker":"' || ticker || '"}}')
          FROM actions WHERE is_current) GROUP BY name"""
)
def state_fingerprint(spark, d):
    return fingerprint.state_fingerprint(fx.bars(spark, d), fx.actions(spark, d))


# --- survivorship ---------------------------------------------------------------------------


@query(f"SELECT {day('snapshot_date')} FROM complete_dates")
def complete_dates(spark, d):
    return listings.complete_dates(fx.snapshots(spark, d))


@query(f"SELECT ticker, {day('termination_date')} FROM gone")
def graveyard_diff(spark, d):
    return listings.disappearances(fx.snapshots(spark, d))


@query(f"SELECT ticker, {day('termination_date')}, detection_source FROM dead")
def graveyard_union(spark, d):
    return listings.union_by_authority(
        fx.delisted(spark, d), listings.disappearances(fx.snapshots(spark, d))
    )


@query(
    f"SELECT ticker, {day('termination_date')}, {rnd('terminal_return')} FROM dead_returns"
)
def terminal_return(spark, d):
    dead = graveyard_union(spark, d)
    return listings.terminal_returns(dead, fx.bars(spark, d)).drop("detection_source")


def _previous_grave(spark, d):
    """An earlier graveyard: the vendor list alone, some of it dated otherwise."""
    position = F.col("position")
    moved = F.when(position % 3 == 0, 1).otherwise(0)
    return fx.delisted(spark, d).filter(position < 1000).select(
        "ticker", F.date_add("termination_date", moved).alias("termination_date"),
        fx.ts("2001-06-01").alias("first_seen"),
    )


@query(
    f"""SELECT d.ticker, {day('d.termination_date')}, d.detection_source,
          epoch_us(coalesce(p.first_seen, TIMESTAMP '2002-02-01')) AS first_seen
        FROM dead d LEFT JOIN (
          SELECT ticker, termination_date + CASE WHEN position % 3 = 0 THEN 1 ELSE 0 END AS termination_date,
                 TIMESTAMP '2001-06-01' AS first_seen FROM delisted WHERE position < 1000) p
          ON p.ticker = d.ticker AND p.termination_date = d.termination_date""",
    stamps=("first_seen",),
)
def graveyard_first_seen(spark, d):
    return listings.with_first_seen(graveyard_union(spark, d), _previous_grave(spark, d), now())


def _graveyard(spark, d):
    return listings.graveyard(
        fx.snapshots(spark, d), fx.delisted(spark, d), fx.bars(spark, d),
        _previous_grave(spark, d), now(),
    )


@query(
    f"""SELECT ticker, {day('termination_date')}, 'unknown' AS termination_reason, 'pending' AS reason_confidence,
          {rnd('terminal_return')}, detection_source FROM dead_returns"""
)
def graveyard(spark, d):
    return _graveyard(spark, d).drop("reason_source", "first_seen")


def _coverage(spark, d, bars=None):
    bars = fx.bars(spark, d) if bars is None else bars
    return listings.coverage(graveyard_union(spark, d), bars, fx.snapshots(spark, d), fx.TRADE_DATE, now())


@query(
    f"""SELECT audit_window, {day('window_start')}, expected_n, covered_n,
          round(CASE WHEN expected_n = 0 THEN 1e0 ELSE covered_n / CAST(expected_n AS DOUBLE) END, 6) + 0e0 AS coverage
        FROM coverage_rows"""
)
def coverage(spark, d):
    return _coverage(spark, d).drop("computed_at")


# --- intraday -------------------------------------------------------------------------------

_QUOTE_OUT = (
    f"SELECT ticker, {us('minute_ts')}, {rnd('bid_close', 'ask_close', 'bid_twm', 'ask_twm')}, "
    "CAST(n_quotes AS BIGINT) AS n_quotes FROM "
)


def _hourly(spark, d):
    return quotes.quote_bars(fx.quotes(spark, d), fx.quote_sessions(spark, d), 3600)


@query(_QUOTE_OUT + "quote_bars_minute", stamps=("minute_ts",))
def quote_twm(spark, d):
    return quotes.quote_bars(fx.quotes(spark, d), fx.quote_sessions(spark, d))


@query(_QUOTE_OUT + "quote_bars_hour", stamps=("minute_ts",))
def quote_twm_hourly(spark, d):
    return _hourly(spark, d)


@query(
    f"""SELECT ticker, {us('minute_ts')}, {rnd('bid_close', 'ask_close')}, n_quotes FROM (
          SELECT ticker, date_trunc('hour', ts) AS minute_ts, arg_max(bid, (ts, pos)) AS bid_close,
                 arg_max(ask, (ts, pos)) AS ask_close, count(*) AS n_quotes
          FROM quotes WHERE bid > 0 AND ask > 0 GROUP BY 1, 2)""",
    stamps=("minute_ts",),
)
def quote_buckets(spark, d):
    return quotes.quote_buckets(fx.quotes(spark, d), 3600)


@query(f"SELECT ticker, {day('bar_date')}, {rnd('cs_spread')} FROM cs")
def corwin_schultz(spark, d):
    return spreads.corwin_schultz(spreads.spread_inputs(fx.event_ranges(spark, d)))


def _hybrid(spark, d):
    return spreads.hybrid_intraday(fx.minutes(spark, d), _hourly(spark, d), corwin_schultz(spark, d))


@query(f"SELECT ticker, {us('minute_ts')}, {rnd('bid', 'ask', 'volume')}, derivation FROM hybrid", stamps=("minute_ts",))
def hybrid_intraday(spark, d):
    return _hybrid(spark, d)


@query("SELECT derivation, count(*) AS n_rows FROM hybrid GROUP BY derivation")
def derivation_mix(spark, d):
    return spreads.derivation_mix(_hybrid(spark, d))


# --- sessions -------------------------------------------------------------------------------


@query(
    f"""SELECT {day('max(session_date)', 'session_date')} FROM sessions
        WHERE session_date BETWEEN DATE '2000-03-03' - 10 AND DATE '2000-03-03'
          AND close_utc <= TIMESTAMP '2000-03-03 18:30:00'"""
)
def latest_session(spark, d):
    return sessions.latest_completed(fx.sessions(spark, d), fx.ts("2000-03-03 18:30:00"))


@query(
    f"""SELECT {day('session_date')} FROM sessions WHERE session_date <= DATE '2000-06-30'
        ORDER BY sessions.session_date DESC LIMIT 20"""
)
def previous_sessions(spark, d):
    return sessions.previous_sessions(fx.sessions(spark, d), "2000-06-30", 20)


@query(
    f"SELECT {day('session_date')} FROM sessions WHERE session_date BETWEEN DATE '2000-06-30' - 90 AND DATE '2000-06-30'"
)
def sessions_within(spark, d):
    return sessions.sessions_within(fx.sessions(spark, d), "2000-06-30", 90)


@query(
    f"""SELECT {day('session_date')},
          hour(timezone('America/New_York', timezone('UTC', close_utc))) < 16 AS is_half_day FROM sessions""",
    bools=("is_half_day",),
)
def half_days(spark, d):
    return sessions.with_half_day(fx.sessions(spark, d)).select("session_date", "is_half_day")


@query(
    f"""SELECT exchange, {day('session_date')}, epoch_us(close_utc) AS close_utc FROM sessions
        WHERE session_date NOT BETWEEN DATE '1999-01-01' AND DATE '1999-12-31'
        UNION ALL
        SELECT exchange, {day('session_date')}, epoch_us(close_utc - INTERVAL 1 HOUR) FROM sessions
        WHERE session_date BETWEEN DATE '1999-01-01' AND DATE '1999-12-31' AND month(session_date) <> 7""",
    stamps=("close_utc",),
)
def sessions_replace(spark, d):
    now = fx.sessions(spark, d)
    earlier = F.timestamp_seconds(F.unix_timestamp("close_utc") - 3600)
    fresh = now.filter(F.month("session_date") != 7).withColumn("close_utc", earlier)
    return sessions.replace_range(now, fresh, "XNYS", "1999-01-01", "1999-12-31").select(
        "exchange", "session_date", "close_utc"
    )


# --- sectors, parity, gaps ------------------------------------------------------------------


@query("SELECT ticker, cik, sic, sector FROM sectored")
def sic_sector(spark, d):
    parts = F.split("request_key", ":", 2)
    return fx.submissions(spark, d).select(
        parts[0].alias("ticker"), parts[1].alias("cik"), "sic",
        sectors.sector_of(F.col("sic")).alias("sector"),
    )


def _known_tickers(spark, d):
    return fx.table(spark, d, "supplier").filter("s_suppkey % 9 = 0").select(
        F.concat(F.lit("S"), "s_suppkey").alias("ticker")
    )


def _sectors(spark, d):
    return sectors.sector_projection(fx.submissions(spark, d), _known_tickers(spark, d), now())


_KNOWN = "CAST(substr(ticker, 2) AS BIGINT) % 9 = 0"


@query(f"SELECT ticker, cik, sic, sector, industry, 'edgar' AS source FROM sector_rows WHERE NOT ({_KNOWN})")
def sector_projection(spark, d):
    return _sectors(spark, d).drop("updated_at")


def _parity(spark, d, bars=None):
    bars = fx.bars(spark, d) if bars is None else bars
    return parity.parity_scores(adjust.servable(bars), fx.parity_peer(spark, d, bars), fx.TRADE_DATE)


@query(f"SELECT '2002-01-31' AS sample_date, ticker, {day('bar_date')}, field, {rnd('ours', 'theirs', 'rel_diff')}, within_tol FROM parity", bools=("within_tol",))
def parity_scores(spark, d):
    return _parity(spark, d)


@query("SELECT round(max(rel_diff), 6) + 0e0 AS worst_rel_diff FROM parity")
def parity_worst(spark, d):
    older = _parity(spark, d).withColumns(
        {"sample_date": F.lit("2002-01-24").cast("date"), "rel_diff": F.col("rel_diff") * 9}
    )
    return parity.parity_worst(_parity(spark, d).unionByName(older))


@query(
    f"""SELECT ticker, {day('bar_date')}, {rnd(*OHLCV)} FROM live_bars WHERE bar_date >= DATE '2001-06-30' - 600
        ORDER BY sha256('2001-06-30|' || ticker || '|' || CAST(bar_date AS VARCHAR)), ticker, live_bars.bar_date LIMIT 25"""
)
def parity_sample(spark, d):
    return parity.parity_sample(fx.bars(spark, d), "2001-06-30")


def _health(spark, d):
    return fx.table(spark, d, "supplier").select(
        F.concat(F.lit("source"), "s_suppkey").alias("source"),
        F.when(F.col("s_suppkey") % 8 == 1, "open").otherwise("closed").alias("state"),
    )


def _universe(spark, d):
    return fx.table(spark, d, "supplier").select(F.concat(F.lit("S"), "s_suppkey").alias("ticker"))


@query(
    f"""SELECT gap_key, round(metric, 6) + 0e0 AS metric, unit, severity FROM (
          SELECT 'intraday_iex_bbo_share' AS gap_key, avg(CASE WHEN derivation = 'iex_bbo' THEN 1e0 ELSE 0e0 END) AS metric,
                 'ratio' AS unit, CASE WHEN coalesce(avg(CASE WHEN derivation = 'iex_bbo' THEN 1e0 ELSE 0e0 END), 0) > 0 THEN 'info' ELSE 'warn' END AS severity
          FROM hybrid
          UNION ALL SELECT 'daily_single_source_share', avg(CASE WHEN single_source THEN 1e0 ELSE 0e0 END), 'ratio',
                 CASE WHEN avg(CASE WHEN single_source THEN 1e0 ELSE 0e0 END) > 0.5 THEN 'warn' ELSE 'info' END
          FROM bars WHERE is_current
          UNION ALL SELECT 'daily_quarantined_count', count(*) FILTER (WHERE grade = 'quarantined'), 'rows',
                 CASE WHEN count(*) FILTER (WHERE grade = 'quarantined') > 0 THEN 'warn' ELSE 'info' END FROM bars WHERE is_current
          UNION ALL SELECT 'delisted_coverage_10y', max(covered_n / CAST(expected_n AS DOUBLE)), 'ratio',
                 CASE WHEN coalesce(max(covered_n / CAST(expected_n AS DOUBLE)), 0) < 0.95 THEN 'blocker' ELSE 'info' END
          FROM coverage_rows WHERE audit_window = '10y'
          UNION ALL SELECT 'delisted_reasons_unknown_share', 1e0, 'ratio', 'info'
          UNION ALL SELECT 'sectors_missing_count',
                 (SELECT count(*) FROM supplier) - (SELECT count(sector) FROM sector_rows WHERE NOT ({_KNOWN})), 'rows', 'info'
          UNION ALL SELECT 'parity_worst_rel_diff', max(rel_diff), 'ratio',
                 CASE WHEN max(rel_diff) > 0.001 THEN 'warn' ELSE 'info' END FROM parity
          UNION ALL SELECT 'sources_circuit_open', count(*) FILTER (WHERE s_suppkey % 8 = 1), 'sources',
                 CASE WHEN count(*) FILTER (WHERE s_suppkey % 8 = 1) > 0 THEN 'warn' ELSE 'info' END FROM supplier)"""
)
def gap_ledger(spark, d):
    # bars are derived once and read by three of the metrics
    bars = staged(fx.bars(spark, d), "bars")
    metrics = gaps.gap_metrics(
        _hybrid(spark, d), bars, _coverage(spark, d, bars),
        graveyard_union(spark, d).withColumn("termination_reason", F.lit("unknown")),
        _universe(spark, d), _sectors(spark, d), _parity(spark, d, bars), _health(spark, d),
    )
    return gaps.gap_ledger(metrics, now()).drop("description", "updated_at")


# --- contracts and serving ------------------------------------------------------------------


@query(
    """SELECT count(*) AS n_rows, count(DISTINCT (ticker, effective_date)) AS n_keys,
         count(*) FILTER (WHERE ticker IS NULL OR effective_date IS NULL OR close IS NULL OR high < low) AS bad_rows FROM pit"""
)
def contract_daily(spark, d):
    return contracts.check_daily(adjust.pit_adjusted(fx.bars(spark, d), fx.actions(spark, d)))


@query(
    """SELECT count(*) AS n_rows, count(DISTINCT (ticker, termination_date)) AS n_keys,
         count(*) FILTER (WHERE length(ticker) = 3) AS bad_reason FROM dead"""
)
def contract_delisted(spark, d):
    served = graveyard_union(spark, d).withColumn(
        "termination_reason", F.when(F.length("ticker") == 3, "vanished").otherwise("merger")
    )
    return contracts.check_delisted(served)


@query(
    f"""SELECT count(*) AS n_rows, count(DISTINCT (ticker, minute_ts)) AS n_keys, count(*) FILTER (WHERE bid > ask) AS crossed,
         count(*) FILTER (WHERE derivation NOT IN ('iex_bbo', 'corwin_schultz')) AS bad_derivation FROM hybrid"""
)
def contract_intraday(spark, d):
    return contracts.check_intraday(serving.serve_intraday(_hybrid(spark, d)))


@query(
    """SELECT count(*) AS n_rows, count(DISTINCT ticker) AS n_keys, count(*) FILTER (WHERE sector IS NULL) AS null_sector
       FROM sectored"""
)
def contract_sectors(spark, d):
    return contracts.check_sectors(sic_sector(spark, d))


@query(
    """SELECT count(*) AS n_rows, 0 AS out_of_range FROM coverage_rows"""
)
def contract_coverage(spark, d):
    return contracts.check_coverage(_coverage(spark, d))


@query(
    """SELECT count(*) + count(*) FILTER (WHERE day(effective_date) = 1) AS n_rows, count(*) AS n_keys,
         count(*) FILTER (WHERE day(effective_date) IN (2, 3)) AS bad_rows FROM pit"""
)
def contract_daily_broken(spark, d):
    """The daily contract over a frame with repeated keys, missing closes and highs below lows."""
    day_of = F.dayofmonth("effective_date")
    served = adjust.pit_adjusted(fx.bars(spark, d), fx.actions(spark, d)).withColumns({
        "close": F.when(day_of != 2, F.col("close")),
        "high": F.when(day_of == 3, F.col("low")).otherwise(F.col("high")),
        "low": F.when(day_of == 3, F.col("high")).otherwise(F.col("low")),
    })
    twice = F.explode(F.when(day_of == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return contracts.check_daily(served.withColumn("copy", twice).drop("copy"))


@query(
    """SELECT count(*) AS n_rows, count(DISTINCT (ticker, date_trunc('day', minute_ts))) AS n_keys,
         count(*) FILTER (WHERE hour(minute_ts) = 15 AND ask > bid) AS crossed,
         count(*) FILTER (WHERE hour(minute_ts) = 16) AS bad_derivation FROM hybrid"""
)
def contract_intraday_broken(spark, d):
    """The intraday contract over minutes cut to days, sides swapped in one hour and a foreign tag in another."""
    hour = F.hour("minute_ts")
    broken = _hybrid(spark, d).withColumns({
        "bid": F.when(hour == 15, F.col("ask")).otherwise(F.col("bid")),
        "ask": F.when(hour == 15, F.col("bid")).otherwise(F.col("ask")),
        "derivation": F.when(hour == 16, "guess").otherwise(F.col("derivation")),
        "minute_ts": F.date_trunc("day", "minute_ts"),
    })
    return contracts.check_intraday(serving.serve_intraday(broken))


@query(
    """SELECT count(*) AS n_rows,
         count(*) FILTER (WHERE 3 * covered_n / CAST(expected_n AS DOUBLE) - 1 NOT BETWEEN 0 AND 1) AS out_of_range
       FROM coverage_rows"""
)
def contract_coverage_broken(spark, d):
    """The coverage contract over shares stretched out of their range."""
    return contracts.check_coverage(_coverage(spark, d).withColumn("coverage", 3 * F.col("coverage") - 1))


@query(
    f"""SELECT ticker, {day('bar_date')}, field, {rnd('ours', 'theirs', 'rel_diff')} FROM parity WHERE NOT within_tol""",
)
def parity_breaches(spark, d):
    """Bars and fields on which the comparison vendor differs by more than the tolerance, or has no value."""
    return _parity(spark, d).filter("NOT within_tol").select("ticker", "bar_date", "field", "ours", "theirs", "rel_diff")


@query(
    f"""SELECT ticker, {day('termination_date')}, 'unknown' AS termination_reason, {rnd('terminal_return')} FROM dead_returns"""
)
def serve_delisted(spark, d):
    return serving.serve_delisted(_graveyard(spark, d))


@query(
    """SELECT audit_window, round(covered_n / CAST(expected_n AS DOUBLE), 6) + 0e0 AS coverage FROM coverage_rows"""
)
def serve_coverage(spark, d):
    return serving.serve_coverage(_coverage(spark, d))


@query(f"SELECT ticker, sector, industry FROM sector_rows WHERE sector IS NOT NULL AND NOT ({_KNOWN})")
def serve_sectors(spark, d):
    return serving.serve_sectors(_sectors(spark, d))


@query(
    f"SELECT ticker, epoch_us(minute_ts) AS minute, {rnd('bid', 'ask', 'volume')}, derivation FROM hybrid",
    stamps=("minute",),
)
def serve_intraday(spark, d):
    return serving.serve_intraday(_hybrid(spark, d))


# --- work lists -----------------------------------------------------------------------------


@query(
    """SELECT 'yf_daily' AS dataset, 'yfinance' AS source, ticker || ':' || CAST(bar_date AS VARCHAR) AS request_key
       FROM base WHERE NOT (k % 5 <> 0 AND k % 997 <> 0)"""
)
def worklist_pending(spark, d):
    return worklists.pending_requests(fx.candidates(spark, d), fx.manifest(spark, d))


@query(
    """SELECT ticker FROM tickers WHERE ticker NOT IN (
         SELECT split_part(request_key, ':', 1) FROM manifest WHERE request_key LIKE '%:history:%')"""
)
def backfill_pending(spark, d):
    return worklists.needs_history(fx._tickers(spark, d).select("ticker"), fx.manifest(spark, d))


@query(
    """SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS ticker, 100000 + s_suppkey AS cik FROM supplier
       WHERE s_suppkey % 9 <> 0 AND s_suppkey % 4 <> 0"""
)
def missing_sectors(spark, d):
    s = F.col("s_suppkey")
    ciks = fx.table(spark, d, "supplier").filter(s % 4 != 0).select(
        F.concat(F.lit("S"), s).alias("ticker"), (F.lit(100000) + s).alias("cik")
    )
    return worklists.missing_sectors(_universe(spark, d), _known_tickers(spark, d), ciks)


@query("SELECT dataset, request_key, path FROM manifest WHERE request_key LIKE '%:1998-03-05'")
def landed_for_date(spark, d):
    return worklists.landed_for_date(fx.manifest(spark, d), ["yf_daily", "stooq_daily"], "1998-03-05")


@query("SELECT dataset, request_key, path FROM manifest WHERE k % 4 <> 0")
def unprocessed(spark, d):
    landed = fx.manifest(spark, d)
    marks = worklists.mark_processed(landed.filter("k % 4 = 0"), now())
    return worklists.unprocessed(landed, marks, "yf_daily")


@query(
    f"""SELECT ticker, {us('minute_ts')}, {rnd('close')} FROM (
          SELECT event_type AS ticker, date_trunc('hour', ts) AS minute_ts, arg_min(value, (ts, event_id)) AS close
          FROM events GROUP BY 1, 2)
        WHERE (ticker, minute_ts) NOT IN (SELECT (ticker, minute_ts) FROM minutes)""",
    stamps=("minute_ts",),
)
def insert_or_ignore(spark, d):
    """New (ticker, minute) rows beside those stored: the first of a batch is kept."""
    at = F.col("ts").cast("timestamp")
    batch = fx.table(spark, d, "events").select(
        F.col("event_type").alias("ticker"), F.date_trunc("hour", at).alias("minute_ts"),
        F.col("value").alias("close"), at.alias("at"), "event_id",
    )
    fresh = worklists.first_writer_wins(
        fx.minutes(spark, d), batch, ["ticker", "minute_ts"], ["at", "event_id"]
    )
    return fresh.select("ticker", "minute_ts", "close")


# --- payload parsing ------------------------------------------------------------------------
# Payload texts are written by Spark from the tables: one per ticker and month, so a payload holds at
# most a month of days.


def _monthly(rows: DataFrame, dataset: str, source: str, line: Column, order: str) -> DataFrame:
    month = F.date_format(order, "yyyy-MM")
    return (
        rows.groupBy("ticker", month.alias("month"))
        .agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("line")))).alias("ls"))
        .select(
            F.concat_ws(":", F.lit(dataset), F.lit(source), "ticker", "month").alias("landing_key"),
            F.lit(dataset).alias("dataset"),
            F.concat_ws(":", "ticker", "month").alias("request_key"),
            "ticker",
            F.transform("ls", lambda x: x["line"]).alias("lines"),
            "month",
        )
    )


def _csv_payloads(spark, d):
    """Daily CSV payloads; August has a column renamed away, some months omit volume."""
    month = F.substring("month", 6, 2)
    line = F.concat_ws(
        ",", F.col("bar_date").cast("string"), *[F.col(c).cast("string") for c in ("px", "px", "px", "px")],
        F.when(F.month("bar_date") != 11, F.col("vol").cast("string")),
    )
    head = (
        F.when(month == "08", "Day,Open,High,Low,Close,Volume")
        .when(month == "11", "Date,Open,High,Low,Close")
        .otherwise("Date,Open,High,Low,Close,Volume")
    )
    return _monthly(fx.base(spark, d), "stooq_daily", "stooq", line, "bar_date").withColumn(
        "text", F.concat_ws("\n", head, F.array_join("lines", "\n"), F.lit(""))
    )


@query(
    f"""SELECT upper(ticker) AS ticker, {day('bar_date')}, {rnd('close')},
          round(CASE WHEN month(bar_date) <> 11 THEN volume END, 6) + 0e0 AS volume
        FROM (SELECT ticker, bar_date, px AS close, vol AS volume FROM base WHERE month(bar_date) <> 8)"""
)
def parse_csv_bars(spark, d):
    return daily.parse_csv_bars(_csv_payloads(spark, d)).good.select(
        "ticker", "bar_date", "close", "volume"
    )


@query(
    """SELECT DISTINCT 'stooq_daily:stooq:' || ticker || ':' || strftime(bar_date, '%Y-%m') AS landing_key,
         'schema_drift' AS error_class, 'missing columns Date' AS detail FROM base WHERE month(bar_date) = 8"""
)
def drift_rejects(spark, d):
    return daily.parse_csv_bars(_csv_payloads(spark, d)).rejects


@query(f"SELECT upper(ticker) AS ticker, {day('bar_date')}, {rnd('px')}, {rnd('vol')} FROM base WHERE month(bar_date) <> 8")
def parse_json_bars(spark, d):
    """Daily JSON payloads; August payloads hold a row without a close."""
    px, close = F.col("px"), F.when(F.month("bar_date") != 8, F.col("px"))
    stamp = F.date_format(F.col("bar_date").cast("timestamp") + F.expr("INTERVAL 20 HOURS"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    line = F.to_json(
        F.struct(stamp.alias("t"), px.alias("o"), px.alias("h"), px.alias("l"), close.alias("c"), F.col("vol").alias("v"))
    )
    payloads = _monthly(fx.base(spark, d), "alpaca_daily", "alpaca_iex", line, "bar_date").withColumn(
        "text", F.concat(F.lit('{"bars":['), F.array_join("lines", ","), F.lit("]}"))
    )
    return daily.parse_json_bars(payloads).good.select(
        "ticker", "bar_date", F.col("close").alias("px"), F.col("volume").alias("vol")
    )


@query(
    f"""SELECT ticker, {us('ts')}, {rnd('bid', 'ask')} FROM quotes WHERE bid > 0 AND ask > 0
          AND day(session_date) NOT IN (10, 11, 12, 13)
          AND (ticker, session_date) NOT IN (
            SELECT (ticker, session_date) FROM quotes WHERE day(session_date) = 9 AND pos % 5 = 0)""",
    stamps=("ts",),
)
def parse_quote_ticks(spark, d):
    """Tick payloads per name and day. On the ninth every fifth id has no time; on the days after, payloads
    break off before the end, inside the list and inside a record, or hold a nested object."""
    day_of = F.dayofmonth("session_date")
    broken = (day_of == 9) & (F.col("pos") % 5 == 0)
    record = F.to_json(
        F.struct(
            F.when(~broken, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).alias("t"),
            F.col("bid").alias("bp"), F.col("ask").alias("ap"),
        )
    )
    whole = F.concat(F.lit('{"quotes":['), F.array_join("records", ","), F.lit('],"symbol":"x"}'))
    text = (
        F.when(day_of == 10, F.rtrim(whole, F.lit("}")))
        .when(day_of == 11, F.substring_index(whole, "]", 1))
        .when(day_of == 12, F.concat(F.substring_index(whole, '"ap"', -2), F.lit("]}")))
        .when(day_of == 13, F.replace(whole, F.lit('"symbol":"x"'), F.lit('"more":{"a":1}')))
        .otherwise(whole)
    )
    payloads = (
        fx.quotes(spark, d).groupBy("ticker", "session_date").agg(F.collect_list(record).alias("records"))
        .select(
            F.concat_ws(":", F.lit("quote_ticks:alpaca_iex"), "ticker", F.col("session_date").cast("string")).alias("landing_key"),
            "ticker", text.alias("text"),
        )
    )
    fragments = minute.fragments_of(payloads)
    return minute.parse_quote_fragments(fragments).good.select("ticker", "ts", "bid", "ask")


@query(
    f"""SELECT upper(ticker) AS ticker, action_type, {day('ex_date')}, {rnd('ratio', 'cash_amount')}
        FROM actions WHERE is_current AND NOT (action_type = 'dividend' AND month(ex_date) = 10)"""
)
def parse_actions(spark, d):
    """Action payloads per ticker, kind and month; October dividends lack their amount."""
    live = fx.actions(spark, d).filter("is_current")
    amount = F.when(F.month("ex_date") != 10, F.col("cash_amount"))
    split = F.struct(
        F.col("ex_date").cast("string").alias("execution_date"), F.lit(1).alias("split_from"),
        F.col("ratio").alias("split_to"),
    )
    paid = F.struct(F.col("ex_date").cast("string").alias("ex_dividend_date"), amount.alias("cash_amount"))
    payloads = None
    for kind, dataset, body in (("split", actions.SPLITS, split), ("dividend", actions.DIVIDENDS, paid)):
        part = _monthly(
            live.filter(F.col("action_type") == kind), dataset, "polygon", F.to_json(body), "ex_date"
        )
        payloads = part if payloads is None else payloads.unionByName(part)
    payloads = payloads.withColumn(
        "text", F.concat(F.lit('{"status":"OK","results":['), F.array_join("lines", ","), F.lit("]}"))
    )
    return actions.parse_actions(payloads, now()).good.select(
        "ticker", "action_type", "ex_date", "ratio", "cash_amount"
    )


@query(
    f"""SELECT source, {day('snapshot_date')}, ticker, exchange, is_etf FROM (
          SELECT DISTINCT source, snapshot_date, ticker,
                 CASE WHEN source = 'nasdaqlisted' THEN 'NASDAQ' ELSE 'N' END AS exchange,
                 CAST(substr(ticker, 2) AS BIGINT) % 4 = 0 AS is_etf
          FROM snapshots WHERE CAST(substr(ticker, 2) AS BIGINT) % 6 <> 0)""",
    bools=("is_etf",),
)
def parse_directories(spark, d):
    """Directory payloads per kind and date, cut into parts of the ticker space.

    A real file lists a market's names once; parts keep a payload bounded however many names there are.
    """
    n = F.substring("ticker", 2, 18).cast("bigint")
    nasdaq = F.col("source") == "nasdaqlisted"
    test, etf = F.when(n % 6 == 0, "Y").otherwise("N"), F.when(n % 4 == 0, "Y").otherwise("N")
    line = F.when(nasdaq, F.concat_ws("|", "ticker", F.lit("Name"), F.lit("Q"), test, F.lit("N"), etf)).otherwise(
        F.concat_ws("|", "ticker", F.lit("Name"), F.lit("N"), "ticker", etf, test)
    )
    head = F.when(nasdaq, "Symbol|Security Name|Market Category|Test Issue|Financial Status|ETF").otherwise(
        "ACT Symbol|Security Name|Exchange|CQS Symbol|ETF|Test Issue"
    )
    key = F.concat_ws(":", "source", F.col("snapshot_date").cast("string"))
    payloads = (
        fx.snapshots(spark, d)
        .groupBy("source", "snapshot_date", F.floor(n / 1000).alias("part"))
        .agg(F.array_join(F.collect_list(line), "\n").alias("body"))
        .select(
            F.concat_ws(":", F.lit("symbol_dirs:nasdaqtrader"), key, "part").alias("landing_key"),
            key.alias("request_key"),
            F.concat_ws("\n", head, "body", F.lit("File Creation Time: 0101200000:00|||||")).alias("text"),
        )
    )
    return listing_source.parse_directories(payloads).good.select(
        "source", "snapshot_date", "ticker", "exchange", "is_etf"
    )


@query(f"SELECT upper(ticker) AS ticker, {day('termination_date')}, position FROM delisted WHERE position % 7 <> 0")
def parse_delisted(spark, d):
    """Delisted-list payloads in parts of a thousand positions; some rows lack their date."""
    line = F.to_json(
        F.struct(
            "ticker",
            F.when(F.col("position") % 7 != 0, F.concat(F.col("termination_date").cast("string"), F.lit("T00:00:00Z"))).alias("delisted_utc"),
            "position",
        )
    )
    payloads = (
        fx.delisted(spark, d)
        .groupBy(F.floor(F.col("position") / 1000).alias("part"))
        .agg(F.array_sort(F.collect_list(F.struct("position", line.alias("line")))).alias("ls"))
        .select(
            F.concat_ws(":", F.lit("polygon_delisted:polygon"), "part").alias("landing_key"),
            F.concat(
                F.lit('{"complete":true,"results":['),
                F.array_join(F.transform("ls", lambda x: x["line"]), ","), F.lit("]}"),
            ).alias("text"),
            F.transform("ls", lambda x: x["position"]).alias("positions"),
        )
    )
    rows = listing_source.parse_delisted(payloads).good
    # a payload's own positions count from zero: map them back to the list's
    at = F.get("positions", F.col("position").cast("int"))
    return rows.join(payloads.select("landing_key", "positions"), "landing_key").select(
        "ticker", "termination_date", at.alias("position")
    )


@query("SELECT ticker, cik, sic, industry FROM submissions")
def parse_submissions(spark, d):
    payloads = fx.submissions(spark, d).select(
        F.concat(F.lit("edgar_submissions:edgar:"), "request_key").alias("landing_key"), "request_key",
        F.to_json(F.struct("sic", F.col("industry").alias("sicDescription"))).alias("text"),
    )
    parts = F.split("request_key", ":", 2)
    return edgar.parse_submissions(payloads).good.select(
        parts[0].alias("ticker"), parts[1].alias("cik"), "sic", "industry"
    )


@query("SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS ticker, 100000 + s_suppkey AS cik FROM supplier")
def parse_cik_map(spark, d):
    """Ticker-to-CIK maps in parts of a thousand companies."""
    s = F.col("s_suppkey")
    entry = F.struct((F.lit(100000) + s).alias("cik_str"), F.concat(F.lit("s"), s).alias("ticker"), F.lit("t").alias("title"))
    payloads = (
        fx.table(spark, d, "supplier")
        .groupBy(F.floor(s / 1000).alias("part"))
        .agg(F.map_from_entries(F.collect_list(F.struct(s.cast("string"), entry))).alias("m"))
        .select(
            F.concat_ws(":", F.lit("edgar_company_tickers:edgar"), "part").alias("landing_key"),
            F.to_json("m").alias("text"),
        )
    )
    return edgar.parse_cik_map(payloads).good.select("ticker", "cik")


# --- streaming ------------------------------------------------------------------------------
# Each runs a stream over the table's files until they are used up and returns what it left behind.


def _event_stream(spark, d):
    return (
        spark.readStream.schema(fx.TABLES["events"])
        .option("pathGlobFilter", "events.parquet")
        .parquet(d)
    )


def _drain(writer):
    writer.trigger(availableNow=True).start().awaitTermination()


@query(
    f"""SELECT ticker, {us('minute_ts')}, {rnd('bid_close', 'ask_close')}, n_quotes FROM (
          SELECT ticker, date_trunc('minute', ts) AS minute_ts, arg_max(bid, (ts, pos)) AS bid_close,
                 arg_max(ask, (ts, pos)) AS ask_close, count(*) AS n_quotes
          FROM quotes WHERE bid > 0 AND ask > 0 GROUP BY 1, 2)
        WHERE minute_ts + INTERVAL 1 MINUTE <= (SELECT max(ts) FROM quotes WHERE bid > 0 AND ask > 0) - INTERVAL 10 MINUTE""",
    stamps=("minute_ts",),
)
def stream_quote_buckets(spark, d):
    root = scratch(spark, "buckets")
    stream = market.minute_buckets(fx.quotes_of(_event_stream(spark, d)))
    _drain(
        stream.writeStream.format("parquet").option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/checkpoint")
    )
    return spark.read.schema(stream.schema).parquet(f"{root}/out")


@query(
    "SELECT DISTINCT event_type AS ticker, epoch_us(date_trunc('hour', ts)) AS minute_ts FROM events",
    stamps=("minute_ts",),
)
def stream_first_minutes(spark, d):
    root = scratch(spark, "minutes")
    rows = _event_stream(spark, d).select(
        F.col("event_type").alias("ticker"),
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("minute_ts"), "value",
    )
    stream = market.first_minutes(rows)
    _drain(
        stream.writeStream.format("parquet").option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/checkpoint")
    )
    return spark.read.schema(stream.schema).parquet(f"{root}/out").select("ticker", "minute_ts")


def _arriving(rows: DataFrame, root: str, lots: int, lot: Column) -> str:
    """A folder of files, one per value of `lot`, for a stream that takes one a micro-batch."""
    path = f"{root}/arriving"
    rows.withColumn("lot", lot).repartitionByRange(lots, "lot").drop("lot").write.parquet(path)
    return path


def _ticks_out_of_order(spark, d, root):
    """Quote ticks as a stream of six files; each has ticks of every session, so most come late."""
    path = _arriving(fx.quotes(spark, d), root, 6, F.col("pos") * 7 % 6)
    return market.parquet_stream(spark, path, market.TICKS, files_per_batch=1)


@query(_QUOTE_OUT + "quote_bars_minute", stamps=("minute_ts",))
def stream_quote_twm(spark, d):
    """Time-weighted bars kept right while ticks of all sessions keep coming in, six micro-batches of them."""
    root = scratch(spark, "weights")
    lake = Lake(spark, root)
    run = market.weighted_touched(lake, staged(fx.quote_sessions(spark, d), "sessions"))
    _drain(market.start_each_batch(_ticks_out_of_order(spark, d, root), run, f"{root}/checkpoint"))
    return lake.read("live_quote_bars", market.LIVE_BARS).select(*quotes.QUOTE_BAR)


@query(
    f"""SELECT ticker, {us('minute_ts')}, {rnd('bid_close', 'ask_close')}, n_quotes FROM (
          SELECT ticker, date_trunc('minute', ts) AS minute_ts, arg_max(bid, (ts, pos)) AS bid_close,
                 arg_max(ask, (ts, pos)) AS ask_close, count(*) AS n_quotes
          FROM quotes WHERE bid > 0 AND ask > 0 GROUP BY 1, 2)""",
    stamps=("minute_ts",),
)
def stream_late_buckets(spark, d):
    """Minute buckets of ticks out of order: late ones count, and buckets that are open are there."""
    root = scratch(spark, "late")
    lake = Lake(spark, root)
    run = market.bucket_partials(lake)
    _drain(market.start_each_batch(_ticks_out_of_order(spark, d, root), run, f"{root}/checkpoint"))
    return market.merged_buckets(lake)


@query(
    """SELECT ticker, minute_ts, value FROM (
          SELECT event_type AS ticker, epoch_us(date_trunc('hour', ts)) AS minute_ts, round(value, 6) + 0e0 AS value,
                 row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY event_id * 7 % 6, event_id) AS rn
          FROM events) WHERE rn = 1""",
    stamps=("minute_ts",),
)
def stream_first_values(spark, d):
    """The first writer's value per name and hour of six files in a row, whatever hours they hold."""
    root = scratch(spark, "first")
    lake, ddl = Lake(spark, root), "ticker string, minute_ts timestamp, value double, event_id bigint"
    rows = fx.table(spark, d, "events").select(
        F.col("event_type").alias("ticker"), F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("minute_ts"),
        "value", "event_id", (F.col("event_id") * 7 % 6).alias("lot"),
    )
    run = market.minute_partials(lake, ["event_id"])
    for lot in range(6):  # in this order; a folder's files have none
        rows.filter(F.col("lot") == lot).coalesce(1).write.parquet(f"{root}/in/{lot}")
        stream = market.parquet_stream(spark, f"{root}/in/*", ddl)
        _drain(market.start_each_batch(stream, run, f"{root}/checkpoint"))
    return market.merged_minutes(lake, ddl).select("ticker", "minute_ts", "value")


@query(
    f"SELECT ticker, {day('bar_date')}, {rnd('close', digits=8)}, grade, single_source FROM screened_latest",
    digits=8, bools=("single_source",),
)
def stream_votes(spark, d):
    """Bar events arriving in five micro-batches, four of some tickers each and one of a vendor that comes later
    for all, voted again per ticker into canonical history."""
    root = scratch(spark, "votes")
    lake = Lake(spark, root)
    rows = fx.bar_events(spark, d).withColumns(
        {
            "event_id": F.uuid(), "vendor_adjusted": F.lit(False), "reversal_factor": F.lit(1.0),
            "landing_key": F.lit("k"),
        }
    )
    late = F.when(F.col("source") == "alpaca_iex", 4).otherwise(F.pmod(F.xxhash64("ticker"), F.lit(4)))
    path = _arriving(rows.select(*schemas.names(schemas.BAR_EVENTS)), root, 5, late)
    stream = market.parquet_stream(spark, path, schemas.BAR_EVENTS, files_per_batch=1)
    _drain(market.start_each_batch(stream, market.vote_touched(lake), f"{root}/checkpoint"))
    return lake.read("bars_daily").filter("is_current").select(
        "ticker", "bar_date", "close", "grade", "single_source"
    )


# --- staged plans ---------------------------------------------------------------------------


@query(f"SELECT ticker, {day('effective_date')}, {rnd(*OHLCV, digits=4)} FROM pit", digits=4)
def pit_adjusted_staged(spark, d):
    """Point-in-time bars with the factor intervals stored first, as a night publishes them.

    The planner reads their size from storage and broadcasts them when small: bars are not shuffled.
    """
    bars = fx.bars(spark, d)
    steps = adjust.cumulative_factors(adjust.adjustment_factors(bars, fx.actions(spark, d)))
    return adjust.adjust_with(bars, staged(steps, "steps"))


@query(
    f"""SELECT ticker, {day('bar_date')}, source, open, knowledge_time, reversal_factor FROM (
          SELECT ticker, bar_date, 'stooq' AS source, round(open * f, 4) + 0e0 AS open,
                 epoch_us(timezone('America/New_York', bar_date + INTERVAL '23:59:59')) AS knowledge_time,
                 round(f, 4) + 0e0 AS reversal_factor FROM reversal)""",
    digits=4, stamps=("knowledge_time",),
)
def bar_envelope(spark, d):
    """Vendor bars made raw and wrapped as events, without the random id."""
    current = fx.bars(spark, d).filter("is_current").select("ticker", "bar_date", *OHLCV)
    raw = adjust.reverse_splits(current, adjust.current_splits(fx.actions(spark, d)))
    wrapped = event_store.bar_envelope(raw.withColumn("landing_key", F.lit("k")), "stooq", True, now())
    return wrapped.select("ticker", "bar_date", "source", "open", "knowledge_time", "reversal_factor")
