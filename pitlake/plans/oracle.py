"""The registered queries restated as plain SQL over the same parquet tables.

Fixtures are shared CTEs; each query pulls in only those it names.
"""

from __future__ import annotations

import re

CTES = {
    "base": """
        SELECT *, (1000 + (dn * 7 + bn * 13) % 11) / 10e0 AS px FROM (
          SELECT p_brand AS ticker, CAST(l_shipdate AS DATE) AS bar_date, min(l_orderkey) AS k,
                 sum(l_quantity) * 1000e0 AS vol, CAST(substr(p_brand, 7) AS INTEGER) AS bn,
                 date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS dn
          FROM lineitem JOIN part ON l_partkey = p_partkey
          GROUP BY p_brand, CAST(l_shipdate AS DATE))""",
    "vendor_cells": """
        SELECT 'yfinance' AS source, ticker, bar_date, k,
               px * CASE WHEN k % 97 = 0 THEN 3e0 ELSE 1e0 END AS c1, 1e0 AS rev, vol AS volume
        FROM base WHERE k % 20 <> 0
        UNION ALL
        SELECT 'stooq', ticker, bar_date, k,
               px * CASE WHEN k % 31 = 0 THEN 1.02e0 ELSE 1.0005e0 END,
               CASE WHEN k % 41 = 0 THEN 1.001e0 ELSE 1e0 END,
               vol * CASE WHEN k % 13 = 0 THEN 1.2e0 ELSE 1.02e0 END
        FROM base WHERE k % 3 <> 0
        UNION ALL
        SELECT 'alpaca_iex', ticker, bar_date, k,
               px * CASE WHEN k % 31 = 0 THEN 1.04e0 ELSE 1.0002e0 END, 1e0, vol * 0.02e0
        FROM base WHERE k % 7 <> 0""",
    "obs": """
        SELECT source, ticker, bar_date, k, c1 * 0.99e0 AS open, c1 * 1.01e0 AS high,
               c1 * 0.98e0 AS low, c1 AS close, volume FROM vendor_cells""",
    "obs2": """
        SELECT source, ticker, bar_date, k, c1 * rev * 0.99e0 AS open, c1 * rev * 1.01e0 AS high,
               c1 * rev * 0.98e0 AS low, c1 * rev AS close, volume FROM vendor_cells""",
    "bar_events": """
        SELECT source, ticker, bar_date, k, open * s AS open, high * s AS high, low * s AS low,
               close * s AS close, volume,
               CASE WHEN v = 3 THEN '1m' ELSE '1d' END AS interval,
               CASE WHEN v = 1 THEN 2 ELSE 1 END AS written_at,
               CASE WHEN v = 2 THEN 'h-' || CAST(k % 2 * 9 AS VARCHAR) ELSE 'h-5' END AS payload_hash
        FROM (SELECT *, CASE v WHEN 1 THEN 1.001e0 WHEN 2 THEN 0.999e0 WHEN 3 THEN 7e0 ELSE 1e0 END AS s
              FROM obs JOIN (VALUES (0), (1), (2), (3)) t(v)
                ON v = 0 OR (v = 1 AND k % 41 = 0) OR (v = 2 AND k % 43 = 0) OR (v = 3 AND k % 47 = 0))""",
    "latest": """
        SELECT source, ticker, bar_date, k, open, high, low, close, volume, payload_hash FROM (
          SELECT *, row_number() OVER (PARTITION BY source, ticker, bar_date
                                       ORDER BY written_at DESC, payload_hash DESC) AS rn
          FROM bar_events WHERE interval = '1d') WHERE rn = 1""",
    "bars": """
        SELECT ticker, bar_date, k, c * 0.99e0 AS open, c * 1.01e0 AS high, c * 0.98e0 AS low,
               c AS close, vol AS volume,
               CASE WHEN k % 3 = 0 THEN 'yfinance' ELSE 'yfinance,stooq' END AS source_set,
               CASE WHEN k % 53 = 0 THEN 'quarantined' WHEN k % 3 = 0 THEN 'degraded' ELSE 'good' END AS grade,
               k % 3 = 0 AS single_source,
               CASE WHEN seq = 2 THEN TIMESTAMP '2002-01-02' ELSE eod END AS valid_from,
               CASE WHEN stale THEN TIMESTAMP '2002-01-02' END AS valid_to,
               NOT stale AS is_current, seq AS revision_seq
        FROM (SELECT *, px * CASE WHEN stale THEN 0.5e0 ELSE 1e0 END AS c,
                     timezone('UTC', timezone('America/New_York', bar_date + INTERVAL '23:59:59')) AS eod
              FROM (SELECT *, k % 29 = 0 AND seq = 1 AS stale
                    FROM base JOIN (VALUES (1), (2)) t(seq) ON seq = 1 OR k % 29 = 0))""",
    "live_bars": "SELECT * FROM bars WHERE is_current AND grade <> 'quarantined'",
    "tickers": """
        SELECT DISTINCT p_brand AS ticker, CAST(substr(p_brand, 7) AS INTEGER) AS bn FROM part""",
    "split_rows": """
        SELECT ticker, DATE '1997-01-01' + bn * 5 AS ex_date, 2e0 AS ratio,
               DATE '1997-01-01' + bn * 5 AS known, TRUE AS is_current FROM tickers
        UNION ALL
        SELECT ticker, DATE '1999-06-01' + bn * 3, CASE WHEN bn % 2 = 0 THEN 3e0 ELSE 0.5e0 END,
               DATE '1999-06-01' + bn * 3 + 30, TRUE FROM tickers
        UNION ALL
        SELECT ticker, DATE '1997-01-01' + bn * 5, 5e0, DATE '1997-01-01' + bn * 5, FALSE FROM tickers""",
    "dividend_rows": """
        SELECT DISTINCT ticker, CAST(date_trunc('quarter', bar_date) AS DATE) AS ex_date,
               (bn + 25) / 100e0 AS cash_amount FROM base WHERE bn % 3 = 0""",
    "actions": """
        SELECT ticker, 'split' AS action_type, ex_date, ratio, CAST(NULL AS DOUBLE) AS cash_amount,
               known, is_current FROM split_rows
        UNION ALL
        SELECT ticker, 'dividend', ex_date, NULL, cash_amount, ex_date, TRUE FROM dividend_rows""",
    "priors": """
        SELECT ticker, ex_date, arg_max(close, bar_date) AS prior_close
        FROM (SELECT DISTINCT d.ticker, d.ex_date, b.bar_date, b.close
              FROM dividend_rows d JOIN live_bars b ON b.ticker = d.ticker AND b.bar_date < d.ex_date)
        GROUP BY ticker, ex_date""",
    "factors": """
        SELECT ticker, ex_date, 'split' AS factor_type, ratio AS factor, known FROM actions
        WHERE is_current AND action_type = 'split' AND ratio > 0
        UNION ALL
        SELECT a.ticker, a.ex_date, 'dividend', prior_close / (prior_close - cash_amount), known
        FROM actions a JOIN priors p ON p.ticker = a.ticker AND p.ex_date = a.ex_date
        WHERE is_current AND action_type = 'dividend' AND cash_amount > 0 AND prior_close > cash_amount""",
    "cum": """
        SELECT b.ticker, b.bar_date,
               coalesce(exp(sum(ln(factor)) FILTER (WHERE f.ex_date <= b.bar_date AND known <= b.bar_date)), 1e0) AS cum,
               coalesce(exp(sum(ln(factor)) FILTER (WHERE factor_type = 'split' AND f.ex_date <= b.bar_date
                                                    AND known <= b.bar_date)), 1e0) AS split_cum
        FROM live_bars b LEFT JOIN factors f ON f.ticker = b.ticker GROUP BY b.ticker, b.bar_date""",
    "pit": """
        SELECT b.ticker, b.bar_date AS effective_date, open * cum AS open, high * cum AS high,
               low * cum AS low, close * cum AS close, volume / split_cum AS volume
        FROM live_bars b JOIN cum c ON c.ticker = b.ticker AND c.bar_date = b.bar_date""",
    "reversal": """
        SELECT b.ticker, b.bar_date, b.open, b.high, b.low, b.close, b.volume,
               coalesce(exp(sum(ln(s.ratio))), 1e0) AS f
        FROM (SELECT * FROM bars WHERE is_current) b
        LEFT JOIN (SELECT * FROM split_rows WHERE is_current) s
          ON s.ticker = b.ticker AND s.ex_date > b.bar_date
        GROUP BY ALL""",
    **{
        f"wide{n}": f"""
        SELECT ticker, bar_date,
               {", ".join(f"max({f}) FILTER (WHERE source = '{s}') AS {f}_{s}"
                          for s in ("yfinance", "stooq", "alpaca_iex")
                          for f in ("open", "high", "low", "close", "volume"))}
        FROM {src} GROUP BY ticker, bar_date"""
        for n, src in (("", "obs"), ("2", "obs2"), ("_latest", "latest"))
    },
    **{
        name: sql
        for n in ("", "2", "_latest")
        for name, sql in {
            f"agree{n}": f"""
        SELECT * EXCLUDE (p1, p2, p3), p1 OR p2 AS backed_yfinance, p1 OR p3 AS backed_stooq, p2 OR p3 AS backed_alpaca_iex
        FROM (SELECT *, (close_yfinance IS NOT NULL)::INT + (close_stooq IS NOT NULL)::INT
                  + (close_alpaca_iex IS NOT NULL)::INT AS n_sources,
               coalesce(abs(close_yfinance - close_stooq)
                 / greatest((abs(close_yfinance) + abs(close_stooq)) / 2, 1e-12) <= 0.001, FALSE) AS p1,
               coalesce(abs(close_yfinance - close_alpaca_iex)
                 / greatest((abs(close_yfinance) + abs(close_alpaca_iex)) / 2, 1e-12) <= 0.001, FALSE) AS p2,
               coalesce(abs(close_stooq - close_alpaca_iex)
                 / greatest((abs(close_stooq) + abs(close_alpaca_iex)) / 2, 1e-12) <= 0.001, FALSE) AS p3
        FROM wide{n})""",
            f"verdicts{n}": f"""
        SELECT *,
               CASE WHEN n_sources = 0 THEN 'empty'
                    WHEN n_sources = 1 AND close_alpaca_iex IS NOT NULL THEN 'alpaca_only_skipped'
                    WHEN n_sources = 1 THEN 'single_source'
                    WHEN backed_yfinance OR backed_stooq THEN 'confirmed'
                    ELSE 'conflict' END AS verdict,
               CASE WHEN n_sources = 1 AND close_yfinance IS NOT NULL THEN 'yfinance'
                    WHEN n_sources = 1 AND close_stooq IS NOT NULL THEN 'stooq'
                    WHEN backed_yfinance THEN 'yfinance'
                    WHEN backed_stooq THEN 'stooq'
                    WHEN close_yfinance IS NOT NULL THEN 'yfinance'
                    WHEN close_stooq IS NOT NULL THEN 'stooq' END AS chosen_source
        FROM agree{n}""",
            f"voted{n}": f"""
        SELECT ticker, bar_date, open, high, low, close, volume, source_set,
               CASE WHEN verdict = 'confirmed' AND volume_agrees IS FALSE THEN 'degraded'
                    WHEN verdict = 'confirmed' THEN 'good'
                    WHEN verdict = 'single_source' THEN 'degraded' ELSE 'quarantined' END AS grade,
               verdict = 'single_source' AS single_source, verdict, chosen_source, n_sources,
               close_stooq, close_yfinance, close_alpaca_iex AS close_alpaca, volume_agrees
        FROM (SELECT *,
                CASE chosen_source WHEN 'yfinance' THEN open_yfinance WHEN 'stooq' THEN open_stooq END AS open,
                CASE chosen_source WHEN 'yfinance' THEN high_yfinance WHEN 'stooq' THEN high_stooq END AS high,
                CASE chosen_source WHEN 'yfinance' THEN low_yfinance WHEN 'stooq' THEN low_stooq END AS low,
                CASE chosen_source WHEN 'yfinance' THEN close_yfinance WHEN 'stooq' THEN close_stooq END AS close,
                CASE WHEN chosen_source = 'yfinance' THEN coalesce(volume_yfinance, volume_stooq)
                     ELSE coalesce(volume_stooq, volume_yfinance) END AS volume,
                abs(volume_yfinance - volume_stooq)
                  / CASE WHEN volume_yfinance IS NOT NULL AND volume_stooq IS NOT NULL
                         THEN greatest((abs(volume_yfinance) + abs(volume_stooq)) / 2, 1e0) END <= 0.05 AS volume_agrees,
                concat_ws(',', CASE WHEN close_yfinance IS NOT NULL THEN 'yfinance' END,
                               CASE WHEN close_stooq IS NOT NULL THEN 'stooq' END,
                               CASE WHEN close_alpaca_iex IS NOT NULL THEN 'alpaca_iex' END) AS source_set
              FROM verdicts{n})
        WHERE verdict NOT IN ('empty', 'alpaca_only_skipped')""",
            f"screened{n}": f"""
        SELECT * EXCLUDE (r, med, mad, n, grade),
               coalesce(n >= 30 AND mad > 0 AND abs(r - med) > 15 * mad, FALSE) AS mad_flag,
               CASE WHEN single_source AND coalesce(n >= 30 AND mad > 0 AND abs(r - med) > 15 * mad, FALSE)
                    THEN 'quarantined' ELSE grade END AS grade
        FROM (SELECT v.*, med, n, median(abs(r - med)) OVER (PARTITION BY v.ticker) AS mad
              FROM (SELECT *, ln(close) - lag(ln(close)) OVER (PARTITION BY ticker ORDER BY bar_date) AS r
                    FROM voted{n}) v
              JOIN (SELECT ticker, median(r) AS med, count(r) AS n
                    FROM (SELECT ticker, ln(close) - lag(ln(close)) OVER (PARTITION BY ticker ORDER BY bar_date) AS r
                          FROM voted{n}) GROUP BY ticker) m ON m.ticker = v.ticker)""",
        }.items()
    },
    # two nights of SCD-2 by rules, night 2 detected at 2002-02-01
    "nights": """
        SELECT coalesce(a.ticker, b.ticker) AS ticker, coalesce(a.bar_date, b.bar_date) AS bar_date,
               a.close AS c1, a.grade AS g1, b.close AS c2, b.grade AS g2,
               a.ticker IS NULL AS is_new, b.ticker IS NULL AS is_absent,
               a.ticker IS NOT NULL AND b.ticker IS NOT NULL AND (
                 a.open IS DISTINCT FROM b.open OR a.high IS DISTINCT FROM b.high
                 OR a.low IS DISTINCT FROM b.low OR a.close IS DISTINCT FROM b.close
                 OR a.volume IS DISTINCT FROM b.volume OR a.source_set <> b.source_set
                 OR a.grade <> b.grade OR a.single_source <> b.single_source) AS is_revised
        FROM screened a FULL JOIN screened2 b ON a.ticker = b.ticker AND a.bar_date = b.bar_date""",
    "two_nights": """
        SELECT ticker, bar_date, c1 AS close, g1 AS grade, eod AS valid_from,
               CASE WHEN is_revised THEN TIMESTAMP '2002-02-01' END AS valid_to,
               NOT is_revised AS is_current, 1 AS revision_seq
        FROM (SELECT *, timezone('UTC', timezone('America/New_York', bar_date + INTERVAL '23:59:59')) AS eod FROM nights)
        WHERE NOT is_new
        UNION ALL
        SELECT ticker, bar_date, c2, g2,
               CASE WHEN is_new THEN timezone('UTC', timezone('America/New_York', bar_date + INTERVAL '23:59:59'))
                    ELSE TIMESTAMP '2002-02-01' END,
               NULL, TRUE, CASE WHEN is_new THEN 1 ELSE 2 END
        FROM nights WHERE is_new OR is_revised""",
    "action_events": """
        SELECT ticker, action_type, ex_date, ratio * s AS ratio, cash_amount * s AS cash_amount, v
        FROM (SELECT *, CASE WHEN v = 1 THEN 2e0 ELSE 1e0 END AS s
              FROM (SELECT * FROM actions WHERE is_current) a
              JOIN (VALUES (0), (1)) t(v) ON v = 0 OR day(ex_date) % 3 = 0)""",
    "quotes": """
        SELECT event_type AS ticker, CAST(ts AS DATE) AS session_date,
               CASE WHEN event_id % 4 = 0 THEN date_trunc('hour', ts) ELSE ts END AS ts, event_id AS pos,
               CASE WHEN event_id % 11 = 0 THEN 0e0 ELSE value END AS bid, value * 1.001e0 AS ask
        FROM events""",
    "quote_sessions": """
        SELECT DISTINCT CAST(ts AS DATE) AS session_date,
               date_trunc('day', ts) + CASE WHEN day(ts) = 3 THEN INTERVAL 18 HOUR ELSE INTERVAL 21 HOUR END AS close_utc
        FROM events WHERE day(ts) % 7 <> 0""",
    **{
        f"quote_bars_{label}": f"""
        SELECT ticker, bucket AS minute_ts, arg_max(bid, (ts, pos)) AS bid_close,
               arg_max(ask, (ts, pos)) AS ask_close,
               sum(bid * w) / greatest(sum(w), 1) AS bid_twm, sum(ask * w) / greatest(sum(w), 1) AS ask_twm,
               count(*) AS n_quotes
        FROM (SELECT *, greatest(0, epoch_us(least(coalesce(next_ts, close_utc), bucket + INTERVAL 1 {label}))
                                    - epoch_us(ts)) AS w
              FROM (SELECT q.*, close_utc, date_trunc('{label}', ts) AS bucket,
                           lead(ts) OVER (PARTITION BY ticker, q.session_date ORDER BY ts, pos) AS next_ts
                    FROM quotes q JOIN quote_sessions s ON s.session_date = q.session_date
                    WHERE bid > 0 AND ask > 0))
        GROUP BY ticker, bucket"""
        for label in ("minute", "hour")
    },
    "minutes": """
        SELECT event_type AS ticker, date_trunc('hour', ts) AS minute_ts,
               arg_max(value, (ts, event_id)) AS close, sum(value) AS volume
        FROM events WHERE event_id % 3 <> 2 GROUP BY 1, 2""",
    "ranges": """
        SELECT event_type AS ticker, CAST(ts AS DATE) AS bar_date, max(value) AS high, min(value) AS low
        FROM events GROUP BY 1, 2""",
    "cs": """
        SELECT ticker, bar_date,
               greatest(2 * (exp(a) - 1) / (1 + exp(a)), 0e0) AS cs_spread
        FROM (SELECT *, (sqrt(2 * beta) - sqrt(beta)) / (3e0 - 2e0 * sqrt(2e0))
                        - sqrt(gamma / (3e0 - 2e0 * sqrt(2e0))) AS a
              FROM (SELECT ticker, bar_date,
                           power(ln(high) - ln(low), 2) + power(h0 - l0, 2) AS beta,
                           power(greatest(ln(high), h0) - least(ln(low), l0), 2) AS gamma
                    FROM (SELECT *, lag(ln(high)) OVER (PARTITION BY ticker ORDER BY bar_date) AS h0,
                                 lag(ln(low)) OVER (PARTITION BY ticker ORDER BY bar_date) AS l0
                          FROM ranges WHERE high > 0 AND low > 0) WHERE h0 IS NOT NULL))""",
    "hybrid": """
        SELECT m.ticker, m.minute_ts,
               CASE WHEN bid_close IS NOT NULL AND ask_close IS NOT NULL THEN bid_close
                    ELSE close * (1 - coalesce(cs_spread, 0) / 2) END AS bid,
               CASE WHEN bid_close IS NOT NULL AND ask_close IS NOT NULL THEN ask_close
                    ELSE close * (1 + coalesce(cs_spread, 0) / 2) END AS ask,
               m.volume,
               CASE WHEN bid_close IS NOT NULL AND ask_close IS NOT NULL THEN 'iex_bbo'
                    ELSE 'corwin_schultz' END AS derivation
        FROM minutes m LEFT JOIN quote_bars_hour q ON q.ticker = m.ticker AND q.minute_ts = m.minute_ts
        LEFT JOIN cs ON cs.ticker = m.ticker
          AND cs.bar_date = CAST(timezone('America/New_York', timezone('UTC', m.minute_ts)) AS DATE)""",
    "snapshots": """
        SELECT DISTINCT CASE WHEN o_orderkey % 2 = 0 THEN 'nasdaqlisted' ELSE 'otherlisted' END AS source,
               CAST(date_trunc('quarter', o_orderdate) AS DATE) AS snapshot_date,
               'C' || CAST(o_custkey AS VARCHAR) AS ticker
        FROM orders
        WHERE NOT (o_orderkey % 2 <> 0 AND month(date_trunc('quarter', o_orderdate)) = 7)""",
    "complete_dates": """
        SELECT snapshot_date FROM snapshots GROUP BY snapshot_date HAVING count(DISTINCT source) = 2""",
    "gone": """
        SELECT ticker, (SELECT min(snapshot_date) FROM complete_dates c WHERE c.snapshot_date > last_seen)
                 AS termination_date
        FROM (SELECT ticker, max(snapshot_date) AS last_seen FROM snapshots
              WHERE snapshot_date IN (SELECT snapshot_date FROM complete_dates) GROUP BY ticker)
        WHERE last_seen < (SELECT max(snapshot_date) FROM complete_dates)""",
    "delisted": """
        SELECT 'C' || CAST(c_custkey AS VARCHAR) AS ticker,
               DATE '1999-01-01' + CAST(c_custkey % 500 AS INTEGER) AS termination_date, c_custkey AS position
        FROM customer WHERE c_custkey % 50 = 0
        UNION ALL
        SELECT ticker, DATE '1999-01-01' + bn * 40 + v * 7, bn + v * 1000
        FROM tickers JOIN (VALUES (0), (1)) t(v) ON TRUE""",
    "dead": """
        SELECT ticker, termination_date, detection_source FROM (
          SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY rank, position) AS rn FROM (
            SELECT ticker, termination_date, 'polygon' AS detection_source, 0 AS rank, position FROM delisted
            UNION ALL SELECT ticker, termination_date, 'symbol_dirs_diff', 1, 0 FROM gone))
        WHERE rn = 1""",
    "dead_returns": """
        SELECT d.*, (SELECT struct_pack(r := ret) FROM (
                       SELECT ticker, bar_date, close / lag(close) OVER (PARTITION BY ticker ORDER BY bar_date) - 1 AS ret
                       FROM live_bars) b
                     WHERE b.ticker = d.ticker AND b.bar_date <= d.termination_date
                     ORDER BY bar_date DESC LIMIT 1).r AS terminal_return
        FROM dead d""",
    "coverage_rows": """
        SELECT audit_window, window_start, count(d.ticker) AS expected_n,
               count(d.ticker) FILTER (WHERE d.ticker IN (SELECT ticker FROM bars WHERE is_current)) AS covered_n
        FROM (SELECT '10y' AS audit_window, DATE '2002-01-31' - 3653 AS window_start
              UNION ALL SELECT 'since_golive', min(snapshot_date) FROM snapshots) w
        LEFT JOIN dead d ON d.termination_date >= w.window_start
        GROUP BY audit_window, window_start""",
    "sessions": """
        SELECT DISTINCT 'XNYS' AS exchange, CAST(o_orderdate AS DATE) AS session_date,
               CAST(o_orderdate AS DATE) + INTERVAL '14:30:00' AS open_utc,
               CAST(o_orderdate AS DATE) + CASE WHEN day(o_orderdate) = 3 THEN INTERVAL 18 HOUR
                                                ELSE INTERVAL 21 HOUR END AS close_utc
        FROM orders""",
    "submissions": """
        SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS ticker, CAST(100000 + s_suppkey + v * 500000 AS VARCHAR) AS cik,
               CASE WHEN s_suppkey % 13 = 5 THEN '' WHEN s_suppkey % 17 = 4 THEN 'garbage'
                    ELSE CAST(1000 + (s_suppkey * 137) % 8000 + v AS VARCHAR) END AS sic,
               'industry ' || CAST(s_suppkey % 7 AS VARCHAR) AS industry
        FROM supplier JOIN (VALUES (0), (1)) t(v) ON v = 0 OR s_suppkey % 10 = 3""",
    "sic_ranges": """
        SELECT * FROM (VALUES
          (1, 3570, 3579, 'XLK'), (2, 3600, 3699, 'XLK'), (3, 7370, 7379, 'XLK'), (4, 2700, 2799, 'XLC'),
          (5, 4800, 4899, 'XLC'), (6, 7800, 7899, 'XLC'), (7, 2830, 2839, 'XLV'), (8, 3840, 3859, 'XLV'),
          (9, 8000, 8099, 'XLV'), (10, 6000, 6499, 'XLF'), (11, 6700, 6799, 'XLF'), (12, 6500, 6599, 'XLRE'),
          (13, 1300, 1399, 'XLE'), (14, 2900, 2999, 'XLE'), (15, 1000, 1299, 'XLB'), (16, 2600, 2699, 'XLB'),
          (17, 2800, 2829, 'XLB'), (18, 2840, 2899, 'XLB'), (19, 3200, 3399, 'XLB'), (20, 2000, 2199, 'XLP'),
          (21, 5400, 5499, 'XLP'), (22, 5912, 5912, 'XLP'), (23, 2300, 2399, 'XLY'), (24, 3700, 3719, 'XLY'),
          (25, 5000, 5999, 'XLY'), (26, 7000, 7299, 'XLY'), (27, 5800, 5899, 'XLY'), (28, 4900, 4999, 'XLU'),
          (29, 1500, 1799, 'XLI'), (30, 3400, 3569, 'XLI'), (31, 3580, 3599, 'XLI'), (32, 3720, 3799, 'XLI'),
          (33, 4000, 4799, 'XLI'), (34, 8700, 8799, 'XLI')) t(ord, lo, hi, sector)""",
    "sectored": """
        SELECT s.*, (SELECT arg_min(sector, ord) FROM sic_ranges r
                     WHERE TRY_CAST(s.sic AS INTEGER) BETWEEN r.lo AND r.hi) AS sector
        FROM submissions s""",
    "sector_rows": """
        SELECT ticker, cik, nullif(sic, '') AS sic, sector, industry FROM (
          SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY cik DESC) AS rn FROM sectored)
        WHERE rn = 1""",
    "peer": """
        SELECT ticker, bar_date, open, high, low,
               CASE WHEN k % 23 <> 0 THEN close * CASE WHEN k % 17 = 0 THEN 1.01e0 ELSE 1.0002e0 END END AS close,
               volume
        FROM bars WHERE is_current""",
    "parity": """
        SELECT ticker, bar_date, field, ours, theirs, rel_diff,
               coalesce(rel_diff <= tol, ours IS NULL AND theirs IS NULL) AS within_tol
        FROM (SELECT *, abs(ours - theirs)
                        / CASE WHEN (abs(ours) + abs(theirs)) / 2 = 0 THEN 1e0 ELSE (abs(ours) + abs(theirs)) / 2 END AS rel_diff
              FROM (SELECT b.ticker, b.bar_date, t.field, t.tol,
                           CASE t.field WHEN 'open' THEN b.open WHEN 'high' THEN b.high WHEN 'low' THEN b.low
                                        WHEN 'close' THEN b.close ELSE b.volume END AS ours,
                           CASE t.field WHEN 'open' THEN p.open WHEN 'high' THEN p.high WHEN 'low' THEN p.low
                                        WHEN 'close' THEN p.close ELSE p.volume END AS theirs
                    FROM live_bars b LEFT JOIN peer p ON p.ticker = b.ticker AND p.bar_date = b.bar_date
                    JOIN (VALUES ('open', 0.001e0), ('high', 0.001e0), ('low', 0.001e0), ('close', 0.001e0),
                                 ('volume', 0.05e0)) t(field, tol) ON TRUE))""",
    "manifest": """
        SELECT 'yf_daily' AS dataset, 'yfinance' AS source, ticker, bar_date, k,
               ticker || ':' || CASE WHEN k % 997 = 0 THEN 'history:' ELSE '' END || CAST(bar_date AS VARCHAR) AS request_key,
               'landing/yf_daily/' || ticker || '/' || CAST(bar_date AS VARCHAR) AS path
        FROM base WHERE k % 5 <> 0""",
    "letters": """
        SELECT date_diff('day', DATE '1995-01-01', bar_date) * 1000 + CAST(substr(ticker, 7) AS BIGINT) AS id, ticker, bar_date,
               ticker || ':' || CAST(bar_date AS VARCHAR) AS request_key,
               TIMESTAMP '2002-01-01' + to_days(CAST(day(bar_date) AS INTEGER)) AS first_seen,
               CASE WHEN day(bar_date) % 2 = 0 THEN TIMESTAMP '2002-03-01' END AS resolved_at
        FROM voted WHERE verdict = 'conflict'""",
}

_NAMES = re.compile(r"\b(" + "|".join(sorted(CTES, key=len, reverse=True)) + r")\b")


def with_ctes(body: str) -> str:
    """Prefix a query with the fixtures it uses, directly or through others."""
    needed: set[str] = set()
    stack = [body]
    while stack:
        for name in _NAMES.findall(stack.pop()):
            if name not in needed:
                needed.add(name)
                stack.append(CTES[name])
    parts = [f"{name} AS ({sql})" for name, sql in CTES.items() if name in needed]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


def day(c: str, name: str | None = None) -> str:
    return f"CAST({c} AS VARCHAR) AS {name or c.split('.')[-1]}"


def rnd(*cols: str, digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) + 0e0 AS {c.split('.')[-1]}" for c in cols)


def us(c: str) -> str:
    return f"epoch_us({c}) AS {c}"


def as_text(sql: str, bools: tuple[str, ...] = (), stamps: tuple[str, ...] = ()) -> str:
    """Flags and instants (given as epoch microseconds) as text, so nulls compare alike everywhere."""
    swaps = [f"CAST({b} AS VARCHAR) AS {b}" for b in bools]
    swaps += [f"strftime(make_timestamp({t}), '%Y-%m-%d %H:%M:%S.%f') AS {t}" for t in stamps]
    return f"SELECT * REPLACE ({', '.join(swaps)}) FROM ({sql})" if swaps else sql


OHLCV = ("open", "high", "low", "close", "volume")
VOTE_OUT = (
    f"ticker, {day('bar_date')}, {rnd(*OHLCV, digits=8)}, source_set, grade, single_source, verdict, "
    f"chosen_source, CAST(n_sources AS BIGINT) AS n_sources, "
    f"{rnd('close_stooq', 'close_yfinance', 'close_alpaca', digits=8)}, volume_agrees"
)
