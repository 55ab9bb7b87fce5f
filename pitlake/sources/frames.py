"""Parquet payloads whose column names carry a ticker suffix.

Files of one dataset disagree on names (`Open`, `Open_AAPL`), so a single Spark schema would grow with
the number of tickers. Each file is small and opened where it lies: Arrow inside the task resolves its
columns and hands typed batches back.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlake.functions.clocks import exchange_wall_to_utc
from pitlake.sources.drift import Parsed, split_parsed


def _find(names: Sequence[str], wanted: str) -> str | None:
    return next((n for n in names if n == wanted or n.startswith(f"{wanted}_")), None)


def _read(
    content: bytes, time: Sequence[str], required: Sequence[str], optional: Sequence[str],
    dates_allowed: bool,
) -> tuple[pa.Table | None, bool, str | None]:
    """(columns at + prices, whether `at` carries a zone, problem)."""
    try:
        data = pq.read_table(pa.BufferReader(content))
    except Exception as exc:  # noqa: BLE001 - any unreadable payload is drift
        return None, False, f"payload unreadable: {exc}"
    names = data.column_names
    at = next((c for c in (_find(names, t) for t in time) if c), None)
    found = {c: _find(names, c) for c in (*required, *optional)}
    missing = [c for c in required if found[c] is None]
    if at is None or missing:
        return None, False, f"payload missing {(['timestamp'] if at is None else []) + missing}"
    kind = data.schema.field(at).type
    if not (pa.types.is_timestamp(kind) or (dates_allowed and pa.types.is_date(kind))):
        return None, False, f"timestamp column has type {kind}"
    zoned = pa.types.is_timestamp(kind) and kind.tz is not None
    nothing = pa.nulls(data.num_rows, pa.float64())
    columns = [data[at].cast(pa.timestamp("us", tz="UTC" if zoned else None), safe=False)]
    for c in (*required, *optional):
        columns.append(data[found[c]].cast(pa.float64()) if found[c] else nothing)
    table = pa.table(columns, names=["at", *required, *optional])
    keep = pc.and_(pc.is_valid(table["at"]), pc.is_valid(table["Close"]))
    return table.filter(keep), zoned, None


def parse_frames(
    payloads: DataFrame, kind: str, time: Sequence[str], required: Sequence[str],
    optional: Sequence[str], empty_is_drift: bool,
) -> Parsed:
    """(landing_key, ticker, at, zoned, <columns>) and rejects, from (landing_key, ticker, content).

    `at` is a UTC instant: zoned stamps are converted, naive ones read as exchange wall time for
    minute frames and kept as calendar days for daily ones.
    """
    values = [*required, *optional]
    daily = kind == "daily"
    shape = ", ".join(
        ["landing_key string", "ticker string", "problem string", "zoned boolean", "us bigint"]
        + [f"`{c}` double" for c in values]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = pa.schema(
            [("landing_key", pa.string()), ("ticker", pa.string()), ("problem", pa.string()),
             ("zoned", pa.bool_()), ("us", pa.int64())] + [(c, pa.float64()) for c in values]
        )
        for batch in batches:
            for row in batch.to_pylist():
                table, zoned, problem = _read(row["content"], time, required, optional, daily)
                if problem is None and empty_is_drift and table.num_rows == 0:
                    problem = "payload parsed to zero rows"
                n = 1 if problem else table.num_rows
                same = {
                    "landing_key": pa.repeat(pa.scalar(row["landing_key"], pa.string()), n),
                    "ticker": pa.repeat(pa.scalar((row["ticker"] or "").upper(), pa.string()), n),
                    "problem": pa.repeat(pa.scalar(problem, pa.string()), n),
                    "zoned": pa.repeat(pa.scalar(zoned, pa.bool_()), n),
                }
                if problem:
                    cells = [pa.nulls(n, pa.int64()), *[pa.nulls(n, pa.float64()) for _ in values]]
                else:
                    cells = [table["at"].cast(pa.int64()), *[table[c] for c in values]]
                filled = pa.table([*same.values(), *cells], schema=out)
                yield from filled.combine_chunks().to_batches(max_chunksize=10_000)

    rows = payloads.select("landing_key", "ticker", "content").mapInArrow(run, shape)
    good, rejects = split_parsed(rows)
    stamp = F.timestamp_micros("us")
    if not daily:
        stamp = F.when(F.col("zoned"), stamp).otherwise(exchange_wall_to_utc(stamp))
    return Parsed(good.withColumn("at", stamp).drop("us"), rejects)
