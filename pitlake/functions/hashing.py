"""Content hashing on built-in functions.

A row's hash must not move with representation noise (column order, 0.30000000000000004) yet must
move with any real change, so doubles enter as text with six decimals and fields are sorted by name.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def double_text(c: Column) -> Column:
    # a decimal prints its six places many times faster than a format string, up to its range
    finite = F.when(F.abs(c) < 1e30, c.cast("decimal(38,6)").cast("string")).otherwise(
        F.format_string("%.6f", c)
    )
    return (
        F.when(c.isNull(), F.lit(None).cast("string"))
        .when(F.isnan(c), F.lit("NaN"))
        .when(c == F.lit(float("inf")), F.lit("Inf"))
        .when(c == F.lit(float("-inf")), F.lit("-Inf"))
        .otherwise(finite)
    )


def content_hash(df: DataFrame, fields: Mapping[str, str]) -> Column:
    """SHA-256 over the JSON object of `fields` (JSON name -> column of `df`), sorted by name."""
    types = dict(df.dtypes)
    parts = []
    for name in sorted(fields):
        c = F.col(fields[name])
        parts.append((double_text(c) if types[fields[name]] in ("double", "float") else c).alias(name))
    body = F.to_json(
        F.struct(*parts),
        {
            "ignoreNullFields": "false",
            "dateFormat": "yyyy-MM-dd",
            "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        },
    )
    return F.sha2(body, 256)


BAR_HASH_FIELDS = [
    "open", "high", "low", "close", "volume", "source_set", "grade", "single_source",
]


def with_bar_hash(bars: DataFrame) -> DataFrame:
    """Adds payload_hash over the value columns present; keys are not part of the hash.

    Grade and source columns count when present: an upgraded belief is a revision even when no
    price moved.
    """
    present = [c for c in BAR_HASH_FIELDS if c in bars.columns]
    return bars.withColumn("payload_hash", content_hash(bars, {c: c for c in present}))


ACTION_HASH_FIELDS = {
    "ticker": "ticker", "type": "action_type", "ex": "ex_date", "ratio": "ratio",
    "cash": "cash_amount",
}


def with_action_hash(actions: DataFrame) -> DataFrame:
    """Adds payload_hash over identity and amount; declared date and confidence do not count."""
    return actions.withColumn("payload_hash", content_hash(actions, ACTION_HASH_FIELDS))
