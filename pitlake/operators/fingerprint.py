"""A fingerprint of canonical state that does not depend on row order.

Each row is hashed where it lies; only a few numbers per table travel to the final aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlake.functions.hashing import content_hash

BAR_STATE = [
    "ticker", "bar_date", "open", "high", "low", "close", "volume", "source_set", "grade",
    "single_source", "payload_hash", "knowledge_time",
]
ACTION_STATE = [
    "ticker", "action_type", "ex_date", "ratio", "cash_amount", "confidence", "payload_hash",
    "knowledge_time",
]


def table_fingerprint(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """(table_name, n_rows, digest) over `columns`: count, and sum and xor of all 256 bits of the row hashes.

    A hash is eight lanes of 32 bits, so that sums stay exact.
    """
    row = content_hash(df, {c: c for c in columns})
    lanes = [F.conv(F.substring(row, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(8)]
    sums = [F.coalesce(F.sum(x.cast("decimal(20,0)")), F.lit(0)).cast("decimal(30,0)").alias(f"_s{k}") for k, x in enumerate(lanes)]
    mixed = [F.coalesce(F.bit_xor(x), F.lit(0)).alias(f"_x{k}") for k, x in enumerate(lanes)]
    told = ["n_rows", *(f"_s{k}" for k in range(8)), *(f"_x{k}" for k in range(8))]
    return df.agg(F.count("*").alias("n_rows"), *sums, *mixed).select(
        F.lit(name).alias("table_name"),
        "n_rows",
        F.sha2(F.concat_ws("|", *told), 256).alias("digest"),
    )


def state_fingerprint(bars: DataFrame, actions: DataFrame) -> DataFrame:
    """Fingerprints of what a consumer can observe: current bars and current actions."""
    return table_fingerprint(bars.filter("is_current"), BAR_STATE, "bars_daily").unionByName(
        table_fingerprint(actions.filter("is_current"), ACTION_STATE, "corporate_actions")
    )
