"""Contract checks on the serving shapes.

`check_*` gives one row of counts from one pass over the table; `assert_*` runs it with the schema
check and raises on any violation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pitlake import schemas
from pitlake.operators.spreads import QUOTED, SYNTHETIC

# The termination reasons a consumer accepts.
TERMINATION_REASONS = ("merger", "bankruptcy", "acquisition", "voluntary", "unknown")


class ContractViolation(AssertionError):
    """A serving table does not match its frozen contract."""


def _count(*key: str, **problems: Column) -> list[Column]:
    # a struct keeps keys with null parts in the distinct count
    return [
        F.count("*").alias("n_rows"),
        F.count_distinct(F.struct(*key)).alias("n_keys"),
        *[F.count_if(c).alias(name) for name, c in problems.items()],
    ]


def check_daily(df: DataFrame) -> DataFrame:
    bad = (
        F.col("ticker").isNull() | F.col("effective_date").isNull() | F.col("close").isNull()
        | (F.col("high") < F.col("low"))
    )
    return df.agg(*_count("ticker", "effective_date", bad_rows=bad))


def check_delisted(df: DataFrame) -> DataFrame:
    outside = ~F.col("termination_reason").isin(*TERMINATION_REASONS)
    return df.agg(*_count("ticker", "termination_date", bad_reason=outside))


def check_sectors(df: DataFrame) -> DataFrame:
    return df.agg(*_count("ticker", null_sector=F.col("sector").isNull()))


def check_intraday(df: DataFrame) -> DataFrame:
    return df.agg(
        *_count(
            "ticker", "minute",
            crossed=F.col("bid") > F.col("ask"),
            bad_derivation=~F.col("derivation").isin(QUOTED, SYNTHETIC),
        )
    )


def check_coverage(df: DataFrame) -> DataFrame:
    outside = (F.col("coverage") < 0) | (F.col("coverage") > 1)
    return df.agg(F.count("*").alias("n_rows"), F.count_if(outside).alias("out_of_range"))


CHECKS = {
    "daily_ohlcv": check_daily,
    "delisted": check_delisted,
    "sectors": check_sectors,
    "intraday": check_intraday,
    "coverage": check_coverage,
}


def _shape(schema: StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def assert_schema(name: str, df: DataFrame) -> None:
    expected = _shape(schemas.struct(schemas.SERVING[name]))
    got = _shape(df.schema)
    if got != expected:
        raise ContractViolation(f"{name} schema drift: got {got}, expected {expected}")


def assert_contract(name: str, df: DataFrame) -> int:
    """Raise ContractViolation on any breach of `name`'s contract, else the row count."""
    assert_schema(name, df)
    counts = CHECKS[name](df).first().asDict()
    total = counts.pop("n_rows")
    keys = counts.pop("n_keys", total)
    if keys != total:
        raise ContractViolation(f"{name}: key not unique ({total} rows, {keys} keys)")
    if name == "coverage" and total == 0:
        raise ContractViolation("coverage: no audit windows served")
    broken = {k: v for k, v in counts.items() if v}
    if broken:
        raise ContractViolation(f"{name}: {broken}")
    return int(total)
