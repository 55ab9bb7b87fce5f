"""Engine-neutral presentation of query results, for comparison with another SQL engine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def present(df: DataFrame, digits: int = 6) -> DataFrame:
    """Dates, instants and flags as text, integers widened, doubles rounded."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(name)
        if kind == "date":
            c = c.cast("string")
        elif kind.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif kind == "boolean":
            c = c.cast("string")
        elif kind in ("int", "smallint", "tinyint"):
            c = c.cast("bigint")
        elif kind in ("double", "float"):
            c = F.round(c, digits) + F.lit(0.0)
        out.append(c.alias(name))
    return df.select(*out)
