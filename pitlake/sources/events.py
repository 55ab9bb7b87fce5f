"""The event store: append-only Parquet, the system of record.

Every append is a lot, a folder of its own, named by the caller when a retry has to replace itself. Within
it rows lie by bucket of the ticker's hash (bars also by interval), so work on some tickers, or on what
came since, opens only those folders.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlake import schemas
from pitlake.functions.hashing import with_bar_hash
from pitlake.operators.history import with_bar_knowledge

# daily scans filter on the interval, so it is a directory
PARTITIONS = {"bar_events": ["interval", "bucket"], "action_events": ["bucket"]}
BUCKETS = 64


def bucket_of(ticker: Column) -> Column:
    """The bucket a ticker's rows are stored under."""
    return F.pmod(F.xxhash64(ticker), F.lit(BUCKETS)).cast("int")


def _path(root: str, event_type: str) -> str:
    if event_type not in schemas.EVENT_TABLES:
        raise ValueError(f"unknown event type: {event_type}")
    return f"{root}/events/{event_type}"


def append(root: str, event_type: str, events: DataFrame, lot: str | None = None) -> bool:
    """Append a batch in the stored schema; false, with no lot told of, when it is empty.

    A named lot that exists is replaced.
    """
    path = _path(root, event_type)
    shape = schemas.struct(schemas.EVENT_TABLES[event_type])
    missing = sorted(set(shape.fieldNames()) - set(events.columns))
    if missing:
        raise ValueError(f"{event_type}: missing columns {missing}")
    spark, lot = events.sparkSession, lot or uuid.uuid4().hex
    rows = events.select(*[F.col(f.name).cast(f.dataType) for f in shape.fields], bucket_of(F.col("ticker")).alias("bucket"))
    rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy(*PARTITIONS[event_type]).parquet(f"{path}/lot={lot}")
    # what was written is looked at, not the input a second time
    if _read(spark, f"{path}/lot={lot}", event_type).isEmpty():
        return False
    spark.range(1).select(F.lit(lot).alias("lot")).write.mode("append").parquet(f"{root}/events/lots/{event_type}")
    return True


def _read(spark: SparkSession, path: str | list[str], event_type: str, base: str | None = None) -> DataFrame:
    ddl = schemas.EVENT_TABLES[event_type]
    reader = spark.read.schema(schemas.struct(ddl + ", bucket int"))
    try:
        return (reader.option("basePath", base) if base else reader).parquet(*([path] if isinstance(path, str) else path))
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return schemas.empty(spark, ddl + ", bucket int")
        raise


def scan(spark: SparkSession, root: str, event_type: str, buckets: Sequence[int] | None = None) -> DataFrame:
    """Every event of a type, or of some buckets; a typed empty frame when none was written."""
    rows = _read(spark, _path(root, event_type), event_type)
    if buckets is not None:
        rows = rows.filter(F.col("bucket").isin(list(buckets)))
    return rows.select(*schemas.names(schemas.EVENT_TABLES[event_type]))


def lots(spark: SparkSession, root: str, event_type: str) -> DataFrame:
    """(lot): every lot appended."""
    _path(root, event_type)
    try:
        return spark.read.schema("lot string").parquet(f"{root}/events/lots/{event_type}").distinct()
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return schemas.empty(spark, "lot string")
        raise


def scan_lots(spark: SparkSession, root: str, event_type: str, wanted: Sequence[str]) -> DataFrame:
    """The events of some lots: only their folders are listed."""
    path = _path(root, event_type)
    if not wanted:
        return schemas.empty(spark, schemas.EVENT_TABLES[event_type])
    rows = _read(spark, [f"{path}/lot={x}" for x in wanted], event_type, path)
    return rows.select(*schemas.names(schemas.EVENT_TABLES[event_type]))


def bar_envelope(
    raw: DataFrame, source: str, vendor_adjusted: bool, written_at: Column
) -> DataFrame:
    """Parsed bars to bar events: ids, hash, knowledge stamp and provenance."""
    stamped = with_bar_knowledge(with_bar_hash(raw))
    if "reversal_factor" not in stamped.columns:
        stamped = stamped.withColumn("reversal_factor", F.lit(1.0))
    return stamped.withColumns(
        {
            "event_id": F.replace(F.uuid(), F.lit("-"), F.lit("")),
            "source": F.lit(source),
            "interval": F.lit("1d"),
            "vendor_adjusted": F.lit(vendor_adjusted),
            "written_at": written_at,
        }
    ).select(*schemas.names(schemas.BAR_EVENTS))


def action_envelope(actions: DataFrame) -> DataFrame:
    return actions.withColumn("event_id", F.replace(F.uuid(), F.lit("-"), F.lit(""))).select(
        *schemas.names(schemas.ACTION_EVENTS)
    )
