"""Landed payload files: `<root>/<dataset>/date=<day>/source=<name>/<slug>.<digest>.<ext>`.

Payload frames carry (landing_key, dataset, source, request_key, ticker, partition_date, path) and
the content as text, bytes or, for tick files, one row per record.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlake import schemas
from pitlake.sources.drift import SCHEMA_DRIFT

FILE_NAME = r"([^/]+)\.([0-9a-f]{16})\.([A-Za-z0-9.]+)$"
SLUG_UNSAFE = "[^A-Za-z0-9_-]+"


def file_name(request_key: Column, ext: str) -> Column:
    """The file name of a request: a readable slug and a digest that tells keys apart."""
    slug = F.substring(F.regexp_replace(request_key, SLUG_UNSAFE, "_"), 1, 80)
    return F.concat_ws(".", slug, F.substring(F.sha2(request_key, 256), 1, 16), F.lit(ext))


def _request_key(slug: Column, digest: Column, name: Column) -> Column:
    """The request key behind a slug: the spelling whose digest is the one in the file name.

    Where no spelling fits (a cut or unusual slug) the key is `file:` and the name: never null, and no
    other file's. The manifest knows better: `keyed_by_manifest`.
    """
    guesses = [
        F.regexp_replace(slug, "_", ":"),
        F.regexp_replace(slug, "^([^_]+)_", "$1:"),
        F.regexp_replace(slug, "^([^_]+)_([^_]+)_", "$1.$2:"),
        F.regexp_replace(slug, "^([^_]+)_history_", "$1:history:"),
        F.regexp_replace(slug, "^([^_]+)_([^_]+)_history_", "$1.$2:history:"),
        F.regexp_replace(slug, "^(.+)_([^_]+)$", "$1:$2"),
        slug,
    ]
    fitting = [F.when(F.substring(F.sha2(g, 256), 1, 16) == digest, g) for g in guesses]
    return F.coalesce(*fitting, F.concat(F.lit("file:"), name))


def _describe(files: DataFrame, dataset: str) -> DataFrame:
    path = F.col("path")
    slug, digest = F.regexp_extract(path, FILE_NAME, 1), F.regexp_extract(path, FILE_NAME, 2)
    key = _request_key(slug, digest, F.substring_index(path, "/", -1))
    return files.withColumns(
        {
            "dataset": F.lit(dataset),
            "source": F.col("source").cast("string"),
            "partition_date": F.col("date").cast("date"),
            "request_key": key,
            "ticker": F.upper(F.split_part(key, F.lit(":"), F.lit(1))),
            "landing_key": F.concat_ws(":", F.lit(dataset), "source", key),
        }
    ).drop("date")


def _landed(files: DataFrame, days: tuple[str, str] | None) -> DataFrame:
    """Files of the days asked for (first, last): a filter on folders, so others are not opened."""
    if days is None:
        return files
    return files.filter(F.col("date").cast("date").between(*(F.lit(x).cast("date") for x in days)))


def days_of(queue: DataFrame) -> tuple[str, str] | None:
    """First and last partition date of a work list, to scan no other folders; None when it is empty."""
    ends = queue.agg(F.min("partition_date").cast("string"), F.max("partition_date").cast("string")).first()
    return None if ends[0] is None else (ends[0], ends[1])


def scan_text(
    spark: SparkSession, root: str, dataset: str, days: tuple[str, str] | None = None
) -> DataFrame:
    """One row per payload with its whole text; `.gz` payloads are decoded by extension.

    Spark's file sources pass over zero-byte files: `empty_payloads` finds those in the manifest.
    """
    files = spark.read.option("basePath", f"{root}/{dataset}").text(
        f"{root}/{dataset}", wholetext=True
    )
    return _describe(
        _landed(files, days).select(
            F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"), "date", "source"
        ),
        dataset,
    )


def scan_bytes(
    spark: SparkSession, root: str, dataset: str, days: tuple[str, str] | None = None
) -> DataFrame:
    """One row per payload with its raw bytes."""
    files = spark.read.format("binaryFile").option("basePath", f"{root}/{dataset}").load(
        f"{root}/{dataset}"
    )
    return _describe(
        _landed(files, days).select("path", "content", "length", "modificationTime", "date", "source"), dataset
    )


def _record_position() -> Column:
    """A value that grows along a file: where its block starts, then the row in the task.

    Blocks of one file may sit in different tasks, so the row id alone would not do.
    """
    row_in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return F.col("_metadata.file_block_start").cast("decimal(20,0)") * F.lit(1 << 33).cast("decimal(10,0)") + row_in_task


def scan_records(
    spark: SparkSession, root: str, dataset: str, days: tuple[str, str] | None = None
) -> DataFrame:
    """One row per JSON record of each payload, in file order, without ever holding a whole payload.

    A night's ticks for one name can be a single huge JSON object. Reading it with `{` as the line
    separator streams it record by record. `pos` orders the records of one file.
    """
    files = spark.read.option("lineSep", "{").option("basePath", f"{root}/{dataset}").text(
        f"{root}/{dataset}"
    )
    return _describe(
        _landed(files, days).select(
            F.col("_metadata.file_path").alias("path"),
            F.col("value").alias("fragment"),
            _record_position().alias("pos"),
            "date", "source",
        ),
        dataset,
    )


def _is_there(spark: SparkSession, folder: str) -> bool:
    """A folder that a manifest names may be gone; `queue_rejects` then tells its payloads."""
    try:
        spark.read.format("binaryFile").load(folder)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


QUEUE = ["dataset", "source", "request_key", "path", "partition_date"]


def _queued(
    spark: SparkSession, root: str, dataset: str, queue: DataFrame, read: Callable[[list[str], str], DataFrame], shape: str
) -> DataFrame:
    """The payloads of a work list, with what `read` gives of each, and the keys that the manifest has for them.

    The partition dates of the work list (at most the calendar's) come to the driver and name the folders that
    are listed and opened; others are not looked at. A payload is known by date, source and file name, so it
    does not matter how either side spells its root. Nothing is guessed from a slug.
    """
    wanted = queue.filter(F.col("dataset") == dataset).select(
        F.col("source").alias("_source"), "request_key", F.col("partition_date").alias("_date"),
        F.substring_index("path", "/", -1).alias("_name"),
    )
    base = f"{root}/{dataset}"
    days = sorted({str(r[0]) for r in wanted.select("_date").distinct().collect() if r[0] is not None})
    held = [day for day in days if _is_there(spark, f"{base}/date={day}")]
    files = (
        read([f"{base}/date={day}" for day in held], base) if held
        else schemas.empty(spark, f"path string, {shape}, date date, source string")
    )
    listed = files.withColumns({"source": F.col("source").cast("string"), "date": F.col("date").cast("date")})
    named = listed.withColumn("_file", F.substring_index("path", "/", -1)).join(
        wanted,
        (F.col("_file") == F.col("_name")) & (F.col("source") == F.col("_source")) & (F.col("date") == F.col("_date")),
        "left",
    )
    return named.withColumns({
        "dataset": F.lit(dataset), "partition_date": F.col("date"),
        "ticker": F.upper(F.split_part("request_key", F.lit(":"), F.lit(1))),
        "landing_key": F.concat_ws(":", F.lit(dataset), "source", "request_key"),
    }).drop("_file", "_name", "_source", "_date", "date")


def queued_text(spark: SparkSession, root: str, queue: DataFrame, dataset: str) -> DataFrame:
    """Whole texts of the payloads of a work list (QUEUE columns)."""
    def read(paths: list[str], base: str) -> DataFrame:
        files = spark.read.option("basePath", base).text(paths, wholetext=True)
        return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"), "date", "source")

    return _queued(spark, root, dataset, queue, read, "text string").filter("request_key IS NOT NULL")


def queued_bytes(spark: SparkSession, root: str, queue: DataFrame, dataset: str) -> DataFrame:
    """Raw bytes of the payloads of a work list."""
    def read(paths: list[str], base: str) -> DataFrame:
        files = spark.read.format("binaryFile").option("basePath", base).load(paths)
        return files.select("path", "content", "date", "source")

    return _queued(spark, root, dataset, queue, read, "content binary").filter("request_key IS NOT NULL")


def queued_records(spark: SparkSession, root: str, queue: DataFrame, dataset: str) -> DataFrame:
    """Record fragments of the tick payloads of a work list, as `scan_records` gives them."""
    def read(paths: list[str], base: str) -> DataFrame:
        files = spark.read.option("lineSep", "{").option("basePath", base).text(paths)
        return files.select(
            F.col("_metadata.file_path").alias("path"), F.col("value").alias("fragment"), _record_position().alias("pos"),
            "date", "source",
        )

    return _queued(spark, root, dataset, queue, read, "fragment string, pos decimal(38,0)").filter("request_key IS NOT NULL")


def queue_rejects(spark: SparkSession, root: str, queue: DataFrame, dataset: str, manifest: DataFrame) -> DataFrame:
    """Rejects for what the folders of a work list and the manifest disagree on.

    Payloads without content, files that no row of the manifest names, and rows whose file is not there.
    Only names and sizes are read.
    """
    def read(paths: list[str], base: str) -> DataFrame:
        files = spark.read.format("binaryFile").option("basePath", base).load(paths)
        return files.select("path", "length", "date", "source")

    days = queue.filter(F.col("dataset") == dataset).select("partition_date").distinct()
    known = manifest.filter(F.col("dataset") == dataset).join(days, "partition_date", "left_semi")
    files = _queued(spark, root, dataset, known.select(*QUEUE), read, "length bigint")
    seen = files.filter("request_key IS NOT NULL").select("request_key", "source", "length")
    held = known.join(seen, ["request_key", "source"], "left").select(
        F.concat_ws(":", "dataset", "source", "request_key").alias("landing_key"),
        F.when((F.col("n_bytes") == 0) | (F.col("length") == 0), "empty payload")
        .when(F.col("length").isNull(), "payload is not where the manifest has it").alias("detail"),
    ).filter("detail IS NOT NULL")
    strangers = files.filter("request_key IS NULL").select(
        F.concat_ws(":", F.lit(dataset), "source", F.concat(F.lit("file:"), F.substring_index("path", "/", -1))).alias("landing_key"),
        F.concat(F.lit("payload without a manifest row: "), "path").alias("detail"),
    )
    return held.unionByName(strangers).select("landing_key", F.lit(SCHEMA_DRIFT).alias("error_class"), "detail")


def empty_payloads(manifest: DataFrame) -> DataFrame:
    """Rejects for payloads landed without content."""
    return manifest.filter("n_bytes = 0").select(
        F.concat_ws(":", "dataset", "source", "request_key").alias("landing_key"),
        F.lit(SCHEMA_DRIFT).alias("error_class"), F.lit("empty payload").alias("detail"),
    )


def keyed_by_manifest(payloads: DataFrame, manifest: DataFrame) -> DataFrame:
    """Request keys from the manifest by path, for names whose key a slug cannot give back."""
    known = manifest.select("path", F.col("request_key").alias("_key"))
    key = F.coalesce("_key", "request_key")
    return (
        payloads.join(known, "path", "left")
        .withColumns(
            {
                "request_key": key,
                "ticker": F.upper(F.split_part(key, F.lit(":"), F.lit(1))),
                "landing_key": F.concat_ws(":", "dataset", "source", key),
            }
        )
        .drop("_key")
    )


def unlisted(payloads: DataFrame, manifest: DataFrame) -> DataFrame:
    """Rejects for payloads that the manifest doesn't name."""
    return payloads.join(manifest.select("path"), "path", "left_anti").select(
        "landing_key", F.lit(SCHEMA_DRIFT).alias("error_class"),
        F.concat(F.lit("payload without a manifest row: "), "path").alias("detail"),
    ).distinct()


def build_manifest(
    spark: SparkSession, root: str, dataset: str, written_at: Column, days: tuple[str, str] | None = None
) -> DataFrame:
    """The manifest of a dataset from its files (of some days): hash, size and knowledge time per payload.

    Knowledge time is the file's modification time: when the payload was pulled.
    """
    return scan_bytes(spark, root, dataset, days).select(
        "dataset", "source", "request_key",
        F.sha2("content", 256).alias("payload_hash"),
        "path",
        F.lit("").alias("content_type"),
        F.col("length").alias("n_bytes"),
        "partition_date",
        F.col("modificationTime").alias("knowledge_time"),
        written_at.alias("written_at"),
    )


def only_queued(payloads: DataFrame, queue: DataFrame) -> DataFrame:
    """Payloads named by a work list (dataset, request_key)."""
    return payloads.join(queue.select("dataset", "request_key"), ["dataset", "request_key"], "left_semi")
