"""Download manifests and failure queues: valid entries, and the last one per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.operators.keep import latest
from gleanery.sources.jsonl import CORRUPT, scan_strict, scan_tolerant
from gleanery.sources.schema import MANIFEST_SCHEMA, QUEUE_SCHEMA

REQUIRED = ("id", "documentoUuid", "archivo", "bytes", "sha256")
NAMED = ("id", "documentoUuid", "archivo")


def is_whole(columns: tuple[str, ...] = REQUIRED):
    """All required fields are there, in their type."""
    whole = F.lit(True)
    for c in columns:
        whole = whole & F.col(c).isNotNull()
    return whole


def manifest_scan(spark: SparkSession, path: str, required: tuple[str, ...] = REQUIRED) -> tuple[DataFrame, DataFrame]:
    """Valid entries with their place in the files, and the malformed ones: no JSON, or a required field is missing or of another type.

    The report asks for all of ``REQUIRED``; a plan can use an entry that names record, document and file (``NAMED``).
    """
    scanned = scan_tolerant(spark, path, MANIFEST_SCHEMA, place=True, required=required)
    return scanned.where(F.col(CORRUPT).isNull()).drop(CORRUPT), scanned.where(F.col(CORRUPT).isNotNull())


def queue_scan(spark: SparkSession, path: str, looked: bool = True) -> DataFrame:
    """The queue collapsed to the latest entry per id. A malformed entry fails the job; ``looked`` as in ``scan_strict``."""
    return latest(checked_queue(scan_strict(spark, path, QUEUE_SCHEMA, place=True, looked=looked)), "id")


def checked_queue(entries: DataFrame) -> DataFrame:
    whole = is_whole(("tipo", "error", "intentos", "ultimoTs")) & F.coalesce(F.col("id") != "", F.lit(False))
    checked = F.when(whole, F.col("id")).otherwise(F.raise_error(F.lit("an entry of the failure queue is malformed")))
    return entries.withColumn("id", checked)
