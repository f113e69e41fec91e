"""What lies in a download folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.functions.outcome import MIN_FILE_BYTES, file_problem
from gleanery.sources.paths import exists


def _files(spark: SparkSession, folder: str) -> DataFrame:
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return found.withColumn("archivo", F.url_decode(F.regexp_extract("path", "([^/]+)$", 1)))


def probe_stat(spark: SparkSession, folder: str) -> DataFrame | None:
    """File name and size; contents are not read. None where there is no folder."""
    if not exists(spark, folder):
        return None
    return _files(spark, folder).select("archivo", F.col("length").alias("bytes"), F.lit(None).cast("string").alias("sha256"))


def probe_hash(spark: SparkSession, folder: str) -> DataFrame | None:
    """File name, size and sha256."""
    if not exists(spark, folder):
        return None
    return _files(spark, folder).select("archivo", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def probe_known(spark: SparkSession, folder: str, known: DataFrame | None = None) -> DataFrame | None:
    """What ``probe_hash`` gives, besides path and time of each file, for the next probe to take as ``known``.

    A file with the path, size and time of a known one keeps its hash. Of the others the earliest time is found from the
    listing, and only contents from then on are read (the filter reaches the scan). So a folder to which files are added
    costs the new ones; a file that is new but old by its time makes later ones be read again, never missed.
    """
    if not exists(spark, folder):
        return None
    whole = ["path", "bytes", "modified"]
    listed = _files(spark, folder).select("path", "archivo", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))
    if known is None:
        known = spark.createDataFrame([], "path string, bytes bigint, modified timestamp, sha256 string")
    known = known.where(F.col("sha256").isNotNull()).select(*whole, "sha256").dropDuplicates(whole)
    told = listed.join(known, whole, "left")
    since = told.where(F.col("sha256").isNull()).agg(F.unix_micros(F.min("modified"))).first()[0]
    if since is None:
        return told.select("path", "archivo", "bytes", "modified", "sha256")
    late = _files(spark, folder).where(F.col("modificationTime") >= F.timestamp_micros(F.lit(since)))
    read = late.select("path", F.sha2("content", 256).alias("_read"))
    return told.join(read, "path", "left").select("path", "archivo", "bytes", "modified", F.coalesce("sha256", "_read").alias("sha256"))


def file_validity(spark: SparkSession, folder: str, min_bytes: int = MIN_FILE_BYTES) -> DataFrame:
    """File name, size and what is wrong with it (``magic``, ``tamano`` or NULL)."""
    files = _files(spark, folder)
    return files.select("archivo", F.col("length").alias("bytes"), file_problem(F.col("content"), F.col("length"), min_bytes).alias("problem"))
