"""Writing: append what is new, replace a whole table, keep the resume state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gleanery.operators.keep import first_occurrence
from gleanery.sources.paths import children, exists, file_system, scratch_dir


BUCKETS = 32
OF = "of_"  # a stored table's partition column: of_<number of buckets>


def bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def buckets_of(spark: SparkSession, path: str) -> int | None:
    """How many buckets the stored table was made with; None where there is none, or one without buckets."""
    made = {int(n.split("=")[0][len(OF):]) for n in children(spark, path) if n.startswith(OF)}
    return min(made) if made else None


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """An appended table; no folder is no rows."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def stored_ids(spark: SparkSession, path: str, only: list[int]) -> DataFrame:
    """Ids stored in the buckets given: a filter on the partition column, so other buckets' files are not opened."""
    n = buckets_of(spark, path)
    if n is None or not only:
        return spark.createDataFrame([], "id string")
    ids = spark.read.schema(f"id string, {OF}{n} int").parquet(path)
    return ids.where(F.col(f"{OF}{n}").isin(only)).select("id")


def new_records(incoming: DataFrame, stored: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Incoming rows whose id is not stored; of one id the first in reading order.

    One row per id is left before the anti join, so no id weighs on it.
    """
    first = first_occurrence(incoming, "id", [F.col(c) for c in (order or ["indice"])])
    return first.join(stored.select("id").distinct(), "id", "left_anti")


def append_new_records(incoming: DataFrame, path: str, order: list[str] | None = None, buckets: int = BUCKETS) -> None:
    """Append the new records of a batch. A second run of the same batch appends nothing.

    Records are stored in buckets of their id's hash, in order of the id, and a batch reads the ids of the buckets that its own
    ids fall into: a small one looks at few files, whatever is stored. The table keeps the number of buckets that it was
    made with; give more to a table that will be large. Records and their ids are one write, so a job that dies between leaves no gap.
    """
    spark = incoming.sparkSession
    made = buckets_of(spark, path)
    of = f"{OF}{made or buckets}"
    batch = incoming.withColumn(of, bucket(F.col("id"), made or buckets)).withColumn("_stored", F.lit(False))
    if made:
        touched = [r[0] for r in batch.select(of).distinct().collect()]  # at most the number of buckets
        stored = stored_ids(spark, path, touched).withColumn("_stored", F.lit(True))
        batch = batch.unionByName(stored, allowMissingColumns=True)
    # A stored id comes before all rows of the batch that have it. So one look finds what is stored and what is first, and cuts copies
    # before they move; the records of a batch are neither written on the way nor moved twice, but for the new ones, to their buckets.
    first = first_occurrence(batch, "id", [F.desc("_stored"), *[F.col(c) for c in order or ["indice"]]])
    fresh = first.where(~F.col("_stored")).select(*incoming.columns, of)
    ordered = fresh.repartition(of).sortWithinPartitions(of, "id")
    ordered.write.mode("append").partitionBy(of).parquet(path)


def append_if_any(rows: DataFrame, path: str) -> bool:
    """Append, unless there is nothing: then no table appears either."""
    if rows.isEmpty():
        return False
    rows.write.mode("append").parquet(path)
    return True


def _versions(spark: SparkSession, path: str) -> list[str]:
    names = sorted(n for n in children(spark, path) if n.startswith("v="))
    return [n for n in names if exists(spark, f"{path}/{n}/_SUCCESS")]


def read_current(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The newest version that was written to its end."""
    done = _versions(spark, path)
    return spark.read.schema(schema).parquet(f"{path}/{done[-1]}") if done else spark.createDataFrame([], schema)


def replace_table(rows: DataFrame, path: str) -> str:
    """Write a new version of the table; readers see it once it is whole.

    The version being read is not touched, so ``rows`` may derive from it, and a job that
    dies leaves the table as it was.
    """
    taken = [int(n[2:]) for n in children(rows.sparkSession, path) if n.startswith("v=")]
    version = f"{path}/v={max(taken, default=0) + 1:012d}"
    rows.write.parquet(version)
    return version


def drop(spark: SparkSession, path: str) -> None:
    """Delete a table or state of ours, if it is there."""
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def drop_versions(spark: SparkSession, path: str, keep: int) -> None:
    """Delete all but the newest ``keep`` whole versions of a table."""
    for name in _versions(spark, path)[:-keep]:
        drop(spark, f"{path}/{name}")


def write_checkpoint(spark: SparkSession, path: str, state: DataFrame) -> str:
    """Replace the resume state. To be called after the data was written, never before."""
    return replace_table(state, path)


def settle(rows: DataFrame, name: str) -> DataFrame:
    """Write rows to shared scratch space and read them back.

    For what is derived once and read many times: the reads see plain columns, and losing an
    executor costs no more than a file read.
    """
    path = scratch_dir(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
