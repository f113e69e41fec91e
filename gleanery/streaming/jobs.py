"""The jobs as Structured Streaming queries over arriving files.

Each runs with ``availableNow``: it takes what has arrived and stops, and the next run goes
on from its checkpoint location. Sinks are written batch by batch and stand a repeated batch.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from gleanery.operators.keep import PLACE, latest
from gleanery.sources import schema as sch
from gleanery.sources.paths import exists
from gleanery.sources.sinks import append_new_records, drop, drop_versions, read_current, read_table, replace_table


def arriving(spark: SparkSession, folder: str, schema: StructType, fmt: str = "json", files_per_batch: int | None = None, place_of_lines: bool = False) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    m = F.col("_metadata")
    place = F.struct(m["file_modification_time"].alias("at"), m["file_path"].alias("file"), m["file_block_start"].alias("start"))
    return reader.load(folder).select("*", place.alias(PLACE)) if place_of_lines else reader.load(folder)


class TotalChanged(RuntimeError):
    """The declared total is not the one the run was started for; ``total`` is the latest one."""

    def __init__(self, total: int):
        super().__init__(f"declared total changed to {total}")
        self.total = total

    @staticmethod
    def within(e: Exception) -> TotalChanged | None:
        """The change that made a streaming query fail, if that was what it failed of."""
        said = re.search(TotalChanged.__name__ + r": declared total changed to (-?\d+)", str(e))
        return TotalChanged(int(said[1])) if said else None


def check_total(rows: DataFrame, expected: int, total: str, at: str = "capturadoEn") -> None:
    """Raise ``TotalChanged`` if a row declares another total than the one expected: the latest by ``at``, or the greatest where rows have no such time."""
    other = rows.where(F.col(total) != expected).agg(F.max_by(total, at if at in rows.columns else total)).first()[0]
    if other is not None:
        raise TotalChanged(other)


def ingest_stream(rows: DataFrame, records_path: str, checkpoint: str, expected_total: int | None = None, total: str | None = None) -> StreamingQuery:
    """Append the new records of each batch; a repeated batch appends nothing.

    With ``expected_total``, a batch that declares another total stops the query: the
    positions have shifted, and the run has to start over (``in_generations``).
    """

    def write(batch: DataFrame, _: int) -> None:
        if expected_total is not None:
            check_total(batch, expected_total, total)
        append_new_records(batch, records_path)

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def dedup_stream(rows: DataFrame, delay: str | None = None, event_time: str = "capturadoEn") -> DataFrame:
    """First arrival of each id. A delay bounds the state by event time; without one it grows."""
    if delay is None:
        return rows.dropDuplicates(["id"])
    return rows.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["id"])


def dedup_run_stream(rows: DataFrame, run: str, ends: str, key: str = "id") -> DataFrame:
    """First arrival of each key within its run; what a run has seen is let go when a later run begins.

    ``ends`` is a time that all rows of a run have and that is later for a later run. It is the event time: the watermark stays just
    behind the latest run's, so the state of that run is kept over any number of batches, and no row of an ended run is taken.
    """
    return rows.withWatermark(ends, "1 millisecond").dropDuplicates([run, key, ends])


def queue_stream(entries: DataFrame, queue_path: str, checkpoint: str) -> StreamingQuery:
    """Add the latest entry per id of each batch as a change; the queue is the latest over all changes.

    A batch writes what it brings and no more, under its own number, so a repeated batch replaces itself.
    """

    def add(batch: DataFrame, number: int) -> None:
        if PLACE in batch.columns:  # rows of a split come in order; a stream can't number them, a batch can
            batch = batch.withColumn(PLACE, F.col(PLACE).withField("row", F.monotonically_increasing_id()))
        latest(batch, "id").write.mode("overwrite").parquet(f"{queue_path}/changes/batch={number}")

    return entries.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def queue_now(spark: SparkSession, queue_path: str, schema: StructType) -> DataFrame:
    """The queue as it stands: the last version of :func:`compact_queue` and the changes since, latest entry per id."""
    base = read_current(spark, f"{queue_path}/base", schema)
    changes = read_table(spark, f"{queue_path}/changes", schema).select(*schema.names)
    return latest(base.unionByName(changes), "id")


def compact_queue(spark: SparkSession, queue_path: str, schema: StructType) -> None:
    """Fold the changes into a new version of the base, and let go of what it replaces. To run between two runs of the stream."""
    replace_table(queue_now(spark, queue_path, schema), f"{queue_path}/base")
    drop_versions(spark, f"{queue_path}/base", keep=1)
    drop(spark, f"{queue_path}/changes")


RANK_ERROR = 0.0133  # of the sketches: by so much of all values a percentile's rank may be off (99 of 100 times)


def _health(log: DataFrame, width: str) -> DataFrame:
    return log.groupBy(F.window("ts", width).alias("w")).agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(F.col("outcome") == "ok").alias("ok"),
        F.count_if(F.col("outcome") == "throttled").alias("throttled"),
        F.kll_sketch_agg_double(F.col("latency_ms").cast("double")).alias("latency_sketch"),
    ).select("w.start", "w.end", "requests", "ok", "throttled", "latency_sketch")


def health(log: DataFrame, width: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Counters per window of time, and a quantile sketch of the latencies, which can be merged to longer spans."""
    return _health(log.withWatermark("ts", delay), width)


def health_now(spark: SparkSession, path: str, log: DataFrame, width: str = "1 hour") -> DataFrame:
    """All windows of the log: those that the stream has written to ``path``, and the ones still open, from the log itself.

    ``log`` is the same log as a table. Only its rows after the last written window are read, a filter on the time."""
    open_rows, done = log, None
    if exists(spark, path):
        done = spark.read.parquet(path)
        last = done.agg(F.max("end")).first()[0]
        open_rows = log if last is None else log.where(F.col("ts") >= F.lit(last))
    still = _health(open_rows, width)
    return still if done is None else done.select(still.columns).unionByName(still)


def health_spans(windows: DataFrame, span: str) -> DataFrame:
    """Windows merged to longer spans: counters added up, sketches merged."""
    return windows.groupBy(F.window("start", span).alias("w")).agg(
        F.sum("requests").alias("requests"), F.sum("ok").alias("ok"), F.sum("throttled").alias("throttled"),
        F.kll_merge_agg_double("latency_sketch").alias("latency_sketch"),
    ).select("w.start", "w.end", "requests", "ok", "throttled", "latency_sketch")


def with_percentiles(windows: DataFrame) -> DataFrame:
    """p50 and p95 of the latencies, from the sketches and therefore named approximate."""
    at = {f"p{int(100 * r)}_approx": F.kll_sketch_get_quantile_double("latency_sketch", F.lit(r)) for r in (0.5, 0.95)}
    return windows.withColumns(at)


def finished_stream(totals: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the windows of a streaming aggregation that the watermark has closed; their state is let go."""
    return totals.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)


GENERATION = sch.schema(number=sch.SMALL, total=sch.COUNT, done=sch.FLAG)
RESTARTS = 8


def in_generations(spark: SparkSession, state: str, expected: int, read: Callable[[int, int], None], restarts: int = RESTARTS) -> tuple[int, int]:
    """Read until a whole reading has met one total: (number, total) of the generation that did.

    ``read(number, total)`` reads all that generation ``number`` brings, with whatever state it keeps under that number, and raises
    ``TotalChanged`` as soon as a row declares another total. Then the next generation starts from the first page, for the
    new total, and is guarded like the one before. The generation is written down before it is begun, so a run that was cut short goes on
    with it; a finished one is followed by a new one if it is asked for another total. More than ``restarts`` changes in a run are an error.
    """
    stored = read_current(spark, state, GENERATION).first()
    number, total = (stored["number"], stored["total"]) if stored else (1, expected)
    if stored and stored["done"] and total != expected:
        number, total = number + 1, expected
    for _ in range(restarts + 1):
        _note(spark, state, number, total, False)
        try:
            read(number, total)
        except (TotalChanged, StreamingQueryException) as e:
            changed = e if isinstance(e, TotalChanged) else TotalChanged.within(e)
            if changed is None:
                raise
            number, total = number + 1, changed.total
            continue
        _note(spark, state, number, total, True)
        return number, total
    raise TotalChanged(total)


def _note(spark: SparkSession, state: str, number: int, total: int, done: bool) -> None:
    replace_table(spark.createDataFrame([(number, total, done)], GENERATION), state)
    drop_versions(spark, state, keep=1)


def ingest_generations(spark: SparkSession, rows: Callable[[int], DataFrame], records_path: str, state: str, expected: int, total: str) -> tuple[int, int]:
    """Ingest streams until a whole generation has declared one total. ``rows(number)`` is the stream of what a generation has landed.

    Records that are stored already stay: reading them again appends nothing. State of generations that were given up is deleted.
    """

    def read(number: int, wanted: int) -> None:
        ingest_stream(rows(number), records_path, f"{state}/stream/{number}", wanted, total).awaitTermination()
        for old in range(1, number):
            drop(spark, f"{state}/stream/{old}")

    return in_generations(spark, f"{state}/generation", expected, read)


def download_generations(spark: SparkSession, entries: Callable[[int], DataFrame], manifest_path: str, state: str, expected: int, total: str) -> tuple[int, int]:
    """The same for downloads, in batches: the entries of a generation are noted once none of its rows declares another total."""

    def read(number: int, wanted: int) -> None:
        landed = entries(number)
        check_total(landed, wanted, total, "descargadoEn")
        append_new_records(landed, manifest_path)

    return in_generations(spark, f"{state}/generation", expected, read)
