"""Ingest a run: records first, then the resume state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.sources.sinks import append_new_records, write_checkpoint


def checkpoint_of(run: DataFrame, task: str, page_size: int, total: Column, last_page: Column, now: Column) -> DataFrame:
    """Resume state per source after a run: last page read, rows seen, and whether it was the last."""
    reached = F.max("pagina").cast("int")
    return run.groupBy("fuente").agg(
        F.lit(task).alias("tarea"),
        F.lit(page_size).cast("int").alias("pageSize"),
        F.max(total).cast("bigint").alias("total"),
        reached.alias("ultimaPagina"),
        (reached == F.max(last_page)).alias("completo"),
        F.count(F.lit(1)).alias("registros"),
        F.max(now).alias("actualizadoEn"),
    )


def ingest(run: DataFrame, records_path: str, checkpoint_path: str, state: DataFrame) -> None:
    """Append the run's new records, then move the resume state on."""
    append_new_records(run, records_path)
    write_checkpoint(run.sparkSession, checkpoint_path, state)
