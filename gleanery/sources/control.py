"""Resume state: one row per source and task."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.sources.paths import exists
from gleanery.sources.schema import CHECKPOINT_SCHEMA


def checkpoint_shape_ok():
    """Names are not empty, numbers are whole and not negative, and the time is there."""
    ok = (F.length("fuente") > 0) & (F.length("tarea") > 0) & F.col("actualizadoEn").isNotNull()
    for c in ("pageSize", "total", "ultimaPagina", "registros"):
        ok = ok & (F.col(c) >= 0)
    return F.coalesce(ok, F.lit(False))


def checked_checkpoints(state: DataFrame) -> DataFrame:
    """The state itself; broken state fails the job."""
    broken = F.raise_error(F.lit("the resume state lacks fields or has them in another type"))
    return state.withColumn("fuente", F.when(checkpoint_shape_ok(), F.col("fuente")).otherwise(broken))


def checkpoint_scan(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """No file is no state. One object per file, over several lines, or one per line."""
    if not exists(spark, path):
        return spark.createDataFrame([], CHECKPOINT_SCHEMA)
    state = spark.read.schema(CHECKPOINT_SCHEMA).option("mode", "FAILFAST").option("multiLine", multi_line).json(path)
    return checked_checkpoints(state)
