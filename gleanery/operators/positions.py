"""Positions that a dense 0-based numbering lacks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.operators.keep import MAX_SAMPLES
from gleanery.operators.ordered import blocks, running
from gleanery.sources.sinks import settle

PIECE = 10_000  # parts that a gap is cut into at a time


def missing_intervals(rows: DataFrame, position: str) -> DataFrame:
    """The gaps of the numbering: ``first`` and ``last`` missing position of each, in one row however wide it is."""
    present = rows.where(F.col(position) >= 0).select(F.col(position).cast("bigint").alias("p")).distinct()
    b = running(blocks(present, [], ["p"]), {"_before": ("max", F.col("p"))}, inclusive=False)
    gaps = b.rows.select((F.coalesce("_before", F.lit(-1)) + 1).alias("first"), (F.col("p") - 1).alias("last"))
    return gaps.where("first <= last")


def missing_total(intervals: DataFrame) -> int:
    """How many positions are missing in all."""
    n = intervals.agg(F.sum((F.col("last") - F.col("first") + 1).cast("decimal(38,0)"))).first()[0]
    return int(n or 0)


def spelled_out(intervals: DataFrame, position: str) -> DataFrame:
    """Every position of the intervals.

    Wide intervals are cut into even parts, ``PIECE`` at a time, and the parts dealt out again before they are cut further: no
    array holds more than ``PIECE`` numbers, and the widest gap is spread over all tasks.
    """
    widest = intervals.agg(F.max(F.col("last") - F.col("first"))).first()[0]
    parts, width = intervals.select("first", "last"), 1
    tasks = int(intervals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while widest is not None and widest // width >= PIECE:
        width *= PIECE
    while width > 1:
        starts = F.explode(F.sequence("first", "last", F.lit(width))).alias("a")
        cut = parts.select("last", starts).select(F.col("a").alias("first"), F.least("last", F.col("a") + (width - 1)).alias("last"))
        parts, width = cut.repartition(tasks), width // PIECE
    return parts.select(F.explode(F.sequence("first", "last")).alias(position))


def missing_positions(rows: DataFrame, position: str) -> DataFrame:
    """Every position from 0 to the greatest one that no row has."""
    return spelled_out(settle(missing_intervals(rows, position), "gaps"), position)


def first_missing(rows: DataFrame, position: str, k: int = MAX_SAMPLES) -> DataFrame:
    """The ``k`` lowest missing positions, without generating the whole range.

    Every gap starts right after a present position (or at 0). The lowest ``k`` missing
    positions lie within the first ``k`` positions of the first ``k`` gaps.
    """
    present = rows.where(F.col(position) >= 0).select(F.col(position).alias("p")).distinct()
    edge = rows.sparkSession.range(1).select((F.col("id") - 1).alias("p"))
    starts = present.unionByName(edge).select((F.col("p") + 1).alias("p")).join(present, "p", "left_anti")
    near = starts.orderBy("p").limit(k).select(
        F.explode(F.sequence("p", F.col("p") + k - 1)).alias("p")
    ).distinct()
    top = present.agg(F.max("p").alias("_top"))
    # One row on the right: the greatest position.
    inside = near.join(F.broadcast(top), F.col("p") < F.col("_top"), "left_semi")
    # At most k*k candidates, so it is they that are broadcast, not the positions.
    taken = present.join(F.broadcast(inside), "p", "left_semi")
    return inside.join(F.broadcast(taken), "p", "left_anti").orderBy("p").limit(k).withColumnRenamed("p", position)
