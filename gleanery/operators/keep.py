"""One row, or the first few, per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PLACE = "place"
MAX_SAMPLES = 5  # fixed value: samples shown per finding


def first_k(rows: DataFrame, keys: list[str], order: list[Column], k: int = 1) -> DataFrame:
    """The first ``k`` rows of each key in ``order``.

    The filter on the rank makes Spark cut each key to ``k`` rows before the shuffle too
    (WindowGroupLimit), so copies of one key do not meet in one task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = rows.withColumn("_rank", F.row_number().over(w))
    return ranked.where(F.col("_rank") <= k).drop("_rank")


def first_occurrence(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """First row of each key in reading order. ``dropDuplicates`` would keep any one."""
    return first_k(rows, [key], order)


def latest(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """Last row of each key by the columns named; without any, in file order."""
    return first_k(rows, [key], [F.desc_nulls_last(c) for c in order or file_order(rows)])


def file_order(rows: DataFrame) -> list[str]:
    """What tells file order: a stored ``seq`` where a line has one, and the ``place`` of the line that a scan lands."""
    return [c for c in ("seq", PLACE) if c in rows.columns]


def repeats(rows: DataFrame, key: str) -> DataFrame:
    """Keys held by more than one row, with their rows."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.where("n > 1")


def capped_samples(offenders: DataFrame, group: str, label: Column, order: list[Column]) -> DataFrame:
    """Full count per group and its first samples in order."""
    counts = offenders.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    few = first_k(offenders.select(group, label.alias("_label"), *[o.alias(f"_o{i}") for i, o in enumerate(order)]),
                  [group], [F.col(f"_o{i}") for i in range(len(order))], MAX_SAMPLES)
    at = F.struct(*[f"_o{i}" for i in range(len(order))])
    shown = few.groupBy(group).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(at.alias("o"), F.col("_label").alias("l")))), lambda s: s["l"]).alias("samples")
    )
    return counts.join(shown, group, "left")
