"""The order statistic ``sorted[min(n-1, floor(p*n))]``: exact and not interpolated.

No built-in gives it: ``percentile`` interpolates, ``percentile_disc`` and
``percentile_approx`` take a lower rank. Equal values are counted before they are ordered,
so only distinct values are cut into blocks. Each block of a key tells how many values it has and
how many come before; only the block that a rank falls into is searched for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanery.operators.ordered import blocks


def rank_percentiles(rows: DataFrame, keys: list[str], value: str, ps: dict[str, float], parts: int | None = None) -> DataFrame:
    """One row per key: ``n`` and one column per name in ``ps``."""
    by = keys or ["_all"]
    rows = rows if keys else rows.withColumn("_all", F.lit(1))
    counts = rows.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_c"))
    b = blocks(counts, by, [value], parts)
    along = Window.partitionBy(*by).orderBy("_block")
    totals = b.rows.groupBy(*b.partition).agg(F.sum("_c").alias("_here"))
    totals = totals.withColumn("_before", F.sum("_here").over(along) - F.col("_here")).withColumn("_n", F.sum("_here").over(Window.partitionBy(*by)))
    small = totals.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(b.partition)], "_before", "_n")
    upto = F.sum("_c").over(Window.partitionBy(*b.partition).orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    counted = b.rows.withColumn("_in_block", upto)
    same = [counted[k].eqNullSafe(small[f"_k{i}"]) for i, k in enumerate(b.partition)]
    ranked = counted.join(small, same).withColumn("_upto", F.col("_before") + F.col("_in_block"))

    def statistic(p: float):
        at = F.least(F.col("_n"), F.floor(F.lit(p) * F.col("_n")) + 1)
        return F.min(F.when(F.col("_upto") >= at, F.col(value)))

    out = ranked.groupBy(*by).agg(F.max("_n").alias("n"), *[statistic(p).alias(n) for n, p in ps.items()])
    return out if keys else out.drop("_all")
