"""The next row in a total order over a whole table, without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanery.llm import common as C


def with_next(rows: DataFrame, order: list[str], wrap: bool = False) -> DataFrame:
    """rows with the column ``next``: a struct of all columns of the following row (last: null, or the first row if ``wrap``).

    ``order`` must tell all rows apart. Rows should be narrow: they are written once, cut into ranges of the order, so that
    the range a row is in stays fixed. Only the first row of each range, one per partition, meets in one place.
    """
    whole = [F.col(c) for c in rows.columns]
    ranged = C.settle(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    inside = Window.partitionBy("_part").orderBy(*order)
    firsts = ranged.groupBy("_part").agg(F.min_by(F.struct(*whole), F.struct(*order)).alias("_first"))
    along = Window.orderBy("_part")  # a row per partition of the range exchange
    everywhere = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = F.lead("_first").over(along)
    after = F.coalesce(after, F.first("_first").over(everywhere)) if wrap else after
    carried = firsts.select("_part", after.alias("_after"))
    return (
        ranged.withColumn("next", F.lead(F.struct(*whole)).over(inside))
        .join(F.broadcast(carried), "_part")  # a row per partition
        .select(*whole, F.coalesce("next", "_after").alias("next"))
    )
