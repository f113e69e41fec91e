"""Running and rolling windows per key that also hold for a key with a third of all rows.

Rows are cut into blocks by ranges of (key, order) and written once, so that a block stays what it is. A block holds rows of
many small keys, or a stretch of a large one; each key in a block is a window partition of its own. What a key's rows need from
the blocks before is one small row, for at most one key per block: only the key that a block starts with can go on from the
block before. As data grows, there are more blocks (``spark.sql.shuffle.partitions``), not larger ones. No key is looked for,
counted or limited beforehand, and the result does not depend on where blocks are cut.

``order`` must order the rows of a key totally. Rows should be narrow.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.sources.sinks import settle

CHUNK_ROWS = 1_000_000  # rows of a key that make a window partition of a rolling sum


@dataclass(frozen=True)
class Blocks:
    """Rows with their block."""

    rows: DataFrame
    keys: list[str]
    order: list[str]

    @property
    def partition(self) -> list[str]:
        return [*self.keys, "_block"]

    def where_rows(self, rows: DataFrame) -> Blocks:
        return replace(self, rows=rows)


def blocks(rows: DataFrame, keys: list[str], order: list[str], parts: int | None = None) -> Blocks:
    """Cut rows into blocks, as many as a shuffle has partitions, or ``parts``."""
    columns = [*keys, *order]
    ranged = rows.repartitionByRange(parts, *columns) if parts else rows.repartitionByRange(*columns)
    return Blocks(settle(ranged.withColumn("_block", F.spark_partition_id()), "blocks"), keys, order)


def over(kind: str, value: Column, window) -> Column:
    if kind == "sum":
        return F.coalesce(F.sum(value).over(window), F.lit(0))
    return F.max(value).over(window) if kind == "max" else F.last(value, ignorenulls=True).over(window)


def total(kind: str, value: Column, order: list[str]) -> Column:
    if kind == "sum":
        return F.sum(value)
    return F.max(value) if kind == "max" else F.max_by(value, F.when(value.isNotNull(), F.struct(*order)))


def running(b: Blocks, specs: dict[str, tuple[str, Column]], inclusive: bool = True) -> Blocks:
    """Add running columns: name → (``sum`` | ``max`` | ``last``, expression).

    Over all rows of the key up to this one, or before it. ``last`` is the last value that is not NULL. An empty sum is 0.
    """
    frame = Window.partitionBy(*b.partition).orderBy(*b.order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    along = Window.partitionBy(*b.keys).orderBy("_block")
    totals = b.rows.groupBy(*b.partition).agg(*[total(k, e, b.order).alias(f"_t_{n}") for n, (k, e) in specs.items()])
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.withColumns({f"_c_{n}": over(k, F.col(f"_t_{n}"), earlier) for n, (k, _) in specs.items()})
    carried = carried.withColumn("_nth", F.row_number().over(along)).where("_nth > 1").select(
        *[F.col(k).alias(f"_c{i}") for i, k in enumerate(b.partition)], *[f"_c_{n}" for n in specs]
    )
    same = [b.rows[k].eqNullSafe(carried[f"_c{i}"]) for i, k in enumerate(b.partition)]
    local = b.rows.join(F.broadcast(carried), same, "left")  # a row per block at most

    def joined(name: str, kind: str, value: Column) -> Column:
        here, before = over(kind, value, frame), F.col(f"_c_{name}")
        if kind == "sum":
            return here + F.coalesce(before, F.lit(0))
        return F.greatest(here, before) if kind == "max" else F.coalesce(here, before)

    done = local.withColumns({n: joined(n, k, e) for n, (k, e) in specs.items()})
    return b.where_rows(done.select(*b.rows.columns, *specs))


def rank(b: Blocks, name: str = "rn") -> Blocks:
    """Number the rows of each key from 1."""
    return running(b, {name: ("sum", F.lit(1).cast("bigint"))})


def rolling_sum(b: Blocks, size: int, specs: dict[str, Column], chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Sums over each row and the ``size - 1`` rows before it.

    A key's rows are cut into even chunks by rank; the last rows of a chunk are repeated ahead of the next one.
    """
    width = max(chunk_rows, size)
    at = F.floor((F.col("_rn") - 1) / width)
    tail = F.pmod(F.col("_rn") - 1, F.lit(width)) >= width - size + 1
    ranked = rank(b, "_rn").rows
    spread = ranked.select("*", F.posexplode(F.when(tail, F.array(at, at + 1)).otherwise(F.array(at))).alias("_halo", "_chunk"))
    w = Window.partitionBy(*b.keys, "_chunk").orderBy("_rn").rowsBetween(1 - size, 0)
    summed = spread.withColumns({n: F.sum(e).over(w) for n, e in specs.items()})
    return summed.where("_halo = 0").select(*[c for c in b.rows.columns if c != "_block"], *specs)


def finish(b: Blocks) -> DataFrame:
    """The rows without the column that served to cut them."""
    return b.rows.drop("_block")
