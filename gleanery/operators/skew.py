"""Joins of many rows to one row per key, where a key may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def lookup(rows: DataFrame, dim: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join ``rows`` to ``dim``, which has one row per key.

    Adaptive execution sees from the shuffle which partitions a hot key (or NULL) has made too large, and gives pieces of them
    to several tasks, each with that key's one row of ``dim`` (``spark.sql.adaptive.skewJoin``). Nothing is counted beforehand.
    It leaves a join alone if that would cost a further shuffle: what comes after should not group by the same keys.
    """
    return rows.join(dim, keys, how)


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def null_safe(left: Column, right: Column) -> Column:
    """True where two values differ, NULL being a value of its own."""
    return ~left.eqNullSafe(right)
