"""Arithmetic of pages: positions are 0-based, pages 1-based."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def page_of_index(position: Column, page_size: int | Column) -> Column:
    size = F.lit(page_size) if isinstance(page_size, int) else page_size
    return F.floor(position / size) + 1


def page_count(total: Column, page_size: int | Column) -> Column:
    size = F.lit(page_size) if isinstance(page_size, int) else page_size
    return F.greatest(F.lit(1).cast("bigint"), F.ceil(total / size))


def expected_rows(total: Column, first: Column, page_size: int | Column) -> Column:
    size = F.lit(page_size) if isinstance(page_size, int) else page_size
    return F.least(size.cast("bigint"), total - first)


def is_last_page(page: Column, total: Column, page_size: int | Column) -> Column:
    return page == page_count(total, page_size)
