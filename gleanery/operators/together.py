"""Independent Spark jobs at the same time, so that small ones do not wait for each other."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def together(spark: SparkSession, jobs: list[Callable]) -> list:
    """Run functions that each start Spark jobs; their results in the order given."""
    if len(jobs) < 2:
        return [job() for job in jobs]
    with ThreadPoolExecutor(len(jobs)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        return [s.result() for s in started]
