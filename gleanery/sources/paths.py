"""Paths and scratch space shared by all executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the one the cluster names for checkpoints.

    A machine's own temporary folder serves only local mode, where one machine is all.
    """
    shared = spark.conf.get(CHECKPOINT_DIR, None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_DIR} must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="gleanery-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    fs, p = file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
