"""Session settings and the shared folder for staged data."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

from chronoloom.functions.buckets import register


def configure(spark: SparkSession) -> SparkSession:
    """Set what results depend on: UTC days and buckets, errors in place of silent nulls, and ``time_bucket`` in SQL.

    Nothing that sizes a job is set here; shuffle partitions, split sizes and AQE stay with the cluster.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    # The JVM never compiles a method over 8000 bytes. Text work on wide rows makes such methods; past this limit
    # Spark splits the work into small ones instead.
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    register(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor reaches: ``spark.checkpoint.dir``.

    Where that is unset, a temporary folder is taken, and only in local mode.
    """
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path is None and context.getCheckpointDir() is not None:
        path = context.getCheckpointDir().rsplit("/", 1)[0]
    if path is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="chronoloom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(path)
    return path.rstrip("/")


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Hold SQL settings for the time of one action."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
