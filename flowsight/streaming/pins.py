"""Side inputs of micro-batches, kept with the checkpoint so that a batch that is run again sees the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _store(spark: SparkSession, path: str):
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    return name, name.getFileSystem(spark._jsc.hadoopConfiguration())


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to `path` has come to its end."""
    name, store = _store(spark, f"{path}/_SUCCESS")
    return store.exists(name)


def pinned(spark: SparkSession, folder: str, load_id: str, read: Callable[[], DataFrame]) -> DataFrame:
    """What `read()` gave when the load was first tried.

    Pins of the run's loads before the last are removed: only the newest batch can be run again.
    """
    path = f"{folder}/{load_id}"
    if not is_complete(spark, path):
        read().write.mode("overwrite").parquet(path)
    run, _, batch = load_id.rpartition("-")
    if batch.isdigit() and int(batch) > 1:
        old, store = _store(spark, f"{folder}/{run}-{int(batch) - 2}")
        store.delete(old, True)
    return spark.read.parquet(path)
