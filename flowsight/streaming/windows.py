"""Event time, watermarks and closing the last windows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from flowsight.session import ROCKSDB_PROVIDER


def with_watermark(
    df: DataFrame, event_time: str = "event_ts", lateness_seconds: int = 0
) -> DataFrame:
    """Rows behind the watermark are dropped; in append mode every window comes out
    once, when the watermark passes its end.

    The watermark lags by one micro-batch. `event_time` must be a TIMESTAMP.
    """
    return df.withWatermark(event_time, f"{lateness_seconds} seconds")


def run_to_end(
    start: Callable[[], list[StreamingQuery]], state_partitions: int | None = None
) -> None:
    """Start availableNow queries and wait for them, with their state on disk.

    `state_partitions` is fixed with the first run of a checkpoint; left out, it is
    the session's number of shuffle partitions.
    """
    spark = SparkSession.active()
    settings = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER}
    if state_partitions:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    with session_settings(spark, settings):
        queries = start()
    for query in queries:
        query.awaitTermination()


def write_sentinel(
    spark: SparkSession,
    schema: StructType,
    directory: str,
    event_time: str = "event_ts",
    **values: object,
) -> None:
    """One record far in the future, for a source folder of its own.

    A stream only closes the windows its watermark has passed. When input has ended
    for good, start the query once more with this record in reach: it closes every
    window of real data, and its own window never closes. `values` make it pass the
    filters in front of the watermark, which Spark evaluates first.
    """
    # within the range of nanosecond timestamps, which Arrow hands to pandas
    far = F.lit("2200-01-01 00:00:00").cast("timestamp")
    row = spark.range(1).select(
        *[
            (far if f.name == event_time else F.lit(values.get(f.name)).cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )
    row.coalesce(1).write.mode("append").parquet(directory)


def empty_source(spark: SparkSession, schema: StructType, directory: str) -> None:
    """Create `directory` as a parquet source without rows."""
    spark.createDataFrame([], schema).write.mode("append").parquet(directory)


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings for the queries started inside; a query keeps those it began with."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
