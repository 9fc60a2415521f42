"""Message-bus and sequence sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stream_kafka(
    spark: SparkSession, servers: str, topic: str, **options: str
) -> DataFrame:
    """`line, event_ts` from a topic; needs the Kafka connector on the classpath."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
    )
    for key, value in options.items():
        reader = reader.option(key, value)
    return from_messages(reader.load())


def from_messages(messages: DataFrame) -> DataFrame:
    """`line, event_ts` from any frame with `value` and `timestamp` columns."""
    return messages.select(
        F.col("value").cast("string").alias("line"),
        F.col("timestamp").alias("event_ts"),
    )


def sequence(spark: SparkSession, rows: int, partitions: int | None = None) -> DataFrame:
    """Bounded sequence 0..rows-1 in column `id`."""
    return spark.range(0, rows, 1, partitions)


def stream_sequence(spark: SparkSession, rows_per_second: int) -> DataFrame:
    """Endless sequence at a fixed rate: `id, event_ts`."""
    return (
        spark.readStream.format("rate")
        .option("rowsPerSecond", rows_per_second)
        .load()
        .select(F.col("value").alias("id"), F.col("timestamp").alias("event_ts"))
    )
