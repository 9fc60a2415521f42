"""Publishing messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter


def publish_kafka(messages: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    """Writer of `value, headers` to a topic; needs the Kafka connector."""
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("includeHeaders", "true")
        .option("checkpointLocation", checkpoint)
    )


def publish_files(messages: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Writer of the same messages as JSON files, for runs without a bus."""
    return (
        messages.writeStream.format("json")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
