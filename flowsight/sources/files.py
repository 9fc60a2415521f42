"""File sources: raw lines, CSV, newline JSON."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowsight.sinks.tables import append, create_table


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Batch: one `line` per row from every file the path or glob matches."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def stream_lines(
    spark: SparkSession,
    directory: str,
    name_glob: str = "*",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Stream: as `read_lines`, for files as they appear in the directory.

    The poll interval belongs to the trigger of the query that is started on it.
    """
    reader = spark.readStream.option("pathGlobFilter", name_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(directory).withColumnRenamed("value", "line")


def with_arrival_time(df: DataFrame, name: str = "event_ts") -> DataFrame:
    """Stamp every record with the time it was read."""
    return df.withColumn(name, F.current_timestamp())


def read_csv(
    spark: SparkSession, path: str, schema: StructType, header: bool = True
) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=header)


def read_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


# Type names of schema files.
_TYPES = {
    "STRING": "string", "INTEGER": "bigint", "INT64": "bigint", "FLOAT": "double", "FLOAT64": "double",
    "NUMERIC": "decimal(38,9)", "BOOLEAN": "boolean", "BOOL": "boolean", "TIMESTAMP": "timestamp",
    "DATE": "date", "BYTES": "binary",
}


def read_schema(spark: SparkSession, path: str) -> StructType:
    """The schema of a file that lists `{"name", "type", "mode"}` of each column; REPEATED makes an array."""
    text = spark.read.text(path, wholetext=True).first()
    if text is None:
        raise ValueError(f"no schema at {path}")
    columns = []
    for column in json.loads(text[0]):
        kind = _TYPES[column["type"].upper()]
        repeated = column.get("mode", "NULLABLE").upper() == "REPEATED"
        columns.append(f"`{column['name']}` " + (f"array<{kind}>" if repeated else kind))
    return StructType.fromDDL(", ".join(columns))


def load_json(spark: SparkSession, path: str, table: str, schema: StructType, location: str | None = None) -> None:
    """Appends the newline JSON at `path` to a table, which is made where it is missing. Runs the load."""
    create_table(spark, table, schema, None, location)
    append(read_json(spark, path, schema), table)


def merge(*frames: DataFrame) -> DataFrame:
    """Union of file and bus records, matched by column name, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), frames)
