"""Table scans: side tables, partition ranges, model tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsight.schemas import NORMALIZED_CENTROIDS, conform
from flowsight.sinks import compaction
from flowsight.sinks.tables import LOAD_COLUMN


def read_query_file(spark: SparkSession, path: str) -> DataFrame:
    """Run the SQL text stored at `path`."""
    rows = spark.read.text(path, wholetext=True).limit(1).collect()
    if not rows:
        raise ValueError(f"no SQL text at {path}")
    return spark.sql(rows[0]["value"].strip().rstrip(";"))


def read_centroids(spark: SparkSession, query_path: str) -> DataFrame:
    """Scoring side table from a stored query, typed and in vector order."""
    return conform(read_query_file(spark, query_path), NORMALIZED_CENTROIDS)


def read_partitions(
    spark: SparkSession,
    table: str,
    date_from: str | dt.date,
    date_to: str | dt.date,
    date_column: str = "dt",
) -> DataFrame:
    """Scan of the day partitions in the closed range; the others are not read.

    Of a table of loads each row once, also while its loads are being merged.
    """
    inside = in_range(date_from, date_to, date_column)
    if LOAD_COLUMN in spark.table(table).columns:
        return compaction.current(spark, table, inside)
    return spark.table(table).where(inside)


def in_range(date_from: str | dt.date, date_to: str | dt.date, date_column: str = "dt") -> Column:
    return F.col(date_column).between(F.lit(str(date_from)).cast("date"), F.lit(str(date_to)).cast("date"))


def partition_range(
    df: DataFrame,
    date_from: str | dt.date,
    date_to: str | dt.date,
    date_column: str = "dt",
) -> DataFrame:
    return df.where(in_range(date_from, date_to, date_column))
