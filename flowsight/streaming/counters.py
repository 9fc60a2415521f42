"""Counters as rows, committed with the load they were observed in.

The counters of a load are its partition of the counters table: a load that is run again replaces them, so totals
are exact over restarts. They are observed while the rows are written, without a pass of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from flowsight.sinks.compaction import current
from flowsight.sinks.tables import LOAD_COLUMN, create_table, load

COUNTERS = StructType([StructField("name", StringType()), StructField("value", LongType())])


def observed(df: DataFrame, seen: Observation, sums: dict[str, str]) -> DataFrame:
    """`df`, whose next action also counts: `sums` maps a counter's name to an expression summed over the rows."""
    return df.observe(seen, *[F.coalesce(F.sum(F.expr(e)), F.lit(0)).cast("bigint").alias(n) for n, e in sums.items()])


def create_counters(spark: SparkSession, table: str, location: str | None = None) -> None:
    create_table(spark, table, COUNTERS, [LOAD_COLUMN], location)


def commit_counters(spark: SparkSession, table: str, load_id: str, values: dict[str, int]) -> None:
    """The counters of a load, in place of those of an earlier try."""
    rows = spark.createDataFrame(sorted(values.items()), COUNTERS).coalesce(1)
    load(rows, table, load_id)


def totals(spark: SparkSession, table: str) -> DataFrame:
    """`name, total` over all loads."""
    return current(spark, table).groupBy("name").agg(F.sum("value").alias("total"))
