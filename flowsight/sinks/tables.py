"""Table sinks: definition, checks, batch loads and idempotent stream loads."""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import DateType, StringType, StructField, StructType

from flowsight.schemas import split_required

# Load columns behind the data columns: day partition and name of the load.
DATE_COLUMN = "dt"
LOAD_COLUMN = "load_id"
# How the names of merged loads begin (see `compaction`).
MERGED = "merged-"

# Files per load of the flow and the payment tables.
FLOW_SHARDS = 100
TRANSACTION_SHARDS = 1000


def create_table(
    spark: SparkSession,
    table: str,
    schema: StructType,
    partition_by: list[str] | None = None,
    location: str | None = None,
) -> None:
    """CREATE TABLE IF NOT EXISTS ... USING parquet, partitioned as named.

    Partition columns that `schema` lacks are added behind it: `dt` as date,
    `load_id` as text.
    """
    extra = {DATE_COLUMN: DateType(), LOAD_COLUMN: StringType()}
    fields = list(schema.fields)
    for name in partition_by or []:
        if name not in schema.fieldNames():
            fields.append(StructField(name, extra[name], True))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    ddl = f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet"
    if partition_by:
        ddl += f" PARTITIONED BY ({', '.join(partition_by)})"
    if location:
        ddl += f" LOCATION '{location}'"
    spark.sql(ddl)


def require_table(spark: SparkSession, table: str, df: DataFrame) -> list[str]:
    """The table's columns, after checking that it exists and can take `df`."""
    if not spark.catalog.tableExists(table):
        raise ValueError(f"table {table} does not exist; the sinks create none")
    target = spark.table(table).schema
    given = {f.name: f.dataType for f in df.schema}
    wrong = [
        f.name
        for f in target
        if f.name not in (DATE_COLUMN, LOAD_COLUMN) and given.get(f.name) != f.dataType
    ]
    if wrong:
        raise ValueError(f"table {table} does not fit the rows in columns {wrong}")
    return target.fieldNames()


def laid_out(
    df: DataFrame, shards: int | None, cluster_by: list[str] | None
) -> DataFrame:
    """File layout: even files, sorted for min/max pruning.

    `shards` is where the rebalancing starts: it joins small partitions and splits large
    ones by the advisory size, so the number of files follows the load. Without
    `shards` the rows are written where they are, without a shuffle.
    """
    if shards:
        df = df.hint("rebalance", shards)
    if cluster_by:
        # led by the partition column, so that the writer has nothing left to sort
        lead = [DATE_COLUMN] if DATE_COLUMN in df.columns else []
        df = df.sortWithinPartitions(*lead, *cluster_by)
    return df


def with_clause(load_id: str, day: str = "") -> str:
    """A partition of a load in SQL."""
    return f"{LOAD_COLUMN} = '{load_id}'" + (f", {DATE_COLUMN} = DATE '{day}'" if day else "")


def with_date(df: DataFrame, time_column: str = "transaction_time") -> DataFrame:
    """Adds the day partition column from a timestamp or its text."""
    return df.withColumn(DATE_COLUMN, F.to_date(F.col(time_column)))


def append(
    df: DataFrame,
    table: str,
    shards: int | None = None,
    cluster_by: list[str] | None = None,
) -> None:
    """Append rows to an existing table, columns matched by name. Runs the query."""
    columns = require_table(df.sparkSession, table, df)
    laid_out(df, shards, cluster_by).select(*columns).write.insertInto(table)


def load(
    df: DataFrame,
    table: str,
    load_id: str | int,
    shards: int | None = None,
    cluster_by: list[str] | None = None,
) -> None:
    """Load `load_id` into a table partitioned by it first, replacing an earlier try.

    The name has to hold the run as well as the batch: a micro-batch that is run again
    after a failure writes its own partition over, so rows are neither lost nor
    doubled, and the loads of other runs stay. Runs the query.
    """
    if not re.fullmatch(r"[\w.-]+", str(load_id)) or str(load_id).startswith(MERGED):
        raise ValueError(f"{load_id!r} is no name for a load")
    columns = require_table(df.sparkSession, table, df)
    data = [c for c in columns if c != LOAD_COLUMN]
    spec = f"{LOAD_COLUMN} = '{load_id}'"
    if DATE_COLUMN in columns:
        spec += f", {DATE_COLUMN}"
    df.sparkSession.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION ({spec}) SELECT * FROM {{rows}}",
        rows=laid_out(df, shards, cluster_by).select(*data),
    )


def loaded(spark: SparkSession, table: str, load_id: str | int) -> DataFrame:
    """The rows of one load, as they were written."""
    return spark.table(table).where(F.col(LOAD_COLUMN) == F.lit(str(load_id)))


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of a started streaming query, kept with its checkpoint over restarts."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def load_checked(
    df: DataFrame,
    table: str,
    load_id: str | int,
    required: list[str],
    rejects_table: str | None = None,
    **layout: object,
) -> None:
    """As `load`; rows with a null in a required column go to the rejects table, or
    fail the load where there is none."""
    good, bad = split_required(df, required)
    if rejects_table:
        load(bad, rejects_table, load_id)
    else:
        message = F.raise_error(F.lit(f"null in a required column of {table}"))
        first = F.when(
            F.greatest(*[F.col(c).isNull() for c in required]), message.cast("string")
        ).otherwise(F.col(required[0]))
        good = df.withColumn(required[0], first)
    load(good, table, load_id, **layout)


def stream_load(
    df: DataFrame,
    write: Callable[[DataFrame, str], None],
    checkpoint: str,
    every_seconds: int | None = None,
    available_now: bool = False,
) -> DataStreamWriter:
    """Writer that hands each micro-batch to `write(batch, load_id)`.

    The load is named by the query of the checkpoint and the batch: another checkpoint
    makes other loads.     `every_seconds` is the load frequency; `available_now` works off what is there.
    """
    run: list[str] = []

    def named(batch: DataFrame, batch_id: int) -> None:
        if not run:
            run.append(run_id(batch.sparkSession, checkpoint))
        write(batch, f"{run[0]}-{batch_id}")

    writer = df.writeStream.foreachBatch(named).option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True)
    if every_seconds:
        return writer.trigger(processingTime=f"{every_seconds} seconds")
    return writer


def stream_append(
    df: DataFrame, path: str, checkpoint: str, available_now: bool = False
) -> DataStreamWriter:
    """Row-by-row insert: exactly-once append to a parquet folder."""
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return writer.trigger(availableNow=True) if available_now else writer
