"""Raw lines of a job, from files, a bus or both."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowsight.options import FlowOptions, FraudOptions
from flowsight.session import written
from flowsight.sources.files import merge, read_lines, stream_lines, with_arrival_time
from flowsight.sources.geofile import read_geo_ranges
from flowsight.sources.tables import read_centroids


def batch_lines(spark: SparkSession, options: FlowOptions | FraudOptions) -> DataFrame:
    """The lines of the files that are there now, with `event_ts` where no field holds it."""
    lines = read_lines(spark, f"{options.input_path}/{options.input_glob}")
    return lines if _own_time(options) else with_arrival_time(lines)


def _own_time(options: FlowOptions | FraudOptions) -> bool:
    """Whether the event time is read from the records."""
    field = getattr(options, "event_time_field", None)
    return bool(field) and not options.arrival_time


def live_lines(
    spark: SparkSession,
    options: FlowOptions | FraudOptions,
    bus: DataFrame | None = None,
) -> DataFrame:
    """The lines of new files and of the bus; `event_ts` of arrival where no field holds it.

    `bus` is a stream with the same two columns, such as `sources.bus` makes.
    """
    parts, columns = [], ["line"] if _own_time(options) else ["line", "event_ts"]
    if options.input_path:
        files = stream_lines(spark, options.input_path, options.input_glob)
        parts.append(with_arrival_time(files).select(*columns))
    if bus is not None:
        parts.append(bus.select(*columns))
    if not parts:
        raise ValueError("give an input path or a bus")
    return merge(*parts)


def side_tables(
    spark: SparkSession, options: FlowOptions
) -> tuple[DataFrame, DataFrame | None]:
    """(centroids, address ranges) as the options name them."""
    if not options.cluster_query:
        raise ValueError("give a cluster query")
    ranges = spark.table(options.geo_table) if options.geo_table else None
    if options.geo_file:  # decoded once, then read as a table
        ranges = written(read_geo_ranges(spark, options.geo_file), "geo")
    return read_centroids(spark, options.cluster_query), ranges


def load_interval(options: FlowOptions | FraudOptions) -> int | None:
    """Seconds between loads: the batch frequency for file loads, else the file
    poll interval, else none (a bus alone is followed without pause)."""
    if options.write_method == "file_loads":
        return options.batch_minutes * 60
    return options.poll_seconds if options.input_path else None
