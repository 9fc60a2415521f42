"""Mock-data publisher: sequence -> records -> messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowsight.operators.generate import (
    generate_flow_logs,
    generate_transactions,
    to_messages,
)
from flowsight.options import GeneratorOptions
from flowsight.schemas import FLOW_LOG, TRANSACTION
from flowsight.sources.bus import sequence, stream_sequence


def messages(ids: DataFrame, options: GeneratorOptions) -> DataFrame:
    """`value, headers` for every id."""
    if options.record == "flow_log":
        records, schema = generate_flow_logs(ids, seed=options.seed), FLOW_LOG
    elif options.record == "transaction":
        records, schema = generate_transactions(ids, seed=options.seed), TRANSACTION
    else:
        raise ValueError(f"unknown record {options.record!r}")
    return to_messages(records, options.event_type, schema.fieldNames())


def bounded(spark: SparkSession, rows: int, options: GeneratorOptions) -> DataFrame:
    return messages(sequence(spark, rows), options)


def endless(spark: SparkSession, options: GeneratorOptions) -> DataFrame:
    return messages(stream_sequence(spark, options.rows_per_second), options)
