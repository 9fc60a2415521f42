"""Payment fraud job: lines -> transactions -> scores -> alerts."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType, TimestampType

from flowsight.functions.scalars import shard_of
from flowsight.operators.ensemble import Ensemble
from flowsight.operators.fraud import (
    KEY_COLUMN,
    alerts,
    instance_json,
    model_input,
    parse_predictions,
    predict,
    prediction_rows,
    score_requests,
    score_transactions,
)
from flowsight.operators.parse import parse_transaction_lines, rejected_rows, valid_rows
from flowsight.options import FraudOptions
from flowsight.schemas import FRAUD_PREDICTION, REJECTS, TRANSACTION, conform
from flowsight.session import written
from flowsight.sinks.tables import LOAD_COLUMN, create_table, load, load_checked, loaded, stream_load
from flowsight.sources.files import with_arrival_time
from flowsight.plans.inputs import load_interval
from flowsight.streaming.batcher import stream_requests
from flowsight.streaming.metrics import counted
from flowsight.streaming.windows import with_watermark

# The transaction table keeps the event time, so that it can be scored from.
TIMED = StructType(TRANSACTION.fields + [StructField("event_ts", TimestampType())])

Scorer = Callable[[], Callable[[str], str]]


def _timed(lines: DataFrame) -> DataFrame:
    return lines if "event_ts" in lines.columns else with_arrival_time(lines)


def transactions_of(lines: DataFrame) -> DataFrame:
    """Typed transactions of `line[, event_ts]` records; malformed lines drop out."""
    return counted(valid_rows(parse_transaction_lines(_timed(lines))), "transactions")


def rejects_of(lines: DataFrame) -> DataFrame:
    """The malformed lines."""
    return rejected_rows(parse_transaction_lines(_timed(lines)))


def create_tables(
    spark: SparkSession, options: FraudOptions, location: str | None = None
) -> None:
    specs = [
        (options.transactions_table, TIMED),
        (options.predictions_table, FRAUD_PREDICTION),
    ]
    if options.transaction_rejects_table:
        specs.append((options.transaction_rejects_table, TIMED))
    if options.rejects_table:
        specs.append((options.rejects_table, REJECTS))
    for table, schema in specs:
        path = f"{location}/{table.split('.')[-1]}" if location else None
        create_table(spark, table, schema, [LOAD_COLUMN], path)


def score(
    transactions: DataFrame,
    options: FraudOptions = FraudOptions(),
    model: PipelineModel | Ensemble | None = None,
    open_scorer: Scorer | None = None,
) -> DataFrame:
    """Alerts of a bounded set of transactions.

    A model (fitted, or read from a table of nodes) scores without request documents. A scorer gets
    the documents of (window, shard), one at a time, and answers in JSON.
    """
    if model is not None:
        scored = prediction_rows(predict(model, model_input(transactions)))
    elif open_scorer is not None:
        answers = score_transactions(
            transactions,
            open_scorer,
            options.batch_bytes,
            options.key_range,
            options.window_seconds,
        )
        scored = parse_predictions(answers)
    else:
        raise ValueError("give a model or a scorer")
    return alerts(scored, options.probability)


def _shards(options: FraudOptions) -> int | None:
    return options.file_shards if options.write_method == "file_loads" else None


def _load_transactions(rows: DataFrame, options: FraudOptions, load_id: str) -> None:
    load_checked(
        conform(rows, TIMED),
        options.transactions_table,
        load_id,
        [KEY_COLUMN],
        options.transaction_rejects_table,
        shards=_shards(options),
    )


def run_batch(
    lines: DataFrame,
    options: FraudOptions = FraudOptions(),
    model: PipelineModel | Ensemble | None = None,
    open_scorer: Scorer | None = None,
    load_id: str | None = None,
) -> None:
    """The job over a bounded input. Runs the queries and writes both tables.

    Every run adds its rows under a name of its own. `load_id` names the input: the same
    name again replaces its rows. The lines are parsed once: scoring reads the
    transactions just written.
    """
    load_id = load_id or uuid.uuid4().hex
    if options.rejects_table:
        parsed = written(parse_transaction_lines(_timed(lines)), "parsed")
        load(rejected_rows(parsed), options.rejects_table, load_id)
        rows = counted(valid_rows(parsed), "transactions")
    else:
        rows = transactions_of(lines)
    _load_transactions(rows, options, load_id)
    transactions = loaded(lines.sparkSession, options.transactions_table, load_id)
    load(
        score(transactions, options, model, open_scorer),
        options.predictions_table,
        load_id,
        _shards(options),
    )


def start_stream(
    lines: DataFrame,
    options: FraudOptions,
    checkpoint: str,
    model: PipelineModel | Ensemble | None = None,
    open_scorer: Scorer | None = None,
    available_now: bool = False,
    on_load: Callable[[str, dict[str, int]], None] | None = None,
) -> list[StreamingQuery]:
    """Start the transaction sink and the scoring query. `on_load` is told the number
    of alerts of every load."""
    transactions = transactions_of(lines)

    def write_transactions(batch: DataFrame, load_id: str) -> None:
        _load_transactions(batch, options, load_id)

    every = load_interval(options)
    queries = [
        stream_load(
            transactions, write_transactions, f"{checkpoint}/transactions", every, available_now
        ).start()
    ]

    if options.rejects_table:

        def write_rejects(batch: DataFrame, load_id: str) -> None:
            load(batch, options.rejects_table, load_id)

        queries.append(
            stream_load(
                rejects_of(lines), write_rejects, f"{checkpoint}/rejects", every, available_now
            ).start()
        )

    if model is not None:
        scored_input = transactions

        def score_batch(batch: DataFrame) -> DataFrame:
            return score(batch, options, model=model)

    else:
        timed = with_watermark(transactions, "event_ts", options.allowed_lateness_seconds)
        scored_input = stream_requests(
            timed,
            instance_json(),
            shard_of(F.col(KEY_COLUMN), options.key_range),
            options.batch_bytes,
            options.window_seconds,
        )

        def score_batch(batch: DataFrame) -> DataFrame:
            answers = score_requests(batch, open_scorer)
            return alerts(parse_predictions(answers), options.probability)

    def write_alerts(batch: DataFrame, load_id: str) -> None:
        load(
            score_batch(batch),
            options.predictions_table,
            load_id,
            _shards(options),
        )
        if on_load:
            found = loaded(batch.sparkSession, options.predictions_table, load_id)
            on_load(load_id, {"alerts": found.count()})

    queries.append(
        stream_load(
            scored_input, write_alerts, f"{checkpoint}/alerts", every, available_now
        ).outputMode("append").start()
    )
    return queries
