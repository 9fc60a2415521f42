"""Registered queries that run the whole jobs, in batch and as streams."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from flowsight.checks import views as V
from flowsight.checks.queries import REQUEST_BYTES, REQUEST_WINDOW, SHARDS, open_rule_scorer
from flowsight.functions.scalars import shard_of
from flowsight.operators.fraud import instance_json
from flowsight.operators.generate import to_messages
from flowsight.options import FlowOptions, FraudOptions
from flowsight.plans import flow_anomaly, fraud_detection
from flowsight.plans.inputs import batch_lines
from flowsight.schemas import FLOW_LOG, NORMALIZED_CENTROIDS, TRANSACTION, conform
from flowsight.session import scratch_path, written
from flowsight.sinks.bus import publish_files
from flowsight.sinks.tables import stream_append
from flowsight.sources.bus import from_messages
from flowsight.sources.files import merge
from flowsight.streaming import counters
from flowsight.streaming.batcher import stream_requests
from flowsight.streaming.windows import (
    empty_source,
    run_to_end,
    with_watermark,
    write_sentinel,
)

_LINE = StructType([StructField("line", StringType()), StructField("event_ts", TimestampType())])

# valid records that only carry a time
_FLOW_SENTINEL = '{"srcIP":"0.0.0.0","dstIP":"0.0.0.0"}'
_PAYMENT_SENTINEL = '{"transactionId":"end"}'


def flow_options() -> FlowOptions:
    tag = uuid.uuid4().hex
    return FlowOptions(
        window_seconds=V.DAY,
        features_table=f"features_{tag}",
        outliers_table=f"outliers_{tag}",
        raw_table=f"raw_{tag}",
        feature_rejects_table=f"feature_rejects_{tag}",
        write_method="file_loads",
        file_shards=4,
    )


def payment_options() -> FraudOptions:
    tag = uuid.uuid4().hex
    return FraudOptions(
        transactions_table=f"transactions_{tag}",
        predictions_table=f"predictions_{tag}",
        transaction_rejects_table=f"transaction_rejects_{tag}",
        window_seconds=REQUEST_WINDOW,
        batch_bytes=REQUEST_BYTES,
        key_range=SHARDS,
    )


def flow_text(events: DataFrame, injected: bool = True) -> DataFrame:
    flows = V.project(events, V.FLOW_INJECTED if injected else V.FLOW)
    return V.project(flows, V.LINES).select("line", "event_ts")


def payment_text(orders: DataFrame) -> DataFrame:
    rows = V.project(orders, V.TRANSACTIONS)
    return rows.select(F.to_json(F.struct(*TRANSACTION.fieldNames())).alias("line"), "event_ts")


def _stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    schema = V.table(spark, sf, name).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    return reader.parquet(sf)


def written_centroids(spark: SparkSession, sf: str, folder: str) -> DataFrame:
    """The side table as the offline job leaves it: computed once and stored."""
    path = f"{folder}/centroids"
    conform(V.normalized_centroids(spark, sf), NORMALIZED_CENTROIDS).write.parquet(path)
    return spark.read.schema(NORMALIZED_CENTROIDS).parquet(path)


def _released(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """The rows a job has written, from their files; the table leaves the catalog."""
    rows = spark.read.schema(spark.table(table).schema).parquet(f"{folder}/{table}")
    spark.sql(f"DROP TABLE {table}")
    return rows


def release(spark: SparkSession, folder: str, options: FlowOptions | FraudOptions, *names: str):
    """The rows of the named tables; all tables of the job leave the catalog."""
    tables = [v for k, v in vars(options).items() if k.endswith("_table") and v]
    rows = {t: _released(spark, folder, t) for t in tables if spark.catalog.tableExists(t)}
    return [rows[getattr(options, f"{name}_table")] for name in names]


def _flow_job(spark, sf) -> list[DataFrame]:
    folder, options = scratch_path(spark, "flow"), flow_options()
    flow_anomaly.create_tables(spark, options, folder)
    flow_anomaly.run_batch(
        flow_text(V.table(spark, sf, "events")),
        written_centroids(spark, sf, folder),
        options,
        V.geo_ranges(spark, sf),
    )
    return release(spark, folder, options, "features", "outliers", "raw")


def flow_job_features(spark, sf):
    return _flow_job(spark, sf)[0].drop("dt", "load_id")


def flow_job_outliers(spark, sf):
    return _flow_job(spark, sf)[1].drop("dt", "load_id")


def flow_job_raw(spark, sf):
    return _flow_job(spark, sf)[2].drop("dt", "load_id", "event_ts")


def flow_job_inspected(spark, sf):
    """The counts of sensitive values that the job stores beside its features."""
    folder = scratch_path(spark, "flow")
    options = replace(flow_options(), inspect_columns=("dst_subnet",))
    flow_anomaly.create_tables(spark, options, folder)
    flow_anomaly.run_batch(
        flow_text(V.table(spark, sf, "events")), written_centroids(spark, sf, folder), options
    )
    (features,) = release(spark, folder, options, "features")
    return features.select(
        "subscriber_id", "dst_subnet", "transaction_time",
        "dst_subnet_imsi_count", "dst_subnet_email_count", "dst_subnet_ipv4_count",
    )


def flow_job_text_files(spark, sf):
    """Text files in, event time out of the records: the features of the job."""
    folder = scratch_path(spark, "flow")
    options = replace(flow_options(), input_path=f"{folder}/in", input_glob="*.txt")
    flow_anomaly.create_tables(spark, options, folder)
    flow_text(V.table(spark, sf, "events")).select("line").write.text(f"{folder}/in")
    flow_anomaly.run_batch(
        batch_lines(spark, options), written_centroids(spark, sf, folder), options
    )
    (features,) = release(spark, folder, options, "features")
    return features.drop("dt", "load_id")


def fraud_job_rejects(spark, sf):
    """Payments without an id are kept apart, those with one are loaded."""
    folder, options = scratch_path(spark, "fraud"), payment_options()
    fraud_detection.create_tables(spark, options, folder)
    rows = V.transactions(spark, sf)
    named = F.when(F.col("o_orderkey") % 10 != 3, F.col("transactionId"))
    rows = rows.withColumn("transactionId", named)
    text = F.to_json(F.struct(*TRANSACTION.fieldNames()))
    fraud_detection.run_batch(
        rows.select(text.alias("line"), "event_ts"), options, open_scorer=open_rule_scorer
    )
    kept, rejected = release(spark, folder, options, "transactions", "transaction_rejects")
    kept = kept.select("transactionId", "amount", F.lit(False).alias("rejected"))
    return kept.union(rejected.select("transactionId", "amount", F.lit(True)))


def two_loads_append(spark, sf):
    """Two runs over the halves of the events: the second leaves the first as it is."""
    folder, options = scratch_path(spark, "flow"), flow_options()
    flow_anomaly.create_tables(spark, options, folder)
    centroids = written_centroids(spark, sf, folder)
    events, half = V.table(spark, sf, "events"), F.col("event_id") % 2
    for part in (0, 1):
        lines = flow_text(events.where(half == part))
        flow_anomaly.run_batch(lines, centroids, options, V.geo_ranges(spark, sf))
    return release(spark, folder, options, "raw")[0].drop("dt", "load_id", "event_ts")


def fraud_job_alerts(spark, sf):
    folder, options = scratch_path(spark, "fraud"), payment_options()
    fraud_detection.create_tables(spark, options, folder)
    fraud_detection.run_batch(
        payment_text(V.table(spark, sf, "orders")), options, open_scorer=open_rule_scorer
    )
    return _alert_rows(spark, folder, options)


def _alert_rows(spark, folder, options):
    return release(spark, folder, options, "predictions")[0].select(
        "transactionId", F.round("logistic", 9).alias("logistic")
    )


def _drained(spark, folder: str, sentinel_line: str, start, more_input=None) -> None:
    """Work off the input, and what `more_input` adds to it in a second run, then let
    the end-of-input record close the windows."""
    ends = f"{folder}/ends"
    empty_source(spark, _LINE, ends)

    def run() -> list:
        return start(spark.readStream.schema(_LINE).parquet(ends))

    partitions = spark.sparkContext.defaultParallelism
    run_to_end(run, partitions)
    if more_input:
        more_input()
        run_to_end(run, partitions)
    write_sentinel(spark, _LINE, ends, line=sentinel_line)
    run_to_end(run, partitions)


def stream_features(spark, sf):
    folder = scratch_path(spark, "stream")
    options = flow_options()

    def start(ends: DataFrame) -> list:
        lines = merge(flow_text(_stream(spark, sf, "events"), injected=False), ends)
        features = flow_anomaly.flow_frames(lines, options).features
        return [
            stream_append(features, f"{folder}/out", f"{folder}/checkpoint", True).start()
        ]

    _drained(spark, folder, _FLOW_SENTINEL, start)
    return spark.read.parquet(f"{folder}/out")


def stream_late_rows(spark, sf):
    """The whole feed arrives twice. The second time its windows are closed, all but
    the last: those rows are late and dropped."""
    folder, options = scratch_path(spark, "stream"), flow_options()
    replay = f"{folder}/replay"
    empty_source(spark, _LINE, replay)

    def start(ends: DataFrame) -> list:
        first = flow_text(_stream(spark, sf, "events"), injected=False)
        again = spark.readStream.schema(_LINE).parquet(replay)
        features = flow_anomaly.flow_frames(merge(first, again, ends), options).features
        return [
            stream_append(features, f"{folder}/out", f"{folder}/checkpoint", True).start()
        ]

    def play_again() -> None:
        lines = flow_text(V.table(spark, sf, "events"), injected=False)
        lines.write.mode("append").parquet(replay)

    _drained(spark, folder, _FLOW_SENTINEL, start, play_again)
    return spark.read.parquet(f"{folder}/out")


def stream_outliers(spark, sf):
    folder, options = scratch_path(spark, "stream"), flow_options()
    flow_anomaly.create_tables(spark, options, folder)
    centroids, ranges = written_centroids(spark, sf, folder), V.geo_ranges(spark, sf)

    def start(ends: DataFrame) -> list:
        lines = merge(flow_text(_stream(spark, sf, "events")), ends)
        return flow_anomaly.start_stream(
            lines, centroids, options, f"{folder}/checkpoint", ranges, available_now=True
        )

    _drained(spark, folder, _FLOW_SENTINEL, start)
    return release(spark, folder, options, "outliers")[0].drop("dt", "load_id")


def stream_request_instances(spark, sf):
    folder = scratch_path(spark, "stream")

    def start(ends: DataFrame) -> list:
        lines = merge(payment_text(_stream(spark, sf, "orders")), ends)
        rows = with_watermark(fraud_detection.transactions_of(lines))
        documents = stream_requests(
            rows, instance_json(), shard_of(F.col("transactionId"), SHARDS), REQUEST_BYTES, REQUEST_WINDOW
        )
        return [
            stream_append(documents, f"{folder}/out", f"{folder}/checkpoint", True).start()
        ]

    _drained(spark, folder, _PAYMENT_SENTINEL, start)
    whole = F.from_json("request", "instances array<string>")["instances"]
    instances = spark.read.parquet(f"{folder}/out").select(F.explode(whole).alias("i"))
    fields = "transactionId string, type string, amount double"
    return instances.select(F.from_json("i", fields).alias("i")).select("i.*")


def stream_alerts(spark, sf):
    folder, options = scratch_path(spark, "stream"), payment_options()
    fraud_detection.create_tables(spark, options, folder)

    def start(ends: DataFrame) -> list:
        lines = merge(payment_text(_stream(spark, sf, "orders")), ends)
        return fraud_detection.start_stream(
            lines, options, f"{folder}/checkpoint", open_scorer=open_rule_scorer, available_now=True
        )

    _drained(spark, folder, _PAYMENT_SENTINEL, start)
    return _alert_rows(spark, folder, options)


_MESSAGE = "value string, headers array<struct<key: string, value: binary>>, timestamp timestamp"


def stream_bus_features(spark, sf):
    """Flows published as messages by one stream, and read from there by the features of another."""
    folder, options = scratch_path(spark, "stream"), flow_options()
    flows = V.project(_stream(spark, sf, "events"), V.FLOW)
    messages = to_messages(flows, "netflow", FLOW_LOG.fieldNames())
    publish_files(messages, f"{folder}/topic", f"{folder}/sent").trigger(availableNow=True).start().awaitTermination()

    def start(ends: DataFrame) -> list:
        topic = from_messages(spark.readStream.schema(_MESSAGE).json(f"{folder}/topic"))
        lines = merge(topic.select("line"), ends.select("line"))  # the event time is in the records
        features = flow_anomaly.flow_frames(lines, options).features
        return [
            stream_append(features, f"{folder}/out", f"{folder}/checkpoint", True).start()
        ]

    _drained(spark, folder, _FLOW_SENTINEL, start)
    return spark.read.parquet(f"{folder}/out")


VERSION_FROM, VERSION_FACTOR = "2024-01-16", 0.5


def centroid_versions(spark, sf) -> DataFrame:
    """The side table in two versions, the later one with other spreads."""
    first = V.normalized_centroids(spark, sf).withColumn("valid_from", F.lit("1970-01-01").cast("timestamp"))
    later = first.withColumns(
        {
            "valid_from": F.lit(VERSION_FROM).cast("timestamp"),
            "normalized_dest": F.col("normalized_dest") * VERSION_FACTOR,
        }
    )
    return first.unionByName(later)


def _run_flow_stream(spark, sf, folder: str, options: FlowOptions, **kwargs) -> None:
    flow_anomaly.create_tables(spark, options, folder)
    centroids = written_centroids(spark, sf, folder)

    def start(ends: DataFrame) -> list:
        lines = merge(flow_text(_stream(spark, sf, "events")), ends)
        return flow_anomaly.start_stream(
            lines, centroids, options, f"{folder}/checkpoint", available_now=True, **kwargs
        )

    _drained(spark, folder, _FLOW_SENTINEL, start)


def stream_versioned_outliers(spark, sf):
    """Windows are scored by the version of the centroids that is valid at their end."""
    folder, options = scratch_path(spark, "stream"), replace(flow_options(), raw_table=None)
    versions = written(centroid_versions(spark, sf), "versions")
    _run_flow_stream(spark, sf, folder, options, centroid_versions=lambda: versions)
    return release(spark, folder, options, "outliers")[0].drop("dt", "load_id")


def stream_counters(spark, sf):
    """Totals of the counters that a stream commits with its loads, over its restarts."""
    folder, tag = scratch_path(spark, "stream"), uuid.uuid4().hex
    options = replace(flow_options(), raw_table=None, counters_table=f"counters_{tag}")
    _run_flow_stream(spark, sf, folder, options)
    found = written(counters.totals(spark, options.counters_table), "totals")
    spark.sql(f"DROP TABLE {options.counters_table}")
    release(spark, folder, options)
    return found


JOB_QUERIES = {
    f.__name__: f
    for f in (
        flow_job_features,
        flow_job_outliers,
        flow_job_raw,
        two_loads_append,
        flow_job_inspected,
        flow_job_text_files,
        fraud_job_rejects,
        fraud_job_alerts,
        stream_features,
        stream_late_rows,
        stream_outliers,
        stream_request_instances,
        stream_alerts,
        stream_bus_features,
        stream_versioned_outliers,
        stream_counters,
    )
}
