"""Flow-log anomaly job: lines -> valid flows -> features -> outliers."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType, TimestampType

from flowsight.functions.privacy import (
    inspect_columns,
    serialized_bytes,
    tokenize_columns,
)
from flowsight.functions.scalars import shard_of
from flowsight.operators.batching import apply_to_batches
from flowsight.operators.features import window_features
from flowsight.operators.geo import geo_enrich, geo_strategy
from flowsight.operators.parse import (
    parse_flow_lines,
    rejected_rows,
    restamp,
    valid_rows,
)
from flowsight.operators.scoring import Centroids, find_outliers, read_centroids
from flowsight.operators.sketches import merged_features, sketch_rows
from flowsight.operators.versions import find_outliers_by_version
from flowsight.options import FlowOptions
from flowsight.plans.inputs import load_interval
from flowsight.schemas import (
    FEATURE_CLUSTER_COLUMNS,
    FEATURES,
    FLOW_LOG_GEO,
    OUTLIERS,
    RAW_CLUSTER_COLUMNS,
    REJECTS,
    REQUIRED_COLUMNS,
    SKETCHES,
)
from flowsight.session import written
from flowsight.sinks.tables import (
    DATE_COLUMN,
    LOAD_COLUMN,
    create_table,
    load,
    load_checked,
    loaded,
    stream_load,
    with_date,
)
from flowsight.sources.files import with_arrival_time
from flowsight.streaming.counters import commit_counters, create_counters, observed
from flowsight.streaming.metrics import counted
from flowsight.streaming.pins import pinned
from flowsight.streaming.windows import with_watermark


# The raw table keeps the event time, so that features can be computed from it.
RAW = StructType(FLOW_LOG_GEO.fields + [StructField("event_ts", TimestampType())])


@dataclass(frozen=True)
class FlowFrames:
    flows: DataFrame
    rejects: DataFrame
    features: DataFrame


def flow_frames(
    lines: DataFrame, options: FlowOptions = FlowOptions(), stored: bool = False
) -> FlowFrames:
    """Valid flows, rejects and features of `line, event_ts` records.

    `stored` (batch) writes the parsed rows to the scratch folder, so that they are parsed once for all of them.
    """
    field = options.event_time_field
    stamped = "event_ts" in lines.columns and not options.arrival_time
    if not stamped and (options.arrival_time or not field):
        lines, stamped = with_arrival_time(lines), True
    parsed = parse_flow_lines(lines)
    if not stamped:
        own = F.timestamp_millis(F.col(field))
        parsed = parsed.withColumn("event_ts", F.coalesce(own, F.current_timestamp()))
    if parsed.isStreaming:
        parsed = with_watermark(parsed, "event_ts", options.allowed_lateness_seconds)
    if stored:
        parsed = written(parsed, "parsed")
    flows = valid_rows(parsed)
    if options.restamp:
        flows = restamp(flows)
    return FlowFrames(flows, rejected_rows(parsed), feature_rows(flows, options))


def feature_rows(flows: DataFrame, options: FlowOptions) -> DataFrame:
    """Features of typed flows, inspected and tokenised as the options say."""
    return protected(_features(flows, options), options)


def _features(flows: DataFrame, options: FlowOptions) -> DataFrame:
    return window_features(
        flows,
        window_seconds=options.window_seconds,
        subnet_form=options.subnet_form,
        mask_bits=options.mask_bits,
        distinct="sketch" if flows.isStreaming else options.distinct,
        lg_k=options.sketch_lg_k,
    )


def protected(features: DataFrame, options: FlowOptions) -> DataFrame:
    """Features inspected and tokenised as the options say."""
    if options.inspect_columns:
        features = inspect_columns(features, options.inspect_columns)
    return tokenize_columns(
        features, options.token_columns, options.token_key, options.token_prefix, options.token_sealed
    )


def stored_features(spark: SparkSession, options: FlowOptions) -> StructType:
    """The feature columns and, with inspection, the counts of what was found."""
    if not options.inspect_columns:
        return FEATURES
    return inspect_columns(spark.createDataFrame([], FEATURES), options.inspect_columns).schema


def create_tables(
    spark: SparkSession, options: FlowOptions, location: str | None = None
) -> None:
    """Define the job's tables: day partitions, one load number per micro-batch."""
    features = stored_features(spark, options)
    specs = [(options.features_table, features), (options.outliers_table, OUTLIERS)]
    if options.raw_table:
        specs.append((options.raw_table, RAW))
    if options.rejects_table:
        specs.append((options.rejects_table, REJECTS))
    if options.feature_rejects_table:
        specs.append((options.feature_rejects_table, features))
    if options.sketches_table:
        specs.append((options.sketches_table, SKETCHES))
    for table, schema in specs:
        path = f"{location}/{table.split('.')[-1]}" if location else None
        create_table(spark, table, schema, [LOAD_COLUMN, DATE_COLUMN], path)
    if options.counters_table:
        path = f"{location}/{options.counters_table.split('.')[-1]}" if location else None
        create_counters(spark, options.counters_table, path)


def _layout(options: FlowOptions, cluster_by: list[str]) -> dict:
    if options.write_method == "file_loads":
        return {"shards": options.file_shards, "cluster_by": cluster_by}
    return {}


def tokenized_by_service(features: DataFrame, options: FlowOptions) -> DataFrame:
    """Tokenise through a service, in size-bounded batches per window and shard."""
    order = ["subscriber_id", "dst_subnet", "transaction_time"]
    for column in options.token_columns:
        features = apply_to_batches(
            features,
            column,
            options.open_tokenizer,
            size=serialized_bytes(features.columns),
            shard=shard_of(F.concat_ws("|", *order), options.key_range),
            order=order,
            limit=options.batch_bytes,
            window=F.to_timestamp("transaction_time"),
        )
    return features


def load_results(
    features: DataFrame,
    centroids: DataFrame | Centroids,
    options: FlowOptions,
    load_id: str,
    versions: DataFrame | None = None,
) -> None:
    """Write one batch of features, then its outliers, scored from the rows written:
    the aggregation runs once and nothing has to be cached.

    With `versions` (of centroids, see `operators.versions`) a window is scored by the one valid at its end.
    """
    spark = features.sparkSession
    seen, flagged = Observation(f"features {load_id}"), Observation(f"outliers {load_id}")
    if options.counters_table:
        features = observed(features, seen, {"features": "1", "records": "number_of_records"})
    if options.open_tokenizer:
        features = tokenized_by_service(features, options)
    load_checked(
        with_date(features),
        options.features_table,
        load_id,
        REQUIRED_COLUMNS,
        options.feature_rejects_table,
        **_layout(options, FEATURE_CLUSTER_COLUMNS),
    )
    features = loaded(spark, options.features_table, load_id).select(*FEATURES.names)
    score, side = (find_outliers, centroids) if versions is None else (find_outliers_by_version, versions)
    outliers = score(features, side, options.outlier_threshold, rotate_counts=options.rotate_counts)
    if options.counters_table:
        outliers = observed(outliers, flagged, {"outliers": "1"})
    load(with_date(outliers), options.outliers_table, load_id)
    if options.counters_table:
        commit_counters(spark, options.counters_table, load_id, {**seen.get, **flagged.get})


def _raw_rows(
    flows: DataFrame, ranges: DataFrame | None, strategy: str = "auto"
) -> DataFrame:
    if ranges is None:
        rows = flows.withColumns(
            {f.name: F.lit(None).cast(f.dataType) for f in FLOW_LOG_GEO.fields[-4:]}
        )
    else:
        rows = geo_enrich(flows, ranges, strategy=strategy)
    return with_date(rows, "event_ts")


def _through_sketches(flows: DataFrame, options: FlowOptions, load_id: str) -> DataFrame:
    """Stores the sketches of the flows, and merges the features from what is stored."""
    lg_k, fine = options.sketch_lg_k, options.sketch_seconds
    rows = sketch_rows(flows, fine, "event_ts", options.subnet_form, options.mask_bits, lg_k)
    load(with_date(rows, "window_start"), options.sketches_table, load_id)
    stored = loaded(flows.sparkSession, options.sketches_table, load_id)
    return merged_features(stored, options.window_seconds, fine, lg_k)


def run_batch(
    lines: DataFrame,
    centroids: DataFrame,
    options: FlowOptions = FlowOptions(),
    ranges: DataFrame | None = None,
    load_id: str | None = None,
    versions: DataFrame | None = None,
) -> None:
    """The job over a bounded input. Runs the queries and writes the tables.

    Every run adds its rows under a name of its own. `load_id` names the input: the same
    name again replaces its rows, for a run that is tried once more. With a raw table the
    features are computed from the few columns they need of the raw rows just written. Lines
    are parsed once, also where rejects are kept.
    """
    load_id = load_id or uuid.uuid4().hex
    frames = flow_frames(lines, options, stored=bool(options.rejects_table))
    features = frames.features
    if options.raw_table:
        load(
            _raw_rows(frames.flows, ranges),
            options.raw_table,
            load_id,
            **_layout(options, RAW_CLUSTER_COLUMNS),
        )
        raw = loaded(lines.sparkSession, options.raw_table, load_id)
        features = feature_rows(raw, options)
    if options.sketches_table:
        flows = raw if options.raw_table else frames.flows
        features = protected(_through_sketches(flows, options, load_id), options)
    if options.rejects_table:
        load(with_date(frames.rejects, "event_ts"), options.rejects_table, load_id)
    load_results(features, centroids, options, load_id, versions)


def start_stream(
    lines: DataFrame,
    centroids: DataFrame,
    options: FlowOptions,
    checkpoint: str,
    ranges: DataFrame | None = None,
    available_now: bool = False,
    refresh_centroids: Callable[[], DataFrame] | None = None,
    on_load: Callable[[str, dict[str, int]], None] | None = None,
    centroid_versions: Callable[[], DataFrame] | None = None,
) -> list[StreamingQuery]:
    """Start the job: one query for features and outliers, one for the raw table and
    one for the rejects where the options name these.

    The centroids are read as they are at the start; `refresh_centroids`, a function
    without arguments, reads them anew for each micro-batch. `centroid_versions` gives a table of
    versions instead: each window is scored by the version valid at its end, and the table as the batch saw it is kept
    with the checkpoint, so that a batch that is run again gives equal rows. `on_load` is told the
    name of every load and its number of features and outliers.
    """
    frames = flow_frames(lines, options)
    at_start = read_centroids(centroids)

    def write_features(batch: DataFrame, load_id: str) -> None:
        side = refresh_centroids() if refresh_centroids else at_start
        versions = None
        if centroid_versions:
            versions = pinned(batch.sparkSession, f"{checkpoint}/versions", load_id, centroid_versions)
        load_results(batch, side, options, load_id, versions)
        if on_load:
            names = {"features": options.features_table, "outliers": options.outliers_table}
            spark = batch.sparkSession
            on_load(load_id, {n: loaded(spark, t, load_id).count() for n, t in names.items()})

    every = load_interval(options)
    queries = [
        stream_load(
            counted(frames.features, "features"),
            write_features,
            f"{checkpoint}/features",
            every,
            available_now,
        ).outputMode("append").start()
    ]
    if options.raw_table:
        # decided once, not by a count in every micro-batch
        strategy = geo_strategy(ranges) if ranges is not None else "auto"

        def write_raw(batch: DataFrame, load_id: str) -> None:
            load(
                _raw_rows(batch, ranges, strategy),
                options.raw_table,
                load_id,
                **_layout(options, RAW_CLUSTER_COLUMNS),
            )

        queries.append(
            stream_load(
                frames.flows, write_raw, f"{checkpoint}/raw", every, available_now
            ).start()
        )
    if options.rejects_table:

        def write_rejects(batch: DataFrame, load_id: str) -> None:
            load(with_date(batch, "event_ts"), options.rejects_table, load_id)

        queries.append(
            stream_load(
                frames.rejects, write_rejects, f"{checkpoint}/rejects", every, available_now
            ).start()
        )
    return queries
