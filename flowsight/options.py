"""Options of the jobs, each with one documented default."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass


@dataclass(frozen=True)
class FlowOptions:
    """Flow-log anomaly job."""

    input_path: str | None = None
    input_glob: str = "*.json"
    poll_seconds: int = 30
    features_table: str = "cluster_model_data"
    outliers_table: str = "outlier_data"
    # None: no raw sink
    raw_table: str | None = None
    # sums and sketches of windows of `sketch_seconds` (batch); the features are merged from them
    sketches_table: str | None = None
    sketch_seconds: int = 60
    # what each load has counted
    counters_table: str | None = None
    # lines that are no valid record; None: not kept
    rejects_table: str | None = None
    # features with a null in a required column; None: they fail the load
    feature_rejects_table: str | None = "cluster_model_rejects"
    # field of the record with the event time, epoch milliseconds; where it is null, and
    # with arrival_time for all, the time of reading counts
    event_time_field: str | None = "startTime"
    # file with the SQL text that reads the centroids, and table or binary file of address ranges
    cluster_query: str | None = None
    geo_table: str | None = None
    geo_file: str | None = None
    # "default", "file_loads" or "streaming_inserts"
    write_method: str = "default"
    batch_minutes: int = 1
    file_shards: int = 100
    window_seconds: int = 60
    allowed_lateness_seconds: int = 0
    # "address" gives 12.0.1.2/22, "network" gives 12.0.0.0/22
    subnet_form: str = "address"
    mask_bits: int = 22
    # "exact" in batch, "sketch" wherever the input is a stream
    distinct: str = "exact"
    sketch_lg_k: int = 20
    outlier_threshold: float = 2.0
    # None: identifiers pass through unchanged
    token_key: bytes | None = None
    # tokens that are bound to their column and refuse to be opened when changed
    token_sealed: bool = True
    token_columns: tuple[str, ...] = ("subscriber_id",)
    token_prefix: str = "IMSI_TOKEN"
    # None: no inspection of the named columns
    inspect_columns: tuple[str, ...] | None = None
    # a service in place of the key: makes a function from values to tokens, which
    # is called once per batch of this many serialised bytes
    open_tokenizer: Callable[[], Callable[[list[str]], list[str]]] | None = None
    batch_bytes: int = 500
    # shards of a window in which batches are filled in parallel
    key_range: int = 100
    restamp: bool = False
    arrival_time: bool = False
    rotate_counts: bool = False


@dataclass(frozen=True)
class FraudOptions:
    """Payment fraud job."""

    input_path: str | None = None
    input_glob: str = "*.json"
    poll_seconds: int = 10
    transactions_table: str = "transactions"
    # transactions without an id; None: they fail the load
    transaction_rejects_table: str | None = "transaction_rejects"
    predictions_table: str = "fraud_prediction"
    rejects_table: str | None = None
    write_method: str = "streaming_inserts"
    batch_minutes: int = 2
    file_shards: int = 1000
    probability: float = 0.99
    window_seconds: int = 5
    allowed_lateness_seconds: int = 0
    batch_bytes: int = 50_000
    key_range: int = 100


@dataclass(frozen=True)
class GeneratorOptions:
    """Mock-data publisher."""

    rows_per_second: int = 1000
    event_type: str = "netflow"
    topic: str = "events"
    # "flow_log" or "transaction"
    record: str = "flow_log"
    seed: int = 7
