"""Fixed schemas of every table the jobs read or write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(spec: list[tuple[str, object]]) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in spec])


_S, _I, _L, _D = StringType(), IntegerType(), LongType(), DoubleType()

# Column names and types of the input and output tables.
FLOW_LOG = _struct(
    [
        ("subscriberId", _S),
        ("srcIP", _S),
        ("dstIP", _S),
        ("srcPort", _I),
        ("dstPort", _I),
        ("txBytes", _I),
        ("rxBytes", _I),
        ("startTime", _L),
        ("endTime", _L),
        ("tcpFlag", _I),
        ("protocolName", _S),
        ("protocolNumber", _I),
    ]
)

GEO_COLUMNS = ["geoCountry", "geoCity", "latitude", "longitude"]

FLOW_LOG_GEO = StructType(
    FLOW_LOG.fields
    + _struct(
        [("geoCountry", _S), ("geoCity", _S), ("latitude", _D), ("longitude", _D)]
    ).fields
)

GEO_RANGES = StructType(
    _struct([("start_ip", _L), ("end_ip", _L)]).fields + FLOW_LOG_GEO.fields[-4:]
)

# stored window sums: a row for each fine window, subscriber and subnet
SKETCHES = _struct(
    [
        ("window_start", TimestampType()),
        ("subscriber_id", _S),
        ("dst_subnet", _S),
        ("n", _L),
        ("ips", BinaryType()),
        ("ports", BinaryType()),
    ]
    + [
        (f"{prefix}_{name}", _I if prefix in ("max", "min") else _L)
        for name in ("tx_bytes", "rx_bytes", "duration")
        for prefix in ("max", "min", "sum", "n")
    ]
)

FEATURES = _struct(
    [
        ("subscriber_id", _S),
        ("dst_subnet", _S),
        ("transaction_time", _S),
        ("number_of_records", _I),
        ("number_of_unique_ips", _I),
        ("number_of_unique_ports", _I),
        ("max_tx_bytes", _I),
        ("min_tx_bytes", _I),
        ("avg_tx_bytes", _D),
        ("max_rx_bytes", _I),
        ("min_rx_bytes", _I),
        ("avg_rx_bytes", _D),
        ("max_duration", _I),
        ("min_duration", _I),
        ("avg_duration", _D),
    ]
)

OUTLIERS = StructType(FEATURES.fields + _struct([("centroid_id", _I)]).fields)

# The ten model dimensions, in vector order.
VECTOR_COLUMNS = [
    "number_of_records",
    "max_tx_bytes",
    "min_tx_bytes",
    "avg_tx_bytes",
    "max_rx_bytes",
    "min_rx_bytes",
    "avg_rx_bytes",
    "max_duration",
    "min_duration",
    "avg_duration",
]

NORMALIZED_CENTROIDS = _struct(
    [("centroid_id", _I), ("normalized_dest", _D)] + [(c, _D) for c in VECTOR_COLUMNS]
)

CENTROIDS_LONG = _struct(
    [("centroid_id", _I), ("feature", _S), ("numerical_value", _D)]
)

TRAINING_INFO = _struct(
    [
        ("iteration", _I),
        (
            "cluster_info",
            ArrayType(
                _struct(
                    [("centroid_id", _I), ("cluster_radius", _D), ("cluster_size", _L)]
                )
            ),
        ),
    ]
)

# one row for every round of training
TRAINING_HISTORY = StructType([TRAINING_INFO["iteration"], StructField("loss", _D), TRAINING_INFO["cluster_info"]])


def with_iteration(schema: StructType) -> StructType:
    return StructType([TRAINING_INFO["iteration"], *schema.fields])


ENSEMBLE_NODES = _struct(
    [
        ("tree", _I),
        ("node", _I),
        ("feature", _S),
        ("category", _S),
        ("threshold", _D),
        ("left", _I),
        ("right", _I),
        ("value", _D),
        ("weight", _D),
    ]
)

TRANSACTION = _struct(
    [
        ("step", _I),
        ("nameOrig", _S),
        ("nameDest", _S),
        ("isFlaggedFraud", _I),
        ("isFraud", _I),
        ("type", _S),
        ("amount", _D),
        ("oldbalanceOrg", _D),
        ("newbalanceOrig", _D),
        ("oldbalanceDest", _D),
        ("newbalanceDest", _D),
        ("transactionId", _S),
    ]
)

MODEL_INPUT = _struct(
    [
        ("step", _I),
        ("type", _S),
        ("amount", _D),
        ("oldbalanceOrg", _D),
        ("newbalanceOrig", _D),
        ("oldbalanceDest", _D),
        ("newbalanceDest", _D),
        ("transactionId", _S),
    ]
)

FRAUD_PREDICTION = _struct(
    [("transactionId", _S), ("logistic", _D), ("json_response", _S)]
)

REJECTS = StructType(
    _struct([("line", _S), ("status", _S), ("error", _S)]).fields
    + [StructField("event_ts", TimestampType(), True)]
)

# Columns the feature and outlier tables refuse to hold null in.
REQUIRED_COLUMNS = ["transaction_time", "subscriber_id", "dst_subnet"]

# Sort columns of the raw and the feature table files.
RAW_CLUSTER_COLUMNS = ["geoCountry", "geoCity"]
FEATURE_CLUSTER_COLUMNS = ["dst_subnet", "subscriber_id"]


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select and cast `df` to `schema` by column name."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def split_required(
    df: DataFrame, required: list[str] = REQUIRED_COLUMNS
) -> tuple[DataFrame, DataFrame]:
    """(rows with every required column set, the others)."""
    complete = F.lit(True)
    for name in required:
        complete = complete & F.col(name).isNotNull()
    return df.where(complete), df.where(~complete)
