"""Per-window features of (subscriber, destination subnet)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsight.functions.netaddr import DEFAULT_MASK_BITS, subnet
from flowsight.functions.scalars import duration_ms, utc_text
from flowsight.schemas import FEATURES

# Fixed value: 2^20 sketch entries, so counts are exact below about a million.
DEFAULT_LG_K = 20

OUTPUT_COLUMNS = FEATURES.fieldNames()[3:]

_VALUE_COLUMNS = [("tx_bytes", "txBytes"), ("rx_bytes", "rxBytes"), ("duration", "duration")]


def with_flow_columns(
    flows: DataFrame, subnet_form: str = "address", mask_bits: int = DEFAULT_MASK_BITS
) -> DataFrame:
    """Adds dstSubnet and duration."""
    return flows.withColumns(
        {
            "dstSubnet": subnet(F.col("dstIP"), subnet_form, mask_bits),
            "duration": duration_ms(F.col("startTime"), F.col("endTime")),
        }
    )


def _statistics() -> list[Column]:
    out = []
    for name, source in _VALUE_COLUMNS:
        out += [
            F.max(source).alias(f"max_{name}"),
            F.min(source).alias(f"min_{name}"),
            F.avg(source).alias(f"avg_{name}"),
        ]
    return out


def window_features(
    flows: DataFrame,
    window_seconds: int = 60,
    event_time: str = "event_ts",
    subnet_form: str = "address",
    mask_bits: int = DEFAULT_MASK_BITS,
    distinct: str = "exact",
    lg_k: int = DEFAULT_LG_K,
    sketch_salts: int = 1,
) -> DataFrame:
    """One feature row per tumbling window, subscriber and destination subnet.

    distinct="exact" counts distinct addresses and ports in two hash aggregations
    keyed by the counted value too, so a hot subscriber spreads over all tasks.
    distinct="sketch" keeps a theta sketch of 2^lg_k entries per group, which is
    what a stream can hold; `sketch_salts` > 1 builds the sketches of a hot group
    in that many tasks before they are merged (batch only).
    """
    window = F.window(event_time, f"{window_seconds} seconds")
    if flows.isStreaming:
        # the watermark hangs on the window column as a whole
        key, end = window.alias("window"), F.col("window.end")
    else:
        # the start alone is a quarter of the bytes to shuffle
        key = window["start"].alias("window")
        end = F.col("window") + F.expr(f"INTERVAL '{window_seconds}' SECOND")
    rows = with_flow_columns(flows, subnet_form, mask_bits).select(
        key,
        F.col("subscriberId").alias("subscriber_id"),
        F.col("dstSubnet").alias("dst_subnet"),
        "srcIP",
        "srcPort",
        "txBytes",
        "rxBytes",
        "duration",
    )
    keys = ["window", "subscriber_id", "dst_subnet"]
    if distinct == "exact":
        grouped = rows.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("number_of_records"),
            F.count_distinct("srcIP").alias("number_of_unique_ips"),
            F.count_distinct("srcPort").alias("number_of_unique_ports"),
            *_statistics(),
        )
    elif distinct == "sketch" and sketch_salts == 1:
        grouped = rows.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("number_of_records"),
            F.theta_sketch_estimate(F.theta_sketch_agg("srcIP", lg_k)).alias(
                "number_of_unique_ips"
            ),
            F.theta_sketch_estimate(F.theta_sketch_agg("srcPort", lg_k)).alias(
                "number_of_unique_ports"
            ),
            *_statistics(),
        )
    elif distinct == "sketch":
        grouped = _salted_sketch(rows, keys, lg_k, sketch_salts)
    else:
        raise ValueError(f"unknown distinct form {distinct!r}")

    def column(name: str) -> Column:
        return F.col(name).cast("int").alias(name) if not name.startswith("avg") else F.col(name)

    return grouped.select(
        "subscriber_id",
        "dst_subnet",
        utc_text(end).alias("transaction_time"),
        *[column(c) for c in OUTPUT_COLUMNS],
    )


def _salted_sketch(
    rows: DataFrame, keys: list[str], lg_k: int, salts: int
) -> DataFrame:
    """Two-step form: sketches and sums per (group, salt), then merged per group."""
    salt = F.pmod(F.xxhash64("srcIP", "srcPort"), F.lit(salts))
    partial = (
        rows.withColumn("_salt", salt)
        .groupBy(*keys, "_salt")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.theta_sketch_agg("srcIP", lg_k).alias("ips"),
            F.theta_sketch_agg("srcPort", lg_k).alias("ports"),
            *[F.max(s).alias(f"max_{n}") for n, s in _VALUE_COLUMNS],
            *[F.min(s).alias(f"min_{n}") for n, s in _VALUE_COLUMNS],
            *[F.sum(s).alias(f"sum_{n}") for n, s in _VALUE_COLUMNS],
            *[F.count(s).alias(f"cnt_{n}") for n, s in _VALUE_COLUMNS],
        )
    )
    merged = []
    for name, _ in _VALUE_COLUMNS:
        merged += [
            F.max(f"max_{name}").alias(f"max_{name}"),
            F.min(f"min_{name}").alias(f"min_{name}"),
            F.try_divide(F.sum(f"sum_{name}"), F.sum(f"cnt_{name}")).alias(f"avg_{name}"),
        ]
    return partial.groupBy(*keys).agg(
        F.sum("n").alias("number_of_records"),
        F.theta_sketch_estimate(F.theta_union_agg("ips", lg_k)).alias(
            "number_of_unique_ips"
        ),
        F.theta_sketch_estimate(F.theta_union_agg("ports", lg_k)).alias(
            "number_of_unique_ports"
        ),
        *merged,
    )
