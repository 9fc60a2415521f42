"""Window sums and sketches that are stored, and merged to coarser windows and over loads without the flows.

A row holds one fine window of a (subscriber, subnet): counts, sums, extremes and a theta sketch of the addresses and of
the ports. Rows of one window may come from several loads. Merging unions the sketches, so distinct counts over
any coarser window are as good as if the flows were counted together: exact below 2^lg_k values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsight.functions.netaddr import DEFAULT_MASK_BITS
from flowsight.functions.scalars import utc_text
from flowsight.operators.features import DEFAULT_LG_K, OUTPUT_COLUMNS, with_flow_columns
from flowsight.schemas import SKETCHES

_VALUES = {"tx_bytes": "txBytes", "rx_bytes": "rxBytes", "duration": "duration"}
_KEYS = ["subscriber_id", "dst_subnet"]


def sketch_rows(
    flows: DataFrame,
    window_seconds: int = 60,
    event_time: str = "event_ts",
    subnet_form: str = "address",
    mask_bits: int = DEFAULT_MASK_BITS,
    lg_k: int = DEFAULT_LG_K,
) -> DataFrame:
    """The rows of `SKETCHES`: one hash aggregation with partial aggregation, also on streams."""
    rows = with_flow_columns(flows, subnet_form, mask_bits)
    window = F.window(event_time, f"{window_seconds} seconds").alias("window")
    sums = [
        f(source).alias(f"{prefix}_{name}")
        for name, source in _VALUES.items()
        for prefix, f in (("max", F.max), ("min", F.min), ("sum", F.sum), ("n", F.count))
    ]
    grouped = rows.groupBy(
        window, F.col("subscriberId").alias("subscriber_id"), F.col("dstSubnet").alias("dst_subnet")
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.theta_sketch_agg("srcIP", lg_k).alias("ips"),
        F.theta_sketch_agg("srcPort", lg_k).alias("ports"),
        *sums,
    )
    found = grouped.withColumn("window_start", F.col("window.start"))
    return found.select(*[F.col(f.name).cast(f.dataType) for f in SKETCHES])


def merged_features(
    sketches: DataFrame, window_seconds: int = 60, fine_seconds: int = 60, lg_k: int = DEFAULT_LG_K
) -> DataFrame:
    """Feature rows of windows of `window_seconds` from stored rows of `fine_seconds`."""
    if window_seconds % fine_seconds:
        raise ValueError("the windows have to be whole multiples of the stored ones")
    start = F.window("window_start", f"{window_seconds} seconds")["start"].alias("_start")
    merged = []
    for name in _VALUES:
        merged += [
            F.max(f"max_{name}").alias(f"max_{name}"),
            F.min(f"min_{name}").alias(f"min_{name}"),
            F.try_divide(F.sum(f"sum_{name}"), F.sum(f"n_{name}")).alias(f"avg_{name}"),
        ]
    grouped = sketches.groupBy(start, *_KEYS).agg(
        F.sum("n").alias("number_of_records"),
        F.theta_sketch_estimate(F.theta_union_agg("ips", lg_k)).alias("number_of_unique_ips"),
        F.theta_sketch_estimate(F.theta_union_agg("ports", lg_k)).alias("number_of_unique_ports"),
        *merged,
    )
    end = F.col("_start") + F.expr(f"INTERVAL '{window_seconds}' SECOND")
    numbers = [F.col(c) if c.startswith("avg") else F.col(c).cast("int").alias(c) for c in OUTPUT_COLUMNS]
    return grouped.select(*_KEYS, utc_text(end).alias("transaction_time"), *numbers)
