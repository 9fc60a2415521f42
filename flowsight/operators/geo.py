"""Geography of an address: point in range, without a nested loop."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowsight.functions.netaddr import ip_to_long
from flowsight.schemas import GEO_COLUMNS
from flowsight.session import written

# /24 buckets: a bucket holds 256 addresses, hence at most 256 ranges.
BUCKET_BITS = 8
# Above this many bucketed ranges (roughly 100 MB) the range side is shuffled.
BROADCAST_ROWS = 1_000_000
# Copies of the range side in the shuffled form; a hot address spreads over them.
DEFAULT_SALTS = 16


def bucket_ranges(ranges: DataFrame, bucket_bits: int = BUCKET_BITS) -> DataFrame:
    """One row per (range, address bucket it touches).

    Ranges do not overlap, so there are at most 2^(32 - bucket_bits) rows more
    than ranges, whatever the table holds.
    """
    return ranges.withColumn(
        "_bucket",
        F.explode(
            F.sequence(
                F.shiftright("start_ip", bucket_bits), F.shiftright("end_ip", bucket_bits)
            )
        ),
    )


def fits_broadcast(bucketed: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether the range side is small enough to broadcast. Runs a counting job
    over the range table that stops at the limit."""
    return bucketed.select("_bucket").limit(limit + 1).count() <= limit


def geo_strategy(ranges: DataFrame, bucket_bits: int = BUCKET_BITS) -> str:
    """What "auto" chooses for these ranges. Runs the counting job."""
    return "broadcast" if fits_broadcast(bucket_ranges(ranges, bucket_bits)) else "shuffle"


def geo_enrich(
    flows: DataFrame,
    ranges: DataFrame,
    ip_column: str = "srcIP",
    strategy: str = "auto",
    bucket_bits: int = BUCKET_BITS,
    salts: int = DEFAULT_SALTS,
    salt_columns: list[str] | None = None,
) -> DataFrame:
    """Adds country, city, latitude and longitude; unknown addresses keep nulls.

    The range condition becomes an equi-join on the address bucket. "broadcast"
    hashes the ranges on every executor and never moves the flow side. "shuffle"
    is for range tables beyond that: both sides are hashed on (bucket, salt), so a
    bucket with a third of all flows is shared by `salts` tasks. "auto" counts the
    bucketed ranges and chooses.
    """
    bucketed = bucket_ranges(ranges, bucket_bits)
    if strategy == "auto":
        strategy = geo_strategy(ranges, bucket_bits)
    probe = flows.withColumn("_ip", ip_to_long(F.col(ip_column)))
    probe = probe.withColumn("_probe", F.shiftright("_ip", bucket_bits))
    match = (F.col("_probe") == F.col("_bucket")) & F.col("_ip").between(
        F.col("start_ip"), F.col("end_ip")
    )
    if strategy == "broadcast":
        side = F.broadcast(bucketed)
    elif strategy == "shuffle":
        # the scan partition is part of the salt, so that copies of one row spread too
        spread_by = salt_columns or [c for c in flows.columns if c != ip_column]
        mixed = F.xxhash64(F.spark_partition_id(), *spread_by)
        probe = probe.withColumn("_salt", F.pmod(mixed, F.lit(salts)).cast("int"))
        side = bucketed.withColumn(
            "_range_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
        ).hint("shuffle_merge")
        match = match & (F.col("_salt") == F.col("_range_salt"))
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return probe.join(side, match, "left").select(
        *flows.columns, *[F.col(c) for c in GEO_COLUMNS]
    )


def enrich_by_key(rows: DataFrame, ranges: DataFrame, key: str) -> DataFrame:
    """Adds the geography of the range that holds the 16-byte `key`, for addresses of any width.

    Ranges (`start_key, end_key`, not overlapping) and rows are cut together into ordered partitions and
    written; a row's range is the last that starts at or before it in its partition, or the last of an
    earlier one. One shuffle, no expansion of long ranges; a hot address spreads over
    partitions, as rows of one key are ordered by their hash. Rows without a key keep nulls.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row = F.struct(*[F.col(c) for c in rows.columns])
    starts = ranges.select(
        F.col("start_key").alias("_key"), F.lit(0).alias("_kind"), F.lit(0).cast("bigint").alias("_tie"),
        F.struct("end_key", *GEO_COLUMNS).alias("_range"),
    )
    tie = F.xxhash64(F.spark_partition_id(), *rows.columns)
    asked = rows.select(F.col(key).alias("_key"), F.lit(1).alias("_kind"), tie.alias("_tie"), row.alias("_row"))
    both = starts.unionByName(asked, allowMissingColumns=True)
    cut = both.repartitionByRange(parts, "_key", "_kind", "_tie").withColumn("_part", F.spark_partition_id())
    cut = written(cut, "keys")
    lasts = cut.where("_kind = 0").groupBy("_part").agg(F.max_by("_range", "_key").alias("_last"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each partition of the cut
    before = cut.select("_part").distinct().join(lasts, "_part", "left")
    before = before.select("_part", F.last("_last", ignorenulls=True).over(earlier).alias("_before"))
    inside = Window.partitionBy("_part").orderBy("_key", "_kind", "_tie")
    found = cut.withColumn("_here", F.last("_range", ignorenulls=True).over(inside)).where("_kind = 1")
    found = found.join(F.broadcast(before), "_part").withColumn("_found", F.coalesce("_here", "_before"))
    hit = F.when(F.col("_key") <= F.col("_found.end_key"), F.col("_found"))
    return found.withColumn("_hit", hit).select("_row.*", *[F.col(f"_hit.{c}").alias(c) for c in GEO_COLUMNS])
