"""Mock flow logs and payments over any sequence of ids.

A record depends on (seed, id) alone: two SHA-256 digests give sixteen 32-bit
numbers, one per field, so batch and stream, any partitioning and any retry produce
the same record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsight.functions.netaddr import long_to_ip

# Domains of the mock records.
PROTOCOLS = ["tcp", "udp", "http"]
TRANSACTION_TYPES = ["CASH_IN", "CASH_OUT", "TRANSFER", "PAYMENT"]
PORT_RANGE = (1000, 5000)
BYTES_RANGE = (10, 1000)
FLAG_RANGE = (0, 65)
SUBSCRIBER_RANGE = (0, 99_999)
STEP_RANGE = (111, 555)
CENTS_RANGE = (100, 99_999_900)
# first address of the destination subnets and their number of addresses
SUBNET_BASE, SUBNET_SIZE = 201326592, 65536
BASE_MILLIS = 1_570_276_550_000


def _with_digest(ids: DataFrame, id_column: str, seed: int) -> DataFrame:
    text = F.concat(F.lit(f"{seed}:"), F.col(id_column).cast("string"))
    return ids.withColumn(
        "_digest",
        F.concat(F.sha2(F.concat(text, F.lit(":a")), 256), F.sha2(F.concat(text, F.lit(":b")), 256)),
    )


def _number(slot: int) -> Column:
    piece = F.substring("_digest", 1 + 8 * slot, 8)
    return F.conv(piece, 16, 10).cast("bigint")


def _between(slot: int, bounds: tuple[int, int]) -> Column:
    low, high = bounds
    return F.lit(low) + F.pmod(_number(slot), F.lit(high - low + 1))


def _one_of(slot: int, values: list[str]) -> Column:
    index = F.pmod(_number(slot), F.lit(len(values))).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in values]), index + 1)


def _money(slot: int) -> Column:
    return _between(slot, CENTS_RANGE) / F.lit(100.0)


def generate_flow_logs(
    ids: DataFrame,
    id_column: str = "id",
    seed: int = 7,
    bytes_range: tuple[int, int] = BYTES_RANGE,
) -> DataFrame:
    """One flow record per id; a higher `bytes_range` makes outlier traffic."""
    keep = [c for c in ids.columns if c != id_column]
    start = F.lit(BASE_MILLIS) + F.col(id_column)
    return _with_digest(ids, id_column, seed).select(
        *keep,
        _between(0, SUBSCRIBER_RANGE).cast("string").alias("subscriberId"),
        long_to_ip(_number(1)).alias("srcIP"),
        long_to_ip(F.lit(SUBNET_BASE) + F.pmod(_number(2), F.lit(SUBNET_SIZE))).alias("dstIP"),
        _between(3, PORT_RANGE).cast("int").alias("srcPort"),
        _between(4, PORT_RANGE).cast("int").alias("dstPort"),
        _between(5, bytes_range).cast("int").alias("txBytes"),
        _between(6, bytes_range).cast("int").alias("rxBytes"),
        start.alias("startTime"),
        (start + F.pmod(_number(7), F.lit(60))).alias("endTime"),
        _between(8, FLAG_RANGE).cast("int").alias("tcpFlag"),
        _one_of(9, PROTOCOLS).alias("protocolName"),
        _between(10, (0, 1)).cast("int").alias("protocolNumber"),
    )


def generate_transactions(
    ids: DataFrame, id_column: str = "id", seed: int = 7
) -> DataFrame:
    """One payment record per id."""
    keep = [c for c in ids.columns if c != id_column]
    key = F.col("_digest")
    uuid = F.concat_ws(
        "-",
        *[F.substring(key, start, length) for start, length in ((81, 8), (89, 4), (93, 4), (97, 4), (101, 12))],
    )
    return _with_digest(ids, id_column, seed).select(
        *keep,
        _between(0, STEP_RANGE).cast("int").alias("step"),
        F.concat(F.lit("C"), _number(1).cast("string")).alias("nameOrig"),
        F.concat(F.lit("C"), _number(2).cast("string")).alias("nameDest"),
        _between(3, (0, 1)).cast("int").alias("isFlaggedFraud"),
        _between(4, (0, 1)).cast("int").alias("isFraud"),
        _one_of(5, TRANSACTION_TYPES).alias("type"),
        _money(6).alias("amount"),
        _money(7).alias("oldbalanceOrg"),
        _money(8).alias("newbalanceOrig"),
        _money(9).alias("oldbalanceDest"),
        _money(14).alias("newbalanceDest"),
        uuid.alias("transactionId"),
    )


def to_messages(records: DataFrame, event_type: str, columns: list[str]) -> DataFrame:
    """`value` (the record as JSON) and `headers` with the event type."""
    header = F.struct(
        F.lit("event_type").alias("key"),
        F.encode(F.lit(event_type), "UTF-8").alias("value"),
    )
    return records.select(
        F.to_json(F.struct(*columns)).alias("value"), F.array(header).alias("headers")
    )
