"""Small scalar expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: text form of transaction_time.
TIME_PATTERN = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def duration_ms(start: Column, end: Column) -> Column:
    """Absolute difference of two epoch-ms columns as int, null beyond int range."""
    return F.abs(end - start).try_cast("int")


def utc_text(ts: Column) -> Column:
    """A timestamp as UTC text with six decimals, whatever the session zone."""
    return F.date_format(
        F.to_utc_timestamp(ts, F.current_timezone()), TIME_PATTERN
    )


def hash32(key: Column, seed: int | str) -> Column:
    """Uniform 32-bit integer of (seed, key), the same on every run and engine."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def shard_of(key: Column, key_range: int) -> Column:
    """Shard 0..key_range-1 drawn per row, so that batching runs in parallel."""
    return F.pmod(F.xxhash64(key), F.lit(key_range)).cast("int")
