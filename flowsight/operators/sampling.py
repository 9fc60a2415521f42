"""Seeded shuffles, samples and positional splits that need no global sort.

The order is that of a 32-bit hash of (seed, key), ties by key. Cutting that order
at position n takes a histogram of the hash and a sort of the one bucket the cut
falls into, both over the key and a hash of the row: no task sees more than about a 65,536th
of the rows, and the rows themselves are read once, unmoved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsight.functions.scalars import hash32

# Fixed value: the histogram keeps the upper 16 of 32 hash bits.
_BUCKET_SHIFT = 16


def shuffle_rows(df: DataFrame, key: str, seed: int = 2) -> DataFrame:
    """All rows in seeded random order (a range-partitioned sort)."""
    return df.orderBy(hash32(F.col(key), seed), F.col(key))


def with_position(df: DataFrame, key: str, seed: int = 2, name: str = "position") -> DataFrame:
    """Adds `name`: the place of each row in the seeded order, from 1.

    The order is cut into 65,536 ranges of the hash; their sizes are summed up to the places where they begin
    (the one window without partitions, over these sums), and rows are numbered inside
    their range. Rows that repeat a key are ordered by a hash of the row; a key is meant to be almost
    unique, as all rows of one are numbered in one task.
    """
    hashed = df.withColumn("_row", F.xxhash64(*df.columns)).withColumn("_hash", hash32(F.col(key), seed))
    hashed = hashed.withColumn("_slot", F.shiftright("_hash", _BUCKET_SHIFT))
    before = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    sizes = hashed.groupBy("_slot").agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.select("_slot", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_slot").orderBy("_hash", key, "_row"))
    return (
        hashed.join(F.broadcast(starts), "_slot")  # two numbers for each range
        .withColumn(name, F.col("_start") + inside)
        .drop("_slot", "_hash", "_row", "_start")
    )


def with_cut(
    df: DataFrame,
    key: str,
    seed: int = 2,
    rows: int | None = None,
    fraction: float | None = None,
    nearest: bool = False,
    name: str = "in_cut",
    among: Column | None = None,
) -> DataFrame:
    """Adds `name`: whether the row is among the first rows of the seeded order.

    The number is `rows`, or fraction * count, rounded down or (`nearest`) to the
    nearest whole number, halves to even. Exact, and the same on
    every run. Rows that repeat a key are ordered by a hash of the row; of rows that are
    equal throughout all are in the cut or none. With `among` the order is that of the rows it holds
    for; the others are never in the cut.
    """
    if (rows is None) == (fraction is None):
        raise ValueError("give either rows or fraction")
    hashed = df.withColumn("_hash", hash32(F.col(key), seed))
    hashed = hashed.withColumn("_slot", F.shiftright("_hash", _BUCKET_SHIFT))
    ordered = hashed if among is None else hashed.where(among)
    row = F.xxhash64(*df.columns)  # only of rows in the slot of the cut

    # at most 65,536 rows from here on
    counts = ordered.groupBy("_slot").agg(F.count(F.lit(1)).alias("n"))
    by_slot = Window.orderBy("_slot").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    running = counts.select(
        "_slot", "n", F.sum("n").over(by_slot).alias("upto"),
    ).withColumn("total", F.sum("n").over(Window.partitionBy()))
    wanted = (
        F.lit(rows).cast("bigint")
        if rows is not None
        else (F.rint if nearest else F.floor)(
            F.lit(float(fraction)) * F.col("total")
        ).cast("bigint")
    )
    # the slot that holds the last wanted row, and how many of its rows are wanted
    reached = running.withColumn("wanted", wanted).where(F.col("upto") >= F.col("wanted"))
    taken = F.col("wanted") - F.col("upto") + F.col("n")
    cut = reached.agg(F.min_by(F.struct("_slot", taken.alias("take")), "_slot").alias("cut"))
    # the last wanted row itself: none if the cut falls on the edge of the slot
    position = F.row_number().over(Window.partitionBy("_slot").orderBy("_hash", key, "_row"))
    last = (
        ordered.withColumn("_cut", cut.scalar())
        .where(F.col("_slot") == F.col("_cut._slot"))
        .select("_slot", "_hash", key, row.alias("_row"), "_cut")
        .withColumn("_position", position)
        .where(F.col("_position") == F.col("_cut.take"))
        .agg(F.min(F.struct("_hash", key, "_row")).alias("last"))
    )
    slot, cut_slot = F.col("_slot"), F.col("_cut._slot")
    inside = (
        F.when(F.col("_cut").isNull(), F.lit(True))
        .when(slot < cut_slot, F.lit(True))
        .when((slot > cut_slot) | F.col("_last").isNull(), F.lit(False))
        .otherwise(F.struct("_hash", key, row.alias("_row")) <= F.col("_last"))
    )
    if among is not None:
        inside = F.coalesce(among, F.lit(False)) & inside
    return (
        hashed.withColumns({"_cut": cut.scalar(), "_last": last.scalar()})
        .withColumn(name, inside)
        .drop("_hash", "_slot", "_cut", "_last")
    )


def take_seeded(
    df: DataFrame,
    key: str,
    seed: int = 2,
    rows: int | None = None,
    fraction: float | None = None,
    nearest: bool = False,
) -> DataFrame:
    """The first rows of the seeded order: a sample, or a deterministic LIMIT."""
    cut = with_cut(df, key, seed, rows, fraction, nearest)
    return cut.where("in_cut").drop("in_cut")


def split_seeded(
    df: DataFrame, key: str, fraction: float = 0.8, seed: int = 2
) -> tuple[DataFrame, DataFrame]:
    """Positional split of the seeded order into (train, test)."""
    cut = with_cut(df, key, seed, fraction=fraction)
    return cut.where("in_cut").drop("in_cut"), cut.where(~F.col("in_cut")).drop("in_cut")


def downsample(
    df: DataFrame, keep_all: Column, key: str, fraction: float = 0.005, seed: int = 2
) -> DataFrame:
    """A seeded fraction of the rows where `keep_all` is false, plus all others."""
    cut = with_cut(df, key, seed, fraction=fraction, nearest=True, name="_taken", among=~keep_all)
    return cut.where(keep_all | F.col("_taken")).drop("_taken")
