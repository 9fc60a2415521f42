"""Sharding by a two-pass external shuffle: scatter into buckets, shuffle each bucket, cut the order.

Pass one scatters whole records over buckets by a seeded hash; a bucket is as much text as a task can
hold (`bucket_bytes` on average, and at least one bucket for each shuffle partition). Pass two puts a
bucket's records into a canonical order, shuffles them in memory by Fisher and Yates with a generator
seeded by (seed, bucket), and writes them. The buckets one behind the other are the shuffled
order of all records; the shards are its equal cuts, so that the law `rows` holds: counts at most one
apart. `slot` is the place in the shard. Only the sizes of buckets are summed up outside of the tasks.

The hash covers seed, doc_id, text and the input partition a record comes from, so neither a hot
doc_id nor a record that is repeated in full fills a bucket. A task that runs again scatters the same records
to the same buckets, and what pass two has written is what all later steps read. Equal seeds over equal
input partitions give equal shards.

Defined results: null texts are records of no bytes, a null `doc_id` is hashed as such; rows repeated in
full are shuffled one by one; a very long text makes its own bucket larger by itself; with fewer rows
than shards some shards are empty; no rows, no rows; other columns, whatever their names, are carried along
in `record`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import shuffle_partitions, whole_text, written

SHARDS = 40
SEED = 17
BUCKET_BYTES = 32 << 20
ROW_BYTES = 16
BROADCAST_BUCKETS = 1 << 20
SLICE = 1024


def row_size(docs: DataFrame) -> Column:
    """UTF-8 bytes of the text and 16 for the row."""
    return F.octet_length(whole_text(docs)).cast("long") + ROW_BYTES


def fisher_yates(n: int, random: np.random.Generator) -> list[int]:
    """A permutation of 0..n-1, each equally likely: from the end, every place takes one of those up to it."""
    order = list(range(n))
    for i, j in zip(range(n - 1, 0, -1), random.integers(0, np.arange(n, 1, -1)).tolist()):
        order[i], order[j] = order[j], order[i]
    return order


def scatter(docs: DataFrame, buckets: int, seed: int) -> DataFrame:
    """(bucket, key, record): pass one; a bucket is in one partition, in the order of its keys."""
    key = F.xxhash64(F.lit(seed), docs["doc_id"], whole_text(docs))
    return (
        docs.select(key.alias("key"), F.struct(*[docs[c] for c in docs.columns]).alias("record"))
        .withColumn("bucket", F.pmod(F.xxhash64("key", F.spark_partition_id()), F.lit(buckets)).cast("int"))
        .repartitionById(buckets, "bucket")
        .sortWithinPartitions("bucket", "key")
    )


def shuffle_buckets(scattered: DataFrame, seed: int) -> DataFrame:
    """(bucket, place, record): pass two, a bucket in memory at a time."""
    kind = StructType.fromDDL("bucket int, place long").add("record", scattered.schema["record"].dataType)
    arrow = to_arrow_schema(kind, prefers_large_types=False)

    def shuffled(bucket: int, parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(parts).column(0)
        order = np.array(fisher_yates(len(rows), np.random.default_rng([seed, bucket])), np.int64)
        for at in range(0, len(order), SLICE):
            taken = rows.take(pa.array(order[at : at + SLICE])).combine_chunks()
            if isinstance(taken, pa.ChunkedArray):
                taken = pa.concat_arrays(taken.chunks)
            place = np.arange(at, at + len(taken))
            columns = [pa.array(np.full(len(taken), bucket, np.int32)), pa.array(place), taken]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, parts = None, []
        for batch in batches:
            bucket = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if parts and bucket[a] != open_:
                    yield from shuffled(open_, parts)
                    parts = []
                open_ = int(bucket[a])
                parts.append(batch.slice(a, b - a).select(["record"]))
        if parts:
            yield from shuffled(open_, parts)

    return scattered.select("bucket", "record").mapInArrow(run, kind)


def shuffle_into_shards(
    docs: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """(record, shard, slot) of every row of `docs`, in random order cut into `shards` equal parts."""
    total = docs.agg(F.sum(row_size(docs)).alias("n")).first()["n"] or 0
    buckets = max(shuffle_partitions(docs.sparkSession), -(-total // bucket_bytes))
    rows = written(shuffle_buckets(scatter(docs, buckets, seed), seed), "shuffled")
    counts = rows.groupBy("bucket").agg(F.count("*").alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "bucket",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"),
        F.sum("n").over(Window.partitionBy()).alias("total"),
    )
    if buckets <= BROADCAST_BUCKETS:  # three numbers a bucket
        offsets = F.broadcast(offsets)
    placed = rows.join(offsets, "bucket").withColumn("at", F.col("base") + F.col("place"))
    placed = placed.withColumn("shard", F.expr(f"cast(at * {shards} div total AS int)"))
    first = F.expr(f"(cast(shard AS long) * total + {shards - 1}) div {shards}")
    return placed.select("record", "shard", (F.col("at") - first).alias("slot"))


def write_shards(placed: DataFrame, path: str) -> None:
    """The records as Parquet, a folder `shard=N` for each shard, rows in order of their slots.

    The order of a shard is cut into ranges, so that a shard of any size is written by many tasks.
    """
    n = shuffle_partitions(placed.sparkSession)
    (
        placed.repartitionByRange(n, "shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )


def sharding_report(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Where each row went: doc_id, size, text_crc32, law, shard, slot, grown_shard (only of law `key`)."""
    placed = shuffle_into_shards(docs.select("doc_id", "text"), shards)
    text = F.coalesce(F.col("record.text").cast("string"), F.lit(""))
    return placed.select(
        F.col("record.doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
