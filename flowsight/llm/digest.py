"""Document fingerprints: a quartile bucket digest.

Byte triplets out of a sliding window of five bytes are hashed into 256 buckets and counted; each
bucket is encoded by the quartile of its count, two bits, after one byte for the length and
one for the ratios of the quartiles. Two digests are compared by a bounded difference.

Each document is also compared with its successor in doc_id order. Documents are dealt by ranges of
doc_id; a range gets a copy of the next range's first document, so every pair meets in
one sorted stream, and a text is shuffled once. The driver sees one row for each range.

Defined results: null text counts as empty; an empty text has a digest of zeros and is like itself
only; rows that repeat a doc_id follow each other in the order of their texts; a null doc_id stands
after all others; a lone document is its own successor; other columns play no part; no rows, no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release_process, shuffle_partitions, whole_text

BUCKETS = 256
RANGES_PER_PARTITION = 4
# positions in the window of five bytes, and an odd factor for each kind of triplet
TRIPLETS = (((0, 1, 2), 0x9E3779B1), ((0, 1, 3), 0x85EBCA77), ((0, 2, 4), 0xC2B2AE3D))
UNLIKE = 1.0  # mean difference of quartile codes from which two digests have nothing in common
LENGTH_BASE = 1.1
LAST = (1 << 63) - 1


def bucket_counts(raw: bytes) -> np.ndarray:
    counts = np.zeros(BUCKETS, np.int64)
    step = 1 << 20
    for start in range(0, max(len(raw) - 2, 0), step):
        b = np.frombuffer(raw[start : start + step + 4], np.uint8).astype(np.uint32)
        for (i, j, k), factor in TRIPLETS:
            n = min(step, len(b) - k)
            if n > 0:
                joined = b[i : i + n] | b[j : j + n] << np.uint32(8) | b[k : k + n] << np.uint32(16)
                hashed = (joined + np.uint32(1)) * np.uint32(factor)
                hashed ^= hashed >> np.uint32(15)
                counts += np.bincount(hashed * np.uint32(0x2C1B3C6D) >> np.uint32(24), minlength=BUCKETS)
    return counts


def fingerprint(text: str) -> str:
    """4 hex digits of length and quartile ratios, 128 of the buckets' quartile codes."""
    raw = text.encode("utf-8")
    counts = bucket_counts(raw)
    q = np.partition(counts, (BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1))
    q1, q2, q3 = q[BUCKETS // 4 - 1], q[BUCKETS // 2 - 1], q[3 * BUCKETS // 4 - 1]
    codes = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    length = min(255, int(np.ceil(np.log(len(raw) + 1) / np.log(LENGTH_BASE))))
    ratios = (15 * q1 // max(q3, 1)) << 4 | 15 * q2 // max(q3, 1)
    packed = codes[0::4] << 6 | codes[1::4] << 4 | codes[2::4] << 2 | codes[3::4]
    return bytes([length, int(ratios)]).hex() + packed.astype(np.uint8).tobytes().hex()


def _codes(fp: str) -> np.ndarray:
    packed = np.frombuffer(bytes.fromhex(fp[4:]), np.uint8)
    return np.stack([packed >> 6, packed >> 4 & 3, packed >> 2 & 3, packed & 3], axis=1).astype(np.int16)


def likeness(a: str, b: str) -> float:
    """1 for equal digests, 0 from a mean code difference of `UNLIKE`; lengths and ratios count a little."""
    if a == b:
        return 1.0
    head_a, head_b = bytes.fromhex(a[:4]), bytes.fromhex(b[:4])
    apart = float(np.abs(_codes(a) - _codes(b)).sum())
    apart += abs(head_a[0] - head_b[0])
    apart += abs((head_a[1] >> 4) - (head_b[1] >> 4)) + abs((head_a[1] & 15) - (head_b[1] & 15))
    return max(0.0, 1.0 - apart / (UNLIKE * BUCKETS))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every row."""

    @F.pandas_udf("string")
    def digest(texts: pd.Series) -> pd.Series:
        return texts.map(fingerprint)

    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), digest(whole_text(docs)).alias("fingerprint")
    )


def edited(text: str, following: str) -> str:
    """The last quarter replaced by the first as many code points of the following text, or all."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def with_successors(docs: DataFrame) -> DataFrame:
    """(range_id, guard, doc_id, text), ranges sorted; a range ends with its successor as guard."""
    spark = docs.sparkSession
    place = F.coalesce(docs["doc_id"].cast("long"), F.lit(LAST))
    rows = docs.select(place.alias("place"), docs["doc_id"].cast("long").alias("doc_id"), whole_text(docs).alias("text"))
    ranges = RANGES_PER_PARTITION * shuffle_partitions(spark)
    cuts = rows.agg(
        F.percentile_approx("place", [k / ranges for k in range(1, ranges)], 20 * ranges)
    ).first()[0]
    bounds = np.unique(np.array(cuts or [], np.int64))

    @F.pandas_udf("int")
    def range_of(places: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, places.to_numpy(), side="right"))

    heads = rows.select("place").withColumn("range_id", range_of("place"))
    heads = heads.groupBy("range_id").agg(F.min("place").alias("place")).collect()
    heads = sorted((r["range_id"], r["place"]) for r in heads)
    guards = [(heads[k][1], heads[k - 1][0]) for k in range(len(heads))]
    at = spark.createDataFrame(guards, "at long, guarded int")
    first = rows.filter(F.col("place").isin([g[0] for g in guards])).groupBy("place").agg(F.min("text").alias("text"))
    guard_rows = first.join(F.broadcast(at), F.col("place") == F.col("at")).select(
        F.col("guarded").alias("range_id"), F.lit(True).alias("guard"), F.lit(LAST).alias("place"),
        F.lit(None).cast("long").alias("doc_id"), "text",
    )
    own = rows.select(range_of("place").alias("range_id"), F.lit(False).alias("guard"), "place", "doc_id", "text")
    dealt = own.union(guard_rows).repartition(shuffle_partitions(spark), "range_id")
    return dealt.sortWithinPartitions("range_id", "guard", "place", "text").drop("place")


def digest_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_process()
        last = None  # (range, doc_id, text, fingerprint) that waits for its successor
        for batch in batches:
            out: list[tuple] = []
            for own, guard, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                fp = fingerprint(text)
                if last is not None and last[0] == own:
                    changed = edited(last[2], text)
                    changed_fp = fingerprint(changed)
                    sha = hashlib.sha256(changed.encode("utf-8")).hexdigest()
                    near = likeness(last[3], changed_fp), likeness(last[3], fp)
                    out.append((last[1], len(last[2]), sha, last[3], changed_fp, *near))
                last = None if guard else (own, doc_id, text, fp)
            columns = zip(*out) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return with_successors(docs).mapInArrow(
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )
