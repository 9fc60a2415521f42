"""SimHash near-dedup by meet-in-the-middle ball hashing.

A 64-bit fingerprint holds the majority of each bit over the XXH64 values of a text's three-word
shingles. Two fingerprints within `radius` bits of each other have a variant in common that
is within half the radius of both. So each distinct fingerprint emits these variants, they are
shuffled, and neighbours in a variant's sorted group are linked: any two of a group are within the
radius, by the triangle inequality, and a group holds no more than one ball of fingerprints.
Copies share a fingerprint and are one row here, however many they are.

Defined results: null, empty and blank texts have fingerprint 0 and are linked like any other;
rows without `doc_id` get a fingerprint and the class of their text, but never name a class;
repeated rows get equal results; other columns play no part.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, whole_text, written
from .components import connected_components

SHINGLE = 3
SEED = 42
RADIUS = 2
BLOCK = 1 << 15


def fingerprint(text: str, size: int = SHINGLE) -> int:
    """Majority bits over all shingles of the lower-cased words; 0 without words."""
    words = text.encode("utf-8").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    size = min(size, len(words))
    total = len(words) - size + 1
    ones = np.zeros(64, np.int64)
    for start in range(0, total, BLOCK):
        part = words[start : start + BLOCK + size - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(size))))
        n = min(BLOCK, total - start)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), "<u8", n)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += np.add.reduce(bits, axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > total, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp long) of every row."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), whole_text(docs).alias("text"))

    def work(batch: pa.RecordBatch):
        yield {
            "doc_id": batch.column(0),
            "fp": [fingerprint(text) for text in batch.column(1).to_pylist()],
        }

    return arrow_map(rows, work, "doc_id long, fp long")


def ball(radius: int) -> list[int]:
    """Bit masks of up to radius // 2 ones, as signed longs."""
    masks = {0}
    for _ in range(radius // 2):
        masks |= {m ^ (1 << i) for m in masks for i in range(64)}
    return sorted(m - (1 << 64) if m >> 63 else m for m in masks)


def fingerprint_links(distinct_fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, other): enough links between distinct fingerprints to connect all within `radius`.

    `radius` is even: 2 emits 65 variants each, 4 emits 2,081.
    """
    masks = F.array(*[F.lit(m).cast("long") for m in ball(radius)])
    variants = distinct_fps.select("fp", F.explode(masks).alias("mask")).select(
        F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"), "mask"
    )
    members = variants.select("variant", F.col("variant").bitwiseXOR(F.col("mask")).alias("fp"))
    other = F.expr("lag(fp) OVER (PARTITION BY variant ORDER BY fp)")
    pairs = members.select("fp", other.alias("other")).filter(F.col("other").isNotNull()).distinct()
    return pairs.filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= radius)


def classes(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, component_id): the smallest doc_id reachable over links, for each distinct fingerprint."""
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "fingerprints")
    parts = connected_components(fingerprint_links(distinct, radius), "fp", "other")
    labelled = distinct.join(parts, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_doc", F.coalesce("component", "fp").alias("component")
    )
    least = labelled.groupBy("component").agg(F.min("first_doc").alias("component_id"))
    return labelled.join(least, "component").select("fp", "component_id")


def simhash_report(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits), component_id."""
    prints = written(fingerprints(docs), "simhash")
    of = classes(prints, radius).withColumnRenamed("fp", "class_fp")
    return prints.join(of, F.col("fp") == F.col("class_fp"), "left").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one_of_each(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """`docs` without the rows whose class has a smaller doc_id; rows without doc_id stay.

    Of rows that repeat a doc_id all stay or none: an id names one document.
    """
    report = simhash_report(docs, radius).filter(F.col("doc_id") > F.col("component_id"))
    gone = report.select(F.col("doc_id").alias("_simhash_gone")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone["_simhash_gone"], "left_anti")
