"""Sharding: the law, the permutation, and the files."""

import zlib
from collections import Counter

import numpy as np
from fixtures import EDGES, documents, sample
from flowsight.llm.sharding import (
    fisher_yates,
    scatter,
    sharding_report,
    shuffle_buckets,
    shuffle_into_shards,
    write_shards,
)


def check(rows, shards=40):
    """Counts at most one apart, slots gapless from 0."""
    sizes = Counter(r["shard"] for r in rows)
    assert set(sizes) <= set(range(shards))
    assert all(-(-len(rows) // shards) >= sizes.get(s, 0) >= len(rows) // shards for s in range(shards))
    for shard in sizes:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sizes[shard]))


def test_report(spark):
    docs = sample(spark, 200)
    rows = sharding_report(docs).collect()
    check(rows)
    texts = {r["doc_id"]: r["text"].encode() for r in docs.collect()}
    assert Counter(r["doc_id"] for r in rows) == Counter(list(texts))
    for r in rows:
        assert r["size"] == len(texts[r["doc_id"]]) + 16
        assert r["text_crc32"] == zlib.crc32(texts[r["doc_id"]])
        assert r["law"] == "rows" and r["grown_shard"] is None


def test_edges_and_clashing_columns(spark):
    docs = documents(spark, EDGES, extra=True).selectExpr("*", "'x' AS shard", "'y' AS bucket", "'z' AS record")
    placed = shuffle_into_shards(docs, 4).collect()
    check(placed, 4)
    same = lambda rows: Counter(tuple(r) for r in rows)
    assert same(r["record"] for r in placed) == same(docs.collect())
    report = sharding_report(documents(spark, EDGES)).collect()
    check(report)
    assert {r["size"] for r in report if r["doc_id"] in (1, 2)} == {16}


def test_no_rows(spark):
    assert sharding_report(documents(spark, [])).count() == 0


def test_a_record_repeated_in_full_spreads_over_buckets(spark):
    docs = documents(spark, [(1, "a text")] * 2000).repartition(16).select("doc_id", "text")
    scattered = scatter(docs, 8, 17)
    counts = {r["bucket"]: r["count"] for r in scattered.groupBy("bucket").count().collect()}
    assert len(counts) > 4 and max(counts.values()) < 1200
    check(sharding_report(docs).collect())


def test_equal_seeds_equal_order_other_seeds_another(spark):
    docs = sample(spark, 150)

    def order(seed):
        placed = shuffle_into_shards(docs, 3, seed, bucket_bytes=1 << 12).collect()
        check(placed, 3)
        return [r["record"]["doc_id"] for r in sorted(placed, key=lambda r: (r["shard"], r["slot"]))]

    first = order(1)
    assert first == order(1)
    other = order(2)
    assert first != other and sorted(first) == sorted(other)
    moved = np.abs(np.argsort(first) - np.arange(len(first)))
    assert moved.mean() > len(first) / 6  # a third on average in a random order


def test_a_bucket_is_the_plain_shuffle_of_its_records(spark):
    docs = sample(spark, 60).select("doc_id", "text")
    scattered = scatter(docs, 3, 5)
    by_bucket = {}
    for r in scattered.collect():
        by_bucket.setdefault(r["bucket"], []).append(r["record"]["doc_id"])
    got = {(r["bucket"], r["place"]): r["record"]["doc_id"] for r in shuffle_buckets(scattered, 5).collect()}
    assert len(got) == 60
    for bucket, ids in by_bucket.items():
        order = fisher_yates(len(ids), np.random.default_rng([5, bucket]))
        assert [got[bucket, k] for k in range(len(ids))] == [ids[i] for i in order]


def test_fisher_yates_is_uniform():
    random = np.random.default_rng(0)
    seen = Counter(tuple(fisher_yates(4, random)) for _ in range(24000))
    assert len(seen) == 24 and max(seen.values()) < 1150 and min(seen.values()) > 850
    assert fisher_yates(0, random) == [] and fisher_yates(1, random) == [0]


def test_written_shards(spark, folder):
    docs = sample(spark, 90)
    placed = shuffle_into_shards(docs, 7)
    write_shards(placed, f"{folder}/shards")
    back = spark.read.parquet(f"{folder}/shards")
    check(back.collect(), 7)
    assert back.select("record.*").exceptAll(docs).count() == 0 and back.count() == 90
