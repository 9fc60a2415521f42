"""Hard negatives by vertical scans of columns (BOND): bounds shrink a candidate bitmap to the window.

Rows are dealt to shards of as many values as a task can hold. A task keeps one shard as columns and
streams all anchors past it, so a row moves once and an anchor once for each shard. For an anchor the columns
are read in the descending order of its components' magnitude. After each block of columns the least and
most that the columns not yet read can add (from their smallest and largest values) bound every candidate's
score from both sides; candidates whose bounds rule them out leave the bitmap, and those that are left
when all columns are read have exact scores.

Two scans: the first finds each anchor's best rows of its own label, its positives; the second the best
rows of other labels in the window that each positive's score opens. Shards answer with a few rows
each, which are merged. All arithmetic is exact: in doubles while no sum can reach 2^53, in
whole numbers of any size beyond.

Defined results: rows with a null label, a null vec_id, a null vector, or null or non-finite components
(also after scaling) take no part; vectors of different lengths do not meet; rows that share a vec_id are
rows of their own, but never partners of each other; an empty vector scores 0; scores beyond a long are cut to the
largest or smallest; ties go to the smaller vec_id; no anchors, no rows; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import release_process, shuffle_partitions, written

SHARD_VALUES = 1 << 24
COLUMNS_AT_ONCE = 8
SCALE = 256.0
LONG = (-(1 << 63), (1 << 63) - 1)
EXACT = 1 << 53


class Shard:
    """Rows of one length as columns."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, values: np.ndarray):
        self.ids, self.labels = ids, labels
        self.columns = np.ascontiguousarray(values.T)
        self.size = len(self.columns)
        none = not self.columns.size
        self.least = np.zeros(self.size) if none else self.columns.min(axis=1)
        self.most = np.zeros(self.size) if none else self.columns.max(axis=1)
        self.reach = 0.0 if none else float(max(-self.least.min(), self.most.max()))
        self._whole: Shard | None = None

    def exact_for(self, query: np.ndarray) -> tuple[Shard, np.ndarray]:
        """Shard and query in a kind of number in which no sum is rounded."""
        if self.size * self.reach * float(np.abs(query).max(initial=0)) < EXACT:
            return self, query
        if self._whole is None:
            self._whole = Shard(self.ids, self.labels, whole_numbers(self.columns.T))
        return self._whole, whole_numbers(query)


def whole_numbers(values: np.ndarray) -> np.ndarray:
    return np.array([int(x) for x in values.ravel()], object).reshape(values.shape)


def vertical_scan(
    shard: Shard, query: np.ndarray, rows: np.ndarray, keep: Callable[[np.ndarray, np.ndarray], np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """(rows, scores) of those of `rows` that `keep(lower bounds, upper bounds)` never rules out."""
    shard, query = shard.exact_for(query)
    order = np.argsort(-np.abs(query), kind="stable")
    ends = np.stack([query * shard.least, query * shard.most])[:, order]
    rest_low = ends.min(axis=0)[::-1].cumsum()[::-1]
    rest_high = ends.max(axis=0)[::-1].cumsum()[::-1]
    score = np.zeros(len(rows), shard.columns.dtype)
    for at in range(0, shard.size, COLUMNS_AT_ONCE):
        now = order[at : at + COLUMNS_AT_ONCE]
        score = score + query[now] @ shard.columns[now[:, None], rows]
        after = at + COLUMNS_AT_ONCE
        if after < shard.size and len(rows):
            alive = keep(score + rest_low[after], score + rest_high[after])
            rows, score = rows[alive], score[alive]
    return rows, score


def kth_largest(values: np.ndarray, k: int):
    return np.sort(values)[-k] if values.dtype == object else np.partition(values, -k)[-k]


def best_of(shard: Shard, rows: np.ndarray, score: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The first k (score, vec_id), higher scores first, then smaller ids."""
    if len(rows) > k:
        near = score >= kth_largest(score, k)
        rows, score = rows[near], score[near]
    pairs = zip(map(int, score), shard.ids[rows].tolist())
    return sorted(pairs, key=lambda x: (-x[0], x[1]))[:k]


def positives_in(shard: Shard, anchor: int, label: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The shard's best k (score, vec_id) of the anchor's label."""

    def keep(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return high >= kth_largest(low, k) if len(low) > k else np.ones(len(low), bool)

    rows = np.flatnonzero((shard.labels == label) & (shard.ids != anchor))
    return best_of(shard, *vertical_scan(shard, query, rows, keep), k)


def window_of(positive: int, low: int, high: int) -> tuple[int, int]:
    """The whole scores n with low * positive <= 100 n <= high * positive."""
    return -(-low * positive // 100), high * positive // 100


def negatives_in(
    shard: Shard, anchor: int, label: int, query: np.ndarray, windows: list[tuple[int, int]], k: int
) -> list[list[tuple[int, int]]]:
    """For each window the shard's best k (score, vec_id) of other labels inside it."""
    open_ = sorted({w for w in windows if w[0] <= w[1]})

    def keep(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        alive = np.zeros(len(low), bool)
        for least, most in open_:
            inside = low[(low >= least) & (high <= most)]
            if len(inside) >= k:
                least = kth_largest(inside, k)
            alive |= (high >= least) & (low <= most)
        return alive

    found = {}
    if open_:
        rows = np.flatnonzero((shard.labels != label) & (shard.ids != anchor))
        rows, score = vertical_scan(shard, query, rows, keep)
        for least, most in open_:
            inside = (score >= least) & (score <= most)
            found[least, most] = best_of(shard, rows[inside], score[inside], k)
    return [found.get(w, []) for w in windows]


def usable(embeddings: DataFrame, relabel: Callable[[Column, Column], Column] | None) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part, components scaled and rounded down."""
    rows = embeddings.select(
        embeddings["vec_id"].cast("long").alias("vec_id"),
        embeddings["label"].cast("long").alias("label"),
        F.transform(embeddings["embedding"], lambda x: x.cast("double") * SCALE).alias("vector"),
    )
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = rows.filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & ~odd
    )
    return rows.withColumn("label", relabel(F.col("vec_id"), F.col("label"))) if relabel else rows


def _matrix(batch: pa.RecordBatch) -> list[np.ndarray]:
    vectors = batch.column("vector")
    return [np.floor(v) for v in np.split(vectors.flatten().to_numpy(), np.cumsum(vectors.value_lengths())[:-1])]


def _past_shards(rows: DataFrame, anchors: DataFrame, shards: int, ask: Callable, schema: str) -> DataFrame:
    """`ask(shard, anchor's row, vector)` of every anchor and shard; an anchor's row is a dict."""
    kind = to_arrow_schema(StructType.fromDDL(schema), prefers_large_types=False)
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", F.spark_partition_id()), F.lit(shards)).cast("int"))
    asked = anchors.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    both = dealt.unionByName(asked, allowMissingColumns=True)
    carried = [c for c in both.columns if c not in ("shard", "vector")]
    both = both.repartitionById(shards, "shard").sortWithinPartitions("shard", F.col("uid").isNotNull())

    def built(parts: list[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]) -> dict[int, Shard]:
        by_size: dict[int, list] = {}
        for ids, labels, vectors in parts:
            for row in zip(ids.tolist(), labels.tolist(), vectors):
                by_size.setdefault(len(row[2]), []).append(row)
        return {
            size: Shard(
                np.array([r[0] for r in found], np.int64),
                np.array([r[1] for r in found], np.int64),
                np.stack([r[2] for r in found]),
            )
            for size, found in by_size.items()
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_process()
        number, parts, shard = None, [], None
        for batch in batches:
            place = batch.column("shard").to_numpy()
            anchor = batch.column("uid").is_valid().to_numpy(zero_copy_only=False)
            change = np.flatnonzero((np.diff(place) != 0) | (np.diff(anchor) != 0)) + 1
            cuts = [0, *change.tolist(), len(place)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if place[a] != number:
                    number, parts, shard = place[a], [], None
                if not anchor[a]:
                    parts.append((part["vec_id"].to_numpy(), part["label"].to_numpy(), _matrix(part)))
                    continue
                if shard is None:
                    shard, parts = built(parts), []
                out = []
                for row, vector in zip(part.select(carried).to_pylist(), _matrix(part)):
                    if len(vector) in shard:
                        out += ask(shard[len(vector)], row, vector)
                columns = zip(*out) if out else [[]] * len(kind)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, kind)], schema=kind
                )

    return both.mapInArrow(run, schema)


def _long(x: int) -> int:
    return min(max(x, LONG[0]), LONG[1])


def hard_negatives(
    embeddings: DataFrame,
    is_anchor: Callable[[Column], Column],
    relabel: Callable[[Column, Column], Column] | None = None,
    positives: int = 5,
    negatives: int = 3,
    window: tuple[int, int] = (50, 95),
    shard_values: int = SHARD_VALUES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank.

    `window` is the share of the positive's score, in percent, between which a negative's score lies.
    """
    rows = usable(embeddings, relabel)
    known = embeddings.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("size")).first()
    values = known["n"] * max(known["size"] or 0, 1)
    shards = max(shuffle_partitions(embeddings.sparkSession), -(-values // shard_values))
    anchors = rows.filter(is_anchor(F.col("vec_id"))).withColumn("uid", F.monotonically_increasing_id())
    anchors = written(anchors, "anchors")

    def near(shard: Shard, row: dict, query: np.ndarray):
        found = positives_in(shard, row["vec_id"], row["label"], query, positives)
        return [(row["uid"], _long(score), i) for score, i in found]

    first = _past_shards(rows, anchors, shards, near, "uid long, score long, id long")
    by_score = Window.partitionBy("uid").orderBy(F.desc("score"), "id")
    first = first.withColumn("place", F.row_number().over(by_score)).filter(F.col("place") <= positives)
    first = written(first, "positives")
    partners = first.groupBy("uid").agg(
        F.array_sort(F.collect_list(F.struct("place", "id", "score"))).alias("partners")
    )

    def hard(shard: Shard, row: dict, query: np.ndarray):
        asked = [window_of(p["score"], *window) for p in row["partners"]]
        found = negatives_in(shard, row["vec_id"], row["label"], query, asked, negatives)
        for p, best in zip(row["partners"], found):
            for score, i in best:
                yield row["uid"], row["vec_id"], p["place"], p["id"], p["score"], i, _long(score)

    second = _past_shards(
        rows,
        anchors.join(partners, "uid"),
        shards,
        hard,
        "uid long, anchor_id long, positive_rank int, positive_id long, positive_score long,"
        " negative_id long, negative_score long",
    )
    by_score = Window.partitionBy("uid", "positive_rank").orderBy(F.desc("negative_score"), "negative_id")
    return (
        second.withColumn("rank", F.row_number().over(by_score))
        .filter(F.col("rank") <= negatives)
        .select(
            "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", "positive_rank"
        )
    )


def hard_negative_report(embeddings: DataFrame) -> DataFrame:
    """Anchors are the rows whose vec_id 50 divides; every seventh row has the next label of ten."""
    return hard_negatives(
        embeddings,
        is_anchor=lambda i: i % 50 == 0,
        relabel=lambda i, label: F.when(i % 7 == 0, (label + 1) % 10).otherwise(label),
    )
