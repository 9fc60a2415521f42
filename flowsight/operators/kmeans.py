"""k-means by distributed rounds, with a record of every round.

Seeding samples candidates in a few passes, each row with a chance in proportion to its squared distance
from the candidates so far; the draw is a hash of (seed, pass, key), so it is the same on every run, layout
and engine. Candidates are weighted by the rows nearest to them and thinned to k. Then rounds of assignment
and update, each one partial aggregation of the rows to k. Distances are taken between standardised
values, centres are kept in raw units.

The driver sees k rows a round and the candidates: `oversampling` a pass on average. The rows are read once
a pass and once a round, so hand over a written table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsight.functions.scalars import hash32
from flowsight.functions.vectors import not_null
from flowsight.operators.scoring import Centroids, nearest_centroid
from flowsight.schemas import CENTROIDS_LONG, TRAINING_HISTORY, VECTOR_COLUMNS, with_iteration

SEED_PASSES = 4


@dataclass(frozen=True)
class Round:
    """What one assignment found, and the centres it led to."""

    iteration: int
    loss: float
    radii: list[float | None]
    sizes: list[int]
    centres: np.ndarray


@dataclass(frozen=True)
class KMeansModel:
    """Centres in raw units, ids from 1, with the deviation of each column and all rounds."""

    deviations: dict[str, float]
    start: np.ndarray
    rounds: list[Round]

    @property
    def centres(self) -> np.ndarray:
        return self.rounds[-1].centres if self.rounds else self.start


def as_centroids(centres: np.ndarray) -> Centroids:
    ids = np.arange(1, len(centres) + 1, dtype=np.int32)
    return Centroids(ids, np.full(len(centres), np.nan), centres)


def column_deviations(rows: DataFrame) -> dict[str, float]:
    """Sample standard deviation of each vector column; 1 where there is none."""
    found = rows.agg(*[F.stddev_samp(c).alias(c) for c in VECTOR_COLUMNS]).first()
    return {c: float(found[c] or 1.0) for c in VECTOR_COLUMNS}


def _near(rows: DataFrame, centres: np.ndarray, scale: dict[str, float]) -> DataFrame:
    """`rows` with the position of the nearest centre, from 1, and the squared distance."""
    near = nearest_centroid(rows, as_centroids(centres), scale)
    square = F.col("nearest.distance") * F.col("nearest.distance")
    return near.withColumns({"_centre": F.col("nearest.centroid_id"), "_square": square}).drop("nearest")


def _vectors(found: list, key: str) -> np.ndarray:
    found = sorted(found, key=lambda r: r[key])
    return np.array([[float(r[c]) for c in VECTOR_COLUMNS] for r in found]).reshape(-1, len(VECTOR_COLUMNS))


def seed_candidates(
    rows: DataFrame, key: str, scale: dict[str, float], seed: int, passes: int, oversampling: float
) -> np.ndarray:
    """Candidate centres: the first row of the seeded order, then `oversampling` a pass on average.

    Within a pass candidates stand in the order of their keys.
    """
    narrow = rows.select(F.col(key).cast("string").alias("_key"), *VECTOR_COLUMNS)
    first = narrow.orderBy(hash32(F.col("_key"), seed), "_key").limit(1).collect()
    candidates = _vectors(first, "_key")
    for turn in range(1, passes + 1 if len(candidates) else 0):
        near = _near(narrow, candidates, scale)
        total = near.agg(F.sum("_square").alias("total")).first()["total"]
        if not total:
            break
        drawn = hash32(F.col("_key"), f"{seed}.{turn}").cast("double") / float(1 << 32)
        taken = near.where(drawn < F.lit(float(oversampling)) * F.col("_square") / F.lit(float(total)))
        candidates = np.concatenate([candidates, _vectors(taken.collect(), "_key")])
    return candidates


def thin(candidates: np.ndarray, weights: np.ndarray, scale: np.ndarray, k: int) -> np.ndarray:
    """`k` of the weighted candidates: the heaviest, then each time the one that adds most to the cost."""
    points = candidates / scale
    picked = [int(np.argmax(weights))] if len(points) else []
    while picked and len(picked) < k:
        square = ((points[:, None, :] - points[None, picked, :]) ** 2).sum(axis=2).min(axis=1)
        gain = weights * square
        if gain.max() <= 0:
            break
        picked.append(int(np.argmax(gain)))
    return candidates[picked]


def seed_centres(
    rows: DataFrame,
    key: str,
    k: int,
    scale: dict[str, float],
    seed: int = 1,
    passes: int = SEED_PASSES,
    oversampling: float | None = None,
) -> np.ndarray:
    """At most `k` starting centres; fewer where there are fewer different rows."""
    candidates = seed_candidates(rows, key, scale, seed, passes, oversampling or 2.0 * k)
    weights = np.zeros(len(candidates))
    if len(candidates):
        for r in _near(rows, candidates, scale).groupBy("_centre").count().collect():
            weights[r["_centre"] - 1] = r["count"]
    return thin(candidates, weights, np.array([scale[c] for c in VECTOR_COLUMNS]), k)


def lloyd_round(rows: DataFrame, centres: np.ndarray, scale: dict[str, float], iteration: int) -> Round:
    """One assignment and update. A cluster without rows keeps its centre and has no radius."""
    found = (
        _near(rows, centres, scale)
        .groupBy("_centre")
        .agg(
            F.count(F.lit(1)).alias("_size"),
            F.sum("_square").alias("_sum"),
            *[F.avg(c).alias(c) for c in VECTOR_COLUMNS],
        )
        .collect()
    )
    updated, radii, sizes = centres.copy(), [None] * len(centres), [0] * len(centres)
    for r in found:
        i = r["_centre"] - 1
        updated[i] = [r[c] for c in VECTOR_COLUMNS]
        radii[i], sizes[i] = float(np.sqrt(r["_sum"] / r["_size"])), r["_size"]
    loss = sum(r["_sum"] for r in found) / max(sum(sizes), 1)
    return Round(iteration, loss, radii, sizes, updated)


def fit(
    rows: DataFrame,
    key: str,
    k: int = 4,
    seed: int = 1,
    iterations: int = 20,
    tolerance: float | None = 1e-4,
    passes: int = SEED_PASSES,
    oversampling: float | None = None,
) -> KMeansModel:
    """Seeding, then rounds until no centre moves more than `tolerance` (in deviations) or `iterations` are done.

    With `tolerance` None all rounds are run. Rows with a null dimension take no part.
    """
    rows = rows.where(not_null())
    scale = column_deviations(rows)
    by = np.array([scale[c] for c in VECTOR_COLUMNS])
    centres = start = seed_centres(rows, key, k, scale, seed, passes, oversampling)
    rounds: list[Round] = []
    while len(rounds) < iterations and len(start):
        rounds.append(lloyd_round(rows, centres, scale, len(rounds) + 1))
        moved = np.sqrt((((rounds[-1].centres - centres) / by) ** 2).sum(axis=1)).max()
        centres = rounds[-1].centres
        if tolerance is not None and moved <= tolerance:
            break
    return KMeansModel(scale, start, rounds)


def assign(model: KMeansModel, rows: DataFrame) -> DataFrame:
    """Adds centroid_id; rows with a null dimension drop out."""
    near = nearest_centroid(rows, as_centroids(model.centres), model.deviations)
    return near.withColumn("centroid_id", F.col("nearest.centroid_id")).drop("nearest")


def centroids_long(spark: SparkSession, model: KMeansModel) -> DataFrame:
    """`iteration, centroid_id, feature, numerical_value` of every round, 0 for the start."""
    steps = [(0, model.start), *[(r.iteration, r.centres) for r in model.rounds]]
    found = [
        (iteration, i + 1, name, float(value))
        for iteration, centres in steps
        for i, centre in enumerate(centres)
        for name, value in zip(VECTOR_COLUMNS, centre)
    ]
    return spark.createDataFrame(found, with_iteration(CENTROIDS_LONG))


def training_info(spark: SparkSession, model: KMeansModel) -> DataFrame:
    """`iteration, loss, cluster_info` of every round; loss is the mean squared distance."""
    found = [
        (r.iteration, r.loss, [(i + 1, radius, size) for i, (radius, size) in enumerate(zip(r.radii, r.sizes))])
        for r in model.rounds
    ]
    return spark.createDataFrame(found, TRAINING_HISTORY)
