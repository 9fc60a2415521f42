"""Offline jobs: the normalised centroid table and the fraud model."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsight.operators import clustering, fraud, kmeans, sampling
from flowsight.schemas import NORMALIZED_CENTROIDS, VECTOR_COLUMNS, conform
from flowsight.session import scratch_root


@dataclass(frozen=True)
class ClusterResult:
    """`centroids` and `info` hold every round, `report` the last one."""

    model: kmeans.KMeansModel
    normalized: DataFrame
    report: DataFrame
    centroids: DataFrame
    info: DataFrame

    def report_at(self, iteration: int) -> DataFrame:
        return round_report(self.centroids, self.info, iteration)


def round_report(centroids: DataFrame, info: DataFrame, iteration: int) -> DataFrame:
    """Cluster radius beside the centroid features after a round of training."""
    of_round = centroids.where(F.col("iteration") == iteration).drop("iteration")
    return clustering.cluster_report(clustering.pivot_centroids(of_round), info, VECTOR_COLUMNS, iteration)


def train_clusters(
    spark: SparkSession,
    features: DataFrame,
    date_from: str | dt.date,
    date_to: str | dt.date,
    k: int = 4,
    seed: int = 1,
    limit: int | None = None,
    compat: bool = False,
    iterations: int = 20,
) -> ClusterResult:
    """Fit k-means on the features of a date range and derive the side table.

    The training rows are checkpointed: they are read by every iteration and by the
    tables derived from the model. Runs the training jobs.
    """
    scratch_root(spark)
    rows = clustering.train_rows(features, date_from, date_to, limit)
    rows = rows.withColumn("_key", clustering.row_key()).checkpoint()
    model = kmeans.fit(rows, "_key", k, seed, iterations)
    centroids, info = kmeans.centroids_long(spark, model), kmeans.training_info(spark, model)
    last = len(model.rounds)
    final = clustering.pivot_centroids(centroids.where(F.col("iteration") == last).drop("iteration"))
    assigned = kmeans.assign(model, rows.drop("_key"))
    normalized = conform(clustering.centroid_spread(assigned, final, compat), NORMALIZED_CENTROIDS)
    return ClusterResult(model, normalized, round_report(centroids, info, last), centroids, info)


def write_clusters(result: ClusterResult, table: str) -> None:
    clustering.write_or_replace(result.normalized, table)


def write_history(result: ClusterResult, centroids_table: str, info_table: str) -> None:
    """The centroids and the figures of every round as tables."""
    clustering.write_or_replace(result.centroids, centroids_table)
    clustering.write_or_replace(result.info, info_table)


@dataclass(frozen=True)
class FraudResult:
    model: PipelineModel
    test_scores: DataFrame


def train_fraud(
    transactions: DataFrame,
    sample_fraction: float = 0.005,
    train_fraction: float = 0.8,
    iterations: int = 100,
    step_size: float = 0.1,
    seed: int = 2,
) -> FraudResult:
    """Down-sample, split, fit boosted trees, score the test rows.

    The sample is checkpointed, so that the large table is sampled once. The split has an order of its own: in
    the sample's, the rows that were taken from the common class all come first.
    """
    scratch_root(transactions.sparkSession)
    labelled = fraud.training_set(transactions, sample_fraction, seed).checkpoint()
    train, test = sampling.split_seeded(labelled, fraud.KEY_COLUMN, train_fraction, seed + 1)
    model = fraud.fit_fraud_model(train, iterations, step_size, seed=seed)
    return FraudResult(model, fraud.predict(model, test))
