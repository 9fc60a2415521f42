"""Training rows, k-means, the centroid table and cluster reports."""

from __future__ import annotations

import datetime as dt

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsight.operators.sampling import take_seeded
from flowsight.operators.scoring import nearest_centroid
from flowsight.schemas import CENTROIDS_LONG, TRAINING_INFO, VECTOR_COLUMNS
from flowsight.sources.tables import partition_range

_KEY_COLUMNS = ["subscriber_id", "dst_subnet", "transaction_time"]


def usable_rows(features: DataFrame) -> DataFrame:
    """Rows whose three averages are numbers."""
    ok = F.lit(True)
    for name in ("avg_tx_bytes", "avg_rx_bytes", "avg_duration"):
        ok = ok & F.col(name).isNotNull() & ~F.isnan(name)
    return features.where(ok)


def row_key() -> Column:
    """The key of a feature row as one text."""
    return F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("\0")) for c in _KEY_COLUMNS])


def train_rows(
    features: DataFrame,
    date_from: str | dt.date,
    date_to: str | dt.date,
    limit: int | None = None,
    seed: int = 0,
) -> DataFrame:
    """Usable rows of the day partitions in range, all or, if asked, `limit` of them.

    Which rows a bare LIMIT takes is arbitrary and funnels them through one task;
    here the choice is seeded and stays distributed.
    """
    rows = usable_rows(partition_range(features, date_from, date_to))
    if limit is None:
        return rows
    keyed = rows.withColumn("_key", row_key())
    return take_seeded(keyed, "_key", seed, rows=limit).drop("_key")


def model_columns(rows: DataFrame) -> DataFrame:
    """Everything but the columns that are not part of the model."""
    return rows.drop(*_KEY_COLUMNS, "number_of_unique_ips", "number_of_unique_ports")


def fit_kmeans(
    rows: DataFrame, k: int = 4, seed: int = 1, max_iter: int = 20
) -> PipelineModel:
    """k-means on standardised features. Runs the training jobs."""
    assembler = VectorAssembler(
        inputCols=VECTOR_COLUMNS, outputCol="raw_vector", handleInvalid="skip"
    )
    scaler = StandardScaler(
        inputCol="raw_vector", outputCol="features", withMean=True, withStd=True
    )
    kmeans = KMeans(k=k, seed=seed, maxIter=max_iter, predictionCol="cluster")
    return Pipeline(stages=[assembler, scaler, kmeans]).fit(rows)


def feature_deviations(model: PipelineModel) -> dict[str, float]:
    return dict(zip(VECTOR_COLUMNS, model.stages[1].std.toArray().tolist()))


def centroids_long(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """`centroid_id, feature, numerical_value` in raw units, ids from 1.

    The k x 10 centre matrix is all that passes through the driver.
    """
    scaler, kmeans = model.stages[1], model.stages[2]
    mean, std = scaler.mean.toArray(), scaler.std.toArray()
    rows = [
        (i + 1, name, float(value))
        for i, centre in enumerate(kmeans.clusterCenters())
        for name, value in zip(VECTOR_COLUMNS, centre * std + mean)
    ]
    return spark.createDataFrame(rows, CENTROIDS_LONG)


def assign(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Adds centroid_id, numbered from 1."""
    return (
        model.transform(rows)
        .withColumn("centroid_id", F.col("cluster") + 1)
        .drop("raw_vector", "features", "cluster")
    )


def centroid_rows(
    assigned: DataFrame, columns: list[str] = VECTOR_COLUMNS
) -> DataFrame:
    """Cluster means in the long form, from rows that carry a centroid_id."""
    means = _means(assigned, columns)
    return means.unpivot("centroid_id", columns, "feature", "numerical_value")


def _means(rows: DataFrame, columns: list[str] = VECTOR_COLUMNS) -> DataFrame:
    return rows.groupBy("centroid_id").agg(*[F.avg(c).alias(c) for c in columns])


def pivot_centroids(long: DataFrame, columns: list[str] = VECTOR_COLUMNS) -> DataFrame:
    """One row per cluster, one column per feature, rounded to one decimal."""
    entries = F.struct("feature", F.round("numerical_value", 1).alias("value"))
    lookup = F.map_from_entries(F.array_sort(F.collect_list(entries)))
    return (
        long.groupBy("centroid_id")
        .agg(lookup.alias("cluster"))
        .select("centroid_id", *[F.col("cluster")[c].alias(c) for c in columns])
    )


def centroid_spread(
    assigned: DataFrame, centroids: DataFrame, compat: bool = False
) -> DataFrame:
    """The normalised centroid table: per cluster, the standard deviation of the
    summed differences between its rows and its centroid.

    The centroid is a constant of its cluster and moves no deviation, so the rows are
    aggregated alone and k rows meet k rows. `compat`, which would subtract other
    columns of the centroid, for that reason only puts out min_tx_bytes as min_rx_bytes.
    """
    summed = F.expr(" + ".join(VECTOR_COLUMNS))
    spread = assigned.groupBy("centroid_id").agg(F.stddev_samp(summed).alias("normalized_dest"))
    out = {c: c for c in VECTOR_COLUMNS}
    if compat:
        out["min_rx_bytes"] = "min_tx_bytes"
    columns = [F.col(source).alias(name) for name, source in out.items()]
    return spread.join(centroids.select("centroid_id", *columns), "centroid_id")


def cluster_report(
    centroids: DataFrame,
    training_info: DataFrame,
    columns: list[str] = VECTOR_COLUMNS,
    iteration: int | None = None,
) -> DataFrame:
    """Cluster radius at the last, or at a given, training iteration beside the centroid features.

    `training_info` has one row per iteration with an array of cluster structs.
    """
    per_cluster = training_info.select(
        "iteration", F.explode("cluster_info").alias("info")
    ).select(
        "iteration",
        F.col("info.centroid_id").alias("centroid_id"),
        F.col("info.cluster_radius").alias("cluster_radius"),
    )
    last = F.lit(iteration) if iteration is not None else training_info.agg(F.max("iteration")).scalar()
    return (
        centroids.join(per_cluster, "centroid_id", "left")
        .where(F.col("iteration") == last)
        .select("centroid_id", "cluster_radius", *columns)
        .orderBy("centroid_id")
    )


def iteration_info(scored: DataFrame, iteration: int) -> DataFrame:
    """One training-info row from rows with centroid_id and distance.

    The radius of a cluster is the root mean square distance of its rows.
    """
    clusters = scored.groupBy("centroid_id").agg(
        F.sqrt(F.avg(F.col("distance") * F.col("distance"))).alias("cluster_radius"),
        F.count(F.lit(1)).alias("cluster_size"),
    )
    return _info_row(clusters, iteration)


def _info_row(clusters: DataFrame, iteration: int) -> DataFrame:
    entry = F.struct("centroid_id", "cluster_radius", "cluster_size")
    return clusters.agg(
        F.array_sort(F.collect_list(entry)).alias("cluster_info")
    ).select(
        F.lit(iteration).alias("iteration"),
        F.col("cluster_info").cast(TRAINING_INFO["cluster_info"].dataType),
    )


def model_training_info(model: PipelineModel, assigned: DataFrame, centroids: DataFrame) -> DataFrame:
    """Training-info row of the last iteration of a fitted model, radii in the
    standardised space the model was trained in."""
    deviations = feature_deviations(model)
    moments = assigned.groupBy("centroid_id").agg(
        F.count(F.lit(1)).alias("cluster_size"),
        *[F.avg(c).alias(f"mean_{c}") for c in VECTOR_COLUMNS],
        *[F.var_pop(c).alias(f"var_{c}") for c in VECTOR_COLUMNS],
    )
    # mean square distance to the centroid: variance plus square of the mean's distance
    terms = [
        (F.col(f"var_{c}") + F.pow(F.col(f"mean_{c}") - F.col(c), F.lit(2.0)))
        / F.lit((float(deviations[c]) or 1.0) ** 2)
        for c in VECTOR_COLUMNS
    ]
    clusters = moments.join(centroids, "centroid_id").select(
        "centroid_id", F.sqrt(sum(terms[1:], terms[0])).alias("cluster_radius"), "cluster_size"
    )
    return _info_row(clusters, model.stages[2].summary.numIter)


def kmeans_step(
    rows: DataFrame, centroids: DataFrame, iteration: int = 1
) -> tuple[DataFrame, DataFrame]:
    """One assign-and-update step from given centroids: (new centroids, info).

    Assignment is a projection, the update one partial aggregation to k rows. A
    cluster that loses its last row disappears. Reads the given centroids, so a
    chain of steps runs one job each and carries no lineage along.
    """
    scored = nearest_centroid(rows, centroids).withColumns(
        {c: F.col(f"nearest.{c}") for c in ("centroid_id", "distance")}
    )
    return _means(scored), iteration_info(scored, iteration)


def write_or_replace(df: DataFrame, table: str, **options: str) -> None:
    """CREATE OR REPLACE TABLE AS SELECT. Runs the query."""
    df.write.mode("overwrite").options(**options).saveAsTable(table)
