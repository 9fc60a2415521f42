"""Scoring and clustering against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowsight.operators import clustering, kmeans, scoring
from flowsight.plans import training
from flowsight.schemas import FEATURES, NORMALIZED_CENTROIDS, VECTOR_COLUMNS

COUNTS = ["number_of_records", "number_of_unique_ips", "number_of_unique_ports"]


def feature_rows(spark, n, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        size = int(rng.integers(1, 4)) * 1000
        values = {}
        for f in FEATURES:
            if f.name in ("subscriber_id", "dst_subnet", "transaction_time"):
                continue
            number = int(rng.integers(0, size))
            values[f.name] = float(number) / 3 if f.name.startswith("avg") else number
        rows.append((f"s{i}", "12.0.1.2/22", "2024-01-01 00:00:00.000000", *[values[c] for c in FEATURES.fieldNames()[3:]]))
    return spark.createDataFrame(rows, FEATURES)


def centroid_rows(spark, k, seed=5):
    rng = np.random.default_rng(seed)
    rows = [
        (i + 1, float(rng.uniform(50, 400)), *[float(x) for x in rng.integers(0, 3000, 10)])
        for i in range(k)
    ]
    return spark.createDataFrame(rows, NORMALIZED_CENTROIDS)


def expected(features, centroids, rotate=False):
    out = {}
    table = [
        (c["centroid_id"], c["normalized_dest"], np.array([c[f] for f in VECTOR_COLUMNS]))
        for c in sorted(centroids.collect(), key=lambda c: c["centroid_id"])
    ]
    for row in features.collect():
        x = np.array([float(row[f]) for f in VECTOR_COLUMNS])
        distances = [np.sqrt(((x - v) ** 2).sum()) for _, _, v in table]
        i = int(np.argmin(distances))
        y = x.copy()
        if rotate:
            y[0] = row["number_of_unique_ips"]
        spread = np.std(y - table[i][2], ddof=1)
        out[row["subscriber_id"]] = (table[i][0], distances[i], spread, spread > 2.0 * table[i][1])
    return out


@pytest.mark.parametrize("k", [1, 2, 6, 7, 40, 600])
def test_scores_equal_numpy(spark, k):
    features, centroids = feature_rows(spark, 300), centroid_rows(spark, k)
    want = expected(features, centroids)
    got = {r["subscriber_id"]: r for r in scoring.score_rows(features, centroids).collect()}
    assert set(got) == set(want)
    for key, (centroid, distance, spread, _) in want.items():
        assert got[key]["centroid_id"] == centroid
        assert got[key]["distance"] == pytest.approx(distance, rel=1e-12)
        assert got[key]["spread"] == pytest.approx(spread, rel=1e-12)
    found = {r["subscriber_id"] for r in scoring.find_outliers(features, centroids).collect()}
    assert found == {key for key, v in want.items() if v[3]}


def test_large_model_and_methods_agree(spark):
    features, centroids = feature_rows(spark, 100), centroid_rows(spark, 500)
    model = scoring.read_centroids(centroids)
    assert len(model) == 500
    got = scoring.score_rows(features, model).collect()
    want = expected(features, centroids)
    assert {r["subscriber_id"]: r["centroid_id"] for r in got} == {k: v[0] for k, v in want.items()}
    few = centroid_rows(spark, 7)
    near = [
        scoring.nearest_centroid(features, few, method=m).select("subscriber_id", "nearest.centroid_id")
        for m in ("arrow", "code")
    ]
    assert sorted(map(tuple, near[0].collect())) == sorted(map(tuple, near[1].collect()))


@pytest.mark.parametrize("k", [3, 7])
@pytest.mark.parametrize("name", ["centroid_id", "distance", "spread", "nearest"])
def test_columns_of_the_result_names(spark, k, name):
    plain, centroids = feature_rows(spark, 50), centroid_rows(spark, k)
    carried = plain.withColumn(name, scoring.F.lit(99))
    want = scoring.score_rows(plain, centroids).select("subscriber_id", "centroid_id", "distance")
    got = scoring.score_rows(carried, centroids).select("subscriber_id", "centroid_id", "distance")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("k", [4, 10])
def test_tie_goes_to_lowest_id(spark, k):
    vector = [1.0] * 10
    rows = [(k - i, 1.0, *vector) for i in range(k)]
    centroids = spark.createDataFrame(rows, NORMALIZED_CENTROIDS)
    got = scoring.score_rows(feature_rows(spark, 20), centroids).select("centroid_id").distinct()
    assert [r[0] for r in got.collect()] == [1]


@pytest.mark.parametrize("k", [3, 9])
def test_nulls(spark, k):
    features = feature_rows(spark, 10).withColumn(
        "avg_duration", F.when(F.col("subscriber_id") != "s1", F.col("avg_duration"))
    )
    centroids = centroid_rows(spark, k)
    incomplete = centroids.withColumn("max_tx_bytes", F.lit(None).cast("double"))
    assert scoring.score_rows(features, centroids).count() == 9
    assert scoring.find_outliers(features, incomplete).count() == 0
    assert scoring.score_rows(features, centroids.limit(0)).count() == 0
    unknown = centroids.withColumn("normalized_dest", F.lit(None).cast("double"))
    assert scoring.score_rows(features, unknown).count() == 9
    assert scoring.find_outliers(features, unknown).count() == 0


@pytest.mark.parametrize("k", [3, 9])
def test_rotated_counts(spark, k):
    features, centroids = feature_rows(spark, 100), centroid_rows(spark, k)
    want = expected(features, centroids, rotate=True)
    before = {r["subscriber_id"]: r for r in features.collect()}
    for r in scoring.score_rows(features, centroids, rotate_counts=True).collect():
        source = before[r["subscriber_id"]]
        assert [r[c] for c in COUNTS] == [source[COUNTS[1]], source[COUNTS[2]], source[COUNTS[0]]]
        assert r["spread"] == pytest.approx(want[r["subscriber_id"]][2], rel=1e-12)


@pytest.mark.parametrize("k", [3, 9])
def test_standardised_distance(spark, k):
    features, centroids = feature_rows(spark, 50), centroid_rows(spark, k)
    scale = {c: float(j + 1) for j, c in enumerate(VECTOR_COLUMNS)}
    by = np.array([scale[c] for c in VECTOR_COLUMNS])
    vectors = {r["centroid_id"]: np.array([r[c] for c in VECTOR_COLUMNS]) for r in centroids.collect()}
    for r in scoring.score_rows(features, centroids, scale).collect():
        x = np.array([float(r[c]) for c in VECTOR_COLUMNS])
        best = min((np.sqrt((((x - v) / by) ** 2).sum()), i) for i, v in vectors.items())
        assert r["centroid_id"] == best[1]
        assert r["distance"] == pytest.approx(best[0], rel=1e-12)


def test_scores_do_not_depend_on_partitions(spark):
    features, centroids = feature_rows(spark, 200), centroid_rows(spark, 9)
    a = scoring.score_rows(features.repartition(7), centroids).collect()
    b = scoring.score_rows(features.orderBy(F.desc("subscriber_id")).coalesce(1), centroids).collect()
    assert sorted(map(repr, a)) == sorted(map(repr, b))


def test_scoring_has_no_shuffle(spark):
    plan = scoring.find_outliers(feature_rows(spark, 10), centroid_rows(spark, 4))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Join" not in text


def test_kmeans_job(spark):
    features = feature_rows(spark, 300).withColumn("dt", F.to_date("transaction_time"))
    result = training.train_clusters(spark, features, "2024-01-01", "2024-01-01", k=3)
    assert result.normalized.schema.names == NORMALIZED_CENTROIDS.names
    assert sorted(r["centroid_id"] for r in result.normalized.collect()) == [1, 2, 3]
    report = result.report.collect()
    assert [r["centroid_id"] for r in report] == [1, 2, 3]
    assert all(r["cluster_radius"] > 0 for r in report)
    # the raw-unit centres are the means of their rows
    rows = kmeans.assign(result.model, features)
    means = {r["centroid_id"]: r for r in clustering.pivot_centroids(clustering.centroid_rows(rows)).collect()}
    for r in report:
        for c in VECTOR_COLUMNS:
            assert r[c] == pytest.approx(means[r["centroid_id"]][c], abs=60)
    assert result.report_at(1).count() == 3
    losses = [r["loss"] for r in result.info.orderBy("iteration").collect()]
    assert losses == sorted(losses, reverse=True) and len(losses) == len(result.model.rounds)
    training.write_clusters(result, "normalized_centroid_data")
    training.write_clusters(result, "normalized_centroid_data")
    assert spark.table("normalized_centroid_data").count() == 3


def test_single_row_cluster_has_no_spread(spark):
    rows = feature_rows(spark, 5).withColumn("centroid_id", F.when(F.col("subscriber_id") == "s0", 1).otherwise(2))
    centres = clustering.pivot_centroids(clustering.centroid_rows(rows))
    spread = {r["centroid_id"]: r["normalized_dest"] for r in clustering.centroid_spread(rows, centres).collect()}
    assert spread[1] is None and spread[2] > 0


def test_report_keeps_last_iteration_only(spark):
    centres = centroid_rows(spark, 2).select("centroid_id", *VECTOR_COLUMNS)
    scored = spark.createDataFrame([(1, 3.0), (1, 4.0), (2, 1.0)], "centroid_id int, distance double")
    later = scored.withColumn("distance", F.col("distance") * 2)
    info = clustering.iteration_info(scored, 1).unionByName(clustering.iteration_info(later, 2))
    report = clustering.cluster_report(centres, info).collect()
    assert [r["cluster_radius"] for r in report] == pytest.approx([np.sqrt(50.0), 2.0])
