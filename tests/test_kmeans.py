"""k-means by rounds against plain numpy, seeding and edges."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowsight.operators import kmeans
from flowsight.schemas import VECTOR_COLUMNS

N = len(VECTOR_COLUMNS)
SCHEMA = "k string, " + ", ".join(f"{c} double" for c in VECTOR_COLUMNS)


def frame(spark, points, keys=None):
    keys = keys or [f"r{i:05d}" for i in range(len(points))]
    return spark.createDataFrame([(k, *map(float, p)) for k, p in zip(keys, points)], SCHEMA)


def blobs(n=400, k=4, seed=3):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(k, N)) * 40
    labels = random.integers(0, k, n)
    return centres[labels] + random.normal(size=(n, N)), labels


def plain_round(points, centres, by):
    distance = np.sqrt((((points[:, None] - centres[None]) / by) ** 2).sum(axis=2))
    label = distance.argmin(axis=1)
    near = distance[np.arange(len(points)), label]
    updated = np.array([points[label == i].mean(axis=0) if (label == i).any() else c for i, c in enumerate(centres)])
    radii = [float(np.sqrt((near[label == i] ** 2).mean())) if (label == i).any() else None for i in range(len(centres))]
    return updated, radii, np.bincount(label, minlength=len(centres)).tolist(), float((near**2).mean())


def test_rounds_equal_numpy(spark):
    points, _ = blobs(300)
    rows = frame(spark, points)
    model = kmeans.fit(rows, "k", k=5, iterations=4, tolerance=None)
    by = points.std(axis=0, ddof=1)
    assert [model.deviations[c] for c in VECTOR_COLUMNS] == pytest.approx(by.tolist())
    centres = model.start
    assert len(model.rounds) == 4
    for r in model.rounds:
        centres, radii, sizes, loss = plain_round(points, centres, by)
        assert r.sizes == sizes and r.loss == pytest.approx(loss)
        assert np.allclose(r.centres, centres) and r.radii == pytest.approx(radii)


def test_finds_separate_clusters(spark):
    points, labels = blobs()
    rows = frame(spark, points)
    model = kmeans.fit(rows, "k", k=4)
    found = {r["k"]: r["centroid_id"] for r in kmeans.assign(model, rows).collect()}
    pairs = {(label, found[f"r{i:05d}"]) for i, label in enumerate(labels)}
    assert len(pairs) == 4
    assert len(model.rounds) < 20  # stopped when nothing moved
    losses = [r.loss for r in model.rounds]
    assert losses == sorted(losses, reverse=True)


def test_same_on_every_layout(spark):
    points, _ = blobs(200)
    rows = frame(spark, points)
    a = kmeans.fit(rows.repartition(7), "k", k=3, iterations=3)
    b = kmeans.fit(rows.orderBy(F.desc("k")).coalesce(1), "k", k=3, iterations=3)
    assert np.allclose(a.centres, b.centres) and (a.start == b.start).all()
    other = kmeans.seed_candidates(rows, "k", a.deviations, 2, 3, 6.0)
    assert not np.array_equal(other, kmeans.seed_candidates(rows, "k", a.deviations, 1, 3, 6.0))


def test_seeding_draws_what_it_is_told_to(spark):
    points, _ = blobs(2000)
    rows = frame(spark, points)
    found = kmeans.seed_candidates(rows, "k", kmeans.column_deviations(rows), 1, 5, 40.0)
    assert 120 < len(found) < 280
    assert len(np.unique(found, axis=0)) == len(found)


def test_fewer_rows_than_clusters_nulls_and_none(spark):
    points = np.repeat(np.arange(3.0)[:, None], N, axis=1).repeat(20, axis=0)
    model = kmeans.fit(frame(spark, points), "k", k=5)
    assert len(model.centres) == 3 and sorted(model.rounds[-1].sizes) == [20, 20, 20]
    holes = frame(spark, points).withColumn("avg_duration", F.when(F.col("k") > "r00030", F.lit(1.0)))
    assert sum(kmeans.fit(holes, "k", k=2).rounds[-1].sizes) == 29
    nothing = kmeans.fit(frame(spark, []), "k", k=2)
    assert len(nothing.centres) == 0 and nothing.rounds == []
    assert kmeans.assign(nothing, frame(spark, points)).count() == 0
    assert kmeans.training_info(spark, nothing).count() == kmeans.centroids_long(spark, nothing).count() == 0
    one = kmeans.fit(frame(spark, points[:1]), "k", k=2)
    assert one.rounds[-1].sizes == [1] and one.rounds[-1].radii == [0.0]


def test_a_cluster_that_loses_its_rows_keeps_its_centre(spark):
    points = np.repeat(np.array([0.0, 1.0, 10.0])[:, None], N, axis=1)
    centres = np.repeat(np.array([0.5, 10.0, 99.0])[:, None], N, axis=1)
    found = kmeans.lloyd_round(frame(spark, points), centres, dict.fromkeys(VECTOR_COLUMNS, 1.0), 1)
    assert found.sizes == [2, 1, 0] and found.radii[2] is None
    assert (found.centres == centres).all()


def test_thinning_takes_the_heaviest_then_the_costliest():
    points = np.array([[0.0], [0.1], [5.0], [9.0]])
    picked = kmeans.thin(points, np.array([10.0, 4.0, 3.0, 2.0]), np.ones(1), 3)
    assert picked.ravel().tolist() == [0.0, 9.0, 5.0]
    assert len(kmeans.thin(points, np.zeros(4), np.ones(1), 3)) == 1
