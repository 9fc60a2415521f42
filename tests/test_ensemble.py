"""Tree ensembles as tables of nodes: against the fitted model, both methods, odd values."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import labelled

from flowsight.operators import ensemble, fraud
from flowsight.plans import training
from flowsight.schemas import ENSEMBLE_NODES

NODES = [
    # tree, node, feature, category, threshold, left, right, value, weight
    (0, 0, "x", None, 2.5, 1, 2, 0.0, 1.0),
    (0, 1, "kind", "it's \\ a", None, 3, 4, 0.0, 1.0),
    (0, 2, None, None, None, None, None, 0.5, 1.0),
    (0, 3, None, None, None, None, None, -1.0, 1.0),
    (0, 4, None, None, None, None, None, 2.0, 1.0),
    (5, 0, None, None, None, None, None, 0.25, 0.5),
]


def model(spark, rows=NODES):
    return ensemble.read_ensemble(spark.createDataFrame(rows, ENSEMBLE_NODES))


@pytest.mark.parametrize("method", ["arrow", "code"])
def test_scores_by_hand(spark, method):
    rows = [(1, 2.5, "it's \\ a"), (2, 2.5, "b"), (3, 2.6, "b"), (4, None, "b"), (5, float("nan"), None), (6, -1.0, None)]
    df = spark.createDataFrame(rows, "id int, x double, kind string").withColumn("logistic", F.lit("old"))
    got = {r["id"]: r["logistic"] for r in ensemble.score(df, model(spark), method).collect()}
    margin = {1: -1.0, 2: 2.0, 3: 0.5, 4: 0.5, 5: 0.5, 6: 2.0}
    for i, m in margin.items():
        assert got[i] == pytest.approx(1 / (1 + np.exp(-2 * (m + 0.125))), abs=1e-15)
    assert ensemble.score(df.limit(0), model(spark), method).count() == 0


@pytest.mark.parametrize("method", ["arrow", "code"])
def test_a_single_leaf_and_no_trees(spark, method):
    df = spark.createDataFrame([(1, 2.0, "a")], "id int, x double, kind string")
    assert ensemble.score(df, model(spark, NODES[-1:]), method).first()["logistic"] == pytest.approx(0.5621765)
    assert ensemble.score(df, model(spark, []), method).first()["logistic"] == 0.5


def test_exported_trees_score_like_the_fitted_ones(spark, folder):
    result = training.train_fraud(labelled(spark), sample_fraction=0.3, iterations=4, step_size=0.3)
    fraud.save_nodes(result.model, folder)
    kept = ensemble.load_ensemble(spark, folder)
    assert len(kept.roots) == 4 and kept.depth <= 5
    rows = fraud.model_input(labelled(spark))
    rows = rows.unionByName(rows.limit(50).withColumns({"type": F.lit("NEW"), "transactionId": F.expr("uuid()")}))
    fitted = fraud.predict(result.model, rows).withColumnRenamed("logistic", "fitted")
    both = fraud.predict(kept, fitted)
    assert both.where(F.abs(F.col("fitted") - F.col("logistic")) > 1e-12).count() == 0
    code = ensemble.score(both.drop("fitted").withColumnRenamed("logistic", "a"), kept, "code")
    assert code.where("abs(a - logistic) > 1e-15").count() == 0
    assert both.agg(F.count_distinct("logistic")).first()[0] > 3


def test_nodes_of_the_job(spark, folder):
    """The job takes a model read from a table of nodes."""
    from flowsight.options import FraudOptions
    from flowsight.plans import fraud_detection

    nodes = [(0, 0, "amount", None, 500_000.0, 1, 2, 0.0, 1.0)]
    nodes += [(0, i, None, None, None, None, None, v, 1.0) for i, v in ((1, -5.0), (2, 5.0))]
    rows = labelled(spark)
    found = fraud_detection.score(rows, FraudOptions(), model=model(spark, nodes))
    assert found.count() == rows.where("amount > 500000").count() > 0


def test_training_rows_are_dealt_to_all_tasks(spark, monkeypatch):
    """Rows of a file with one row group lie in one partition: the training spreads them, each row once."""
    seen = []

    def fit(_, rows):
        parts = rows.groupBy(F.spark_partition_id()).count().collect()
        seen.append(([r["count"] for r in parts], sorted(r["amount"] for r in rows.select("amount").collect())))

    monkeypatch.setattr(fraud.Pipeline, "fit", fit)
    monkeypatch.setattr(fraud, "TRAIN_TASK_ROWS", 100, raising=False)
    rows = labelled(spark).coalesce(1).persist()
    amounts = sorted(r["amount"] for r in rows.select("amount").collect())
    fraud.fit_fraud_model(rows)
    fraud.fit_fraud_model(rows.limit(99))
    fraud.fit_fraud_model(rows.limit(0))
    rows.unpersist()
    (counts, kept), (few, _), (none, _) = seen
    assert kept == amounts and len(counts) > 1
    assert max(counts) * len(counts) <= 2 * sum(counts)
    assert few == [99] and none == []
