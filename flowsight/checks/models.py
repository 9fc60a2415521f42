"""Scores of tree ensembles kept as tables of nodes, curves, seeded orders; and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsight.checks import views as V
from flowsight.checks.oracles import RULE, TRANSACTIONS, hash32_sql
from flowsight.checks.queries import Query, fitted_trees, rounded, rule_scored
from flowsight.operators import curves, ensemble, fraud, sampling
from flowsight.session import scratch_path

NUMBERS = fraud.NUMERIC_COLUMNS
HOT, WEIGHT, ALERT = "TRANSFER", 0.6, 0.004

# tree i: its column at the mean, then the type, then four cells with their mean label
_LONG = f"stack({len(NUMBERS)}, {', '.join(f"{i}, '{c}', CAST({c} AS DOUBLE)" for i, c in enumerate(NUMBERS))})"


def rule_nodes(spark, sf) -> DataFrame:
    """An ensemble made from the transactions by a rule that SQL can state."""
    rows = V.transactions(spark, sf).selectExpr("type", "isFraud", f"{_LONG} AS (tree, feature, x)")
    means = rows.groupBy("tree", "feature").agg(F.avg("x").alias("threshold"))
    sides = rows.join(F.broadcast(means), ["tree", "feature"])  # a row for each column
    low, hot = F.col("x") <= F.col("threshold"), F.col("type") == HOT
    leaf = F.when(low & hot, 3).when(low, 4).when(hot, 5).otherwise(6)
    cells = sides.groupBy("tree", leaf.alias("node")).agg((F.avg("isFraud") * 2 - 1).alias("mean"))
    slots = means.withColumn("node", F.explode(F.sequence(F.lit(0), F.lit(6)))).join(cells, ["tree", "node"], "left")
    inner, root = F.col("node") <= 2, F.col("node") == 0
    return slots.select(
        "tree",
        "node",
        F.when(root, F.col("feature")).when(inner, "type").alias("feature"),
        F.when(inner & ~root, HOT).alias("category"),
        F.when(root, F.col("threshold")).alias("threshold"),
        F.when(inner, 2 * F.col("node") + 1).alias("left"),
        F.when(inner, 2 * F.col("node") + 2).alias("right"),
        F.coalesce("mean", F.lit(0.0)).alias("value"),
        F.lit(WEIGHT).alias("weight"),
    )


def _stored(spark, sf) -> ensemble.Ensemble:
    path = scratch_path(spark, "ensemble")
    ensemble.write_nodes(rule_nodes(spark, sf), f"{path}/nodes")
    return ensemble.load_ensemble(spark, path)


def _scores(spark, sf, method: str) -> DataFrame:
    rows = fraud.model_input(V.transactions(spark, sf))
    scored = ensemble.score(rows, _stored(spark, sf), method)
    return rounded(scored.select("transactionId", "type", "logistic"), 9, "logistic")


def ensemble_scores(spark, sf):
    return _scores(spark, sf, "arrow")


def ensemble_scores_in_code(spark, sf):
    return _scores(spark, sf, "code")


def ensemble_alerts(spark, sf):
    """Alerts as the job makes them, by a stored ensemble."""
    scored = fraud.predict(_stored(spark, sf), fraud.model_input(V.transactions(spark, sf)))
    found = fraud.alerts(fraud.prediction_rows(scored), ALERT)
    return rounded(found.drop("json_response"), 9, "logistic")


def _tied(spark, sf) -> DataFrame:
    """Rule scores with many ties."""
    return rounded(rule_scored(spark, sf), 4, "logistic")


def roc_curve(spark, sf):
    numbers = ["recall", "false_positive_rate", "precision"]
    return rounded(curves.curve(_tied(spark, sf)), 9, *numbers)


def areas_under_curves(spark, sf):
    return rounded(curves.areas(_tied(spark, sf)), 9, "roc_area", "average_precision")


def shuffled_positions(spark, sf):
    """The place of every transaction in a seeded order of all."""
    rows = V.transactions(spark, sf).select("transactionId", "amount")
    return sampling.with_position(rows, "transactionId", seed=5)


def gbt_nodes_agree(spark, sf):
    """Every transaction: whether the fitted trees and their table of nodes score it alike."""
    model = fitted_trees(spark, sf)
    path = scratch_path(spark, "gbt_nodes")
    fraud.save_nodes(model, path)
    rows = fraud.model_input(V.transactions(spark, sf))
    both = fraud.predict(model, rows).withColumnRenamed("logistic", "fitted")
    both = fraud.predict(ensemble.load_ensemble(spark, path), both)
    near = F.abs(F.col("fitted") - F.col("logistic")) < 1e-9
    return both.select("transactionId", near.alias("alike"), F.col("logistic").between(0, 1).alias("probability"))


# ---- the same in SQL ----

_UNPIVOT = " UNION ALL ".join(
    f"SELECT transactionId, type, isFraud, {i} AS tree, '{c}' AS feature, CAST({c} AS DOUBLE) AS x FROM t"
    for i, c in enumerate(NUMBERS)
)
_WALK = f"""WITH RECURSIVE t AS ({TRANSACTIONS}), rows AS MATERIALIZED ({_UNPIVOT}),
means AS MATERIALIZED (SELECT tree, feature, avg(x) AS threshold FROM rows GROUP BY 1, 2),
cells AS (SELECT tree, CASE WHEN x <= threshold THEN 3 ELSE 5 END + CASE WHEN type = '{HOT}' THEN 0 ELSE 1 END AS node,
  avg(isFraud) * 2 - 1 AS mean FROM rows JOIN means USING (tree, feature) GROUP BY 1, 2),
nodes AS MATERIALIZED (SELECT tree, node, CASE WHEN node = 0 THEN feature WHEN node <= 2 THEN 'type' END AS feature,
  CASE WHEN node = 0 THEN threshold END AS threshold, coalesce(mean, 0) AS value
  FROM means CROSS JOIN (SELECT unnest(range(7)) AS node) LEFT JOIN cells USING (tree, node)),
walk AS (
  SELECT transactionId, tree, CAST(0 AS BIGINT) AS node FROM rows
  UNION ALL
  SELECT w.transactionId, w.tree, 2 * w.node + CASE WHEN (n.feature = 'type' AND r.type = '{HOT}')
    OR (n.feature <> 'type' AND r.x <= n.threshold) THEN 1 ELSE 2 END
  FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node
    JOIN rows r ON r.transactionId = w.transactionId AND r.tree = w.tree
  WHERE n.feature IS NOT NULL
),
scored AS (
  SELECT transactionId, any_value(r.type) AS type, 1 / (1 + exp(-2 * sum({WEIGHT}::DOUBLE * value))) AS logistic
  FROM walk JOIN nodes n USING (tree, node) JOIN rows r USING (transactionId, tree) WHERE n.feature IS NULL GROUP BY 1
) """
_SCORES = f"{_WALK} SELECT transactionId, type, round(logistic, 9) AS logistic FROM scored"

_CURVE = f"""WITH s AS (SELECT round(logistic, 4) AS score, isFraud FROM ({RULE})),
c AS (SELECT score, count(*) FILTER (isFraud = 1) AS p, count(*) FILTER (isFraud <> 1) AS n FROM s GROUP BY 1),
r AS (SELECT *, CAST(sum(p) OVER w AS BIGINT) AS tp, CAST(sum(n) OVER w AS BIGINT) AS fp, sum(p) OVER () AS all_p, sum(n) OVER () AS all_n
  FROM c WINDOW w AS (ORDER BY score DESC)) """

MODEL_QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        ensemble_scores,
        ensemble_scores_in_code,
        ensemble_alerts,
        gbt_nodes_agree,
        roc_curve,
        areas_under_curves,
        shuffled_positions,
    )
}

MODEL_ORACLES: dict[str, str] = {
    "ensemble_scores": _SCORES,
    "ensemble_scores_in_code": _SCORES,
    "ensemble_alerts": f"{_WALK} SELECT transactionId, round(logistic, 9) AS logistic FROM scored WHERE logistic >= {ALERT}",
    "roc_curve": f"{_CURVE} SELECT score, tp AS true_positives, fp AS false_positives, round(tp / all_p::DOUBLE, 9) AS recall, "
    "round(fp / all_n::DOUBLE, 9) AS false_positive_rate, round(tp / (tp + fp)::DOUBLE, 9) AS precision FROM r",
    "areas_under_curves": f"{_CURVE} SELECT CAST(sum(p) AS BIGINT) AS positives, CAST(sum(n) AS BIGINT) AS negatives, "
    "round(sum(n::DOUBLE * (2 * (tp - p) + p)) / (2.0 * sum(p) * sum(n)), 9) AS roc_area, "
    "round(sum(p * tp / (tp + fp)::DOUBLE) / sum(p), 9) AS average_precision FROM r",
    "shuffled_positions": f"SELECT transactionId, amount, row_number() OVER (ORDER BY {hash32_sql('transactionId', 5)}, transactionId) "
    f"AS position FROM ({TRANSACTIONS})",
    "gbt_nodes_agree": f"SELECT transactionId, true AS alike, true AS probability FROM ({TRANSACTIONS})",
}
