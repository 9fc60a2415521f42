"""Boosted trees as a table of nodes: exported from a fitted model, stored, read back and scored without it.

A node is a row: numeric nodes send values up to `threshold` left, category nodes send rows of
`category` left, all else (also nulls) goes right; leaves have no feature. Node 0 is a tree's root. The
margin of a row is the sum of weight * value over the leaves it reaches, its probability
1 / (1 + exp(-2 margin)). The table is a model: it is read to the driver once, and scoring is a projection.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from flowsight.schemas import ENSEMBLE_NODES

SCORE = "logistic"


@dataclass(frozen=True)
class Ensemble:
    """Nodes of all trees behind one another; a leaf's children are itself."""

    roots: np.ndarray
    weights: np.ndarray
    feature: list[tuple[str, str | None] | None]
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    @property
    def inputs(self) -> list[tuple[str, str | None]]:
        """(column, category) of all tests, in the order of their first use."""
        return list(dict.fromkeys(f for f in self.feature if f))


# ---- export, write, read ----


def save_ensemble(model: PipelineModel, path: str, columns: list[str], category: str) -> None:
    """Writes the nodes of a fitted pipeline (indexer, one-hot encoder, assembler, trees) as Parquet.

    `columns` are the numeric inputs of the assembler in their order behind the one-hot slots.
    """
    spark = SparkSession.active()
    labels, trees = model.stages[0].labels, model.stages[-1]
    trees.write().overwrite().save(f"{path}/fitted")
    inputs = [(category, label) for label in labels] + [(c, None) for c in columns]
    names = spark.createDataFrame(
        [(i, name, label) for i, (name, label) in enumerate(inputs)], "input int, feature string, category string"
    )
    weights = spark.createDataFrame(
        [(i, float(w)) for i, w in enumerate(trees.treeWeights)], "tree int, weight double"
    )
    data = spark.read.parquet(f"{path}/fitted/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    flat = data.select(
        "tree",
        F.col("id").alias("node"),
        F.col("split.featureIndex").alias("input"),
        F.col("split.numCategories").alias("categories"),
        F.col("split.leftCategoriesOrThreshold").alias("at"),
        "leftChild",
        "rightChild",
        F.col("prediction").alias("value"),
    )
    inner, numeric = F.col("leftChild") >= 0, F.col("categories") < 0
    # a one-hot slot is 1 for rows of its category: the child for 1 becomes the left one
    hot_left = F.array_contains("at", 1.0)
    low, high = F.when(inner, F.col("leftChild")), F.when(inner, F.col("rightChild"))
    # a slot that was split by a threshold sends 0 to the left
    slot = F.col("input") < len(labels)
    swapped = slot & (numeric | ~hot_left)
    nodes = flat.join(F.broadcast(names), "input", "left").join(F.broadcast(weights), "tree")
    nodes = nodes.select(
        "tree",
        "node",
        F.when(inner, F.col("feature")).alias("feature"),
        F.when(inner, F.col("category")).alias("category"),
        F.when(inner & ~slot, F.get("at", F.lit(0))).alias("threshold"),
        F.when(swapped, high).otherwise(low).alias("left"),
        F.when(swapped, low).otherwise(high).alias("right"),
        "value",
        "weight",
    )
    write_nodes(nodes, f"{path}/nodes")


def write_nodes(nodes: DataFrame, path: str) -> None:
    nodes.select(*[F.col(f.name).cast(f.dataType) for f in ENSEMBLE_NODES]).coalesce(1).write.mode(
        "overwrite"
    ).parquet(path)


def load_ensemble(spark: SparkSession, path: str) -> Ensemble:
    """The ensemble of a folder that `save_ensemble` has written."""
    return read_ensemble(spark.read.schema(ENSEMBLE_NODES).parquet(f"{path}/nodes"))


def read_ensemble(nodes: DataFrame) -> Ensemble:
    """The node table as a model. Runs the query behind it, once."""
    rows = sorted(nodes.collect(), key=lambda r: (r["tree"], r["node"]))
    place = {(r["tree"], r["node"]): i for i, r in enumerate(rows)}
    trees = sorted({r["tree"] for r in rows})
    children = [
        [place[r["tree"], r[side]] if r["feature"] is not None else i for i, r in enumerate(rows)]
        for side in ("left", "right")
    ]
    depth = [0] * len(rows)
    todo = [place[t, 0] for t in trees]
    while todo:
        at = todo.pop()
        for child in {children[0][at], children[1][at]} - {at}:
            depth[child] = depth[at] + 1
            todo.append(child)
    weight = {r["tree"]: r["weight"] for r in rows}
    return Ensemble(
        np.array([place[t, 0] for t in trees], np.int64),
        np.array([weight[t] for t in trees], float),
        [None if r["feature"] is None else (r["feature"], r["category"]) for r in rows],
        np.array([0.5 if r["threshold"] is None else r["threshold"] for r in rows], float),
        np.array(children[0], np.int64),
        np.array(children[1], np.int64),
        np.array([r["value"] for r in rows], float),
        max(depth, default=0),
    )


# ---- scoring ----


def _in_batches(rows: DataFrame, model: Ensemble) -> DataFrame:
    inputs = model.inputs
    number = {name: i for i, name in enumerate(inputs)}
    test = np.array([number[f] if f else 0 for f in model.feature], np.int64)
    names = rows.columns
    schema = StructType([*rows.schema.fields, StructField("_score", DoubleType())])

    def values(batch: pa.RecordBatch, name: str, category: str | None) -> np.ndarray:
        column = batch.column(name)
        if category is None:
            return column.cast(pa.float64()).to_numpy(zero_copy_only=False)
        return np.array([0.0 if v == category else 1.0 for v in column.to_pylist()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([values(batch, *i) for i in inputs] or [np.zeros(batch.num_rows)])
            row = np.arange(len(x))
            margin = np.zeros(len(x))
            for root, weight in zip(model.roots, model.weights):
                node = np.full(len(x), root)
                for _ in range(model.depth):
                    low = x[row, test[node]] <= model.threshold[node]  # false for NaN
                    node = np.where(low, model.left[node], model.right[node])
                margin += weight * model.value[node]
            score = 1.0 / (1.0 + np.exp(-2.0 * margin))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*names, "_score"])

    return rows.mapInArrow(run, schema)


def tree_text(model: Ensemble, root: int) -> str:
    """A tree as a SQL expression."""
    if model.feature[root] is None:
        return f"{float(model.value[root])!r}D"
    name, category = model.feature[root]
    if category is None:
        test = f"coalesce(CAST(`{name}` AS DOUBLE), double('NaN')) <= {float(model.threshold[root])!r}D"
    else:
        quoted = category.replace("\\", "\\\\").replace("'", "\\'")
        test = f"coalesce(`{name}` = '{quoted}', false)"
    left, right = tree_text(model, int(model.left[root])), tree_text(model, int(model.right[root]))
    return f"CASE WHEN {test} THEN {left} ELSE {right} END"


def _in_code(rows: DataFrame, model: Ensemble) -> DataFrame:
    terms = [f"{float(w)!r}D * ({tree_text(model, int(r))})" for r, w in zip(model.roots, model.weights)]
    margin = " + ".join(["0D", *terms])
    return rows.withColumn("_score", F.expr(f"1D / (1D + exp(-2D * ({margin})))"))


def score(rows: DataFrame, model: Ensemble, method: str = "arrow") -> DataFrame:
    """Adds `logistic`, over a column of this name.

    Both methods give the same rows: "arrow" walks the trees a batch at a time, for any number of them;
    "code" writes a few small trees out in generated code.
    """
    if method not in ("arrow", "code"):
        raise ValueError(f"no method {method}")
    scored = (_in_code if method == "code" else _in_batches)(rows, model)
    kept = [c for c in rows.columns if c != SCORE]
    return scored.select(*kept, F.col("_score").alias(SCORE))
