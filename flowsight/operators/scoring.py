"""Nearest centroid, spread and the outlier test.

The centroids are model parameters: a handful of rows that every row is compared
with. They are read once when the scoring is set up and become constants of the
plan, so scoring is a projection: no join, no shuffle, legal on streams.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from flowsight.functions.vectors import (
    as_double,
    differences,
    euclidean,
    not_null,
    sum_of_squares,
)
from flowsight.schemas import OUTLIERS, VECTOR_COLUMNS

# Fixed value: a row is an outlier strictly above this score.
THRESHOLD = 2.0

# Up to this many centroids "auto" writes the distances out in generated code.
CODE_CENTROIDS = 8
# Centroids per distance matrix of a batch.
MATRIX_SIZE = 256
# Columns that carry the result through the batches.
_CARRIER = "_nearest_"

_N = len(VECTOR_COLUMNS)
_RESULT = StructType(
    [
        StructField("distance", DoubleType()),
        StructField("centroid_id", IntegerType()),
        StructField("normalized_dest", DoubleType()),
        StructField("spread", DoubleType()),
    ]
)


@dataclass(frozen=True)
class Centroids:
    """Centroids sorted by id: ids, normalised spreads (NaN for none) and vectors."""

    ids: np.ndarray
    norms: np.ndarray
    vectors: np.ndarray

    @staticmethod
    def none() -> Centroids:
        return Centroids(np.zeros(0, np.int32), np.zeros(0), np.zeros((0, _N)))

    def __len__(self) -> int:
        return len(self.ids)

    @property
    def deviations(self) -> np.ndarray:
        """Each vector minus its own mean."""
        return self.vectors - self.vectors.sum(axis=1, keepdims=True) / _N


def read_centroids(centroids: DataFrame) -> Centroids:
    """The side table as constants: model parameters, 12 numbers for each centroid.

    Runs the query behind it, once. A row with a null dimension is no centroid.
    """
    norm = "normalized_dest" if "normalized_dest" in centroids.columns else "NULL"
    rows = centroids.where(not_null(["centroid_id", *VECTOR_COLUMNS])).selectExpr(
        "CAST(centroid_id AS INT) AS id",
        f"CAST({norm} AS DOUBLE) AS norm",
        *[f"CAST({c} AS DOUBLE) AS {c}" for c in VECTOR_COLUMNS],
    )
    found = sorted(rows.collect(), key=lambda r: r["id"])
    return Centroids(
        np.array([r["id"] for r in found], dtype=np.int32),
        np.array([np.nan if r["norm"] is None else r["norm"] for r in found], dtype=float),
        np.array([[r[c] for c in VECTOR_COLUMNS] for r in found], dtype=float).reshape(-1, _N),
    )


def _number(value: float) -> str:
    return "CAST(NULL AS DOUBLE)" if np.isnan(value) else f"{float(value)!r}D"


def _numbers(values: np.ndarray) -> list[str]:
    return [_number(v) for v in values]


def _staged(features: DataFrame) -> DataFrame:
    """Vector columns as doubles that cannot be null, `_x0` .. `_x9`."""
    return features.where(not_null()).selectExpr(
        "*", *[f"{as_double(c)} AS _x{j}" for j, c in enumerate(VECTOR_COLUMNS)]
    )


def _distance_exprs(model: Centroids, scale: dict[str, float] | None) -> list[str]:
    x = [f"_x{j}" for j in range(_N)]
    by = [scale[c] for c in VECTOR_COLUMNS] if scale else None
    return [euclidean(differences(x, _numbers(v), by)) for v in model.vectors]


def _scored_in_code(
    features: DataFrame,
    model: Centroids,
    scale: dict[str, float] | None,
    spread_columns: list[str],
) -> DataFrame:
    k = len(model)
    df = _staged(features)
    df = df.selectExpr(
        "*",
        *[f"{d} AS _d{i}" for i, d in enumerate(_distance_exprs(model, scale))],
        f"({' + '.join(as_double(c) for c in spread_columns)}) / {_N}D AS _mean",
    )
    if k == 1:
        nearest, pos = "_d0", "0"
    else:
        nearest = f"least({', '.join(f'_d{i}' for i in range(k))})"
        cases = "".join(f" WHEN _d{i} = _nearest THEN {i}" for i in range(k - 1))
        pos = f"CASE{cases} ELSE {k - 1} END"
    df = df.selectExpr("*", f"{nearest} AS _nearest").selectExpr("*", f"{pos} AS _pos")

    def pick(values: list[str]) -> str:
        return f"get(array({', '.join(values)}), _pos)"

    own = [f"({as_double(c)} - _mean)" for c in spread_columns]
    centre = [pick(_numbers(model.deviations[:, j])) for j in range(_N)]
    spread = f"sqrt({sum_of_squares(differences(own, centre))} / {_N - 1}D)"
    result = (
        f"struct(_nearest AS distance, CAST({pick([str(i) for i in model.ids])} AS INT) AS centroid_id, "
        f"{pick(_numbers(model.norms))} AS normalized_dest, {spread} AS spread)"
    )
    # Exploding the one struct keeps filters on it from being pushed below, where
    # the distances would be written out again for every use.
    return df.selectExpr(
        *[f"`{c}`" for c in features.columns], f"explode(array({result})) AS nearest"
    )


def _nearest_rows(
    x: np.ndarray, model: Centroids, scale: np.ndarray | None
) -> tuple[np.ndarray, np.ndarray]:
    """(distance, position) of the nearest centroid per row of `x`."""
    best = np.full(len(x), np.inf)
    where = np.zeros(len(x), dtype=np.int64)
    for start in range(0, len(model), MATRIX_SIZE):
        block = model.vectors[start : start + MATRIX_SIZE]
        total = np.zeros((len(x), len(block)))
        for j in range(_N):
            d = x[:, j, None] - block[None, :, j]
            if scale is not None:
                d = d / scale[j]
            total += d * d
        distance = np.sqrt(total)
        pos = distance.argmin(axis=1)
        found = distance[np.arange(len(x)), pos]
        closer = found < best
        best[closer], where[closer] = found[closer], pos[closer] + start
    return best, where


def _scored_in_batches(
    features: DataFrame,
    model: Centroids,
    scale: dict[str, float] | None,
    spread_columns: list[str],
) -> DataFrame:
    by = (
        np.array([float(scale[c]) or 1.0 for c in VECTOR_COLUMNS]) if scale else None
    )
    names = features.columns
    carried = [StructField(_CARRIER + f.name, f.dataType) for f in _RESULT]
    schema = StructType(features.schema.fields + carried)

    def matrix(batch: pa.RecordBatch, columns: list[str]) -> np.ndarray:
        picked = [
            batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in columns
        ]
        return np.column_stack(picked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        deviations = model.deviations
        for batch in batches:
            if not batch.num_rows:
                continue
            distance, pos = _nearest_rows(matrix(batch, VECTOR_COLUMNS), model, by)
            y = matrix(batch, spread_columns)
            d = (y - y.sum(axis=1, keepdims=True) / _N) - deviations[pos]
            spread = np.sqrt((d * d).sum(axis=1) / (_N - 1))
            ids, norms = model.ids[pos], model.norms[pos]
            results = [
                pa.array(distance, pa.float64()),
                pa.array(ids.astype(np.int32), pa.int32()),
                pa.array(norms, pa.float64(), mask=np.isnan(norms)),
                pa.array(spread, pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(
                batch.columns + results, names=names + [f.name for f in carried]
            )

    scored = features.where(not_null()).mapInArrow(run, schema)
    result = F.struct(*[F.col(_CARRIER + f.name).alias(f.name) for f in _RESULT])
    return scored.select(*names, result.alias("nearest"))


def nearest_centroid(
    features: DataFrame,
    centroids: DataFrame | Centroids,
    scale: dict[str, float] | None = None,
    spread_columns: list[str] = VECTOR_COLUMNS,
    method: str = "auto",
) -> DataFrame:
    """Adds `nearest`: distance, centroid_id, normalized_dest and the spread to it.

    Ties go to the lowest id. A row with a null dimension has no nearest centroid
    and drops out; without centroids there are no rows. `scale` holds a deviation
    per dimension to compare standardised values. A centroid table given as
    DataFrame is read at once; `read_centroids` reads it ahead.

    Both methods give the same rows: "arrow" compares batches in numpy, for any number of
    centroids; "code" writes the distances out in generated code, for a handful; "auto" takes code for up
    to `CODE_CENTROIDS` of them.
    """
    model = read_centroids(centroids) if isinstance(centroids, DataFrame) else centroids
    features = features.drop("nearest")
    if not len(model):
        empty = F.lit(None).cast(_RESULT)
        return features.where(F.lit(False)).withColumn("nearest", empty)
    if method == "auto":
        method = "code" if len(model) <= CODE_CENTROIDS else "arrow"
    if method not in ("arrow", "code"):
        raise ValueError(f"no method {method}")
    scored = _scored_in_code if method == "code" else _scored_in_batches
    return scored(features, model, scale, spread_columns)


def centroid_distances(
    features: DataFrame, centroids: DataFrame | Centroids
) -> DataFrame:
    """Adds one column `distance_<centroid_id>` per centroid: a report for small models."""
    model = read_centroids(centroids) if isinstance(centroids, DataFrame) else centroids
    exprs = [
        f"{distance} AS distance_{i}"
        for i, distance in zip(model.ids, _distance_exprs(model, None))
    ]
    return _staged(features).selectExpr(*[f"`{c}`" for c in features.columns], *exprs)


# Compat: what each count column is filled from when the counts are rotated.
_ROTATED = {
    "number_of_records": "number_of_unique_ips",
    "number_of_unique_ips": "number_of_unique_ports",
    "number_of_unique_ports": "number_of_records",
}


def score_rows(
    features: DataFrame,
    centroids: DataFrame | Centroids,
    scale: dict[str, float] | None = None,
    rotate_counts: bool = False,
) -> DataFrame:
    """Adds distance, centroid_id, normalized_dest and spread, over columns of these names.

    `rotate_counts` (compat) shifts the three counts by one place between the
    nearest-centroid and the spread step.
    """
    spread_columns = VECTOR_COLUMNS
    if rotate_counts:
        spread_columns = [_ROTATED.get(c, c) for c in VECTOR_COLUMNS]
    scored = nearest_centroid(features, centroids, scale, spread_columns)
    if rotate_counts:
        scored = scored.withColumns({c: F.col(s) for c, s in _ROTATED.items()})
    kept = [c for c in features.columns if c not in _RESULT.names and c != "nearest"]
    return scored.select(*kept, "nearest.*")


def is_outlier(threshold: float = THRESHOLD) -> str:
    """spread / normalized_dest > threshold, written without the division.

    A cluster of one row has no normalized_dest and flags nothing.
    """
    return f"spread > {float(threshold)!r}D * normalized_dest"


def find_outliers(
    features: DataFrame,
    centroids: DataFrame | Centroids,
    threshold: float = THRESHOLD,
    scale: dict[str, float] | None = None,
    rotate_counts: bool = False,
) -> DataFrame:
    """The feature rows that are outliers, with the id of their nearest centroid."""
    scored = score_rows(features, centroids, scale, rotate_counts)
    return scored.where(is_outlier(threshold)).select(*[f.name for f in OUTLIERS])
