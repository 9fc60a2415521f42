"""Feature-vector arithmetic over named columns, as SQL expression text.

The ten dimensions are fixed, so sums are written out term by term over columns
that cannot be null: the generated code stays small enough to be compiled.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowsight.schemas import VECTOR_COLUMNS


def feature_vector() -> Column:
    return F.array(*[F.col(c).cast("double") for c in VECTOR_COLUMNS])


def not_null(names: list[str] = VECTOR_COLUMNS) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in names)


def as_double(name: str) -> str:
    """The column as a double that cannot be null, for rows that passed `not_null`."""
    return f"coalesce(CAST({name} AS DOUBLE), 0D)"


def differences(
    left: list[str], right: list[str], scale: list[float] | None = None
) -> list[str]:
    """left - right per dimension; `scale` divides each by its deviation."""
    diffs = [f"({a} - {b})" for a, b in zip(left, right)]
    if scale is None:
        return diffs
    return [f"({d} / {float(s) or 1.0!r}D)" for d, s in zip(diffs, scale)]


def sum_of_squares(terms: list[str]) -> str:
    return "(" + " + ".join(f"{t} * {t}" for t in terms) + ")"


def euclidean(diffs: list[str]) -> str:
    return f"sqrt({sum_of_squares(diffs)})"
