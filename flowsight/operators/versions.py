"""Centroid tables in versions: every window is scored by the version valid at its end."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsight.operators.scoring import THRESHOLD, Centroids, find_outliers, read_centroids
from flowsight.schemas import NORMALIZED_CENTROIDS

VALID_FROM = "valid_from"


def _micros(column: Column) -> Column:
    return F.unix_micros(column)


def _window_end() -> Column:
    return _micros(F.to_timestamp("transaction_time"))


@dataclass(frozen=True)
class Version:
    """Centroids valid from a time (inclusive, in microseconds) to the next version's."""

    start: int
    end: int | None
    centroids: Centroids


def read_versions(versions: DataFrame, first: int, last: int) -> list[Version]:
    """The versions valid at some time in [first, last]. Runs the query behind the table, for these versions only.

    A row with a null dimension is no centroid; the start of a version is known even if it has none.
    """
    since = _micros(F.col(VALID_FROM).cast("timestamp"))
    starts = sorted(r[0] for r in versions.select(since).distinct().where(since <= last).collect())
    found = []
    for start, end in zip(starts, [*starts[1:], None]):
        if end is None or end > first:
            rows = versions.where(since == start).select(*NORMALIZED_CENTROIDS.fieldNames())
            found.append(Version(start, end, read_centroids(rows)))
    return found


def find_outliers_by_version(
    features: DataFrame, versions: DataFrame, threshold: float = THRESHOLD, rotate_counts: bool = False
) -> DataFrame:
    """Outliers of `features` (written: they are read once for each version they meet).

    Windows that end before the first version have no outliers. A batch of a stream meets one version, at a change two.
    """
    seen = features.agg(F.min(_window_end()).alias("first"), F.max(_window_end()).alias("last")).first()
    nothing = find_outliers(features, Centroids.none(), threshold)
    if seen["first"] is None:
        return nothing
    parts = []
    for v in read_versions(versions, seen["first"], seen["last"]):
        inside = _window_end() >= v.start
        if v.end is not None:
            inside = inside & (_window_end() < v.end)
        parts.append(find_outliers(features.where(inside), v.centroids, threshold, rotate_counts=rotate_counts))
    return reduce(DataFrame.unionByName, parts, nothing)
