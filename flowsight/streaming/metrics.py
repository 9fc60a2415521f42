"""Counters observed while a query runs."""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def counted(df: DataFrame, name: str, **counters: Column) -> DataFrame:
    """Count rows, or the given aggregates, as they pass; the rows are unchanged."""
    exprs = [c.alias(n) for n, c in counters.items()] or [
        F.count(F.lit(1)).alias("rows")
    ]
    return df.observe(name, *exprs)


class CounterListener(StreamingQueryListener):
    """Sums the observed counters and the rows dropped as late, over all batches."""

    def __init__(self) -> None:
        self.totals: dict[str, int] = {}
        self.dropped_late = 0
        self.input_rows = 0
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self._lock:
            self.input_rows += progress.numInputRows
            for operator in progress.stateOperators:
                self.dropped_late += operator.numRowsDroppedByWatermark
            for name, row in progress.observedMetrics.items():
                for key, value in row.asDict().items():
                    label = f"{name}.{key}"
                    self.totals[label] = self.totals.get(label, 0) + (value or 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
