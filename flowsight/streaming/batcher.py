"""Request batching on a stream: keyed list state and an event-time timer."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from flowsight.operators.batching import Packer, request_text

_OUTPUT = (
    "window_start bigint, shard bigint, batch_id bigint, n_rows bigint, "
    "n_bytes bigint, request string"
)


# Documents handed back to Spark at a time.
_SLICE = 64


class WindowBatcher(StatefulProcessor):
    """Keeps the payloads of a (window, shard) until the watermark passes the window
    end, then packs them in arrival order. One state value holds a chunk of rows."""

    def __init__(self, limit: int) -> None:
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.chunks = handle.getListState("chunks", "payloads array<string>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        self.chunks.appendList([(frame["payload"].tolist(),) for frame in rows if len(frame)])
        self.handle.registerTimer(int(key[1]) // 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # the state is read as an iterator: a chunk, an open batch and a slice are held
        packer, pending, done = Packer(self.limit), [], []
        for (payloads,) in self.chunks.get():
            texts = list(payloads)
            sizes = np.fromiter((len(t.encode("utf-8")) for t in texts), np.int64, len(texts))
            group = np.zeros(len(texts), np.int64)
            _, opens = packer.number(group, group, sizes)
            cuts = np.flatnonzero(opens).tolist()
            for start, end in zip([0, *cuts], [*cuts, len(texts)]):
                if pending and start < len(texts) and opens[start]:
                    done.append(pending)
                    pending = []
                pending = pending + texts[start:end]
            while len(done) >= _SLICE:
                yield self._documents(key, packer.batch - len(done), done[:_SLICE])
                done = done[_SLICE:]
        if pending:
            done.append(pending)
        if done:
            yield self._documents(key, packer.batch + 1 - len(done), done)
        self.chunks.clear()

    def _documents(self, key, first: int, batches: list[list[str]]) -> pd.DataFrame:
        n = len(batches)
        return pd.DataFrame(
            {
                "window_start": [int(key[0])] * n,
                "shard": [int(key[2])] * n,
                "batch_id": range(first, first + n),
                "n_rows": [len(texts) for texts in batches],
                "n_bytes": [sum(len(t.encode("utf-8")) for t in texts) for texts in batches],
                "request": [request_text(texts) for texts in batches],
            }
        )

    def close(self) -> None:
        pass


def stream_requests(
    rows: DataFrame,
    payload: Column,
    shard: Column,
    limit: int,
    window_seconds: int = 5,
    event_time: str = "event_ts",
) -> DataFrame:
    """Request documents per window and shard of a watermarked stream, in the shape
    of the batch operator (`window_start` in epoch microseconds).

    Needs the RocksDB state store. Rows past the watermark are dropped.
    """
    window = F.window(event_time, f"{window_seconds} seconds")
    keyed = rows.select(
        event_time,
        F.unix_micros(window.start).alias("window_start"),
        F.unix_micros(window.end).alias("window_end"),
        shard.cast("bigint").alias("shard"),
        payload.alias("payload"),
    )
    return keyed.groupBy("window_start", "window_end", "shard").transformWithStateInPandas(
        statefulProcessor=WindowBatcher(limit),
        outputStructType=_OUTPUT,
        outputMode="append",
        timeMode="EventTime",
    )
