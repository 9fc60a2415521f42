"""Greedy packing of rows into size-bounded batches.

The rule is sequential: a row that would take the open batch over the limit closes
it and opens the next. Groups are (window, shard); rows of a group arrive sorted
and are streamed through Arrow record batches, so a task holds one record batch and
at most one open batch, never a group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

# Text around the joined instances of a request.
REQUEST_HEAD = '{"signature_name":"predict","instances": [\n'
REQUEST_TAIL = "\n]}"

_WINDOW, _SHARD, _SIZE = "_window", "_shard", "_size"


class Packer:
    """Batch numbers for successive slices of sorted rows."""

    def __init__(self, limit: int) -> None:
        self.limit = limit
        self.group: tuple[int, int] | None = None
        self.batch = 0
        self.filled = 0

    def number(
        self, windows: np.ndarray, shards: np.ndarray, sizes: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """(batch number per row, whether the row opens a batch)."""
        n = len(sizes)
        numbers = np.zeros(n, dtype=np.int64)
        opens = np.zeros(n, dtype=bool)
        changed = np.empty(n, dtype=bool)
        changed[0] = self.group != (windows[0], shards[0])
        changed[1:] = (windows[1:] != windows[:-1]) | (shards[1:] != shards[:-1])
        edges = np.flatnonzero(changed)
        if not len(edges) or edges[0] != 0:
            edges = np.concatenate(([0], edges))
        for start, end in zip(edges, np.append(edges[1:], n)):
            if changed[start]:
                self.batch, self.filled = 0, 0
                opens[start] = True
            total = np.cumsum(sizes[start:end])
            i, m = 0, end - start
            while i < m:
                before = total[i - 1] if i else 0
                room = self.limit - self.filled
                j = int(np.searchsorted(total, before + room, side="right"))
                if j <= i and self.filled > 0:
                    self.batch, self.filled = self.batch + 1, 0
                    opens[start + i] = True
                    continue
                j = max(j, i + 1)  # a row over the limit is a batch of one
                numbers[start + i : start + j] = self.batch
                self.filled += int(total[j - 1] - before)
                i = j
        self.group = (windows[-1], shards[-1])
        return numbers, opens

    def number_batch(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in (_WINDOW, _SHARD, _SIZE)]
        return self.number(*columns)


def _sorted_groups(
    df: DataFrame, size: Column, shard: Column, order: list[str], window: Column | None
) -> DataFrame:
    start = F.unix_micros(window) if window is not None else F.lit(0).cast("bigint")
    keyed = df.withColumns(
        {
            _WINDOW: F.coalesce(start, F.lit(-1).cast("bigint")),
            _SHARD: shard.cast("bigint"),
            _SIZE: F.coalesce(size, F.lit(0)).cast("bigint"),
        }
    )
    return keyed.repartition(_WINDOW, _SHARD).sortWithinPartitions(
        _WINDOW, _SHARD, *order
    )


def pack_rows(
    df: DataFrame,
    size: Column,
    shard: Column,
    order: list[str],
    limit: int,
    window: Column | None = None,
) -> DataFrame:
    """Adds `shard` and `batch_id`, the number of the batch inside its group.

    `size` is the bytes a row counts for, `shard` spreads a window over tasks and
    `order` fixes the order inside a shard. `window` is the start of the event-time
    window, a timestamp.
    """
    grouped = _sorted_groups(df, size, shard, order, window)
    names = [f.name for f in grouped.schema if f.name not in (_WINDOW, _SHARD, _SIZE)]
    schema = StructType(
        [grouped.schema[n] for n in names]
        + [StructField("shard", LongType()), StructField("batch_id", LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(limit)
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers, _ = packer.number_batch(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names]
                + [batch.column(_SHARD), pa.array(numbers)],
                names=names + ["shard", "batch_id"],
            )

    return grouped.mapInArrow(run, schema)


def _closed_batches(
    batches: Iterator[pa.RecordBatch], names: list[str], limit: int
) -> Iterator[tuple[tuple[int, int, int], int, pa.Table]]:
    """((window, shard, batch number), bytes, rows) of every batch as it closes."""
    packer = Packer(limit)
    held: list[pa.RecordBatch] = []
    label, size = (0, 0, 0), 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        numbers, opens = packer.number_batch(batch)
        sizes = batch.column(_SIZE).to_numpy()
        rows = batch.select(names)
        position = 0
        for cut in [*np.flatnonzero(opens).tolist(), n]:
            if cut > position:
                if not held:
                    label = (
                        batch.column(_WINDOW)[position].as_py(),
                        batch.column(_SHARD)[position].as_py(),
                        int(numbers[position]),
                    )
                held.append(rows.slice(position, cut - position))
                size += int(sizes[position:cut].sum())
            if cut < n and held:
                yield label, size, pa.Table.from_batches(held)
                held, size = [], 0
            position = cut
    if held:
        yield label, size, pa.Table.from_batches(held)


def apply_to_batches(
    df: DataFrame,
    column: str,
    open_function: Callable[[], Callable[[list[str]], list[str]]],
    size: Column,
    shard: Column,
    order: list[str],
    limit: int,
    window: Column | None = None,
) -> DataFrame:
    """Replace a text column batch by batch, through a function on lists of values.

    For services that take many values per call: `open_function` makes one client
    per partition, which is then called once per size-bounded batch.
    """
    grouped = _sorted_groups(df, size, shard, order, window)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = open_function()
        for _, _, rows in _closed_batches(batches, names, limit):
            answers = function(rows.column(column).to_pylist())
            if len(answers) != rows.num_rows:
                raise ValueError(f"{len(answers)} answers for {rows.num_rows} values")
            position = names.index(column)
            replaced = rows.set_column(position, column, pa.array(answers, pa.string()))
            yield from replaced.combine_chunks().to_batches()

    return grouped.mapInArrow(run, df.schema)


_REQUEST_SCHEMA = StructType(
    [
        StructField("window_start", LongType()),
        StructField("shard", LongType()),
        StructField("batch_id", LongType()),
        StructField("n_rows", LongType()),
        StructField("n_bytes", LongType()),
        StructField("request", StringType()),
    ]
)

# Requests handed back to Spark at a time.
_REQUESTS_PER_SLICE = 64
_SLICE_CHARS = 1 << 20


def _payload_groups(
    df: DataFrame, payload: str, shard: Column, order: list[str], window: Column | None
) -> DataFrame:
    grouped = _sorted_groups(df, F.octet_length(payload), shard, order, window)
    return grouped.select(_WINDOW, _SHARD, _SIZE, payload)


def _request_rows(batches: Iterator[pa.RecordBatch], payload: str, limit: int) -> Iterator[tuple]:
    """The columns of a request document, one document at a time."""
    for label, size, rows in _closed_batches(batches, [payload], limit):
        yield (*label, rows.num_rows, size, request_text(rows.column(0).to_pylist()))


def pack_requests(
    df: DataFrame,
    payload: str,
    shard: Column,
    order: list[str],
    limit: int,
    window: Column | None = None,
) -> DataFrame:
    """One request document per batch of `payload` texts, sized by UTF-8 bytes.

    The documents are put together in the packing pass itself; `window_start` is
    in epoch microseconds (0 without a window).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for done in slices(_request_rows(batches, payload, limit), lambda row: len(row[-1])):
            yield _request_slice(done)

    return _payload_groups(df, payload, shard, order, window).mapInArrow(run, _REQUEST_SCHEMA)


def answer_requests(
    df: DataFrame,
    payload: str,
    open_function: Callable[[], Callable[[str], str]],
    shard: Column,
    order: list[str],
    limit: int,
    window: Column | None = None,
) -> DataFrame:
    """`response`: the answers to the documents of `pack_requests`, each given as the document closes.

    `open_function` makes one client per partition. A worker holds one document and a few answers,
    and no document travels: sent on to a pass of its own, thousands of them would come at once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = open_function()
        answers = (function(row[-1]) for row in _request_rows(batches, payload, limit))
        for done in slices(answers, lambda answer: len(answer or "")):
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], names=["response"])

    return _payload_groups(df, payload, shard, order, window).mapInArrow(run, "response string")


def slices(items: Iterator, size: Callable[[object], int]) -> Iterator[list]:
    """The items in lists that end at `_REQUESTS_PER_SLICE` items or `_SLICE_CHARS` in size."""
    done: list = []
    held = 0
    for item in items:
        done.append(item)
        held += size(item)
        if len(done) == _REQUESTS_PER_SLICE or held >= _SLICE_CHARS:
            yield done
            done, held = [], 0
    if done:
        yield done


def _request_slice(done: list[tuple]) -> pa.RecordBatch:
    *numbers, texts = zip(*done)
    arrays = [pa.array(n, pa.int64()) for n in numbers] + [pa.array(texts, pa.string())]
    return pa.RecordBatch.from_arrays(arrays, names=_REQUEST_SCHEMA.names)


def request_text(instances: list[str]) -> str:
    return REQUEST_HEAD + ",".join(instances) + REQUEST_TAIL


def request_column(instances: Column) -> Column:
    """The same document from an array column."""
    return F.concat(
        F.lit(REQUEST_HEAD), F.array_join(instances, ","), F.lit(REQUEST_TAIL)
    )
