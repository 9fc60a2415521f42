"""What the operators of this package share: written tables, Arrow maps, worker state."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

WHITE = " \t\n\x0b\x0c\r"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """`df` written to the shared folder and read again: computed once, safe when executors go."""
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(docs: DataFrame) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(docs["text"].cast("string"), F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def arrow_map(
    df: DataFrame,
    work: Callable[[pa.RecordBatch], Iterable[dict]] | Callable,
    schema: str,
    keeps: str = "",
) -> DataFrame:
    """Runs `work` on each Arrow batch; it gives the columns of a batch or several of them.

    `keeps` is the key of what the tasks keep in their process.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema), prefers_large_types=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_process(keeps)
        for batch in batches:
            for columns in work(batch):
                yield pa.RecordBatch.from_arrays(
                    [
                        columns[f.name]
                        if isinstance(columns[f.name], pa.Array)
                        else pa.array(columns[f.name], f.type)
                        for f in arrow
                    ],
                    schema=arrow,
                )

    return df.mapInArrow(run, schema)


def _process_store() -> dict:
    name = "flowsight_process_store"
    module = sys.modules.setdefault(name, types.ModuleType(name))
    return module.__dict__.setdefault("values", {})


def per_process(key: str, make: Callable):
    """The value of `make()`, made once in each Python worker and kept between its tasks."""
    store = _process_store()
    if key not in store:
        store[key] = make()
    return store[key]


def release_process(keep: str = "") -> None:
    """Frees what earlier tasks of other kinds have kept in this Python worker."""
    store = _process_store()
    gone = [key for key in store if key != keep]
    for key in gone:
        del store[key]
    if gone:
        gc.collect()
        if hasattr(trim := ctypes.CDLL(None), "malloc_trim"):
            trim.malloc_trim(0)


GROUP_CHARS = 1 << 20


def text_groups(texts: list[str], limit: int = GROUP_CHARS) -> Iterator[list[str]]:
    """The texts in order, in groups of about `limit` characters; a longer text stands alone."""
    group, size = [], 0
    for text in texts:
        if group and size + len(text) > limit:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


def text_blocks(text: str, limit: int = GROUP_CHARS, keep: Iterable[str] = ()) -> Iterator[str]:
    """A long text in blocks that begin at a blank between two letters, digits or marks.

    Nothing that splits words at white space can reach over such a place. Strings of `keep`
    that hold white space would be cut, so a text that has one stays whole.
    """
    if any(k in text for k in keep if len(k.split()) != 1):
        yield text
        return
    start = 0
    while len(text) - start > limit:
        at = start + limit
        while (at := text.find(" ", at)) > 0:
            if not text[at - 1].isspace() and at + 1 < len(text) and not text[at + 1].isspace():
                break
            at += 1
        if at <= 0:
            break
        yield text[start:at]
        start = at
    yield text[start:]


def arrow_fold(df: DataFrame, start: Callable, add: Callable, finish: Callable, schema: str) -> DataFrame:
    """One state a partition: `start()`, `add(state, batch)` for each batch, `finish(state)` as columns."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema), prefers_large_types=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_process()
        state = start()
        for batch in batches:
            add(state, batch)
        for columns in finish(state):
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], f.type) for f in arrow], schema=arrow
            )

    return df.mapInArrow(run, schema)


def held_out(docs: DataFrame, folds: int, fold: int) -> Column:
    """Whether crc32 of the doc_id's text falls into the fold kept from learning; so do null ids."""
    fallen = F.pmod(F.crc32(docs["doc_id"].cast("string").cast("binary")), F.lit(folds)) == fold
    return F.coalesce(fallen, F.lit(True))
