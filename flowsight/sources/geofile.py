"""Binary address databases: a trie over address bits whose leaves point at typed records.

The format is the public one of version 2 of such files: node pairs of 24, 28 or 32 bits, a data section of typed
fields with pointers, and a metadata map behind a marker. The trie is walked level by level in numpy, all
nodes of a level together; records are decoded once each. A file is one task's work (Spark reads files up to
2 GB so), what comes out is a table of ranges that the joins of `operators.geo` spread.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsight.schemas import GEO_COLUMNS, GEO_RANGES

# The marker before the metadata, the gap behind the trie, type numbers of fields.
MARKER = b"\xab\xcd\xefMaxMind.com"
GAP = 16
POINTER, TEXT, DOUBLE, BYTES, UINT16, UINT32, MAP, INT32, UINT64, UINT128, ARRAY, END, BOOL, FLOAT = (
    1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 13, 14, 15,
)
POINTER_BASE = (0, 2048, 526336, 0)
SIZE_BASE = (29, 285, 65821)
# Where a record keeps what the geography columns show.
COUNTRY, CITY = ("country", "names", "en"), ("city", "names", "en")
LATITUDE, LONGITUDE = ("location", "latitude"), ("location", "longitude")

KEY_RANGES = f"start_key binary, end_key binary, {', '.join(f'{f.name} {f.dataType.simpleString()}' for f in GEO_RANGES.fields[-4:])}"


class Fields:
    """Decodes typed fields of a section; pointers count from its start."""

    def __init__(self, section: bytes):
        self.data = section

    def at(self, place: int) -> tuple[object, int]:
        """(value, place behind it)."""
        control = self.data[place]
        kind, place = control >> 5, place + 1
        if kind == POINTER:
            width = (control >> 3 & 3) + 1
            high = (control & 7) << 8 * width if width < 4 else 0
            target = high + int.from_bytes(self.data[place : place + width], "big") + POINTER_BASE[width - 1]
            return self.at(target)[0], place + width
        if kind == 0:
            kind, place = 7 + self.data[place], place + 1
        size = control & 31
        if size >= 29:
            width = size - 28
            size = SIZE_BASE[width - 1] + int.from_bytes(self.data[place : place + width], "big")
            place += width
        if kind == MAP:
            found = {}
            for _ in range(size):
                key, place = self.at(place)
                found[key], place = self.at(place)
            return found, place
        if kind == ARRAY:
            items = []
            for _ in range(size):
                item, place = self.at(place)
                items.append(item)
            return items, place
        if kind == BOOL:
            return bool(size), place
        return self._scalar(kind, self.data[place : place + size]), place + size

    @staticmethod
    def _scalar(kind: int, raw: bytes) -> object:
        if kind == TEXT:
            return raw.decode("utf-8")
        if kind == DOUBLE:
            return struct.unpack(">d", raw)[0]
        if kind == FLOAT:
            return struct.unpack(">f", raw)[0]
        if kind == INT32:
            return int.from_bytes(raw, "big", signed=len(raw) == 4)
        if kind in (UINT16, UINT32, UINT64, UINT128):
            return int.from_bytes(raw, "big")
        if kind == BYTES:
            return raw
        raise ValueError(f"no field of type {kind}")


def metadata(content: bytes) -> dict:
    """The file's description of itself."""
    at = content.rfind(MARKER)
    if at < 0:
        raise ValueError("no address database: the marker of its metadata is missing")
    return Fields(content[at + len(MARKER) :]).at(0)[0]


def node_records(content: bytes, nodes: int, bits: int) -> np.ndarray:
    """(nodes, 2): where the 0 and the 1 branch of every node lead."""
    raw = np.frombuffer(content, np.uint8, nodes * bits // 4).reshape(nodes, bits // 4).astype(np.int64)
    if bits == 28:
        middle = raw[:, 3]
        left = (middle >> 4) << 24 | raw[:, 0] << 16 | raw[:, 1] << 8 | raw[:, 2]
        right = (middle & 15) << 24 | raw[:, 4] << 16 | raw[:, 5] << 8 | raw[:, 6]
    elif bits in (24, 32):
        powers = 256 ** np.arange(bits // 8 - 1, -1, -1)
        left, right = raw[:, : bits // 8] @ powers, raw[:, bits // 8 :] @ powers
    else:
        raise ValueError(f"no record size of {bits} bits")
    return np.stack([left, right], axis=1)


def leaves(records: np.ndarray, depth: int) -> tuple[list[int], list[int], list[int]]:
    """(first address, length of the prefix, record) of all leaves with data, by address.

    Addresses of 32 bits in a trie of 128 stand below 96 zeros; other branches that lead to the same nodes are left out.
    """
    count = len(records)
    node, high, low = np.zeros(1, np.int64), np.zeros(1, np.uint64), np.zeros(1, np.uint64)
    found: list[tuple[np.ndarray, np.ndarray, int, np.ndarray]] = []
    short = -1  # the root of the 32-bit addresses
    if depth == 128:
        short = 0
        for _ in range(96):
            short = records[short, 0] if short < count else short
    for level in range(depth):
        branch = np.repeat(np.arange(2), len(node))
        target = records[np.tile(node, 2), branch]
        shift = depth - 1 - level
        one = branch.astype(np.uint64)
        high, low = np.tile(high, 2), np.tile(low, 2)
        if shift >= 64:
            high = high | one << np.uint64(shift - 64)
        else:
            low = low | one << np.uint64(shift)
        leaf = target > count
        if depth == 128 and short > 0:
            alias = (target == short) & ((high != 0) | (low != 0))
            leaf &= ~alias
        else:
            alias = np.zeros(len(target), bool)
        found.append((high[leaf], low[leaf], level + 1, target[leaf] - count - GAP))
        inner = (target < count) & ~alias
        node, high, low = target[inner], high[inner], low[inner]
        if not len(node):
            break
    rows = [
        ((int(h) << 64) + int(w), length, int(t))
        for highs, lows, length, targets in found
        for h, w, t in zip(highs, lows, targets)
    ]
    rows.sort()
    return tuple(map(list, zip(*rows))) if rows else ([], [], [])


def _field(record: object, path: tuple[str, ...], kind: type) -> object:
    for name in path:
        record = record.get(name) if isinstance(record, dict) else None
    if kind is float and isinstance(record, (int, float)):
        return float(record)
    return record if isinstance(record, kind) else None


def file_ranges(content: bytes) -> Iterator[tuple[int, int, bool, tuple]]:
    """(first address, last address, whether of 32 bits, geography), neighbours of one record joined."""
    about = metadata(content)
    nodes, bits = about["node_count"], about["record_size"]
    depth = 128 if about["ip_version"] == 6 else 32
    start = nodes * bits // 4 + GAP
    fields = Fields(content[start : content.rfind(MARKER)])
    known: dict[int, tuple] = {}
    open_: list | None = None
    for first, length, target in zip(*leaves(node_records(content, nodes, bits), depth)):
        if target not in known:
            record = fields.at(target)[0]
            known[target] = (
                _field(record, COUNTRY, str), _field(record, CITY, str),
                _field(record, LATITUDE, float), _field(record, LONGITUDE, float),
            )
        last, narrow = first + (1 << depth - length) - 1, depth == 32 or first >> 32 == 0 and length >= 96
        if open_ and open_[1] + 1 == first and open_[2] == narrow and open_[3] == known[target]:
            open_[1] = last
            continue
        if open_:
            yield tuple(open_)
        open_ = [first, last, narrow, known[target]]
    if open_:
        yield tuple(open_)


def read_key_ranges(spark: SparkSession, path: str) -> DataFrame:
    """`start_key, end_key` (16 bytes, 32-bit addresses below 12 zero bytes) and the geography of the files at `path`."""
    names = [f.name for f in GEO_RANGES.fields[-4:]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0).to_pylist():
                rows = list(file_ranges(content))
                for at in range(0, len(rows), 1 << 16):
                    part = rows[at : at + (1 << 16)]
                    columns = [pa.array([r[i].to_bytes(16, "big") for r in part], pa.binary()) for i in (0, 1)]
                    texts = [pa.array([r[3][i] for r in part], pa.string() if i < 2 else pa.float64()) for i in range(4)]
                    yield pa.RecordBatch.from_arrays([*columns, *texts], names=["start_key", "end_key", *names])

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, KEY_RANGES)


def read_geo_ranges(spark: SparkSession, path: str) -> DataFrame:
    """The 32-bit addresses of the files at `path` in the shape of the geography side table."""
    rows = read_key_ranges(spark, path).where(F.substring("end_key", 1, 12) == F.lit(bytes(12)))
    number = lambda key: F.conv(F.hex(F.substring(key, 13, 4)), 16, 10).cast("bigint")
    return rows.select(number("start_key").alias("start_ip"), number("end_key").alias("end_ip"), *GEO_COLUMNS)
