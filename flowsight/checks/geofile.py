"""A small binary address database of the test tables' ranges, and queries that read it."""

from __future__ import annotations

import ipaddress
import struct

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from flowsight.checks import views as V
from flowsight.checks.oracles import GEO
from flowsight.checks.queries import Query
from flowsight.functions import netaddr
from flowsight.operators import geo
from flowsight.schemas import GEO_COLUMNS
from flowsight.session import scratch_path
from flowsight.sources import geofile


def _field(value: object) -> bytes:
    """A value as a typed field."""

    def control(kind: int, size: int) -> bytes:
        extra = b""
        if size >= 29:
            width = 1 if size < 285 else 2
            extra = (size - geofile.SIZE_BASE[width - 1]).to_bytes(width, "big")
            size = 28 + width
        return (bytes([kind << 5 | size]) if kind < 8 else bytes([size, kind - 7])) + extra

    if isinstance(value, str):
        return control(geofile.TEXT, len(value.encode())) + value.encode()
    if isinstance(value, bool):
        return control(geofile.BOOL, int(value))
    if isinstance(value, float):
        return control(geofile.DOUBLE, 8) + struct.pack(">d", value)
    if isinstance(value, int):
        raw = value.to_bytes((value.bit_length() + 7) // 8, "big")
        return control(geofile.UINT64, len(raw)) + raw
    if isinstance(value, list):
        return control(geofile.ARRAY, len(value)) + b"".join(map(_field, value))
    return control(geofile.MAP, len(value)) + b"".join(_field(k) + _field(v) for k, v in value.items())


def database(ranges: list[tuple[int, int, dict]], version: int = 4, bits: int = 24, aliases: list[int] = ()) -> bytes:
    """A file of these (first, last, record) ranges. `aliases` are prefixes of 32 bits that lead to the IPv4 tree."""
    depth = 128 if version == 6 else 32
    nodes: list[list] = [[None, None]]
    section, places = b"", {}

    def walk(first: int, length: int) -> tuple[list, int]:
        node = nodes[0]
        for k in range(length - 1):
            bit = first >> depth - 1 - k & 1
            if not isinstance(node[bit], int):
                nodes.append([None, None])
                node[bit] = len(nodes) - 1
            node = nodes[node[bit]]
        return node, first >> depth - length & 1

    for first, last, record in ranges:
        text = repr(record)
        if text not in places:
            places[text] = len(section)
            section += _field(record)
        kind = ipaddress.IPv6Address if version == 6 else ipaddress.IPv4Address
        for net in ipaddress.summarize_address_range(kind(first), kind(last)):
            node, bit = walk(int(net.network_address), net.prefixlen)
            node[bit] = ("data", places[text])
    for prefix in aliases:
        top, bit = walk(0, 96)
        node, side = walk(prefix << 96, 32)
        node[side] = top[bit]

    def record_of(target) -> int:
        if target is None:
            return len(nodes)
        return target if isinstance(target, int) else len(nodes) + geofile.GAP + target[1]

    trie = b""
    for left, right in ((record_of(a), record_of(b)) for a, b in nodes):
        if bits == 28:
            trie += (left & 0xFFFFFF).to_bytes(3, "big") + bytes([left >> 24 << 4 | right >> 24])
            trie += (right & 0xFFFFFF).to_bytes(3, "big")
        else:
            trie += left.to_bytes(bits // 8, "big") + right.to_bytes(bits // 8, "big")
    about = {"node_count": len(nodes), "record_size": bits, "ip_version": version, "description": {"en": "check " * 60}}
    return trie + bytes(geofile.GAP) + section + geofile.MARKER + _field(about)


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """A file in the shared store."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(content))
    out.close()


def _database_path(spark, sf, version: int, shift: int) -> str:
    rows = V.geo_ranges(spark, sf).collect()  # one row for each nation
    ranges = []
    for r in rows:
        place = {"latitude": r["latitude"], "longitude": r["longitude"]}
        record = {"country": {"names": {"en": r["geoCountry"]}}, "city": {"names": {"en": r["geoCity"]}}, "location": place}
        ranges.append((r["start_ip"] << shift, (r["end_ip"] + 1 << shift) - 1, record))
    path = f"{scratch_path(spark, 'geo')}/places.db"
    write_bytes(spark, path, database(ranges, version, 28 if version == 6 else 24))
    return path


def geo_enrich_from_file(spark, sf):
    """Flows beside the ranges of a binary file."""
    ranges = geofile.read_geo_ranges(spark, _database_path(spark, sf, 4, 0))
    return geo.geo_enrich(V.flow_logs(spark, sf).select("event_id", "srcIP"), ranges)


def geo_enrich_wide(spark, sf):
    """The same flows with addresses of 128 bits, whose upper half is the address of 32."""
    ranges = geofile.read_key_ranges(spark, _database_path(spark, sf, 6, 96))
    number = F.lpad(F.hex(netaddr.ip_to_long(F.col("srcIP"))), 8, "0")
    rows = V.flow_logs(spark, sf).select("event_id", "srcIP", number.alias("number"))
    text = F.concat_ws(":", F.substring("number", 1, 4), F.substring("number", 5, 4), F.lit(":1"))
    rows = rows.select("event_id", "srcIP", netaddr.ip_key(text).alias("key"))
    return geo.enrich_by_key(rows, ranges, "key").select("event_id", "srcIP", *GEO_COLUMNS)


GEO_QUERIES: dict[str, Query] = {f.__name__: f for f in (geo_enrich_from_file, geo_enrich_wide)}
GEO_ORACLES: dict[str, str] = {name: GEO for name in GEO_QUERIES}
