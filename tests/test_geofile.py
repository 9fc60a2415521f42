"""Binary address databases: decoding, ranges, and the join by 16-byte keys."""

import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from flowsight.checks.geofile import database, write_bytes
from flowsight.functions.netaddr import ip_key
from flowsight.operators.geo import enrich_by_key
from flowsight.sources.geofile import Fields, file_ranges, metadata, read_geo_ranges, read_key_ranges

NET = 0x2001_0DB8 << 96


def record(name, latitude=1.5):
    return {"country": {"names": {"en": name}}, "city": {"names": {"de": "x", "en": name.lower()}}, "location": {"latitude": latitude, "longitude": -2.0}}


@pytest.mark.parametrize("bits", [24, 28, 32])
@pytest.mark.parametrize("version", [4, 6])
def test_ranges_come_back(bits, version):
    pick = random.Random(bits)
    ranges, at = [], 5
    for i in range(60):
        first = at + pick.randint(1, 9000)
        at = first + pick.choice([0, 1, 255, 4999, 70000])
        ranges.append((first, at, record(f"Place{i}")))
    got = list(file_ranges(database(ranges, version, bits)))
    assert got == [(a, b, True, (r["country"]["names"]["en"], r["city"]["names"]["en"], 1.5, -2.0)) for a, b, r in ranges]


def test_wide_addresses_and_aliases():
    ranges = [(1 << 24, (1 << 24) + 255, record("V4")), (NET, NET + (1 << 64) - 1, record("V6")), (NET + (1 << 64), NET + (1 << 65) - 1, {"city": 7})]
    got = list(file_ranges(database(ranges, 6, 28, aliases=[0x20020000, 0x12345678])))
    assert got == [
        (1 << 24, (1 << 24) + 255, True, ("V4", "v4", 1.5, -2.0)),
        (NET, NET + (1 << 64) - 1, False, ("V6", "v6", 1.5, -2.0)),
        (NET + (1 << 64), NET + (1 << 65) - 1, False, (None, None, None, None)),
    ]


def test_fields():
    at = lambda raw: Fields(raw).at(0)[0]
    assert at(b"\x42hi") == "hi" and at(b"\x5d\x00" + b"x" * 29) == "x" * 29
    assert at(b"\xa2\x01\x02") == 258 and at(b"\xc0") == 0 and at(b"\x04\x01\xff\xff\xff\xfe") == -2
    assert at(b"\x02\x03" + b"\x01\x00") == 256 and at(b"\x01\x07") is True and at(b"\x00\x07") is False
    assert at(b"\x04\x08\x3f\x80\x00\x00") == 1.0 and at(b"\x91z") == b"z" or at(b"\x81z") == b"z"
    assert at(b"\x02\x04\x41a\x20\x02") == ["a", "a"]  # a pointer to the first item
    assert at(b"\xe1\x41k\x41v") == {"k": "v"}
    with pytest.raises(ValueError):
        metadata(b"no database")


def test_tables_and_join(spark, folder):
    wide = [(NET + (i << 70), NET + (i << 70) + (1 << 69) - 1, record(f"N{i}")) for i in range(40)]
    ranges = [(1000, 1999, record("A")), (2000, 2004, record("B"))] + wide
    write_bytes(spark, f"{folder}/geo.db", database(ranges, 6, 24))
    four = read_geo_ranges(spark, f"{folder}/geo.db").orderBy("start_ip").collect()
    assert [(r["start_ip"], r["end_ip"], r["geoCity"]) for r in four] == [(1000, 1999, "a"), (2000, 2004, "b")]
    keys = read_key_ranges(spark, f"{folder}/geo.db")
    assert keys.count() == 42
    pick = random.Random(1)
    asked = [0, 999, 1000, 1999, 2000, 2005, 1 << 127, (1 << 128) - 1] + [a for a, _, _ in wide] + [b for _, b, _ in wide] + [b + 1 for _, b, _ in wide]
    asked += [NET + pick.getrandbits(76) for _ in range(200)] + [1500] * 300
    rows = [(i, str(ipaddress.IPv6Address(a)) if a >> 32 else str(ipaddress.IPv4Address(a))) for i, a in enumerate(asked)]
    rows += [(-1, "nothing"), (-2, None)]
    df = spark.createDataFrame(rows, "n int, ip string").withColumn("key", ip_key(F.col("ip"))).repartition(5)
    got = {r["n"]: r["geoCountry"] for r in enrich_by_key(df, keys, "key").collect()}
    want = {i: next((r["country"]["names"]["en"] for a, b, r in ranges if a <= x <= b), None) for i, x in enumerate(asked)}
    assert got == {**want, -1: None, -2: None}
    assert enrich_by_key(df, keys.limit(0), "key").where("geoCountry IS NOT NULL").count() == 0


def test_keys(spark):
    good = ["::", "::1", "1::", "2001:db8::8:800:200c:417a", "1:2:3:4:5:6:7:8", "FFFF:ffff:0:0:0:0:0:1", "12.0.1.2", "a::b:c"]
    bad = ["", ":", ":::", "1:2:3", "1::2::3", "12345::", "g::", "1:2:3:4:5:6:7:8:9", "1:2:3:4:5:6:7:", ":1:2:3:4:5:6:7", "1.2.3", None]
    df = spark.createDataFrame([(x,) for x in good + bad], "ip string").withColumn("key", ip_key(F.col("ip")))
    got = {r["ip"]: r["key"] for r in df.collect()}
    for x in good:
        a = ipaddress.ip_address(x)
        assert bytes(got[x]) == int(a).to_bytes(16, "big"), x
    assert [x for x in bad if got[x] is not None] == []


def test_an_address_is_taken_apart_once(spark):
    """A key of a computed address names the computation once, and each step of its own once."""
    rows = spark.createDataFrame([("2001:DB8::1",)], "ip string").withColumn("key", ip_key(F.upper("ip")))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("upper(") == 1
    assert plan.count("split(") < 20
    assert bytes(rows.first()["key"]) == int(ipaddress.ip_address("2001:db8::1")).to_bytes(16, "big")
