"""Golden rows, parsing, addresses and features."""

import ipaddress
import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from flowsight.functions import netaddr, scalars
from flowsight.operators import parse
from flowsight.operators.features import window_features
from flowsight.options import FlowOptions
from flowsight.plans.flow_anomaly import flow_frames


def flow(**fields):
    record = {
        "subscriberId": "100",
        "srcIP": "12.0.9.4",
        "dstIP": "12.0.1.2",
        "srcPort": 5000,
        "dstPort": 3000,
        "txBytes": 10,
        "rxBytes": 40,
        "startTime": 1570276550,
        "endTime": 1570276559,
        "tcpFlag": 0,
        "protocolName": "tcp",
        "protocolNumber": 0,
    }
    return {**record, **fields}


def lines(spark, records, second=10):
    at = datetime(2019, 10, 5, 12, 0, second, tzinfo=timezone.utc)
    rows = [(r if isinstance(r, str) or r is None else json.dumps(r), at) for r in records]
    return spark.createDataFrame(rows, "line string, event_ts timestamp")


def one(spark, records, **options):
    rows = flow_frames(lines(spark, records), FlowOptions(**options)).features.collect()
    assert len(rows) == 1
    return rows[0].asDict()


# golden rows: inputs and outputs are fixed values
def test_two_flows_of_one_source(spark):
    got = one(
        spark,
        [
            flow(txBytes=15),
            flow(startTime=1570276650, endTime=1570276750),
        ],
    )
    assert got["subscriber_id"] == "100"
    assert got["dst_subnet"] == "12.0.1.2/22"
    assert (got["number_of_unique_ips"], got["number_of_unique_ports"]) == (1, 1)
    assert got["number_of_records"] == 2
    assert (got["max_tx_bytes"], got["min_tx_bytes"], got["avg_tx_bytes"]) == (15, 10, 12.5)
    assert (got["max_rx_bytes"], got["min_rx_bytes"], got["avg_rx_bytes"]) == (40, 40, 40.0)
    assert (got["max_duration"], got["min_duration"], got["avg_duration"]) == (100, 9, 54.5)
    assert got["transaction_time"] == "2019-10-05 12:01:00.000000"


@pytest.mark.parametrize("distinct", ["exact", "sketch"])
def test_two_sources(spark, distinct):
    second = flow(srcIP="13.0.9.4", srcPort=5001, txBytes=15, startTime=1570276650, endTime=1570276750)
    got = one(spark, [flow(), second], distinct=distinct)
    assert (got["number_of_unique_ips"], got["number_of_unique_ports"]) == (2, 2)
    assert (got["avg_tx_bytes"], got["max_tx_bytes"], got["min_tx_bytes"]) == (12.5, 15, 10)


def test_zero_duration(spark):
    got = one(spark, [flow(endTime=1570276550), flow(endTime=1570276550, txBytes=15)])
    assert (got["number_of_unique_ips"], got["number_of_records"]) == (1, 2)
    assert got["max_duration"] == 0


def test_transaction_record(spark):
    record = {
        "step": 113, "type": "CASH_OUT", "amount": 388075.78, "nameOrig": "C994950684",
        "oldbalanceOrg": 80040.78, "newbalanceOrig": 989710.84, "nameDest": "C1662241365",
        "oldbalanceDest": 633178.75, "newbalanceDest": 206923.02, "isFraud": 0,
        "isFlaggedFraud": 0, "transactionId": "a0249a23-0bc0-4a97-9afa-3c50853db9d2",
    }
    parsed = parse.parse_transaction_lines(lines(spark, [record, "{oops"]))
    rows = parse.valid_rows(parsed).drop("event_ts").collect()
    assert [r.asDict() for r in rows] == [record]
    assert parse.rejected_rows(parsed).count() == 1


def test_line_status(spark):
    cases = {
        json.dumps(flow()): "ok",
        "": "bad_json",
        "12": "bad_json",
        "null": "bad_json",
        '{"srcIP":': "bad_json",
        json.dumps(flow()) + " x": "bad_json",
        "[" + json.dumps(flow()) + "]": "bad_json",
        json.dumps(flow(srcPort="many")): "bad_json",
        json.dumps({"srcIP": "1.2.3.4"}): "missing_ip",
        "{}": "missing_ip",
        json.dumps(flow(srcIP="1.2.3.256")): "bad_ip",
        json.dumps(flow(dstIP="1.2.3")): "bad_ip",
        json.dumps(flow(dstIP="01.2.3.4")): "bad_ip",
        json.dumps(flow(dstIP="1.2.3.4\n")): "bad_ip",
    }
    parsed = parse.parse_flow_lines(lines(spark, list(cases)))
    got = {r["line"]: r["status"] for r in parsed.collect()}
    assert got == cases
    null_line = parse.parse_flow_lines(lines(spark, [None]))
    assert [r["status"] for r in null_line.collect()] == ["bad_json"]


def test_valid_and_rejected_add_up(spark):
    parsed = parse.parse_flow_lines(lines(spark, [json.dumps(flow()), "{", json.dumps(flow(srcIP="x"))]))
    rejects = parse.rejected_rows(parsed)
    assert parse.valid_rows(parsed).count() + rejects.count() == 3
    errors = {r["error"].split(" {")[0] for r in rejects.collect()}
    assert errors == {"Not a valid JSON record", "Not a valid IP address"}


def test_line_is_parsed_once(spark):
    plan = parse.valid_rows(parse.parse_flow_lines(lines(spark, ["{}"])))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json(") == 1


def test_addresses(spark):
    texts = ["0.0.0.0", "255.255.255.255", "12.0.1.2", "192.168.77.200"]
    rows = spark.createDataFrame([(t,) for t in texts], "ip string").select(
        "ip",
        netaddr.ip_to_long(F.col("ip")).alias("n"),
        netaddr.network_cidr(F.col("ip")).alias("net"),
        netaddr.network_cidr(F.col("ip"), 8).alias("net8"),
    ).collect()
    for r in rows:
        assert r["n"] == int(ipaddress.ip_address(r["ip"]))
        assert r["net"] == str(ipaddress.ip_network(f"{r['ip']}/22", strict=False))
        assert r["net8"] == str(ipaddress.ip_network(f"{r['ip']}/8", strict=False))


def test_network_form_is_idempotent(spark):
    first = netaddr.network_cidr(F.col("ip"))
    again = netaddr.network_cidr(F.split(first, "/")[0])
    rows = spark.createDataFrame([("12.0.1.2",), ("1.2.255.4",)], "ip string").select(first, again)
    assert all(a == b for a, b in rows.collect())


def test_bad_address_has_no_number(spark):
    rows = spark.createDataFrame([("1.2.3",), ("1.2.3.400",), ("a.b.c.d",), (None,)], "ip string")
    assert {r[0] for r in rows.select(netaddr.ip_to_long(F.col("ip"))).collect()} == {None}


def test_duration_beyond_int_is_null(spark):
    rows = spark.sql("SELECT 0L AS a, 9000000000L AS b, 5L AS c")
    got = rows.select(
        scalars.duration_ms(F.col("a"), F.col("b")), scalars.duration_ms(F.col("c"), F.col("a"))
    ).first()
    assert tuple(got) == (None, 5)


def test_restamp(spark):
    frames = flow_frames(lines(spark, [flow()] * 50), FlowOptions(restamp=True))
    rows = frames.flows.collect()
    assert all(r["startTime"] > 1_600_000_000_000 for r in rows)
    assert all(0 <= r["endTime"] - r["startTime"] < 60 for r in rows)


def test_hot_subscriber(spark):
    """A third of the rows in one group, with many distinct addresses."""
    ids = spark.range(30_000)
    hot = F.col("id") % 3 == 0
    flows = ids.select(
        F.when(hot, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("subscriberId"),
        netaddr.long_to_ip(F.col("id")).alias("srcIP"),
        F.lit("12.0.1.2").alias("dstIP"),
        (F.col("id") % 4000).cast("int").alias("srcPort"),
        F.lit(1).alias("txBytes"),
        F.lit(1).alias("rxBytes"),
        F.lit(0).cast("bigint").alias("startTime"),
        F.lit(5).cast("bigint").alias("endTime"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("event_ts"),
    )
    for options in ({}, {"distinct": "sketch"}, {"distinct": "sketch", "sketch_salts": 8}):
        row = window_features(flows, **options).where("subscriber_id = 'hot'").first()
        assert row["number_of_records"] == 10_000
        assert row["number_of_unique_ips"] == 10_000
        assert row["number_of_unique_ports"] == 4_000
        assert row["avg_duration"] == 5.0
