"""Geography, sampling, privacy, generators, sources, sinks and the fraud model."""

import dataclasses
import json
import re
import uuid

import pytest
from pyspark.sql import functions as F

from flowsight.functions import privacy
from flowsight.functions.netaddr import long_to_ip
from flowsight.operators import fraud, generate, geo, sampling
from flowsight.options import FlowOptions, GeneratorOptions
from flowsight.plans import inputs, publisher, training
from flowsight.schemas import FEATURES, FLOW_LOG, GEO_RANGES, NORMALIZED_CENTROIDS, TRANSACTION
from flowsight.sinks import tables as sinks
from flowsight.sources import bus, files, tables


# ---- geography ----

RANGES = [
    (0, 255, "A"),
    (300, 300, "B"),
    (500, 5000, "C"),
    (5001, 5002, "D"),
    (1 << 24, (1 << 25) - 1, "E"),  # a whole /7 half
    ((1 << 32) - 5, (1 << 32) - 1, "F"),
]


def ranges(spark):
    rows = [(a, b, n, n.lower(), 1.0, 2.0) for a, b, n in RANGES]
    return spark.createDataFrame(rows, GEO_RANGES)


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle", "auto"])
def test_geo_equals_scan(spark, strategy):
    points = [0, 255, 256, 299, 300, 301, 499, 500, 2500, 5000, 5001, 5002, 5003,
              1 << 24, (1 << 25) - 1, 1 << 25, (1 << 32) - 6, (1 << 32) - 1]
    flows = spark.createDataFrame([(p,) for p in points], "n bigint").withColumn("srcIP", long_to_ip(F.col("n")))
    got = {r["n"]: r["geoCountry"] for r in geo.geo_enrich(flows, ranges(spark), strategy=strategy).collect()}
    want = {p: next((n for a, b, n in RANGES if a <= p <= b), None) for p in points}
    assert got == want


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_geo_keeps_hot_and_bad_addresses(spark, strategy):
    flows = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "0.0.0.7").when(F.col("id") % 3 == 1, "x").otherwise("9.9.9.9").alias("srcIP")
    )
    counts = geo.geo_enrich(flows, ranges(spark), strategy=strategy).groupBy("geoCountry").count().collect()
    assert {r[0]: r[1] for r in counts} == {"A": 1000, None: 2000}


def test_geo_chooses_by_size(spark):
    bucketed = geo.bucket_ranges(ranges(spark))
    assert geo.fits_broadcast(bucketed)
    assert not geo.fits_broadcast(bucketed, limit=10)


def test_broadcast_geo_moves_no_flows(spark):
    flows = spark.createDataFrame([("0.0.0.1",)], "srcIP string")
    plan = geo.geo_enrich(flows, ranges(spark), strategy="broadcast")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "NestedLoop" not in plan


# ---- sampling ----


def order_of(spark, n, seed):
    return [r["id"] for r in sampling.shuffle_rows(spark.range(n), "id", seed).collect()]


@pytest.mark.parametrize("n, rows", [(1000, 0), (1000, 1), (1000, 137), (1000, 1000), (1000, 5000), (0, 3)])
def test_cut_by_rows(spark, n, rows):
    got = {r["id"] for r in sampling.take_seeded(spark.range(n), "id", 4, rows=rows).collect()}
    assert got == set(order_of(spark, n, 4)[:rows])


@pytest.mark.parametrize("n, fraction", [(1000, 0.8), (999, 0.8), (7, 0.5), (1000, 0.005), (0, 0.5), (10, 1.0)])
def test_split_is_positional(spark, n, fraction):
    train, test = sampling.split_seeded(spark.range(n), "id", fraction, 9)
    order = order_of(spark, n, 9)
    size = int(n * fraction)
    assert {r["id"] for r in train.collect()} == set(order[:size])
    assert {r["id"] for r in test.collect()} == set(order[size:])


def test_cut_inside_one_hash_bucket(spark, monkeypatch):
    monkeypatch.setattr(sampling, "_BUCKET_SHIFT", 31)  # two buckets: the sort does the work
    got = {r["id"] for r in sampling.take_seeded(spark.range(500), "id", 1, rows=123).collect()}
    assert got == set(order_of(spark, 500, 1)[:123])


def test_downsample_keeps_all_rare_rows(spark):
    rows = spark.range(2000).withColumn("isFraud", (F.col("id") % 100 == 0).cast("int"))
    got = sampling.downsample(rows, F.col("isFraud") == 1, "id", 0.1)
    counts = {r[0]: r[1] for r in got.groupBy("isFraud").count().collect()}
    assert counts == {1: 20, 0: 198}


def test_shuffle_depends_on_the_seed(spark):
    a, b = order_of(spark, 200, 1), order_of(spark, 200, 2)
    assert a != b and sorted(a) == sorted(b) and a != sorted(a)


# ---- privacy ----

KEY = b"fedcba9876543210"


def test_tokens(spark):
    values = ["", "1", "310150123456789", "ünïcode ☃", "a" * 1000, None, "1"]
    rows = spark.createDataFrame([(v,) for v in values], "v string")
    got = rows.select(
        "v",
        privacy.tokenize(F.col("v"), KEY).alias("t"),
        privacy.tokenize(F.col("v"), b"0000000000000000").alias("other"),
    ).withColumn("back", privacy.detokenize(F.col("t"), KEY)).collect()
    assert all(r["back"] == r["v"] for r in got)
    assert len({r["t"] for r in got}) == len(set(values))
    assert all(r["t"] is None or re.match(r"IMSI_TOKEN\(\d+\):", r["t"]) for r in got)
    assert all(r["t"] != r["other"] for r in got if r["t"])


def test_without_key_nothing_changes(spark):
    rows = spark.createDataFrame([("1",)], "v string")
    assert privacy.tokenize_columns(rows, ["v"], None) is rows


def test_inspection(spark):
    texts = {
        "310150123456789 and 31015012345678": (2, 0, 0),
        "3101501234567890 x310150123456789 310150123456789x": (0, 0, 0),
        "a.b@c.org, x@y": (0, 1, 0),
        "at 10.0.0.1, v1.2.3.4 or 1.2.3.4.5": (0, 0, 2),
        "é310150123456789é": (1, 0, 0),
    }
    rows = spark.createDataFrame([(t,) for t in [*texts, None]], "text string")
    got = {r["text"]: tuple(r)[1:] for r in privacy.inspect_columns(rows, ["text"]).collect()}
    assert got == {**texts, None: (0, 0, 0)}


# ---- generators ----


def test_records_depend_on_seed_and_id_only(spark):
    a = generate.generate_flow_logs(spark.range(0, 500, 1, 1), seed=3).collect()
    b = generate.generate_flow_logs(spark.range(0, 500, 1, 9), seed=3).collect()
    c = generate.generate_flow_logs(spark.range(500), seed=4).collect()
    assert sorted(a) == sorted(b) and sorted(a) != sorted(c)


def test_flow_domains(spark):
    rows = generate.generate_flow_logs(spark.range(3000))
    assert rows.schema.names == FLOW_LOG.names
    assert [f.dataType for f in rows.schema] == [f.dataType for f in FLOW_LOG]
    for r in rows.collect():
        assert 0 <= int(r["subscriberId"]) <= 99_999
        assert 1000 <= r["srcPort"] <= 5000 and 10 <= r["txBytes"] <= 1000
        assert r["dstIP"].startswith("12.0.") and 0 <= r["endTime"] - r["startTime"] < 60
        assert 0 <= r["tcpFlag"] <= 65 and r["protocolName"] in ("tcp", "udp", "http")
    high = generate.generate_flow_logs(spark.range(50), bytes_range=(150_000, 15_000_000))
    assert high.where("txBytes < 150000").count() == 0


def test_transaction_domains(spark):
    rows = generate.generate_transactions(spark.range(2000))
    assert sorted(rows.columns) == sorted(TRANSACTION.names)
    got = rows.collect()
    for r in got:
        uuid.UUID(r["transactionId"])
        assert 111 <= r["step"] <= 555 and 1.0 <= r["amount"] <= 999_999.0
        assert round(r["amount"], 2) == r["amount"]
    assert len({r["transactionId"] for r in got}) == 2000
    assert {r["type"] for r in got} == {"CASH_IN", "CASH_OUT", "TRANSFER", "PAYMENT"}


def test_publisher(spark, folder):
    options = GeneratorOptions(event_type="fraud", record="transaction")
    row = publisher.bounded(spark, 5, options).first()
    assert set(json.loads(row["value"])) == set(TRANSACTION.names)
    assert row["headers"][0]["key"] == "event_type" and bytes(row["headers"][0]["value"]) == b"fraud"
    from flowsight.sinks.bus import publish_files

    query = publish_files(
        publisher.endless(spark, GeneratorOptions(rows_per_second=200)), f"{folder}/out", f"{folder}/c"
    ).start()
    try:
        for _ in range(60):
            if query.lastProgress and sum(p.numInputRows for p in query.recentProgress) > 0:
                break
            query.awaitTermination(0.5)
        query.processAllAvailable()
    finally:
        query.stop()
    lines = bus.from_messages(
        spark.read.json(f"{folder}/out").withColumn("timestamp", F.current_timestamp())
    )
    assert lines.columns == ["line", "event_ts"] and lines.count() > 0


# ---- sources ----


def test_file_sources(spark, folder):
    spark.createDataFrame([("a",), ("b",)], "v string").coalesce(1).write.text(f"{folder}/in")
    assert sorted(r["line"] for r in files.read_lines(spark, f"{folder}/in/*.txt").collect()) == ["a", "b"]
    options = FlowOptions(input_path=f"{folder}/in", input_glob="*.txt")
    assert inputs.batch_lines(spark, options).columns == ["line"]
    on_arrival = dataclasses.replace(options, arrival_time=True)
    assert inputs.batch_lines(spark, on_arrival).columns == ["line", "event_ts"]
    live = inputs.live_lines(spark, on_arrival)
    assert live.isStreaming and live.columns == ["line", "event_ts"]
    assert inputs.load_interval(options) == 30
    assert inputs.load_interval(FlowOptions(write_method="file_loads")) == 60
    with pytest.raises(ValueError):
        inputs.live_lines(spark, FlowOptions())


def test_stored_query(spark, folder):
    columns = ", ".join(f"'{i}' AS {f.name}" for i, f in enumerate(NORMALIZED_CENTROIDS))
    spark.createDataFrame([(f"SELECT {columns};",)], "v string").coalesce(1).write.text(f"{folder}/q")
    got = tables.read_centroids(spark, f"{folder}/q")
    assert got.schema == NORMALIZED_CENTROIDS
    assert got.first()["centroid_id"] == 0


# ---- sinks ----


def feature_rows(spark, ids, day="2024-01-02"):
    numbers = [f"cast({i} as {f.dataType.simpleString()}) AS {f.name}" for i, f in enumerate(FEATURES) if i > 2]
    keys = ["cast(id as string) AS subscriber_id", "'n' AS dst_subnet", f"'{day} 00:00:00.000000' AS transaction_time"]
    return sinks.with_date(ids.selectExpr(*keys, *numbers))


def new_table(spark, folder, schema=FEATURES, partition_by=("load_id", "dt")):
    name = f"t_{uuid.uuid4().hex}"
    sinks.create_table(spark, name, schema, list(partition_by), f"{folder}/{name}")
    return name


def test_load_again_replaces_only_itself(spark, folder):
    table = new_table(spark, folder)
    sinks.load(feature_rows(spark, spark.range(10)), table, 0)
    sinks.load(feature_rows(spark, spark.range(10, 25), "2024-01-03"), table, 1, shards=2, cluster_by=["subscriber_id"])
    sinks.load(feature_rows(spark, spark.range(10)), table, 0)
    sinks.load(feature_rows(spark, spark.range(10, 20), "2024-01-04"), table, 1)
    assert spark.table(table).count() == 20
    days = {str(r[0]): r[1] for r in spark.table(table).groupBy("dt").count().collect()}
    assert days == {"2024-01-02": 10, "2024-01-04": 10}
    pruned = tables.read_partitions(spark, table, "2024-01-03", "2024-01-05")
    assert pruned.count() == 10
    assert "PartitionFilters: [isnotnull(dt" in pruned._jdf.queryExecution().executedPlan().toString()


def test_sinks_create_no_table(spark, folder):
    rows = feature_rows(spark, spark.range(1))
    with pytest.raises(ValueError, match="does not exist"):
        sinks.append(rows, "no_such_table")
    table = new_table(spark, folder)
    with pytest.raises(ValueError, match="does not fit"):
        sinks.load(rows.withColumn("max_tx_bytes", F.lit("x")), table, 0)


def test_append(spark, folder):
    table = new_table(spark, folder, TRANSACTION, ())
    rows = generate.generate_transactions(spark.range(10)).select(*reversed(TRANSACTION.names))
    sinks.append(rows, table)
    sinks.append(rows, table, shards=3)
    assert spark.table(table).count() == 20
    assert spark.table(table).where("step between 111 and 555").count() == 20


def test_required_columns(spark, folder):
    rows = feature_rows(spark, spark.range(10)).withColumn(
        "subscriber_id", F.when(F.col("subscriber_id") != "3", F.col("subscriber_id"))
    )
    required = ["transaction_time", "subscriber_id"]
    table, rejects = new_table(spark, folder), new_table(spark, folder)
    sinks.load_checked(rows, table, 0, required, rejects)
    assert (spark.table(table).count(), spark.table(rejects).count()) == (9, 1)
    with pytest.raises(Exception, match="null in a required column"):
        sinks.load_checked(rows, new_table(spark, folder), 0, required)
    alone = new_table(spark, folder)
    sinks.load_checked(rows.where("subscriber_id is not null"), alone, 0, required)
    assert spark.table(alone).count() == 9


# ---- fraud model ----


def labelled(spark):
    rows = generate.generate_transactions(spark.range(3000))
    return rows.withColumn("isFraud", (F.col("amount") > 700_000).cast("int"))


def test_fraud_training(spark, folder):
    result = training.train_fraud(labelled(spark), sample_fraction=0.3, iterations=5, step_size=0.3)
    scores = result.test_scores
    assert "nameOrig" not in scores.columns
    assert {r["isFraud"] for r in scores.select("isFraud").distinct().collect()} == {0, 1}
    assert fraud.area_under_curve(scores) > 0.95
    assert fraud.evaluate(scores).first()["accuracy"] > 0.95
    fraud.save_model(result.model, f"{folder}/model")
    again = fraud.load_model(f"{folder}/model")
    rows = fraud.model_input(labelled(spark))
    unseen = rows.limit(5).withColumn("type", F.lit("NEW"))
    assert fraud.predict(again, unseen).count() == 5
    predictions = fraud.prediction_rows(fraud.predict(again, rows))
    row = predictions.first()
    assert json.loads(row["json_response"])["transactionId"] == [row["transactionId"]]


def test_known_examples(spark, folder):
    fraud.write_examples(labelled(spark), f"{folder}/examples", 10)
    written = spark.read.json(f"{folder}/examples")
    assert written.count() == 10 and "isFraud" not in written.columns


def test_keys(spark):
    rows = spark.range(100)
    random = fraud.with_random_key(rows)
    assert random.select("transactionId").distinct().count() == 100
    fixed = fraud.with_random_key(rows, ["id"]).collect()
    assert fixed == fraud.with_random_key(rows, ["id"]).collect()


def test_one_hot_of_unseen_value(spark):
    train = spark.createDataFrame([("b",), ("a",), ("a",)], "type string")
    rows = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "type string")
    got = {r["type"]: r["type_onehot"] for r in fraud.one_hot(rows, train).collect()}
    assert got == {"a": [1, 0], "b": [0, 1], "z": [0, 0], None: [0, 0]}
