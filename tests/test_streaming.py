"""Streams: late rows, closing windows, equality with batch, whole jobs."""

import json
import os
import time
import uuid

import pytest
from pyspark.sql import functions as F
from test_flows import flow
from test_operators import labelled

from flowsight.operators import fraud
from flowsight.options import FlowOptions, FraudOptions
from flowsight.plans import flow_anomaly, fraud_detection, inputs
from flowsight.schemas import NORMALIZED_CENTROIDS, TRANSACTION
from flowsight.sinks.tables import stream_append
from flowsight.sources.bus import stream_sequence
from flowsight.sources.files import stream_lines
from flowsight.streaming.metrics import CounterListener, counted
from flowsight.streaming.windows import empty_source, run_to_end, write_sentinel

LINE = "line string, event_ts timestamp"


def put(directory, number, seconds, **fields):
    """One file of flow records at the given event seconds, newer than the last."""
    os.makedirs(directory, exist_ok=True)
    path = os.path.join(directory, f"{number:04d}.json")
    with open(path, "w") as out:
        for i, second in enumerate(seconds):
            record = flow(srcPort=1000 + number * 100 + i, **fields)
            stamp = time.strftime("%Y-%m-%d %H:%M:%S", time.gmtime(1_700_000_000 - 1_700_000_000 % 60 + second))
            out.write(json.dumps({"line": json.dumps(record), "event_ts": stamp}) + "\n")
    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


def lines_of(spark, directory):
    return (
        spark.readStream.schema(LINE).option("maxFilesPerTrigger", 1).json(directory)
    )


def run_features(spark, folder, lines, **options):
    features = flow_anomaly.flow_frames(lines, FlowOptions(**options)).features

    def start():
        return [stream_append(features, f"{folder}/out", f"{folder}/check", True).start()]

    run_to_end(start)
    return spark.read.parquet(f"{folder}/out")


@pytest.fixture
def listener(spark):
    one = CounterListener()
    spark.streams.addListener(one)
    yield one
    spark.streams.removeListener(one)


def wait_for(condition):
    for _ in range(100):
        if condition():
            return True
        time.sleep(0.1)
    return False


def test_late_row_is_dropped(spark, folder, listener):
    """The watermark acts from the second micro-batch behind the one that moved it."""
    for number, seconds in enumerate(([10, 20], [130], [135], [15, 200], [330])):
        put(f"{folder}/in", number, seconds)
    rows = run_features(spark, folder, lines_of(spark, f"{folder}/in")).collect()
    counts = sorted((r["transaction_time"], r["number_of_records"]) for r in rows)
    assert [n for _, n in counts] == [2, 2, 1]
    assert wait_for(lambda: listener.dropped_late == 1)
    assert listener.input_rows == 7


def test_lateness_keeps_the_row(spark, folder):
    for number, seconds in enumerate(([10, 20], [130], [135], [15, 200], [700])):
        put(f"{folder}/in", number, seconds)
    rows = run_features(
        spark, folder, lines_of(spark, f"{folder}/in"), allowed_lateness_seconds=300
    ).collect()
    assert sorted(r["number_of_records"] for r in rows) == [1, 2, 3]


def test_every_window_comes_out_once(spark, folder):
    """A restart from the checkpoint neither loses nor repeats windows."""
    for number in range(3):
        put(f"{folder}/in", number, [number * 60 + 5, number * 60 + 30])
    run_features(spark, folder, lines_of(spark, f"{folder}/in"))
    for number in range(3, 6):
        put(f"{folder}/in", number, [number * 60 + 5])
    rows = run_features(spark, folder, lines_of(spark, f"{folder}/in")).collect()
    times = [r["transaction_time"] for r in rows]
    assert len(times) == len(set(times)) == 5
    assert sorted(r["number_of_records"] for r in rows) == [1, 1, 2, 2, 2]


def test_counters(spark, folder, listener):
    put(f"{folder}/in", 0, [1, 2, 3])
    lines = counted(lines_of(spark, f"{folder}/in"), "seen", rows=F.count(F.lit(1)))
    run_to_end(lambda: [stream_append(lines, f"{folder}/out", f"{folder}/check", True).start()])
    assert wait_for(lambda: listener.totals.get("seen.rows") == 3)


def test_text_stream_with_arrival_time(spark, folder):
    os.makedirs(f"{folder}/in")
    with open(f"{folder}/in/a.json", "w") as out:
        out.write(json.dumps(flow()) + "\n{broken\n")
    options = FlowOptions(input_path=f"{folder}/in")
    frames = flow_anomaly.flow_frames(inputs.live_lines(spark, options), options)

    def start():
        return [
            stream_append(frames.flows, f"{folder}/flows", f"{folder}/c1", True).start(),
            stream_append(frames.rejects, f"{folder}/rejects", f"{folder}/c2", True).start(),
        ]

    run_to_end(start)
    assert spark.read.parquet(f"{folder}/flows").count() == 1
    reject = spark.read.parquet(f"{folder}/rejects").first()
    assert reject["status"] == "bad_json" and reject["line"] == "{broken"


def centroid_table(spark):
    rows = [(1, 1.0, *[10.0] * 10), (2, 5.0, *[1000.0] * 10)]
    return spark.createDataFrame(rows, NORMALIZED_CENTROIDS)


def tables(spark, folder, **options):
    tag = uuid.uuid4().hex
    made = FlowOptions(
        features_table=f"features_{tag}", outliers_table=f"outliers_{tag}", raw_table=f"raw_{tag}", **options
    )
    flow_anomaly.create_tables(spark, made, f"{folder}/tables")
    return made


def batch_lines(spark, records):
    rows = [(json.dumps(r), "2024-01-01 00:00:05") for r in records]
    return spark.createDataFrame(rows, "line string, ts string").select(
        "line", F.col("ts").cast("timestamp").alias("event_ts")
    )


RECORDS = [flow(subscriberId=str(i % 5), txBytes=100 * i, srcPort=1000 + i) for i in range(50)]


def test_flow_job_in_batch(spark, folder):
    options = tables(spark, folder)
    flow_anomaly.run_batch(batch_lines(spark, RECORDS), centroid_table(spark), options, load_id="one")
    features, found = spark.table(options.features_table), spark.table(options.outliers_table)
    assert features.count() == 5 and spark.table(options.raw_table).count() == 50
    assert 0 < found.count() <= 5
    flow_anomaly.run_batch(batch_lines(spark, RECORDS), centroid_table(spark), options, load_id="one")
    assert spark.table(options.features_table).count() == 5  # the same load again
    flow_anomaly.run_batch(batch_lines(spark, RECORDS), centroid_table(spark), options)
    assert spark.table(options.features_table).count() == 10  # another run adds its own


def test_flow_job_with_key_and_with_service(spark, folder):
    sealed = tables(spark, folder, token_key=b"0123456789abcdef")
    flow_anomaly.run_batch(batch_lines(spark, RECORDS), centroid_table(spark), sealed)
    tokens = {r["subscriber_id"] for r in spark.table(sealed.features_table).collect()}
    assert len(tokens) == 5 and all(t.startswith("IMSI_TOKEN(") for t in tokens)
    out = {r["subscriber_id"] for r in spark.table(sealed.outliers_table).collect()}
    assert out and out <= tokens

    def open_service():
        return lambda values: [f"token-{v}" for v in values]

    served = tables(spark, folder, open_tokenizer=open_service)
    flow_anomaly.run_batch(batch_lines(spark, RECORDS), centroid_table(spark), served)
    tokens = {r["subscriber_id"] for r in spark.table(served.features_table).collect()}
    assert tokens == {f"token-{i}" for i in range(5)}


def test_flow_job_rereads_centroids(spark, folder):
    put(f"{folder}/in", 0, [1, 2], txBytes=5000)
    put(f"{folder}/in", 1, [3000])
    options, calls, loads = tables(spark, folder), [], []

    def refresh():
        calls.append(1)
        return centroid_table(spark)

    def start():
        return flow_anomaly.start_stream(
            lines_of(spark, f"{folder}/in"), centroid_table(spark), options, f"{folder}/check",
            available_now=True, refresh_centroids=refresh, on_load=lambda i, n: loads.append(n),
        )

    run_to_end(start)
    assert calls
    assert sum(n["features"] for n in loads) == sum(n["outliers"] for n in loads) == 1
    assert spark.table(options.features_table).count() == 1
    assert spark.table(options.outliers_table).count() == 1
    assert spark.table(options.raw_table).count() == 3


def test_flow_job_keeps_rejects(spark, folder):
    tag = uuid.uuid4().hex
    options = tables(spark, folder, rejects_table=f"rejects_{tag}", cluster_query=f"{folder}/q")
    bad = spark.createDataFrame([("{", None), ("[]", None)], LINE)
    flow_anomaly.run_batch(batch_lines(spark, RECORDS).unionByName(bad), centroid_table(spark), options)
    assert spark.table(options.rejects_table).count() == 2
    assert spark.table(options.features_table).count() == 5

    centroid_table(spark).createOrReplaceTempView(f"centroids_{tag}")
    spark.createDataFrame([(f"SELECT * FROM centroids_{tag}",)], "v string").coalesce(1).write.text(f"{folder}/q")
    put(f"{folder}/in", 0, [1, 2])
    with open(f"{folder}/in/0001.json", "w") as out:
        out.write(json.dumps({"line": "{oops", "event_ts": "2023-11-14 00:00:00"}) + "\n")
    live = tables(spark, folder, rejects_table=f"live_rejects_{tag}", cluster_query=f"{folder}/q")
    centroids, ranges = inputs.side_tables(spark, live)
    assert ranges is None

    def start():
        return flow_anomaly.start_stream(
            lines_of(spark, f"{folder}/in"), centroids, live, f"{folder}/check", available_now=True
        )

    run_to_end(start)
    assert [r["line"] for r in spark.table(live.rejects_table).collect()] == ["{oops"]
    assert spark.table(live.raw_table).count() == 2


def fraud_tables(spark, folder, **options):
    tag = uuid.uuid4().hex
    made = FraudOptions(
        transactions_table=f"transactions_{tag}", predictions_table=f"predictions_{tag}",
        probability=0.5, key_range=3, **options,
    )
    fraud_detection.create_tables(spark, made, f"{folder}/tables")
    return made


def test_fraud_job_with_model(spark, folder):
    rows = labelled(spark)
    model = fraud.fit_fraud_model(rows.drop("nameOrig", "nameDest", "isFlaggedFraud"), 3, 0.5)
    lines = rows.select(F.to_json(F.struct(*TRANSACTION.names)).alias("line"))
    options = fraud_tables(spark, folder)
    fraud_detection.run_batch(lines, options, model=model)
    assert spark.table(options.transactions_table).count() == 3000
    found = spark.table(options.predictions_table).select("transactionId")
    hits = fraud.match_transactions(found, rows).where("isFraud = 1").count()
    assert hits > 0.95 * found.count() > 0

    lines.write.text(f"{folder}/in")
    spark.createDataFrame([("{oops",)], "line string").write.mode("append").text(f"{folder}/in")
    live, loads = fraud_tables(spark, folder, rejects_table=f"bad_{uuid.uuid4().hex}"), []

    def start():
        return fraud_detection.start_stream(
            stream_lines(spark, f"{folder}/in", "*.txt"), live, f"{folder}/check", model=model, available_now=True,
            on_load=lambda i, n: loads.append(n),
        )

    run_to_end(start)
    assert spark.table(live.transactions_table).count() == 3000
    assert spark.table(live.predictions_table).count() == found.count()
    assert spark.table(live.rejects_table).count() == 1
    assert sum(n["alerts"] for n in loads) == found.count()


def test_score_needs_a_scorer(spark):
    with pytest.raises(ValueError):
        fraud_detection.score(labelled(spark))


def test_rate_source(spark, folder):
    rows = stream_sequence(spark, 500)
    assert rows.isStreaming and rows.columns == ["id", "event_ts"]


def test_sentinel_is_within_reach_of_pandas(spark, folder):
    schema = spark.createDataFrame([], LINE).schema
    empty_source(spark, schema, f"{folder}/ends")
    assert spark.read.parquet(f"{folder}/ends").count() == 0
    write_sentinel(spark, schema, f"{folder}/ends", line="{}")
    row = spark.read.parquet(f"{folder}/ends").toPandas().iloc[0]
    assert row["line"] == "{}" and row["event_ts"].year == 2200
