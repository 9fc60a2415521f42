"""Greedy packing against a plain loop."""

import json

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowsight.operators import batching, fraud
from flowsight.operators.batching import _closed_batches, Packer


def plain(rows, limit):
    """(window, shard, size) rows in order -> batch number per row."""
    out, group, batch, filled = [], None, 0, 0
    for window, shard, size in rows:
        if (window, shard) != group:
            group, batch, filled = (window, shard), 0, 0
        elif filled > 0 and filled + size > limit:
            batch, filled = batch + 1, 0
        filled += size
        out.append(batch)
    return out


ROWS = st.lists(
    st.tuples(st.integers(0, 2), st.integers(0, 2), st.integers(0, 30)), max_size=60
).map(lambda rows: sorted(rows, key=lambda r: r[:2]))


@settings(max_examples=300, deadline=None)
@given(ROWS, st.integers(1, 40), st.integers(1, 7))
def test_numbers_equal_plain_loop(rows, limit, slice_size):
    packer, got = Packer(limit), []
    for i in range(0, len(rows), slice_size):
        columns = [np.array(c, dtype=np.int64) for c in zip(*rows[i : i + slice_size])]
        got += packer.number(*columns)[0].tolist()
    assert got == plain(rows, limit)


@settings(max_examples=300, deadline=None)
@given(ROWS, st.integers(1, 40), st.integers(1, 7))
def test_closed_batches(rows, limit, slice_size):
    batches = []
    for i in range(0, len(rows), slice_size):
        part = rows[i : i + slice_size]
        window, shard, size = (list(c) for c in zip(*part))
        names = ["_window", "_shard", "_size", "row"]
        values = [window, shard, size, list(range(i, i + len(part)))]
        batches.append(pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in values], names))
    kept = []
    for (window, shard, _), total, table in _closed_batches(iter(batches), ["row"], limit):
        ids = table.column("row").to_pylist()
        sizes = [rows[i][2] for i in ids]
        assert {rows[i][:2] for i in ids} == {(window, shard)}
        assert total == sum(sizes)
        # over the limit only when the rest of the batch counts nothing
        assert total <= limit or total == sizes[np.flatnonzero(sizes)[0]]
        kept += ids
    assert kept == list(range(len(rows)))


def test_exactly_the_limit_fits():
    numbers, _ = Packer(10).number(np.zeros(4, int), np.zeros(4, int), np.array([4, 6, 1, 10]))
    assert numbers.tolist() == [0, 0, 1, 2]


def test_oversized_row_is_a_batch_of_one():
    numbers, _ = Packer(10).number(np.zeros(3, int), np.zeros(3, int), np.array([50, 5, 60]))
    assert numbers.tolist() == [0, 1, 2]


def test_requests_with_a_hot_window(spark):
    """A third of all rows in one window; several Arrow slices per group."""
    rows = spark.range(9000).select(
        F.col("id"),
        F.concat(F.lit('{"é":'), F.col("id").cast("string"), F.lit("}")).alias("text"),
        F.when(F.col("id") % 3 == 0, F.lit("2024-01-01"))
        .otherwise(F.concat(F.lit("2024-02-"), F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0")))
        .cast("timestamp")
        .alias("start"),
    )
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)
    try:
        documents = batching.pack_requests(
            rows, "text", F.pmod("id", F.lit(2)), ["id"], 1000, F.col("start")
        ).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    seen = []
    for d in documents:
        body = json.loads(d["request"])
        assert body["signature_name"] == "predict"
        assert len(body["instances"]) == d["n_rows"]
        assert d["n_bytes"] <= 1000
        seen += [i["é"] for i in body["instances"]]
    assert sorted(seen) == list(range(9000))
    numbers = {}
    for d in documents:
        numbers.setdefault((d["window_start"], d["shard"]), []).append(d["batch_id"])
    assert all(sorted(b) == list(range(len(b))) for b in numbers.values())


def test_request_text_is_the_column_form(spark):
    texts = ['{"a":1}', '{"b":2}']
    row = spark.createDataFrame([(texts,)], "t array<string>").select(
        batching.request_column(F.col("t"))
    ).first()
    assert row[0] == batching.request_text(texts)
    assert json.loads(row[0])["instances"] == [{"a": 1}, {"b": 2}]


def test_service_gets_whole_batches(spark):
    rows = spark.range(100).select(F.col("id").cast("string").alias("v"), (F.col("id") % 7).alias("k"))

    def open_service():
        return lambda values: [f"{v}/{len(values)}" for v in values]

    got = batching.apply_to_batches(
        rows, "v", open_service, F.lit(10), F.lit(0), ["k", "v"], limit=30
    ).collect()
    assert len(got) == 100
    assert sorted(int(r["v"].split("/")[0]) for r in got) == list(range(100))
    assert sorted({int(r["v"].split("/")[1]) for r in got}) == [1, 3]


def test_parse_predictions_keeps_the_element(spark):
    response = '{"predictions":[{"logistic":[0.25],"transactionId":["T1"],"classes":["0","1"]}]}'
    rows = spark.createDataFrame([(response,)], "response string")
    row = fraud.parse_predictions(rows).first()
    assert (row["transactionId"], row["logistic"]) == ("T1", 0.25)
    assert json.loads(row["json_response"])["classes"] == ["0", "1"]


def test_alert_bound_is_inclusive(spark):
    rows = spark.createDataFrame([("a", 0.99), ("b", 0.9899), ("c", None)], "t string, logistic double")
    assert [r["t"] for r in fraud.alerts(rows).collect()] == ["a"]


def test_documents_are_answered_where_they_are_packed(spark):
    """Scoring is one pass in Python: documents that travelled to a second would meet there by the thousand."""
    from flowsight.options import FraudOptions
    from flowsight.plans import fraud_detection
    from flowsight.schemas import MODEL_INPUT

    def open_scorer():
        def answer(request):
            rows = json.loads(request)["instances"]
            found = [{"logistic": [len(rows) / 100], "transactionId": [r["transactionId"]]} for r in rows]
            return json.dumps({"predictions": found})

        return answer

    given = {"transactionId": "concat('T', id)", "event_ts": "timestamp_seconds(id div 500)"}
    names = [f"CAST({given.get(f.name, 'id')} AS {f.dataType.simpleString()}) AS {f.name}" for f in MODEL_INPUT]
    rows = spark.range(2000).selectExpr(*names, f"{given['event_ts']} AS event_ts").repartition(3)
    options = FraudOptions(batch_bytes=2000, key_range=3, window_seconds=1, probability=0.0)
    scored = fraud_detection.score(rows, options, open_scorer=open_scorer)
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") + plan.count("MapInPandas") == 1
    documents = fraud.requests(rows, 2000, 3, 1)
    plain_scored = fraud.parse_predictions(fraud.score_requests(documents, open_scorer))
    assert sorted(map(tuple, scored.collect())) == sorted(map(tuple, plain_scored.collect()))
    assert scored.count() == 2000 and documents.count() > 100


def test_slices_end_by_number_and_by_size():
    assert [len(s) for s in batching.slices(iter([1] * 130), lambda x: x)] == [64, 64, 2]
    assert [len(s) for s in batching.slices(iter([1 << 19] * 5), lambda x: x)] == [2, 2, 1]
    assert list(batching.slices(iter([]), lambda x: x)) == []
