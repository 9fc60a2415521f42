"""Versions of the centroids, pinned side inputs, counters of loads, stored sketches."""

import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from test_scoring import centroid_rows, feature_rows

from flowsight.checks import views as V
from flowsight.checks.jobs import flow_options, flow_text
from flowsight.operators import scoring, sketches, versions
from flowsight.operators.features import window_features
from flowsight.plans import flow_anomaly
from flowsight.schemas import NORMALIZED_CENTROIDS, conform
from flowsight.streaming import counters
from flowsight.streaming.pins import is_complete, pinned

SF = "/root/testdata/sf0.001"


def versioned(spark, *starts):
    side = centroid_rows(spark, 3)
    parts = [side.withColumns({"valid_from": F.lit(t).cast("timestamp"), "normalized_dest": F.lit(d)}) for t, d in starts]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def keys(df):
    return sorted((r["subscriber_id"], r["dst_subnet"], r["transaction_time"]) for r in df.collect())


def test_each_window_is_scored_by_its_version(spark):
    rows = feature_rows(spark, 60)
    hour = F.format_string("2024-01-01 %02d:00:00.000000", (F.monotonically_increasing_id() % 24).cast("int"))
    rows = rows.coalesce(1).withColumn("transaction_time", hour)
    table = versioned(spark, ("2024-01-01 06:00:00", 0.0), ("2024-01-01 12:00:00", 1e12), ("2024-01-01 18:00:00", 0.0), ("2024-02-01", 0.0))
    got = keys(versions.find_outliers_by_version(rows, table))
    every = keys(scoring.find_outliers(rows, versioned(spark, ("2024-01-01", 0.0)).drop("valid_from")))
    assert len(every) > 30
    assert got == [k for k in every if "06" <= k[2][11:13] < "12" or k[2][11:13] >= "18"]
    assert versions.find_outliers_by_version(rows.limit(0), table).count() == 0
    late = versioned(spark, ("2030-01-01", 0.0))
    assert versions.find_outliers_by_version(rows, late).count() == 0
    assert len(versions.read_versions(table, 0, 1 << 60)) == 4


def test_pins_keep_what_the_first_try_saw(spark, folder):
    value = [1]

    def read():
        return spark.range(value[0], value[0] + 2)

    first = pinned(spark, folder, "run-0", read).collect()
    value[0] = 7
    assert pinned(spark, folder, "run-0", read).collect() == first
    assert sorted(r[0] for r in pinned(spark, folder, "run-1", read).collect()) == [7, 8]
    spark.range(3).write.parquet(f"{folder}/run-2")
    import os

    os.remove(f"{folder}/run-2/_SUCCESS")  # a try that stopped half-way
    assert sorted(r[0] for r in pinned(spark, folder, "run-2", read).collect()) == [7, 8]
    assert not is_complete(spark, f"{folder}/run-0") and is_complete(spark, f"{folder}/run-1")


def test_counters_of_a_load_that_is_run_again(spark, folder):
    table = f"c_{uuid.uuid4().hex}"
    counters.create_counters(spark, table, f"{folder}/c")
    counters.commit_counters(spark, table, "run-0", {"a": 2, "b": 5})
    counters.commit_counters(spark, table, "run-1", {"a": 3})
    counters.commit_counters(spark, table, "run-0", {"a": 1, "b": 5})
    assert {r["name"]: r["total"] for r in counters.totals(spark, table).collect()} == {"a": 4, "b": 5}
    spark.sql(f"DROP TABLE {table}")


def test_job_with_sketches_counters_and_versions(spark, folder):
    tag = uuid.uuid4().hex
    options = replace(
        flow_options(), raw_table=None, sketches_table=f"s_{tag}", counters_table=f"n_{tag}", sketch_seconds=3600
    )
    plain = replace(flow_options(), raw_table=None)
    side = conform(V.normalized_centroids(spark, SF), NORMALIZED_CENTROIDS)
    lines = flow_text(V.table(spark, SF, "events"))
    for o, where in ((options, "a"), (plain, "b")):
        flow_anomaly.create_tables(spark, o, f"{folder}/{where}")
    flow_anomaly.run_batch(lines, side, plain, load_id="x")
    always = side.withColumn("valid_from", F.lit("1970-01-01").cast("timestamp"))
    for _ in range(2):
        flow_anomaly.run_batch(lines, side, options, load_id="x", versions=always)
    for name in ("features_table", "outliers_table"):
        got, want = (spark.table(getattr(o, name)).drop("load_id") for o in (options, plain))
        assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0
    found = {r["name"]: r["total"] for r in counters.totals(spark, options.counters_table).collect()}
    features = spark.table(options.features_table)
    assert found == {
        "features": features.count(),
        "records": features.agg(F.sum("number_of_records")).first()[0],
        "outliers": spark.table(options.outliers_table).count(),
    }


def test_merged_sketches_equal_the_flows_counted_together(spark):
    flows = V.flow_logs(spark, SF)
    parts = [sketches.sketch_rows(flows.where(F.col("event_id") % 3 == i), 600) for i in range(3)]
    stored = parts[0].unionByName(parts[1]).unionByName(parts[2])
    for seconds in (600, 3600, V.DAY):
        want = window_features(flows, seconds)
        got = sketches.merged_features(stored, seconds, 600)
        assert got.count() == want.count() and got.exceptAll(want).count() == 0
    with pytest.raises(ValueError):
        sketches.merged_features(stored, 900, 600)
    assert sketches.merged_features(stored.limit(0), 600, 600).count() == 0
