"""The runnable jobs: arguments become options, the tables get their rows."""

import uuid

import pytest
from flowsight.__main__ import parser, run
from flowsight.checks import views as V
from flowsight.checks.jobs import flow_text
from flowsight.schemas import NORMALIZED_CENTROIDS, conform

SF = "/root/testdata/sf0.001"


def test_arguments():
    got = parser().parse_args(
        ["flow-batch", "--window_seconds", "300", "--no-restamp", "--token_columns", "a,b", "--token_key", "k"]
    )
    assert got.window_seconds == 300 and got.restamp is False
    assert got.token_columns == ("a", "b") and got.token_key == b"k"
    with pytest.raises(SystemExit):
        parser().parse_args(["flow-stream"])


def test_flow_job_from_the_command_line(spark, folder):
    tag = uuid.uuid4().hex
    conform(V.normalized_centroids(spark, SF), NORMALIZED_CENTROIDS).write.parquet(f"{folder}/side")
    query = f"SELECT * FROM parquet.`{folder}/side`"
    spark.createDataFrame([(query,)], "value string").coalesce(1).write.text(f"{folder}/query")
    flow_text(V.table(spark, SF, "events")).select("line").write.text(f"{folder}/in")
    arguments = [
        "flow-batch", "--input_path", f"{folder}/in", "--input_glob", "*.txt",
        "--cluster_query", f"{folder}/query", "--features_table", f"f_{tag}",
        "--outliers_table", f"o_{tag}", "--feature_rejects_table", f"r_{tag}",
        "--window_seconds", "86400", "--load_id", "first",
    ]
    run(spark, arguments)
    features = spark.table(f"f_{tag}")
    count = features.count()
    assert count > 100 and {r.load_id for r in features.select("load_id").distinct().collect()} == {"first"}
    run(spark, arguments)
    assert spark.table(f"f_{tag}").count() == count
    run(spark, ["compact", "--table", f"f_{tag}", "--clean"])
    assert {r.load_id for r in spark.table(f"f_{tag}").select("load_id").distinct().collect()} == {"merged-1"}
    assert spark.table(f"f_{tag}").count() == count


def test_publish(spark, folder):
    run(spark, ["publish", "--rows", "50", "--output", f"{folder}/out"])
    assert spark.read.text(f"{folder}/out").count() == 50
