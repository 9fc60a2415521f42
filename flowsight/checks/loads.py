"""Tables of loads: merged, appended, refused; and the same in SQL."""

from __future__ import annotations

import json
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsight.checks import views as V
from flowsight.checks.jobs import payment_options, payment_text, release
from flowsight.checks.oracles import DAY_FEATURES, TRANSACTIONS
from flowsight.checks.queries import Query, new_table, open_rule_scorer, rounded
from flowsight.operators import sketches
from flowsight.plans import fraud_detection
from flowsight.schemas import FEATURES, SKETCHES, VECTOR_COLUMNS
from flowsight.session import scratch_path, written
from flowsight.sinks import compaction
from flowsight.sinks import tables as sinks
from flowsight.sources import files

LOADS = 5


def _loads(spark, sf) -> tuple[str, list[DataFrame]]:
    """A table of loads, and the day features dealt to some loads."""
    rows = written(sinks.with_date(V.features(spark, sf)), "rows")
    table, _ = new_table(spark, FEATURES, [sinks.LOAD_COLUMN, sinks.DATE_COLUMN])
    part = F.pmod(F.xxhash64("subscriber_id", "transaction_time"), F.lit(LOADS))
    return table, [rows.where(part == i) for i in range(LOADS)]


def compacted_loads(spark, sf):
    """Loads before and after a compaction, and a retry of one that is merged: every row once."""
    table, parts = _loads(spark, sf)
    for i, rows in enumerate(parts):
        sinks.load(rows, table, f"run-{i}")
        if i == LOADS - 2:
            compaction.compact(spark, table, cluster_by=["dst_subnet", "subscriber_id"])
    sinks.load(parts[1], table, "run-1")
    found = written(compaction.current(spark, table).select(*FEATURES.fieldNames()), "current")
    spark.sql(f"DROP TABLE {table}")
    return found


def compacted_partitions(spark, sf):
    """Rows and partitions of each day when all loads are merged and cleaned up."""
    table, parts = _loads(spark, sf)
    for i, rows in enumerate(parts[:3]):
        sinks.load(rows, table, f"run-{i}")
    compaction.compact(spark, table)
    for i, rows in enumerate(parts[3:]):
        sinks.load(rows, table, f"run-{i + 3}")
    compaction.compact(spark, table)
    compaction.clean(spark, table)
    counts = spark.table(table).groupBy(F.col("dt").cast("string").alias("dt")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("load_id").alias("partitions")
    )
    found = written(counts, "counts")
    spark.sql(f"DROP TABLE {table}")
    return found


def features_from_sketches(spark, sf):
    """Day features merged from the minute sketches that two loads have stored."""
    table, _ = new_table(spark, SKETCHES, [sinks.LOAD_COLUMN, sinks.DATE_COLUMN])
    flows, half = V.flow_logs(spark, sf), F.col("event_id") % 2
    for i in range(2):
        rows = sketches.sketch_rows(flows.where(half == i))
        sinks.load(sinks.with_date(rows, "window_start"), table, f"run-{i}")
    found = written(sketches.merged_features(compaction.current(spark, table), V.DAY), "merged")
    spark.sql(f"DROP TABLE {table}")
    return found


def default_method_appends(spark, sf):
    """Two runs of the payment job by the default method: the rows of both stay."""
    folder, options = scratch_path(spark, "default"), replace(payment_options(), write_method="default")
    fraud_detection.create_tables(spark, options, folder)
    orders = V.table(spark, sf, "orders")
    for i in range(2):
        lines = payment_text(orders.where(F.col("o_orderkey") % 2 == i))
        fraud_detection.run_batch(lines, options, open_scorer=open_rule_scorer)
    return release(spark, folder, options, "transactions")[0].select("transactionId", "type", "amount")


def centroids_json_into_table(spark, sf):
    """Two loads of newline JSON into a table, by a file with its schema."""
    folder = scratch_path(spark, "json")
    side = V.normalized_centroids(spark, sf)
    types = {"int": "INTEGER", "double": "FLOAT"}
    listed = json.dumps([{"name": n, "type": types[t], "mode": "NULLABLE"} for n, t in side.dtypes])
    spark.createDataFrame([(listed,)], "value string").coalesce(1).write.text(f"{folder}/schema")
    table, path = new_table(spark, files.read_schema(spark, f"{folder}/schema"))
    for i in range(2):
        side.where(F.col("centroid_id") % 2 == i).write.json(f"{folder}/{i}")
        files.load_json(spark, f"{folder}/{i}", table, files.read_schema(spark, f"{folder}/schema"))
    schema = spark.table(table).schema
    spark.sql(f"DROP TABLE {table}")
    found = spark.read.schema(schema).parquet(path)
    return rounded(found.withColumn("centroid_id", F.col("centroid_id").cast("int")), 5, "normalized_dest")


LOAD_QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        compacted_loads,
        compacted_partitions,
        features_from_sketches,
        default_method_appends,
        centroids_json_into_table,
    )
}

LOAD_ORACLES: dict[str, str] = {
    "compacted_loads": DAY_FEATURES,
    "features_from_sketches": DAY_FEATURES,
    "default_method_appends": f"SELECT transactionId, type, amount FROM ({TRANSACTIONS})",
    "centroids_json_into_table": f"WITH {V.normalized_sql()} SELECT centroid_id, round(normalized_dest, 5) AS normalized_dest, "
    f"{', '.join(VECTOR_COLUMNS)} FROM normalized",
    "compacted_partitions": "SELECT substr(transaction_time, 1, 10) AS dt, count(*) AS n, CAST(1 AS BIGINT) AS partitions "
    f"FROM ({DAY_FEATURES}) GROUP BY 1",
}
