"""Merged loads: equal rows, bounded partitions, retries, stops half-way."""

import uuid

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from flowsight.sinks import compaction
from flowsight.sinks import tables as sinks
from flowsight.sources import tables
from flowsight.sources.tables import read_partitions

SCHEMA = "n bigint, name string"


@pytest.fixture
def table(spark, folder):
    name = f"t_{uuid.uuid4().hex}"
    sinks.create_table(spark, name, spark.createDataFrame([], SCHEMA).schema, ["load_id", "dt"], f"{folder}/t")
    yield name
    spark.sql(f"DROP TABLE {name}")


def rows(spark, start, n=10, days=2):
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("n") % days).cast("int"))
    return spark.range(start, start + n).select(F.col("id").alias("n"), F.lit("x").alias("name")).withColumn("dt", day)


def numbers(df):
    return sorted(r["n"] for r in df.select("n").collect())


def test_loads_before_and_after(spark, table):
    assert compaction.compact(spark, table) is None
    for batch in range(3):
        sinks.load(rows(spark, 10 * batch), table, f"run-{batch}")
    assert numbers(compaction.current(spark, table)) == list(range(30))
    assert compaction.compact(spark, table, cluster_by=["n"]) == "merged-1"
    assert numbers(compaction.current(spark, table)) == list(range(30))
    sinks.load(rows(spark, 30), table, "run-3")
    sinks.load(rows(spark, 40, days=3), table, "other")
    sinks.load(rows(spark, 10), table, "run-1")  # merged already: must not be seen again
    assert numbers(compaction.current(spark, table)) == list(range(50))
    assert compaction.compact(spark, table) == "merged-2"
    assert compaction.clean(spark, table) > 8
    assert numbers(compaction.current(spark, table)) == list(range(50))
    assert spark.sql(f"SHOW PARTITIONS {table}").count() == 3  # one for each day
    assert numbers(spark.table(table)) == list(range(50))
    assert compaction.clean(spark, table) == 0 and compaction.compact(spark, table) is None
    sinks.load(rows(spark, 20), table, "run-2")  # a retry after all that
    sinks.load(rows(spark, 40, days=3), table, "other")
    assert numbers(compaction.current(spark, table)) == list(range(50))
    assert compaction.compact(spark, table) is None
    assert numbers(read_partitions(spark, table, "2024-01-02", "2024-01-02")) == [
        r["n"] for r in spark.table(table).where("load_id = 'merged-2' AND dt = '2024-01-02'").orderBy("n").collect()
    ]


def test_two_hundred_loads(spark, table):
    where = compaction.location(spark, table)
    many = rows(spark, 0, 2000, days=1).withColumn("load_id", F.concat(F.lit("run-"), F.col("n") % 200))
    many.repartition("load_id").write.partitionBy("load_id", "dt").mode("append").parquet(where)
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    assert spark.sql(f"SHOW PARTITIONS {table}").count() == 200
    compaction.compact(spark, table, shards=1)
    assert numbers(compaction.current(spark, table)) == list(range(2000))
    compaction.clean(spark, table)
    assert spark.sql(f"SHOW PARTITIONS {table}").count() == 1
    assert len(spark.table(table).inputFiles()) == 1
    assert numbers(compaction.current(spark, table)) == list(range(2000))


def test_stop_before_the_commit(spark, table, monkeypatch):
    sinks.load(rows(spark, 0), table, "run-0")

    def fails(*_):
        raise RuntimeError("gone")

    monkeypatch.setattr(compaction, "_commit", fails)
    with pytest.raises(RuntimeError):
        compaction.compact(spark, table)
    monkeypatch.undo()
    assert numbers(compaction.current(spark, table)) == list(range(10))  # the merged load is not seen
    sinks.load(rows(spark, 10), table, "run-1")
    assert compaction.compact(spark, table) == "merged-1"
    assert numbers(compaction.current(spark, table)) == list(range(20))


def test_second_commit_of_a_version_fails(spark, table):
    sinks.load(rows(spark, 0), table, "run-0")
    compaction.compact(spark, table)
    before = compaction.read_manifest(spark, table)
    with pytest.raises(AnalysisException):
        compaction._commit(spark, table, before)
    assert compaction.read_manifest(spark, table) == before


def test_table_without_days(spark, folder):
    table = f"t_{uuid.uuid4().hex}"
    sinks.create_table(spark, table, spark.createDataFrame([], SCHEMA).schema, ["load_id"], f"{folder}/t")
    for turn in range(2):
        for batch in range(2):
            start = 20 * turn + 10 * batch
            sinks.load(rows(spark, start).drop("dt"), table, f"run-{2 * turn + batch}")
        assert compaction.compact(spark, table) == f"merged-{turn + 1}"
        compaction.clean(spark, table)
        assert numbers(compaction.current(spark, table)) == list(range(20 * turn + 20))
    assert spark.sql(f"SHOW PARTITIONS {table}").count() == 2
    spark.sql(f"DROP TABLE {table}")


def test_names_of_merged_loads_are_kept(spark, table):
    with pytest.raises(ValueError):
        sinks.load(rows(spark, 0), table, "merged-1")
    assert tables.read_partitions(spark, table, "2024-01-01", "2024-01-31").count() == 0


def test_json_by_a_schema_file(spark, folder):
    import json

    from flowsight.sources import files

    listed = [{"name": "a", "type": "INTEGER", "mode": "REQUIRED"}, {"name": "b c", "type": "string"}, {"name": "d", "type": "FLOAT", "mode": "REPEATED"}]
    with open(f"{folder}/schema.json", "w") as out:
        json.dump(listed, out, indent=1)
    schema = files.read_schema(spark, f"{folder}/schema.json")
    assert schema.simpleString() == "struct<a:bigint,b c:string,d:array<double>>"
    table = f"j_{uuid.uuid4().hex}"
    for n in range(2):
        with open(f"{folder}/{n}.json", "w") as out:
            out.write(json.dumps({"a": n, "b c": "x", "d": [1.5]}) + "\n")
        files.load_json(spark, f"{folder}/{n}.json", table, schema, f"{folder}/table")
    assert sorted((r[0], r[1], r[2]) for r in spark.table(table).collect()) == [(0, "x", [1.5]), (1, "x", [1.5])]
    spark.sql(f"DROP TABLE {table}")


def test_categories_are_bounded(spark):
    from flowsight.operators import fraud

    rows = spark.range(50).selectExpr("CAST(id % 7 AS STRING) AS type").unionByName(spark.sql("SELECT CAST(NULL AS STRING) AS type"))
    got = spark.range(1).select(fraud.vocabulary(rows).alias("v")).first()["v"]
    assert got == [str(i) for i in range(7)]
    with pytest.raises(Exception, match="more than 6 values"):
        spark.range(1).select(fraud.vocabulary(rows, most=6).alias("v")).collect()
