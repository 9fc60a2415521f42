"""Session construction and the shared scratch folder."""

from __future__ import annotations

import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def build_session(
    app_name: str = "flowsight",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with UTC time, AQE and a state store that spills to disk."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # long texts: a batch in a Python worker ends at this size, however few its rows
        "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    }
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder `spark.checkpoint.dir` names, else one below the warehouse.

    On a cluster the warehouse has to be shared for that; a warning says so.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
        if not spark.sparkContext.master.startswith("local"):
            warnings.warn(f"spark.checkpoint.dir is not set: scratch data goes to {root}, which all executors must share")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new path below the shared folder, unique per call."""
    return f"{scratch_root(spark)}/flowsight/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """`df` written to the shared folder and read again: computed once, and safe when executors go."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
