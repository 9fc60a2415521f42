"""Registered queries, one or more per operator, over the whole test tables."""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsight.checks import views as V
from flowsight.functions import netaddr, privacy, scalars, vectors
from flowsight.operators import (
    batching,
    clustering,
    features,
    fraud,
    generate,
    geo,
    parse,
    sampling,
    scoring,
)
from flowsight.schemas import (
    FEATURES,
    FLOW_LOG,
    NORMALIZED_CENTROIDS,
    TRANSACTION,
    VECTOR_COLUMNS,
)
from flowsight.session import scratch_path, written
from flowsight.sinks import tables as sinks
from flowsight.sources import files, tables

Query = Callable[[SparkSession, str], DataFrame]

KEYS = ["subscriber_id", "dst_subnet", "transaction_time"]
FLOW_COLUMNS = ["event_id", *FLOW_LOG.fieldNames()]
TOKEN_KEY = b"0123456789abcdef"
# request batching of the checks: shards, bytes, and a window of thirty days
SHARDS, REQUEST_BYTES, REQUEST_WINDOW = 8, 2000, 30 * V.DAY


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# ---- features ----


def flow_features(spark, sf):
    return V.features(spark, sf)


def flow_features_minute(spark, sf):
    return features.window_features(V.flow_logs(spark, sf))


def flow_features_network_subnet(spark, sf):
    return features.window_features(V.flow_logs(spark, sf), V.DAY, subnet_form="network")


def flow_features_sketch(spark, sf):
    return features.window_features(V.flow_logs(spark, sf), V.DAY, distinct="sketch")


def flow_features_sketch_salted(spark, sf):
    return features.window_features(
        V.flow_logs(spark, sf), V.DAY, distinct="sketch", sketch_salts=4
    )


# ---- parsing ----


def _parsed(spark, sf):
    return parse.parse_flow_lines(V.flow_lines(spark, sf))


def json_validate_status(spark, sf):
    return _parsed(spark, sf).select("event_id", "status")


def json_rejects(spark, sf):
    return parse.rejected_rows(_parsed(spark, sf)).drop("event_ts")


def json_valid_rows(spark, sf):
    return parse.valid_rows(_parsed(spark, sf)).select(*FLOW_COLUMNS)


def transaction_json_rows(spark, sf):
    rows = V.transactions(spark, sf).select(
        "o_orderkey", F.to_json(F.struct(*TRANSACTION.fieldNames())).alias("line")
    )
    return parse.valid_rows(parse.parse_transaction_lines(rows)).drop("o_orderkey")


def transaction_status(spark, sf):
    lines = V.project(V.transactions(spark, sf), V.PAYMENT_LINES)
    return parse.parse_transaction_lines(lines).select("o_orderkey", "status")


def flow_restamped(spark, sf):
    """Restamped times are new and 0..59 ms apart; all else is as it was."""
    rows = parse.restamp(V.flow_logs(spark, sf), seed=1)
    apart = F.col("endTime") - F.col("startTime")
    return rows.select(
        *[c for c in FLOW_COLUMNS if c not in ("startTime", "endTime")],
        (apart.between(0, 59) & (F.col("startTime") > 1_750_000_000_000)).alias("restamped"),
    )


def ipv4_predicate(spark, sf):
    known = F.col("status") != parse.BAD_JSON
    return _parsed(spark, sf).select(
        "event_id",
        netaddr.is_ipv4(F.when(known, F.col("srcIP"))).alias("src_ok"),
        netaddr.is_ipv4(F.when(known, F.col("dstIP"))).alias("dst_ok"),
    )


def ip_to_int(spark, sf):
    return V.flow_logs(spark, sf).select(
        "event_id", netaddr.ip_to_long(F.col("srcIP")).alias("ip")
    )


def subnet_cidr(spark, sf):
    dst = F.col("dstIP")
    return V.flow_logs(spark, sf).select(
        "event_id",
        netaddr.cidr_signature(dst).alias("signature"),
        netaddr.network_cidr(dst).alias("network"),
        netaddr.network_cidr(F.col("srcIP"), 20).alias("src_network"),
    )


def flow_duration(spark, sf):
    return V.flow_logs(spark, sf).select(
        "event_id", scalars.duration_ms(F.col("endTime"), F.col("startTime")).alias("duration")
    )


def union_file_and_bus(spark, sf):
    from_files = V.flow_logs(spark, sf).select(*FLOW_COLUMNS)
    from_bus = V.flow_logs_injected(spark, sf).select(*FLOW_COLUMNS)
    return files.merge(from_files, from_bus)


# ---- geography ----


def _geo(spark, sf, strategy):
    flows = V.flow_logs(spark, sf).select("event_id", "srcIP")
    return geo.geo_enrich(flows, V.geo_ranges(spark, sf), strategy=strategy)


def geo_enrich_broadcast(spark, sf):
    return _geo(spark, sf, "auto")


def geo_enrich_bucketed(spark, sf):
    return _geo(spark, sf, "shuffle")


# ---- scoring ----


def feature_vector(spark, sf):
    rows = V.features(spark, sf).withColumn("v", vectors.feature_vector())
    return rows.select(
        *KEYS, *[F.col("v")[i].alias(f"v{i}") for i in range(len(VECTOR_COLUMNS))]
    )


def nearest_centroid(spark, sf):
    rows = scoring.nearest_centroid(
        V.features(spark, sf, injected=True),
        V.normalized_centroids(spark, sf),
    )
    return rows.select(
        *KEYS,
        F.col("nearest.centroid_id").alias("centroid_id"),
        F.round("nearest.distance", 6).alias("distance"),
    )


def nearest_centroid_in_code(spark, sf):
    """The other method, over rows that carry columns of the result's names."""
    rows = V.features(spark, sf, injected=True)
    rows = rows.withColumns({"centroid_id": F.lit(-1), "distance": F.lit(-1.0)})
    side = scoring.read_centroids(V.normalized_centroids(spark, sf))
    rows = scoring.nearest_centroid(rows, side, method="code")
    return rows.select(
        *KEYS,
        F.col("nearest.centroid_id").alias("centroid_id"),
        F.round("nearest.distance", 6).alias("distance"),
    )


def nearest_of_many(spark, sf):
    """Twelve centroids, over rows that carry columns of the result's names."""
    rows = V.features(spark, sf)
    side = rows.withColumn("centroid_id", F.expr(V.CLUSTER_OF_MANY)).groupBy("centroid_id")
    side = side.agg(*[F.avg(c).alias(c) for c in VECTOR_COLUMNS])
    rows = rows.withColumns({"centroid_id": F.lit(-1), "distance": F.lit(-1.0)})
    scored = scoring.score_rows(rows, side)
    return scored.select(*KEYS, "centroid_id", F.round("distance", 5).alias("distance"))


def centroid_distance(spark, sf):
    rows = scoring.centroid_distances(
        V.features(spark, sf), V.normalized_centroids(spark, sf)
    )
    names = [f"distance_{i + 1}" for i in range(V.N_CLUSTERS)]
    # a scale factor may leave a cluster of the fixed model empty
    missing = {n: F.lit(None).cast("double") for n in names if n not in rows.columns}
    return rounded(rows.withColumns(missing).select(*KEYS, *names), 6, *names)


def row_spread(spark, sf):
    rows = scoring.score_rows(
        V.features(spark, sf, injected=True),
        V.normalized_centroids(spark, sf),
    )
    numbers = ["normalized_dest", "spread"]
    return rounded(rows.select(*KEYS, "centroid_id", *numbers), 5, *numbers)


def outliers(spark, sf):
    return scoring.find_outliers(
        V.features(spark, sf, injected=True),
        V.normalized_centroids(spark, sf),
    )


def outliers_rotated_counts(spark, sf):
    return scoring.find_outliers(
        V.features(spark, sf, injected=True),
        V.normalized_centroids(spark, sf),
        rotate_counts=True,
    )


# ---- clustering ----


def centroid_pivot(spark, sf):
    return V.centroids(spark, sf)


def centroid_spread(spark, sf):
    return rounded(V.normalized_centroids(spark, sf), 5, "normalized_dest")


def centroid_spread_compat(spark, sf):
    return rounded(V.normalized_centroids(spark, sf, compat=True), 5, "normalized_dest")


def _steps(spark, sf):
    rows = V.features(spark, sf)
    start = V.centroids(spark, sf)
    first, info_1 = clustering.kmeans_step(rows, start, 1)
    second, info_2 = clustering.kmeans_step(rows, first, 2)
    return second, info_1.unionByName(info_2)


def kmeans_one_step(spark, sf):
    rows, start = V.features(spark, sf), V.centroids(spark, sf)
    updated, _ = clustering.kmeans_step(rows, start)
    return rounded(updated, 6, *VECTOR_COLUMNS)


def cluster_report(spark, sf):
    centres, info = _steps(spark, sf)
    report = clustering.cluster_report(centres, info)
    return rounded(report, 4, "cluster_radius", *VECTOR_COLUMNS)


def train_rows_filtered(spark, sf):
    rows = V.features(spark, sf).withColumn("dt", F.to_date("transaction_time"))
    return clustering.model_columns(
        clustering.train_rows(rows, "2024-01-05", "2024-01-20", limit=None)
    ).drop("dt")


def train_rows_limited(spark, sf):
    rows = V.features(spark, sf).withColumn("dt", F.to_date("transaction_time"))
    return clustering.train_rows(rows, "2024-01-01", "2024-01-31", limit=300).select(*KEYS)


def _kmeans(spark, sf):
    rows = V.features(spark, sf)
    return rows, clustering.fit_kmeans(rows, k=4, seed=1)


def _inertia(rows: DataFrame, centres: DataFrame, scale: dict[str, float]) -> DataFrame:
    """Rows with the id of their nearest standardised centre and the squared distance."""
    near = scoring.nearest_centroid(rows, centres, scale=scale)
    return near.withColumns(
        {"near_id": F.col("nearest.centroid_id"), "square": F.pow("nearest.distance", F.lit(2.0))}
    )


def kmeans_facts(spark, sf):
    """What any k-means result has to fulfil, as one row."""
    rows, model = _kmeans(spark, sf)
    long = clustering.centroids_long(spark, model)
    exact = long.groupBy("centroid_id").pivot("feature", VECTOR_COLUMNS).agg(F.first("numerical_value"))
    scale = clustering.feature_deviations(model)
    assigned = _inertia(clustering.assign(model, rows), exact, scale)
    start = _inertia(rows, V.centroids(spark, sf), scale).agg(F.sum("square")).scalar()
    facts = assigned.agg(
        F.count_distinct("centroid_id").alias("clusters"),
        F.count(F.lit(1)).alias("n"),
        F.bool_and(F.col("centroid_id") == F.col("near_id")).alias("nearest"),
        F.sum("square").alias("inertia"),
    )
    return facts.select("clusters", "n", "nearest", (F.col("inertia") <= start).alias("not_above_start"))


# ---- privacy ----


def tokens_without_key(spark, sf):
    """Without a key the identifiers pass through."""
    rows = V.features(spark, sf).select(*KEYS)
    return privacy.tokenize_columns(rows, ["subscriber_id"], None)


def tokenize_hash(spark, sf):
    token = privacy.tokenize_one_way(F.col("subscriberId"), TOKEN_KEY.decode())
    return V.flow_logs(spark, sf).select("event_id", token.alias("token"))


def tokenize_aes_roundtrip(spark, sf):
    rows = V.features(spark, sf).select(*KEYS)
    sealed = privacy.tokenize_columns(rows, ["subscriber_id"], TOKEN_KEY)
    return sealed.withColumns(
        {
            "is_token": F.col("subscriber_id").startswith(privacy.TOKEN_PREFIX),
            "subscriber_id": privacy.detokenize(F.col("subscriber_id"), TOKEN_KEY),
        }
    )


def tokenize_groups(spark, sf):
    """Equal identifiers get equal tokens: group sizes survive tokenising."""
    rows = privacy.tokenize_columns(
        V.flow_logs(spark, sf).select("subscriberId", "txBytes"), ["subscriberId"], TOKEN_KEY
    )
    return rows.groupBy("subscriberId").agg(
        F.count(F.lit(1)).alias("n"), F.sum("txBytes").alias("tx")
    ).select("n", "tx")


FEATURE_SHARDS, FEATURE_BYTES = 4, 500


def _feature_shard():
    return F.pmod(scalars.hash32(F.concat_ws("|", *KEYS), 0), F.lit(FEATURE_SHARDS))


def feature_batches(spark, sf):
    rows = V.features(spark, sf)
    packed = batching.pack_rows(
        rows.withColumn("size", privacy.serialized_bytes(KEYS + VECTOR_COLUMNS[:1])),
        size=F.col("size"),
        shard=_feature_shard(),
        order=KEYS[:2],
        limit=FEATURE_BYTES,
        window=F.to_timestamp("transaction_time"),
    )
    return packed.select(*KEYS, "shard", "batch_id")


def open_hash_service() -> Callable[[list[str]], list[str]]:
    """A stand-in for a remote service that turns a list of values into tokens."""
    return lambda values: [hashlib.sha256(v.encode("utf-8")).hexdigest() for v in values]


def tokenize_service(spark, sf):
    rows = V.features(spark, sf).select(*KEYS)
    return batching.apply_to_batches(
        rows,
        "subscriber_id",
        open_hash_service,
        size=privacy.serialized_bytes(KEYS),
        shard=_feature_shard(),
        order=KEYS,
        limit=FEATURE_BYTES,
        window=F.to_timestamp("transaction_time"),
    )


def inspect_sensitive(spark, sf):
    docs = V.table(spark, sf, "documents").select("doc_id", "text")
    return privacy.inspect_columns(docs, ["text"]).drop("text")


# ---- payments ----


def model_input(spark, sf):
    return fraud.model_input(V.transactions(spark, sf))


def _order_shard():
    return F.pmod(F.col("o_orderkey"), F.lit(SHARDS))


def request_batches(spark, sf):
    rows = V.transactions(spark, sf).select(
        "transactionId",
        "o_orderkey",
        F.window("event_ts", f"{REQUEST_WINDOW} seconds").start.alias("start"),
        fraud.instance_json().alias("instance"),
    )
    packed = batching.pack_rows(
        rows.withColumn("size", F.octet_length("instance")),
        size=F.col("size"),
        shard=_order_shard(),
        order=["o_orderkey"],
        limit=REQUEST_BYTES,
        window=F.col("start"),
    )
    return packed.select("transactionId", "shard", "batch_id")


_DOCUMENTS = {"batch_bytes": REQUEST_BYTES, "window_seconds": REQUEST_WINDOW, "order": "o_orderkey"}


def _documents(spark, sf):
    return fraud.requests(V.transactions(spark, sf), shard=_order_shard(), **_DOCUMENTS)


def request_documents(spark, sf):
    return _documents(spark, sf).drop("request")


def request_instances(spark, sf):
    """The requests taken apart again: every transaction once, with its fields."""
    whole = F.from_json("request", "signature_name string, instances array<string>")
    fields = "transactionId string, type string, amount double"
    return (
        _documents(spark, sf)
        .select(F.explode(whole["instances"]).alias("instance"))
        .select(F.from_json("instance", fields).alias("i"))
        .select("i.*")
    )


def open_rule_scorer() -> Callable[[str], str]:
    """A fixed rule in place of a hosted model: large amounts that empty an account."""

    def answer(request: str) -> str:
        predictions = []
        for row in json.loads(request)["instances"]:
            margin = (row["amount"] - 300000.0) / 10000.0
            margin -= 0.0 if row["newbalanceOrig"] == 0 else 20.0
            predictions.append(
                {
                    "logistic": [1.0 / (1.0 + math.exp(-margin))],
                    "transactionId": [row["transactionId"]],
                }
            )
        return json.dumps({"predictions": predictions})

    return answer


def _rule_predictions(spark, sf):
    rows = V.transactions(spark, sf)
    return fraud.parse_predictions(
        fraud.score_transactions(rows, open_rule_scorer, shard=_order_shard(), **_DOCUMENTS)
    )


def parse_predictions(spark, sf):
    return rounded(_rule_predictions(spark, sf).drop("json_response"), 9, "logistic")


def scorer_alerts(spark, sf):
    return rounded(
        fraud.alerts(_rule_predictions(spark, sf)).drop("json_response"), 9, "logistic"
    )


def prediction_join(spark, sf):
    found = fraud.alerts(_rule_predictions(spark, sf), 0.5).drop("json_response")
    matched = fraud.match_transactions(found, V.transactions(spark, sf))
    return rounded(
        matched.select("transactionId", "logistic", "nameOrig", "nameDest", "amount", "isFraud"),
        9,
        "logistic",
    )


def fraud_downsample(spark, sf):
    return fraud.training_set(V.transactions(spark, sf)).select(
        "transactionId", "type", "amount", "isFraud"
    )


def fraud_split(spark, sf):
    rows = V.transactions(spark, sf).select("transactionId", "isFraud")
    return sampling.with_cut(rows, "transactionId", seed=2, fraction=0.8, name="in_train")


def known_frauds(spark, sf):
    return fraud.known_frauds(V.transactions(spark, sf)).select(
        "transactionId", "type", "amount", "nameOrig"
    )


def one_hot_type(spark, sf):
    rows = V.transactions(spark, sf)
    hot = fraud.one_hot(rows, rows).withColumn(
        "type_onehot", F.array_join("type_onehot", ",")
    )
    return hot.select("transactionId", "type", "type_onehot", *fraud.NUMERIC_COLUMNS)


def type_vocabulary(spark, sf):
    rows = V.transactions(spark, sf)
    return spark.range(1).select(F.explode(fraud.vocabulary(rows)).alias("type"))


def transaction_keys(spark, sf):
    rows = V.transactions(spark, sf).withColumnRenamed("transactionId", "original")
    return fraud.with_random_key(rows, ["original"]).select("original", "transactionId")


def rule_scored(spark, sf):
    emptied = F.when(F.col("newbalanceOrig") == 0, 0.0).otherwise(20.0)
    margin = (F.col("amount") - 300000.0) / 10000.0 - emptied
    return V.transactions(spark, sf).withColumn(
        "logistic", F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
    )


def confusion_counts(spark, sf):
    return fraud.confusion_counts(rule_scored(spark, sf))


def model_evaluation(spark, sf):
    numbers = ["accuracy", "precision", "recall"]
    return rounded(fraud.evaluate(rule_scored(spark, sf)), 9, *numbers)


def fitted_trees(spark, sf):
    rows = fraud.training_set(V.transactions(spark, sf), fraction=0.5)
    return fraud.fit_fraud_model(rows, iterations=40, step_size=0.3)


def gbt_scores(spark, sf):
    model = fitted_trees(spark, sf)
    return fraud.predict(model, fraud.model_input(V.transactions(spark, sf)))


def gbt_facts(spark, sf):
    """What a fitted and a reloaded model have to fulfil, as one row."""
    model = fitted_trees(spark, sf)
    path = scratch_path(spark, "gbt")
    fraud.save_model(model, path)
    rows = V.transactions(spark, sf)
    kept = fraud.predict(model, rows).select("transactionId", "isFraud", "logistic")
    again = fraud.predict(fraud.load_model(path), rows).select(
        F.col("transactionId").alias("id"), F.col("logistic").alias("reloaded")
    )
    actual, called = F.col("isFraud") == 1, F.col("logistic") >= 0.5
    return kept.join(again, F.col("transactionId") == F.col("id")).agg(
        F.count(F.lit(1)).alias("n"),
        F.bool_and(F.col("logistic").between(0, 1)).alias("probabilities"),
        (F.count_if(actual == called) >= 0.98 * F.count(F.lit(1))).alias("accurate"),
        (F.count_if(actual & called) >= 0.9 * F.count_if(actual)).alias("recalled"),
        F.bool_and(F.col("logistic") == F.col("reloaded")).alias("same_when_reloaded"),
    )


def fraud_alerts(spark, sf):
    return fraud.alerts(fraud.prediction_rows(gbt_scores(spark, sf)))


# ---- generators and messages ----


def _event_ids(spark, sf):
    return V.table(spark, sf, "events").select(F.col("event_id").alias("id"))


def generate_flow_logs(spark, sf):
    return generate.generate_flow_logs(_event_ids(spark, sf))


def generate_transactions(spark, sf):
    return generate.generate_transactions(_event_ids(spark, sf))


def publish_messages(spark, sf):
    messages = generate.to_messages(
        V.flow_logs(spark, sf), "netflow", ["event_id", *FLOW_LOG.fieldNames()]
    )
    return messages.select(
        "value",
        F.col("headers")[0]["key"].alias("header"),
        F.col("headers")[0]["value"].cast("string").alias("event_type"),
    )


# ---- sources and sinks ----


def load_features_table(spark, sf):
    """Features loaded into a day-partitioned, sorted table, then a pruned scan."""
    table = scratch_path(spark, "t").rsplit("/", 1)[-1].replace("-", "_")
    sinks.create_table(
        spark,
        table,
        FEATURES,
        [sinks.LOAD_COLUMN, sinks.DATE_COLUMN],
        scratch_path(spark, "features"),
    )
    rows = sinks.with_date(V.features(spark, sf))
    for _ in range(2):  # the second try of a load replaces the first
        sinks.load(rows, table, 0, shards=4, cluster_by=["dst_subnet", "subscriber_id"])
    found = tables.read_partitions(spark, table, "2024-01-05", "2024-01-20")
    found = written(found.drop("dt", "load_id"), "scan")
    spark.sql(f"DROP TABLE {table}")
    return found


def new_table(spark, columns, partition_by=None) -> tuple[str, str]:
    path = scratch_path(spark, "t")
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    sinks.create_table(spark, table, columns, partition_by, path)
    return table, path


def append_twice(spark, sf):
    """The default method: rows of every append stay."""
    rows = V.features(spark, sf)
    table, path = new_table(spark, FEATURES)
    first = F.pmod(F.xxhash64("transaction_time"), F.lit(2)) == 0
    sinks.append(rows.where(first), table)
    sinks.append(rows.where(~first), table)
    spark.sql(f"DROP TABLE {table}")
    return spark.read.schema(FEATURES).parquet(path)


def create_or_replace(spark, sf):
    """A table made anew holds the last rows only."""
    path = scratch_path(spark, "t")
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    for rows in (V.features(spark, sf).select("subscriber_id"), V.centroids(spark, sf)):
        clustering.write_or_replace(rows, table, path=path)
    found = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return spark.read.schema(found.schema).parquet(path)


def stored_query_centroids(spark, sf):
    """The side table from SQL text in a file."""
    folder = scratch_path(spark, "q")
    V.normalized_centroids(spark, sf).write.parquet(f"{folder}/centroids")
    text = f"SELECT * FROM parquet.`{folder}/centroids`;"
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{folder}/sql")
    return rounded(tables.read_centroids(spark, f"{folder}/sql"), 5, "normalized_dest")


def csv_labelled_scan(spark, sf):
    path = scratch_path(spark, "csv")
    V.transactions(spark, sf).select(*TRANSACTION.fieldNames()).write.csv(path, header=True)
    rows = files.read_csv(spark, path, TRANSACTION)
    return rows.where(F.col("isFraud") == 1).drop(*fraud.UNUSED_COLUMNS)


def centroids_json_load(spark, sf):
    path = scratch_path(spark, "json")
    V.normalized_centroids(spark, sf).write.json(path)
    loaded = files.read_json(spark, path, NORMALIZED_CENTROIDS)
    return rounded(loaded, 5, "normalized_dest")


BATCH_QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        flow_features,
        flow_features_minute,
        flow_features_network_subnet,
        flow_features_sketch,
        flow_features_sketch_salted,
        json_validate_status,
        json_rejects,
        json_valid_rows,
        transaction_json_rows,
        transaction_status,
        flow_restamped,
        ipv4_predicate,
        ip_to_int,
        subnet_cidr,
        flow_duration,
        union_file_and_bus,
        geo_enrich_broadcast,
        geo_enrich_bucketed,
        feature_vector,
        nearest_centroid,
        nearest_centroid_in_code,
        nearest_of_many,
        centroid_distance,
        row_spread,
        outliers,
        outliers_rotated_counts,
        centroid_pivot,
        centroid_spread,
        centroid_spread_compat,
        kmeans_one_step,
        cluster_report,
        train_rows_filtered,
        train_rows_limited,
        kmeans_facts,
        tokens_without_key,
        tokenize_hash,
        tokenize_aes_roundtrip,
        tokenize_groups,
        feature_batches,
        tokenize_service,
        inspect_sensitive,
        model_input,
        request_batches,
        request_documents,
        request_instances,
        parse_predictions,
        scorer_alerts,
        prediction_join,
        fraud_downsample,
        fraud_split,
        known_frauds,
        one_hot_type,
        type_vocabulary,
        transaction_keys,
        confusion_counts,
        model_evaluation,
        gbt_scores,
        gbt_facts,
        fraud_alerts,
        generate_flow_logs,
        generate_transactions,
        publish_messages,
        load_features_table,
        append_twice,
        create_or_replace,
        stored_query_centroids,
        csv_labelled_scan,
        centroids_json_load,
    )
}
