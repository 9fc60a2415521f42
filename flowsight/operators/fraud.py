"""Payment transactions: model input, training, scoring and alerts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from flowsight.functions.scalars import shard_of
from flowsight.operators import curves, ensemble
from flowsight.operators.batching import answer_requests, pack_requests, slices
from flowsight.operators.ensemble import Ensemble
from flowsight.operators.sampling import downsample
from flowsight.schemas import MODEL_INPUT

# Model columns.
CATEGORICAL_COLUMN = "type"
NUMERIC_COLUMNS = [
    "step",
    "amount",
    "oldbalanceOrg",
    "newbalanceOrig",
    "oldbalanceDest",
    "newbalanceDest",
]
KEY_COLUMN = "transactionId"
LABEL_COLUMN = "isFraud"
UNUSED_COLUMNS = ["nameOrig", "nameDest", "isFlaggedFraud"]

# Most values of a categorical column.
MAX_CATEGORIES = 4096

# Fewer training rows than this are not dealt to more tasks.
TRAIN_TASK_ROWS = 50_000

# Fixed value: an alert needs at least this probability.
PROBABILITY = 0.99


def model_input(transactions: DataFrame) -> DataFrame:
    """The eight columns the model is served with."""
    return transactions.select(*[f.name for f in MODEL_INPUT])


def instance_json(columns: list[str] | None = None) -> Column:
    """A row as one JSON object."""
    return F.to_json(F.struct(*(columns or [f.name for f in MODEL_INPUT])))


def _instances(
    transactions: DataFrame, key_range: int, window_seconds: int, event_time: str, shard: Column | None, order: str
) -> tuple[DataFrame, dict]:
    """Rows to pack, and how to group them."""
    rows = transactions.select(
        order,
        F.window(event_time, f"{window_seconds} seconds").start.alias("_start"),
        (shard if shard is not None else shard_of(F.col(KEY_COLUMN), key_range)).alias("_part"),
        instance_json().alias("instance"),
    )
    return rows, {"payload": "instance", "shard": F.col("_part"), "order": [order], "window": F.col("_start")}


def requests(
    transactions: DataFrame,
    batch_bytes: int = 50_000,
    key_range: int = 100,
    window_seconds: int = 5,
    event_time: str = "event_ts",
    shard: Column | None = None,
    order: str = KEY_COLUMN,
) -> DataFrame:
    """Size-bounded request documents per window and shard."""
    rows, groups = _instances(transactions, key_range, window_seconds, event_time, shard, order)
    return pack_requests(rows, limit=batch_bytes, **groups)


def score_transactions(
    transactions: DataFrame,
    open_scorer: Callable[[], Callable[[str], str]],
    batch_bytes: int = 50_000,
    key_range: int = 100,
    window_seconds: int = 5,
    event_time: str = "event_ts",
    shard: Column | None = None,
    order: str = KEY_COLUMN,
) -> DataFrame:
    """`response`: what the scorer answers to each document of `requests`, asked where it is put together."""
    rows, groups = _instances(transactions, key_range, window_seconds, event_time, shard, order)
    return answer_requests(rows, open_function=open_scorer, limit=batch_bytes, **groups)


def score_requests(
    request_rows: DataFrame,
    open_scorer: Callable[[], Callable[[str], str]],
    request_column: str = "request",
) -> DataFrame:
    """`response`: what the scorer answers to each request document.

    `open_scorer` is called once per partition, for a client or a loaded model. For documents that exist, as
    on a stream: a worker gets as many of them at a time as the Arrow settings allow.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = open_scorer()
        answers = (scorer(text.as_py()) for batch in batches for text in batch.column(0))
        for done in slices(answers, lambda answer: len(answer or "")):
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], names=["response"])

    schema = StructType([StructField("response", StringType())])
    return request_rows.select(request_column).mapInArrow(run, schema)


def parse_predictions(responses: DataFrame, column: str = "response") -> DataFrame:
    """`transactionId, logistic, json_response` for every element of `predictions`."""
    elements = F.from_json(F.col(column), "predictions array<string>")["predictions"]
    fields = "transactionId array<string>, logistic array<double>"
    return (
        responses.select(F.explode(elements).alias("json_response"))
        .withColumn("_p", F.from_json("json_response", fields))
        .select(
            F.get("_p.transactionId", F.lit(0)).alias("transactionId"),
            F.get("_p.logistic", F.lit(0)).alias("logistic"),
            "json_response",
        )
    )


def alerts(predictions: DataFrame, probability: float = PROBABILITY) -> DataFrame:
    return predictions.where(F.col("logistic") >= F.lit(float(probability)))


def match_transactions(predictions: DataFrame, transactions: DataFrame) -> DataFrame:
    """Predictions beside the transaction they were made for."""
    return predictions.join(transactions, KEY_COLUMN)


def with_random_key(df: DataFrame, from_columns: list[str] | None = None) -> DataFrame:
    """Adds transactionId: a uuid, or a digest of the given columns."""
    if from_columns is None:
        return df.withColumn(KEY_COLUMN, F.expr("uuid()"))
    return df.withColumn(KEY_COLUMN, F.sha2(F.concat_ws("|", *from_columns), 256))


def training_set(
    transactions: DataFrame,
    fraction: float = 0.005,
    seed: int = 2,
    key: str = KEY_COLUMN,
) -> DataFrame:
    """All frauds, a seeded fraction of the rest, without the unused columns."""
    sampled = downsample(
        transactions, F.col(LABEL_COLUMN) == 1, key, fraction, seed
    )
    return sampled.drop(*UNUSED_COLUMNS)


def vocabulary(df: DataFrame, column: str = CATEGORICAL_COLUMN, most: int = MAX_CATEGORIES) -> Column:
    """The distinct values of a categorical column, sorted, as a scalar subquery.

    Only the first values are ever gathered; a column with more than `most` is no category and fails.
    """
    values = df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column).limit(most + 1)
    found = values.agg(F.array_sort(F.collect_list(column)).alias("vocabulary")).select(
        F.when(
            F.size("vocabulary") > most, F.raise_error(F.lit(f"more than {most} values of {column}"))
        ).otherwise(F.col("vocabulary"))
    )
    return found.scalar()


def one_hot(df: DataFrame, train: DataFrame, column: str = CATEGORICAL_COLUMN) -> DataFrame:
    """Adds `<column>_onehot`, one 0/1 per value seen in `train`."""
    hot = F.transform(
        F.col("_vocabulary"), lambda v: F.when(v == F.col(column), 1).otherwise(0)
    )
    return (
        df.withColumn("_vocabulary", vocabulary(train, column))
        .withColumn(f"{column}_onehot", hot)
        .drop("_vocabulary")
    )


def _dealt(rows: DataFrame) -> DataFrame:
    """Persisted rows, dealt out evenly where a task has more than twice its share.

    The training reads its rows in the partitions of the files, and a file with few row groups
    has few of them, however many cores there are. Runs a count by partition.
    """
    counts = [r["count"] for r in rows.groupBy(F.spark_partition_id().alias("part")).count().collect()]
    tasks = min(rows.sparkSession.sparkContext.defaultParallelism, -(-sum(counts) // TRAIN_TASK_ROWS))
    if max(counts, default=0) * tasks <= 2 * sum(counts):
        return rows
    dealt = rows.repartition(tasks).persist()
    dealt.count()
    rows.unpersist()
    return dealt


def fit_fraud_model(
    train: DataFrame,
    iterations: int = 100,
    step_size: float = 0.1,
    max_depth: int = 5,
    seed: int = 2,
) -> PipelineModel:
    """Boosted trees over one-hot type and the numeric columns. Runs the training."""
    indexer = StringIndexer(
        inputCol=CATEGORICAL_COLUMN, outputCol="_type_index", handleInvalid="keep"
    )
    encoder = OneHotEncoder(inputCol="_type_index", outputCol="_type_vector")
    assembler = VectorAssembler(
        inputCols=["_type_vector", *NUMERIC_COLUMNS],
        outputCol="_features",
        handleInvalid="keep",
    )
    trees = GBTClassifier(
        labelCol=LABEL_COLUMN,
        featuresCol="_features",
        maxIter=iterations,
        stepSize=step_size,
        maxDepth=max_depth,
        seed=seed,
    )
    # read once per tree level: keep the columns that are used
    rows = _dealt(train.select(LABEL_COLUMN, CATEGORICAL_COLUMN, *NUMERIC_COLUMNS).persist())
    try:
        return Pipeline(stages=[indexer, encoder, assembler, trees]).fit(rows)
    finally:
        rows.unpersist()


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def save_nodes(model: PipelineModel, path: str) -> None:
    """The fitted trees as a table of nodes, which `ensemble.load_ensemble` reads."""
    ensemble.save_ensemble(model, path, NUMERIC_COLUMNS, CATEGORICAL_COLUMN)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def predict(model: PipelineModel | Ensemble, rows: DataFrame) -> DataFrame:
    """The input columns plus `logistic`, the probability of fraud."""
    if isinstance(model, Ensemble):
        return ensemble.score(rows, model)
    scored = model.transform(rows).withColumn(
        "logistic", F.get(vector_to_array("probability"), F.lit(1))
    )
    return scored.select(*rows.columns, "logistic")


def prediction_rows(scored: DataFrame) -> DataFrame:
    """Scored rows in the shape of the prediction table."""
    response = F.to_json(
        F.struct(
            F.array("logistic").alias("logistic"),
            F.array(KEY_COLUMN).alias(KEY_COLUMN),
        )
    )
    return scored.select(KEY_COLUMN, "logistic", response.alias("json_response"))


def confusion_counts(scored: DataFrame, probability: str = "logistic") -> DataFrame:
    """Number of rows per (label, probability rounded to 0 or 1)."""
    return (
        scored.select(
            F.col(LABEL_COLUMN).alias("actual"),
            F.rint(probability).cast("int").alias("predicted"),
        )
        .groupBy("actual", "predicted")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def evaluate(scored: DataFrame, probability: str = "logistic") -> DataFrame:
    """Accuracy, precision, recall and counts as one row, in one pass."""
    actual = F.col(LABEL_COLUMN) == 1
    predicted = F.rint(probability) == 1
    n = F.count(F.lit(1))
    tp = F.count_if(actual & predicted)
    return scored.agg(
        n.alias("n"),
        tp.alias("true_positives"),
        F.try_divide(F.count_if(actual == predicted), n).alias("accuracy"),
        F.try_divide(tp, F.count_if(predicted)).alias("precision"),
        F.try_divide(tp, F.count_if(actual)).alias("recall"),
    )


def area_under_curve(scored: DataFrame, probability: str = "logistic") -> float:
    """Area under the ROC curve. Runs the evaluation job."""
    return curves.areas(scored, probability, LABEL_COLUMN).first()["roc_area"]


def known_frauds(rows: DataFrame, n: int = 10, key: str = KEY_COLUMN) -> DataFrame:
    """The first `n` fraud rows by key: a report of known examples."""
    return rows.where(F.col(LABEL_COLUMN) == 1).orderBy(key).limit(n)


def write_examples(rows: DataFrame, path: str, n: int = 10) -> None:
    """Known frauds as newline JSON without the label, for a trial request."""
    known_frauds(rows, n).drop(LABEL_COLUMN).write.mode("overwrite").json(path)
