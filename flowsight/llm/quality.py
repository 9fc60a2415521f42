"""Quality classifier: naive Bayes support vectors (NB-SVM).

Indicators of word n-grams and byte triples, hashed into a fixed number of buckets, are scaled by the
log-count ratios of the two classes, and a linear model with hinge loss is fitted on them by dual
coordinate descent. The counts cover all learnable labelled rows, in one pass with partial
aggregation; the fit takes a sample of them, at most about `train_rows` rows by a hash of doc_id,
in one task. A logistic curve fitted on a part of the sample that the descent never saw
turns margins into scores.

Defined results: null text counts as empty, which has no indicators and gets the score of the bias;
a null doc_id is never learned from (it counts as held out) but scored; labels other than 0 and 1 are
ignored, of several labels for a document the lowest counts; with one class or none to learn from
every score is the share of label 1, smoothed; repeated rows get equal scores; a text of any length is
read in blocks, and its indicators do not depend on where these end; other columns play no part.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_fold, arrow_map, held_out, text_blocks, whole_text, written

BUCKETS = 1 << 18
TRAIN_ROWS = 10_000
THRESHOLD = 0.3
EPOCHS = 12
COST = 1.0
REPEAT_SIZES = (1, 5)
HALVINGS = 7


def _repeats(words: np.ndarray) -> np.ndarray:
    """Indicators of repeated n-grams over the whole text, for each size of `REPEAT_SIZES`.

    One for each k for which the share of n-grams that were there before (of single words: directly before) is above 2^-k.
    """
    levels = []
    for row, size in enumerate(REPEAT_SIZES):
        total = len(words) - size + 1 if size > 1 else len(words) - 1
        if total < 1:
            continue
        if size == 1:
            again = np.count_nonzero(words[1:] == words[:-1])
        else:
            grams = words[:total].copy()
            for k in range(1, size):
                grams = grams * np.uint64(0x9E3779B97F4A7C15) + words[k : total + k]
            again = total - len(np.unique(grams))
        levels += [row * HALVINGS + k for k in range(HALVINGS) if again << k > total]
    return np.array(levels, np.uint64) + np.uint64(1 << 41)


def _buckets(keys: np.ndarray) -> np.ndarray:
    keys = keys * np.uint64(0xD6E8FEB86659FD93)
    return np.unique(((keys ^ keys >> np.uint64(32)) * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(46))


def indicators(text: str) -> np.ndarray:
    """The sorted buckets of the text's words, word pairs, byte triples and repeats.

    A long text is read in blocks; the numbers of its words are all that is kept of them.
    """
    found, all_words, last = [], [], np.zeros(0, np.uint64)
    for block in text_blocks(text):
        raw = block.encode("utf-8")
        b = np.frombuffer(raw, np.uint8).astype(np.uint64)
        triples = b[:-2] | b[1:-1] << np.uint64(8) | b[2:] << np.uint64(16) | np.uint64(1 << 40)
        split = raw.split()
        words = np.fromiter(map(zlib.crc32, split), np.uint64, len(split))
        run = np.concatenate([last, words])
        pairs = run[:-1] * np.uint64(0x9E3779B97F4A7C15) + run[1:]
        last = run[-1:]
        all_words.append(words)
        found.append(_buckets(np.concatenate([triples, words, pairs])))
    found.append(_buckets(_repeats(np.concatenate(all_words))))
    return np.unique(np.concatenate(found)).astype(np.int64)


@dataclass
class Model:
    weights: np.ndarray  # of the scaled indicators, times the scale
    scale: np.ndarray
    bias: float
    slope: float
    shift: float

    def score(self, text: str) -> float:
        at = indicators(text)
        norm = float(np.sqrt(np.square(self.scale[at]).sum())) or 1.0
        margin = float(self.weights[at].sum()) / norm + self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500))))


def descend(
    rows: list[np.ndarray], labels: np.ndarray, scale: np.ndarray, cost: float = COST, epochs: int = EPOCHS
) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge loss, by dual coordinate descent; classes weigh alike.

    Minimises |w, bias|^2 / 2 + sum of C_i * max(0, 1 - y_i * margin_i); every dual variable stays in [0, C_i].
    """
    sign = np.where(labels > 0, 1.0, -1.0)
    share = np.where(labels > 0, max((labels > 0).mean(), 1e-9), max((labels <= 0).mean(), 1e-9))
    most = cost / (2 * share)
    w, bias = np.zeros(len(scale)), 0.0
    alpha = np.zeros(len(rows))
    values = []
    for at in rows:
        x = scale[at]
        values.append(x / (float(np.sqrt(x @ x)) or 1.0))
    order = np.random.default_rng(0)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, x, y = rows[i], values[i], sign[i]
            gradient = y * (float(w[at] @ x) + bias) - 1
            new = min(max(alpha[i] - gradient / (float(x @ x) + 1), 0.0), most[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y
                w[at] += step * x
                bias += step
                alpha[i] = new
    return w, bias


def logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope (never below 0) and shift of P(label 1 | margin), by Newton steps with a small prior."""
    slope, shift = 1.0, 0.0
    x = np.stack([margins, np.ones(len(margins))], axis=1)
    target = np.where(labels > 0, (labels.sum() + 1) / (labels.sum() + 2), 1 / ((labels <= 0).sum() + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ [slope, shift], -50, 50)))
        gradient = x.T @ (p - target) + [1e-3 * slope, 1e-3 * shift]
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        step /= max(1.0, np.abs(step).max() / 5)
        slope, shift = slope - step[0], shift - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return max(float(slope), 1e-3), float(shift)


def _gathered(docs: DataFrame, labels: DataFrame, train_rows: int) -> DataFrame:
    """Class counts of each bucket (label null) and the sampled rows (label 0 or 1, indicators)."""
    label = labels.select(labels["doc_id"].cast("long").alias("id"), labels["quality"].cast("int").alias("y"))
    label = label.filter(F.col("y").isin(0, 1)).groupBy("id").agg(F.min("y").alias("y"))
    fraction = min(1.0, train_rows / max(1, label.count()))
    limit = int(fraction * (1 << 30))
    rows = docs.filter(~held_out(docs, 5, 0)).select(
        docs["doc_id"].cast("long").alias("doc_id"), whole_text(docs).alias("text")
    )
    picked = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) < limit
    # always by shuffle: the plan of the labels must not change with their number
    rows = rows.join(label.hint("shuffle_hash"), F.col("doc_id") == F.col("id")).select("doc_id", "y", picked.alias("picked"), "text")

    def start() -> dict:
        return {"counts": np.zeros((2, BUCKETS), np.int64), "rows": np.zeros(2, np.int64), "sample": []}

    def add(state: dict, batch: pa.RecordBatch) -> None:
        for i, y, taken, text in zip(*(c.to_pylist() for c in batch.columns)):
            at = indicators(text)
            state["counts"][y, at] += 1
            if taken:
                state["sample"].append((i, y, at))

    def finish(state: dict):
        at = np.flatnonzero(state["counts"].any(axis=0))
        nothing = [None] * len(at)
        yield {"key": at, "no": state["counts"][0, at], "yes": state["counts"][1, at], "y": nothing, "at": nothing}
        for k in range(0, len(state["sample"]), 500):
            part = state["sample"][k : k + 500]
            zero = [0] * len(part)
            yield {
                "key": [i for i, _, _ in part],
                "no": zero,
                "yes": zero,
                "y": [y for _, y, _ in part],
                "at": [a.astype(np.int32) for _, _, a in part],
            }

    return arrow_fold(rows, start, add, finish, "key long, no long, yes long, y int, at array<int>")


def learn(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """The model; the driver sees at most BUCKETS sums and the weights, the sample stays in a task."""
    gathered = written(_gathered(docs, labels, train_rows), "indicators")
    counted = gathered.filter(F.col("y").isNull()).groupBy("key").agg(F.sum("no").alias("no"), F.sum("yes").alias("yes"))
    sums = counted.toArrow()
    counts = np.ones((2, BUCKETS))
    at = sums.column("key").to_numpy()
    counts[0, at] += sums.column("no").to_numpy()
    counts[1, at] += sums.column("yes").to_numpy()
    share = counts / counts.sum(axis=1, keepdims=True)
    scale = np.log(share[1] / share[0])
    sample = gathered.filter(F.col("y").isNotNull()).select("key", "y", "at").coalesce(1)

    def add(state: list, batch: pa.RecordBatch) -> None:
        at = batch.column(2)
        values, cuts = at.flatten().to_numpy(), at.offsets.to_numpy()
        cuts = cuts - cuts[0]
        for k, (key, y) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            state.append((key, y, values[cuts[k] : cuts[k + 1]].copy()))

    def finish(state: list):
        state.sort(key=lambda row: row[0])
        y = np.array([row[1] for row in state], np.float64)
        rows = [row[2] for row in state]
        test = np.arange(len(rows)) % 5 == 0
        if len({*y[~test]}) < 2 or len({*y[test]}) < 2:
            test = np.zeros(len(rows), bool)
        if len({*y[~test]}) < 2:
            odds = (y.sum() + 1) / (len(y) + 2)
            fit = (np.zeros(BUCKETS), 0.0, 1.0, float(np.log(odds / (1 - odds))))
        else:
            train = np.flatnonzero(~test)
            w, bias = descend([rows[i] for i in train], y[train], scale)
            check = np.flatnonzero(test) if test.any() else train
            norms = [float(np.sqrt(np.square(scale[rows[i]]).sum())) or 1.0 for i in check]
            margins = np.array([w[rows[i]] @ scale[rows[i]] / n + bias for i, n in zip(check, norms)])
            fit = (w, bias, *logistic(margins, y[check]))
        yield {"w": [fit[0].tobytes()], "bias": [fit[1]], "slope": [fit[2]], "shift": [fit[3]]}

    schema = "w binary, bias double, slope double, shift double"
    fitted = arrow_fold(sample, list, add, finish, schema).first()
    if fitted is None:  # no partition at all
        return Model(np.zeros(BUCKETS), scale, 0.0, 1.0, 0.0)
    weights = np.frombuffer(bytes(fitted["w"])) * scale
    return Model(weights, scale, fitted["bias"], fitted["slope"], fitted["shift"])


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        held_out(docs, 5, 0).alias("held_out"),
        whole_text(docs).alias("text"),
    )

    def work(batch: pa.RecordBatch):
        scores = [model.score(text) for text in batch.column(2).to_pylist()]
        yield {
            "doc_id": batch.column(0),
            "held_out": batch.column(1),
            "score": scores,
            "predicted": [int(s >= threshold) for s in scores],
        }

    return arrow_map(rows, work, "doc_id long, held_out boolean, score double, predicted int")


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, learn(docs, labels))
