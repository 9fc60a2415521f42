"""Quality classifier: held-out accuracy, the descent's optimality, awkward rows."""

import zlib

import numpy as np
import pytest
from fixtures import DOCS_SCHEMA, EDGES, documents
from flowsight.llm.quality import (
    BUCKETS,
    HALVINGS,
    _buckets,
    _repeats,
    descend,
    indicators,
    learn,
    logistic,
    quality_report,
    score,
)


@pytest.fixture(scope="module")
def tables(spark):
    folder = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


def test_held_out_accuracy(tables):
    docs, labels = tables
    got = quality_report(docs, labels)
    assert got.count() == docs.count()
    out = got.filter("held_out").join(labels, "doc_id").collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    good = [r.predicted for r in out if r.quality == 1]
    bad = [r.predicted for r in out if r.quality == 0]
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) < 0.15


def test_labels_of_the_held_out_fold_do_not_matter(tables):
    docs, labels = tables
    flipped = labels.selectExpr(
        "doc_id",
        "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality",
    )
    a, b = learn(docs, labels, 300), learn(docs, flipped, 300)
    assert np.array_equal(a.weights, b.weights) and (a.bias, a.slope, a.shift) == (b.bias, b.slope, b.shift)
    held = {r.doc_id: r.held_out for r in score(docs, a).collect()}
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in held.items())


def test_descent_minimises_the_hinge_loss():
    rng = np.random.default_rng(4)
    rows = [np.unique(rng.integers(0, 12, 5)) for _ in range(80)]
    labels = np.array([float(3 in r or 5 in r) for r in rows])
    scale = rng.normal(size=12)
    w, bias = descend(rows, labels, scale, cost=0.7, epochs=2000)
    x = np.zeros((80, 12))
    for i, at in enumerate(rows):
        x[i, at] = scale[at] / np.sqrt(scale[at] @ scale[at])
    sign = np.where(labels > 0, 1, -1)
    weight = 0.7 / (2 * np.where(labels > 0, labels.mean(), 1 - labels.mean()))

    def loss(w, b):
        return (w @ w + b * b) / 2 + (weight * np.maximum(0, 1 - sign * (x @ w + b))).sum()

    best = loss(w, bias)
    for size in (1e-2, 1e-1, 1):
        assert all(loss(w + d[1:] * size, bias + d[0] * size) > best for d in rng.normal(size=(50, 13)))
    slope, shift = logistic(x @ w + bias, labels)
    assert slope > 0 and np.isfinite(shift)


def test_indicators():
    assert len(indicators("")) == 0 and indicators("ab cd").max() < BUCKETS
    assert np.array_equal(indicators("x y " * 10), np.unique(indicators("x y " * 10)))
    assert len(np.setdiff1d(indicators("w w w w w w w"), indicators("w"))) >= 5


def test_repeats_do_not_depend_on_blocks():
    rng = np.random.default_rng(1)
    half = " ".join(f"w{i}" for i in rng.integers(0, 1 << 30, 120_000))
    text = f"{half} {half}"  # longer than a block
    assert len(text) > 2_000_000
    whole = np.fromiter((zlib.crc32(w.encode()) for w in text.split()), np.uint64)
    assert _repeats(whole).tolist() == [(1 << 41) + HALVINGS + k for k in range(2, HALVINGS)]
    assert np.isin(_buckets(_repeats(whole)), indicators(text)).all()
    assert len(_repeats(whole[: len(whole) // 2])) == 0


def test_scores_equal_a_plain_version(tables):
    """The whole model from its parts, in Python over all labelled rows."""
    docs, labels = tables
    model = learn(docs, labels)
    known = {r.doc_id: r.quality for r in labels.collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = sorted(i for i in known if i in texts and zlib.crc32(str(i).encode()) % 5)
    counts = np.ones((2, BUCKETS))
    for i in rows:
        counts[known[i], indicators(texts[i])] += 1
    scale = np.log((counts[1] / counts[1].sum()) / (counts[0] / counts[0].sum()))
    assert np.allclose(model.scale, scale)
    y = np.array([known[i] for i in rows], float)
    found = [indicators(texts[i]) for i in rows]
    train = [k for k in range(len(rows)) if k % 5]
    w, bias = descend([found[k] for k in train], y[train], scale)
    assert np.allclose(model.weights, w * scale) and abs(model.bias - bias) < 1e-9
    got = {r.doc_id: r.score for r in score(docs, model).collect()}
    for i in list(texts)[:50]:
        at = indicators(texts[i])
        margin = (w[at] @ scale[at]) / (np.sqrt(scale[at] @ scale[at]) or 1.0) + bias
        assert abs(got[i] - 1 / (1 + np.exp(-(model.slope * margin + model.shift)))) < 1e-9


def test_awkward_rows(spark, tables):
    docs, labels = tables
    model = learn(docs, labels, 200)
    rows = documents(spark, EDGES, True)
    got = score(rows, model).collect()
    assert len(got) == len(EDGES)
    by_doc = {}
    for r in got:
        assert by_doc.setdefault(r.doc_id, r.score) == r.score or r.doc_id == 10
    assert by_doc[1] == by_doc[2]
    assert [r.held_out for r in got if r.doc_id is None] == [True]


def test_one_class_and_nothing(spark):
    one = spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(i, f"text {i}", None, None, 0) for i in range(40)], DOCS_SCHEMA)
    assert {r.predicted for r in quality_report(docs, one).collect()} == {1}
    none = one.filter("false")
    assert {r.score for r in quality_report(docs, none).collect()} == {0.5}
    assert quality_report(documents(spark, []), none).count() == 0
