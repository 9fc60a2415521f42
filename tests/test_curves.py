"""Curves and positions against plain Python."""

import random

import pytest

from flowsight.operators import curves, sampling


def frame(spark, rows):
    return spark.createDataFrame(rows, "logistic double, isFraud int").repartition(5)


def plain(rows):
    rows = [r for r in rows if None not in r]
    out, tp, fp = [], 0, 0
    for s in sorted({s for s, _ in rows}, reverse=True):
        tp += sum(1 for x, y in rows if x == s and y == 1)
        fp += sum(1 for x, y in rows if x == s and y != 1)
        out.append((s, tp, fp))
    return out


def pairs_area(rows):
    up = [s for s, y in rows if y == 1]
    down = [s for s, y in rows if y != 1]
    return sum((a > b) + 0.5 * (a == b) for a in up for b in down) / (len(up) * len(down))


def test_curve_and_areas(spark):
    pick = random.Random(1)
    rows = [(round(pick.random() ** 3, 2), int(pick.random() < 0.3)) for _ in range(500)] + [(0.5, 0)] * 300
    want = plain(rows)
    got = curves.curve(frame(spark, rows)).orderBy("score", ascending=False).collect()
    assert [(r["score"], r["true_positives"], r["false_positives"]) for r in got] == want
    p, n = want[-1][1:]
    for r in got:
        assert r["recall"] == pytest.approx(r["true_positives"] / p)
        assert r["false_positive_rate"] == pytest.approx(r["false_positives"] / n)
        assert r["precision"] == pytest.approx(r["true_positives"] / (r["true_positives"] + r["false_positives"]))
    area = curves.areas(frame(spark, rows)).first()
    assert area["roc_area"] == pytest.approx(pairs_area(rows))
    before, steps = 0, 0.0
    for _, tp, fp in want:
        steps += (tp - before) / p * tp / (tp + fp)
        before = tp
    assert area["average_precision"] == pytest.approx(steps)


def test_empty_classes_and_nulls(spark):
    assert curves.areas(frame(spark, [])).first().asDict() == {
        "positives": 0, "negatives": 0, "roc_area": None, "average_precision": None,
    }
    one = curves.areas(frame(spark, [(0.5, 1), (0.7, 1), (None, 0), (0.3, None)])).first()
    assert (one["positives"], one["negatives"], one["roc_area"]) == (2, 0, None)
    assert curves.curve(frame(spark, [(0.5, 1)])).first()["false_positive_rate"] is None
    assert curves.areas(frame(spark, [(0.5, 1), (0.5, 0), (float("nan"), 1)])).first()["roc_area"] == 0.75


def test_positions(spark):
    rows = spark.range(5000).selectExpr("CAST(id AS STRING) AS k", "id % 7 AS _n").repartition(6)
    got = sampling.with_position(rows, "k", seed=3)
    assert got.columns == ["k", "_n", "position"]
    order = [r["k"] for r in got.orderBy("position").collect()]
    assert sorted(r["position"] for r in got.collect()) == list(range(1, 5001))
    assert order == [r["k"] for r in sampling.shuffle_rows(rows, "k", 3).collect()]
    first = {r["k"] for r in sampling.take_seeded(rows, "k", 3, rows=700).collect()}
    assert first == set(order[:700])
    twice = sampling.with_position(rows.unionByName(rows), "k", seed=3)
    assert sorted(r["position"] for r in twice.collect()) == list(range(1, 10001))
    assert sampling.with_position(rows.limit(0), "k").count() == 0
