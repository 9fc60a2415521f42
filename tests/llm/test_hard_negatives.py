"""Hard negatives against all pairs in Python, and the bounds of the scan."""

import math

import numpy as np
import pytest
from flowsight.llm.hard_negatives import (
    Shard,
    hard_negative_report,
    hard_negatives,
    negatives_in,
    positives_in,
    vertical_scan,
    window_of,
)

SCHEMA = "vec_id long, embedding array<double>, label int, shard string, uid string, score string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, c, "x", "y", "z") for i, v, c in rows], SCHEMA)


def plain(rows):
    """The contract, row by row; rows are (vec_id, vector, label)."""
    usable = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = int(math.fmod(label + 1, 10)) if i % 7 == 0 else label
        usable.append((i, [math.floor(256 * x) for x in v], label))
    out = []
    for a, q, label in usable:
        if a % 50:
            continue
        others = [
            (-sum(x * y for x, y in zip(q, v)), i, c == label)
            for i, v, c in usable
            if i != a and len(v) == len(q)
        ]
        for s, p, _ in sorted(o for o in others if o[2])[:5]:
            hard = sorted(o for o in others if not o[2] and -50 * s <= -100 * o[0] <= -95 * s)[:3]
            out += [(a, p, k + 1, i, -s, -n) for k, (n, i, _) in enumerate(hard)]
    return sorted(out)


def got(report):
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in report.select(columns).collect())


def random_rows(n, size=12, seed=3, labels=3):
    random = np.random.default_rng(seed)
    return [
        (int(i), (random.normal(size=size) + 0.4).tolist(), int(c))
        for i, c in zip(random.permutation(n), random.integers(0, labels, n))
    ]


def test_equals_all_pairs(spark):
    rows = random_rows(400)
    want = plain(rows)
    assert len(want) > 60
    assert got(hard_negative_report(frame(spark, rows))) == want


def test_any_number_of_shards_gives_the_same(spark):
    rows = random_rows(150)
    made = hard_negatives(frame(spark, rows), lambda i: i % 50 == 0, shard_values=12 * 20)
    same = hard_negatives(frame(spark, rows), lambda i: i % 50 == 0)
    assert got(made) == got(same) != []


def test_nulls_ties_repeats_lengths(spark):
    one = [0.5, 0.25, 1.0]
    rows = [(i, one, i % 2) for i in range(100, 112)]  # all tie
    rows += [(i, [0.25, 0.5, 0.5], 1) for i in (7, 14, 21, 150, 150)]  # the label of 7, 14, 21 becomes 2
    rows += [(0, [0.125] * 3, 0), (0, [0.125] * 3, 0), (None, one, 0), (3, None, 0), (4, one, None)]
    rows += [(5, [0.5, None, 1.0], 0), (6, [0.5, float("nan"), 1.0], 0), (8, [float("inf"), 1.0, 1.0], 0)]
    rows += [(200, [1.0, 2.0], 1), (201, [1.0, 2.0], 1), (202, [1.0, 1.2], 2), (250, [], 1), (251, [], 1), (252, [], 3)]
    rows += [(300, [-1.0, 0.0, 0.0], 5), (301, [1.0, 0.0, 0.0], 5)]  # a negative positive has no window
    assert got(hard_negative_report(frame(spark, rows))) == plain(rows)


def test_large_components_are_exact(spark):
    rows = [(0, [3e5, 1.0], 1), (1, [3e5, 1.0], 1), (2, [2.5e5, 7.0], 2), (3, [2.5e5, 9.0], 2)]
    assert got(hard_negative_report(frame(spark, rows))) == plain(rows)
    beyond = [(0, [1e300], 1), (1, [1e300], 1), (2, [1e10], 2)]
    assert got(hard_negative_report(frame(spark, beyond))) == []  # cut to the largest long: the window lies above


def test_empty_tables(spark):
    assert got(hard_negative_report(frame(spark, []))) == []
    assert got(hard_negative_report(frame(spark, [(1, [1.0], 1), (2, [1.0], 2)]))) == []


@pytest.mark.parametrize("kind", [float, object])
def test_scan_drops_only_what_is_out_of_reach(kind):
    random = np.random.default_rng(1)
    values = np.floor(random.normal(size=(500, 40)) * 100).astype(kind)
    shard = Shard(np.arange(500), random.integers(0, 2, 500), values)
    query = np.floor(random.normal(size=40) * 100)
    exact = (values.astype(float) @ query).astype(int)
    seen = []

    def keep(low, high):
        seen.append(len(low))
        return high >= np.sort(low)[-5]

    rows, score = vertical_scan(shard, query, np.arange(500), keep)
    assert (exact[rows] == score).all()
    assert set(np.argsort(-exact)[:5]) <= set(rows.tolist())
    assert seen[-1] < seen[0]
    own = shard.labels == 1
    best = sorted((-exact[i], i) for i in np.flatnonzero(own))[:5]
    assert positives_in(shard, -1, 1, query, 5) == [(-s, i) for s, i in best]
    windows = [window_of(int(s), 50, 95) for s in np.sort(exact)[-3:]]
    found = negatives_in(shard, -1, 1, query, windows, 3)
    for (low, high), best in zip(windows, found):
        inside = sorted((-exact[i], i) for i in np.flatnonzero(~own) if low <= exact[i] <= high)
        assert best == [(-s, i) for s, i in inside[:3]]
