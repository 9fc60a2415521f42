"""Nearest neighbours against brute force, and the pieces of the graph."""

import numpy as np
import pytest
from flowsight.llm import ann
from flowsight.llm.ann import beam_search, build_graph, build_index, nearest_report, robust_prune, search, valid_vectors

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k=5):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(np.float64)
    length = np.sqrt((x * x).sum(axis=1))
    want = {}
    for q in np.flatnonzero(ids % 50 == 0):
        score = (x * x[q]).sum(axis=1) / (length * length[q])
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != ids[q]][:k]
        want[int(ids[q])] = [(int(ids[i]), float(score[i])) for i in order]
    return want


def found(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.fixture(scope="module")
def embeddings(spark):
    return spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")


def test_recall_and_scores(embeddings):
    rows = [(r.vec_id, r.embedding) for r in embeddings.collect()]
    want, got = brute(rows), found(nearest_report(embeddings))
    assert set(got) == set(want)
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want]
    assert sum(hits) / (5 * len(want)) >= 0.95
    scores = {(q, i): s for q, best in want.items() for i, s in best}
    assert all(abs(scores.get((q, i), s) - s) < 1e-12 for q, best in got.items() for i, s in best)


def test_many_shards_and_blocks(embeddings, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 9)
    rows = valid_vectors(embeddings)
    index = build_index(rows, 5, shard_rows=150)
    assert index.select("shard").distinct().count() > 8
    got = found(search(index, rows.filter("vec_id % 50 = 0"), 5))
    want = brute([(r.vec_id, r.embedding) for r in embeddings.collect()])
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want]
    assert sum(hits) / (5 * len(want)) >= 0.95


def test_copies_ties_and_bad_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(300)]
    rows += [(1000 + i, [1.0, 2, 3, 4, 5, 6]) for i in range(200)]
    rows += [(2000, [2.0, 4, 6, 8, 10, 12]), (2001, [1e-30, 2e-30, 3e-30, 4e-30, 5e-30, 6e-30])]
    bad = [(50 * 100, None), (50 * 101, [0.0] * 6), (50 * 102, [1.0, None, 0, 0, 0, 0]), (50 * 103, [float("nan")] * 6)]
    bad += [(50 * 104, [float("inf"), 1, 1, 1, 1, 1]), (None, [1.0] * 6), (50 * 105, [])]
    bad = [(i, v and [x if x is None else float(x) for x in v]) for i, v in bad]
    rows = [(i, [float(x) for x in v]) for i, v in rows]
    frame = spark.createDataFrame(rows + bad + rows[:5], SCHEMA).selectExpr("*", "'x' AS shard", "1 AS copy", "2 AS node")
    got, want = found(nearest_report(frame)), brute(rows)
    assert set(got) == set(want)
    for q in want:
        assert [round(s, 12) for _, s in got[q]] == [round(s, 12) for _, s in want[q]]
        if 1000 <= q < 2000:
            assert len({i for i, _ in got[q]}) == 5 and q not in {i for i, _ in got[q]}
    assert [i for i, _ in got[1050]] == [1000, 1001, 1002, 1003, 1004]


def test_few_rows_and_other_lengths(spark):
    rows = [(0, [1.0, 0.0]), (50, [1.0, 0.0, 0.0]), (51, [0.0, 1.0, 0.0])]
    got = found(nearest_report(spark.createDataFrame(rows, SCHEMA)))
    assert got == {50: [(51, 0.0)]}
    assert nearest_report(spark.createDataFrame([], SCHEMA)).count() == 0


def test_pruning_keeps_diverse_neighbours():
    angles = np.array([0.0, 0.1, 0.11, -0.3, 3.0])
    points = np.stack([np.cos(angles), np.sin(angles)], axis=1).astype(np.float32)
    kept = robust_prune(points, np.array([0]), np.array([[1, 2, 3, 4, 1, 0, -1]]), 1.0, 4)
    assert kept.tolist() == [[1, 3, -1, -1]]


def test_graph_is_searchable():
    rng = np.random.default_rng(0)
    points = rng.normal(size=(700, 16)).astype(np.float32)
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    graph = build_graph(points)
    assert (graph.links < 700).all() and not (graph.links == np.arange(700)[:, None]).any()
    ids, near = beam_search(points, graph.links, graph.entry, points[:50], 30)
    assert (ids[:, 0] == np.arange(50)).mean() > 0.95
    assert (np.diff(near, axis=1) <= 0).all()
