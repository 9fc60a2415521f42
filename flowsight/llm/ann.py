"""Approximate nearest neighbours with robust-pruned directed graphs, one a shard.

Vectors are dealt to shards by a hash of their values. A shard's graph starts random; then, in blocks,
greedy searches propose neighbours for each node and relaxed distance pruning keeps the diverse ones:
a candidate goes if one already kept is `alpha` times nearer to it than the node itself. Edges are
added in both directions and pruned again where a node has too many. A query walks every shard's graph
with a beam; its best rows of all shards are merged. Scores are cosines in double precision.

Every row is indexed. Equal vectors are one node; since a query wants `k` rows besides its own, only
the `k` + 1 smallest vec_ids of a vector can be in an answer, so copies beyond these are left out
before the shuffle, by a window with a group limit. For a search a shard is sent to one task, and the queries
stream past it in blocks.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no part,
nor do rows without vec_id; of rows that repeat a vec_id the one with the smaller vector counts;
vectors of different lengths are never compared; ties go to the smaller vec_id; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

SHARD_ROWS = 4096
DEGREE = 32
BUILD_BEAM = 64
SEARCH_BEAM = 100
ALPHA = 1.1
EXPAND = 4
BLOCK = 256


def beam_search(
    points: np.ndarray, links: np.ndarray, entry: int, queries: np.ndarray, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, cosines) of the best `beam` nodes met, best first; -1 where there are fewer.

    Every round each query's best `EXPAND` unvisited nodes are visited, all queries together.
    """
    n = len(queries)
    rows = np.arange(n)[:, None]
    ids = np.full((n, beam), -1)
    near = np.full((n, beam), -np.inf, np.float32)
    ids[:, 0], near[:, 0] = entry, queries @ points[entry]
    open_ = np.zeros((n, beam), bool)
    open_[:, 0] = True
    seen = np.zeros((n, len(points) + 1), bool)
    seen[:, entry] = seen[:, -1] = True  # -1 stands for no link
    step = min(EXPAND, beam)
    while open_.any():
        waiting = np.where(open_, near, -np.inf)
        pick = np.argpartition(-waiting, step - 1, axis=1)[:, :step]
        chosen = np.where(open_[rows, pick], ids[rows, pick], -1)
        open_[rows, pick] = False
        found = np.where(chosen[:, :, None] >= 0, links[chosen], -1).reshape(n, -1)
        found = np.where(seen[rows, found], -1, found)
        found.sort(axis=1)
        found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
        seen[rows, found] = True
        width = int((found >= 0).sum(axis=1).max(initial=0))
        if not width:
            continue
        found = -np.sort(-found, axis=1)[:, :width]
        cosine = np.einsum("qd,qkd->qk", queries, points[found])
        cosine[found < 0] = -np.inf
        all_ids = np.concatenate([ids, found], axis=1)
        all_near = np.concatenate([near, cosine], axis=1)
        all_open = np.concatenate([open_, found >= 0], axis=1)
        best = np.argpartition(-all_near, beam - 1, axis=1)[:, :beam]
        ids, near, open_ = all_ids[rows, best], all_near[rows, best], all_open[rows, best]
    order = np.argsort(-near, axis=1, kind="stable")
    return ids[rows, order], near[rows, order]


def robust_prune(points: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, alpha: float, degree: int) -> np.ndarray:
    """For each node its kept neighbours out of the candidates (-1: none), at most `degree`."""
    n, width = candidates.shape
    rows = np.arange(n)
    order = np.sort(np.where(candidates == nodes[:, None], -1, candidates), axis=1)
    order[:, 1:][order[:, 1:] == order[:, :-1]] = -1
    vectors = points[order]
    away = 1 - np.einsum("nd,nkd->nk", points[nodes], vectors)  # half the squared distance
    alive = order >= 0
    kept = np.full((n, degree), -1)
    for k in range(degree):
        if not alive.any():
            break
        pick = np.where(alive, away, np.inf).argmin(axis=1)
        some = alive[rows, pick]
        kept[some, k] = order[rows, pick][some]
        between = 1 - np.einsum("nd,nkd->nk", vectors[rows, pick], vectors)
        alive &= alpha * alpha * between > away
        alive[rows, pick] = False
    return kept


def _add_back_links(points: np.ndarray, links: np.ndarray, nodes: np.ndarray, alpha: float) -> None:
    """Adds the reverse of the links of `nodes`; a full node is pruned again."""
    degree = links.shape[1]
    source, target = np.repeat(nodes, degree), links[nodes].ravel()
    source, target = source[target >= 0], target[target >= 0]
    if not len(source):
        return
    order = np.lexsort((source, target))
    source, target = source[order], target[order]
    owners, first, count = np.unique(target, return_index=True, return_counts=True)
    by_size = np.argsort(count, kind="stable")
    for part in np.array_split(by_size, -(-len(by_size) // BLOCK)):
        width = count[part].max()
        at = first[part][:, None] + np.arange(width)
        new = np.where(np.arange(width) < count[part][:, None], source[np.minimum(at, len(source) - 1)], -1)
        merged = np.concatenate([links[owners[part]], new], axis=1)
        links[owners[part]] = robust_prune(points, owners[part], merged, alpha, degree)


@dataclass
class Graph:
    points: np.ndarray
    links: np.ndarray
    entry: int


def build_graph(points: np.ndarray, seed: int = 0) -> Graph:
    """Unit vectors, all different, in float32; two passes, the second with relaxed pruning."""
    n = len(points)
    rng = np.random.default_rng(seed)
    degree = max(1, min(DEGREE, n - 1))
    links = rng.integers(0, n, (n, degree))
    links[links == np.arange(n)[:, None]] = -1
    entry = int((points @ points.mean(axis=0)).argmax())
    for alpha in (1.0, ALPHA):
        for nodes in np.array_split(rng.permutation(n), -(-n // BLOCK)):
            met, _ = beam_search(points, links, entry, points[nodes], min(BUILD_BEAM, n))
            links[nodes] = robust_prune(points, nodes, np.concatenate([met, links[nodes]], axis=1), alpha, degree)
            _add_back_links(points, links, nodes, alpha)
    return Graph(points, links, entry)


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding array<double>), one row for each vec_id that takes part."""
    wide = vectors.select(
        vectors["vec_id"].cast("long").alias("vec_id"),
        vectors["embedding"].cast("array<double>").alias("embedding"),
    )
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    fits = wide.filter(F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda x: x != 0))
    return fits.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def scaled(exact: np.ndarray) -> np.ndarray:
    """The vectors, each times a power of two: no digit and no cosine changes, no square overflows."""
    _, exponent = np.frexp(np.abs(exact).max(axis=1, keepdims=True))
    return np.ldexp(exact, -exponent)


def build_index(vectors: DataFrame, k: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(dim, shard, vec_id, embedding, node, entry, links) of `valid_vectors`, written.

    The first row of a node has its links.
    """
    copies = Window.partitionBy("embedding").orderBy("vec_id")
    rows = vectors.withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= k + 1)
    shards = max(1, -(-vectors.count() // shard_rows))
    dealt = rows.select(
        F.size("embedding").alias("dim"),
        F.pmod(F.xxhash64("embedding"), F.lit(shards)).cast("int").alias("shard"),
        "vec_id",
        "embedding",
    )

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("vec_id", ignore_index=True)
        exact = scaled(np.stack(rows["embedding"].to_numpy()))
        unit = exact / np.sqrt((exact * exact).sum(axis=1, keepdims=True))
        _, first, node = np.unique(np.round(unit, 5), axis=0, return_index=True, return_inverse=True)
        graph = build_graph(unit[first].astype(np.float32))
        rows["node"] = node.ravel()
        rows["entry"] = graph.entry
        heads = [graph.links[c] if first[c] == i else None for i, c in enumerate(node.ravel())]
        rows["links"] = pd.Series(heads, dtype=object)
        return rows

    schema = "dim int, shard int, vec_id long, embedding array<double>, node int, entry int, links array<int>"
    # a number of partitions that is asked for stays: shards are heavy however few their bytes
    dealt = dealt.repartition(shards, "dim", "shard")
    return written(dealt.groupBy("dim", "shard").applyInPandas(build, schema), "ann-index")


class Shard:
    """A shard's rows with their graph, ready to be searched."""

    def __init__(self, rows: pa.Table, dim: int):
        self.ids = rows["vec_id"].to_numpy()
        self.exact = scaled(_vectors(rows["embedding"], dim))
        self.length = np.sqrt((self.exact * self.exact).sum(axis=1))
        self.entry = rows["entry"][0].as_py()
        node, links = rows["node"].to_numpy(), rows["links"].combine_chunks()
        heads = np.flatnonzero(links.is_valid().to_numpy(zero_copy_only=False))
        heads = heads[np.argsort(node[heads])]
        self.points = (self.exact / self.length[:, None])[heads].astype(np.float32)
        self.links = np.array([links[int(i)].as_py() for i in heads], np.int64).reshape(len(heads), -1)
        self.members = np.argsort(node, kind="stable")
        self.cuts = np.searchsorted(node[self.members], np.arange(len(heads) + 1))

    def best(self, query_ids: np.ndarray, queries: np.ndarray, k: int, beam: int) -> tuple[list, list, list]:
        """(query_id, vec_id, score): the best `k` of all rows that a beam of `beam` nodes has met, by exact score."""
        wanted = scaled(queries)
        wanted_length = np.sqrt((wanted * wanted).sum(axis=1))
        unit = (wanted / wanted_length[:, None]).astype(np.float32)
        found, _ = beam_search(self.points, self.links, self.entry, unit, min(beam, len(self.points)))
        out: tuple[list, list, list] = ([], [], [])
        for q, nodes in enumerate(found.tolist()):
            at = np.concatenate([self.members[self.cuts[c] : self.cuts[c + 1]] for c in nodes if c >= 0])
            at = at[self.ids[at] != query_ids[q]]
            score = (self.exact[at] * wanted[q]).sum(axis=1) / (self.length[at] * wanted_length[q])
            best = np.lexsort((self.ids[at], -score))[:k]
            for column, values in zip(out, ([query_ids[q]] * len(best), self.ids[at[best]], score[best])):
                column += list(values)
        return out


def _vectors(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy().reshape(-1, dim)


def search(index: DataFrame, queries: DataFrame, k: int, beam: int = SEARCH_BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score): the `k` best rows found for each of `queries`, but for itself.

    `queries` are rows of `valid_vectors`, whether indexed or not. A task holds one shard at a time, which is sent
    to it once, and the queries of its length stream past.
    """
    shards = (index.agg(F.max("shard").alias("last")).first()["last"] or 0) + 1
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    asked = queries.select(F.size("embedding").alias("dim"), every, F.lit(True).alias("asked"), "vec_id", "embedding")
    both = index.withColumn("asked", F.lit(False)).unionByName(asked, allowMissingColumns=True)
    both = both.repartitionById(shards, "shard").sortWithinPartitions("shard", "dim", "asked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, parts, shard = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("shard", "dim")])
            is_query = batch.column("asked").to_numpy(zero_copy_only=False)
            change = np.flatnonzero((np.diff(keys) != 0).any(axis=0) | (np.diff(is_query.astype(int)) != 0)) + 1
            cuts = [0, *change.tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                here = tuple(keys[:, a].tolist())
                if here != place:
                    place, parts, shard = here, [], None
                part = batch.slice(a, b - a)
                if not is_query[a]:
                    parts.append(part)
                    continue
                if shard is None and parts:
                    shard, parts = Shard(pa.Table.from_batches(parts), here[1]), []
                for at in range(0, part.num_rows if shard else 0, BLOCK):
                    some = part.slice(at, BLOCK)
                    columns = shard.best(some["vec_id"].to_numpy(), _vectors(some["embedding"], here[1]), k, beam)
                    kinds = (pa.int64(), pa.int64(), pa.float64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, kinds)], names=["query_id", "vec_id", "score"]
                    )

    found = both.mapInArrow(run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def nearest_report(vectors: DataFrame, k: int = 5) -> DataFrame:
    """The `k` nearest of every row whose vec_id is divisible by 50, among all others."""
    rows = written(valid_vectors(vectors), "vectors")
    return search(build_index(rows, k), rows.filter(F.col("vec_id") % 50 == 0), k)
