"""Exact largest inner products by ball trees, one per shard."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import map_batches, stored
from tripflow.llm.vectors import (
    cell_counts,
    centres,
    in_shards,
    matrix,
    nearest_centre,
    queries_of,
    sample,
    search_shards,
    shard_rows,
    stored_entries,
    top_rows,
    valid_vectors,
)

NEIGHBOURS = 10
QUERY_MODULUS = 100
SCALE = 1024
CLUSTERS = 64
TRAIN_ROWS = 8_192
CUT_ROWS = 65_536  # sampled rows by which large clusters are cut
CELL_SAMPLE = 16  # of them at least in a cell
SEEDS = 3  # cells searched first
LEAF = 32
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1


def scaled(points: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(points * scale)


def products(points: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Integer inner products as longs; beyond a long's range, the nearest long.

    Doubles hold every sum exactly while it stays below 2^53 in any order; larger
    components are multiplied as whole numbers of any size.
    """
    most = np.abs(points).max(initial=0) * np.abs(query).max(initial=0) * points.shape[1]
    if most < _EXACT:
        return (points @ query).astype(np.int64)
    whole = [int(x) for x in query]
    sums = [sum(int(x) * y for x, y in zip(row, whole, strict=True)) for row in points]
    return np.array([min(max(s, -_LONG - 1), _LONG) for s in sums], dtype=np.int64)


def lowered(score: float) -> float:
    """A bound no score that rounds to the same double falls under."""
    return score - abs(score) * 1e-15


class Cells:
    """Cells with a ball each: clusters, large ones cut by the top levels of their own tree.

    A cluster of more than ``most`` sampled rows is halved along its widest axis until each
    cell has at most so many, or too few to be cut.
    """

    def __init__(self, points: np.ndarray, middle: np.ndarray, most: int) -> None:
        self.middle = middle
        near = nearest_centre(points, middle) if len(points) else np.zeros(0, dtype=np.int64)
        parts = [(np.flatnonzero(near == c), middle[c]) for c in range(len(middle))]
        axis, cut, below, cell, centre = [], [], [], [], []
        for own, fallback in parts:  # grows while nodes are cut; a cut node's halves are neighbours
            along, at = self._cut(points[own]) if len(own) > max(most, 2 * CELL_SAMPLE) else (-1, 0.0)
            axis.append(along)
            cut.append(at)
            below.append(len(parts))
            cell.append(len(centre))
            if along < 0:
                centre.append(points[own].mean(axis=0) if len(own) else fallback)
                continue
            over = points[own, along] > at
            parts += [(own[~over], fallback), (own[over], fallback)]
        self.axis, self.below, self.cell = (np.array(x, dtype=np.int64) for x in (axis, below, cell))
        self.cut = np.array(cut)
        self.centre = np.array(centre).reshape(-1, middle.shape[1])

    @staticmethod
    def _cut(points: np.ndarray) -> tuple[int, float]:
        """Widest axis and where it halves the points; no axis (-1) if all are alike."""
        wide = np.ptp(points, axis=0)
        along = int(wide.argmax())
        if wide[along] == 0:
            return -1, 0.0
        values = points[:, along]
        at = float(np.median(values))
        if at >= values.max():  # ties on the upper side
            at = float(values[values < at].max())
        return along, at

    def find(self, points: np.ndarray) -> np.ndarray:
        node = nearest_centre(points, self.middle)
        while True:
            inner = np.flatnonzero(self.axis[node] >= 0)
            if not len(inner):
                return self.cell[node]
            at = node[inner]
            node[inner] = self.below[at] + (points[inner, self.axis[at]] > self.cut[at])


class BallTree:
    """Balanced tree over a shard's rows; each node is the ball around its rows' mean.

    Halving along the widest axis gives leaves of at most ``LEAF`` rows. Level d holds 2^d
    nodes, and node i's children are 2i and 2i + 1 on the next.
    """

    def __init__(self, ids: np.ndarray, points: np.ndarray) -> None:
        parts = [np.arange(len(ids))]
        self.centre: list[np.ndarray] = []
        self.radius: list[np.ndarray] = []
        while True:
            middles = [points[p].mean(axis=0) if len(p) else np.zeros(points.shape[1]) for p in parts]
            self.centre.append(np.array(middles))
            self.radius.append(np.array([
                np.sqrt(((points[p] - m) ** 2).sum(axis=1).max()) if len(p) else -np.inf
                for p, m in zip(parts, middles, strict=True)
            ]))
            if max(map(len, parts)) <= LEAF:
                break
            halves = []
            for p in parts:
                if len(p) < 2:
                    halves += [p, p[:0]]
                    continue
                axis = np.ptp(points[p], axis=0).argmax()
                order = p[np.argpartition(points[p, axis], len(p) // 2)]
                halves += [order[: len(p) // 2], order[len(p) // 2 :]]
            parts = halves
        self.leaves = [(points[p], ids[p]) for p in parts]

    def bounds(self, query: np.ndarray, length: float, level: int) -> np.ndarray:
        """Upper bounds of the product with anything in each node, rounded outwards."""
        reach = self.centre[level] @ query
        far = length * self.radius[level]
        return reach + far + 1e-9 * (np.abs(reach) + np.abs(far) + 1)

    def best(self, query: np.ndarray, own: int, k: int, bound: float) -> tuple[np.ndarray, np.ndarray]:
        """Up to ``k`` best rows with a product of ``bound`` or more.

        Nodes are left with all below them once their upper bound is under the k-th best
        product so far, at first the one shared by the caller. Leaves are taken by falling
        bound, so the first one under it ends the search.
        """
        length = float(np.sqrt(query @ query))
        alive = np.zeros(1, dtype=np.int64)
        for level in range(len(self.centre)):
            if level:
                alive = np.concatenate([2 * alive, 2 * alive + 1])
            reach = self.bounds(query, length, level)[alive]
            within = reach >= bound
            alive, reach = alive[within], reach[within]
        ids, scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for at in np.argsort(-reach, kind="stable"):
            if reach[at] < bound:
                break
            points, names = self.leaves[alive[at]]
            found = products(points, query)
            good = (found >= bound) & (names != own)
            scores = np.concatenate([scores, found[good]])
            ids = np.concatenate([ids, names[good]])
            if len(ids) > k:
                order = np.lexsort((ids, ~scores))[:k]  # ~ reverses longs without overflow
                ids, scores = ids[order], scores[order]
            if len(ids) >= k:
                bound = max(bound, lowered(float(scores.min())))
        return ids, scores


def top_products(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = NEIGHBOURS,
    modulus: int = QUERY_MODULUS,
    scale: int = SCALE,
    clusters: int = CLUSTERS,
    train_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``k`` highest inner products, exactly.

    Components x count as floor(scale * x). Queries are the rows whose id is divisible by
    ``modulus``; a query's own id is no candidate; ties go to the smaller id. Rows are
    clustered around centres fitted on at most ``train_rows``, and large clusters are cut into
    cells by at most ``CUT_ROWS`` sampled rows; a cell is a shard with a ball of its own (several
    shards, if it is too large still). Each query first searches its ``SEEDS`` most promising
    cells. The k-th score found there goes with it to every other cell whose ball may hold
    as much, where it prunes the trees from the start. Null ids and vectors null, empty, not
    finite or of an odd length take no part; rows repeated in full count once; with no valid
    row the result is empty; other columns are not read.
    """
    rows = valid_vectors(vectors, id_col, vector_col, allow_zero=True)
    entries = stored_entries(rows, k, "tree-rows")
    total = entries.count()
    size = shard_rows(total)
    drawn = scaled(sample(entries, max(train_rows, CUT_ROWS)), scale)
    cells = Cells(drawn, centres(drawn[:train_rows], clusters), math.ceil(size * len(drawn) / max(1, total)))
    middle = cells.centre

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            points = scaled(matrix(batch.column(1)), scale) if batch.num_rows else np.zeros((0, 1))
            cell = cells.find(points) if len(points) else np.zeros(0, dtype=np.int64)
            apart = np.sqrt(((points - middle[cell]) ** 2).sum(axis=1)) if len(points) else np.zeros(0)
            flat = pa.array(points.ravel() if len(points) else np.zeros(0))
            width = points.shape[1] if len(points) else 0
            offsets = pa.array(np.arange(len(points) + 1, dtype=np.int32) * width)
            vec = pa.ListArray.from_arrays(offsets, flat)
            return pa.RecordBatch.from_arrays(
                [batch.column(0), vec, pa.array(cell.astype(np.int32)), pa.array(apart)], ["vec_id", "vec", "cell", "apart"]
            )

        return step

    schema = "vec_id bigint, vec array<double>, cell int, apart double"
    placed = stored(map_batches(entries.select("vec_id", "vec"), schema, make), "tree-entries")
    counts = cell_counts(placed, max(1, len(middle)))
    parts = np.maximum(1, -(-counts // size))
    first = np.cumsum(parts) - parts
    radius = np.full(len(counts), -np.inf)
    for row in placed.groupBy("cell").agg(F.max("apart").alias("r")).toLocalIterator():
        radius[row["cell"]] = row["r"]
    sharded = stored(in_shards(placed, first, parts), "tree-shards")
    asked = map_batches(queries_of(rows, modulus).select(F.col("query_id").alias("vec_id"), "vec"), schema, make)
    asked = stored(asked.select(F.col("vec_id").alias("query_id"), "vec"), "tree-queries")

    def probes(queries: DataFrame, seeds: bool) -> DataFrame:
        """Shards a query must enter: its first ones, or all others its bound does not exclude."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                points = matrix(batch.column("vec"))
                reach = points @ middle.T
                far = np.sqrt((points * points).sum(axis=1))[:, None] * np.where(counts > 0, radius, 0)
                limit = np.where(counts > 0, reach + far + 1e-9 * (np.abs(reach) + far + 1), -np.inf)
                likely = np.argsort(-limit, axis=1, kind="stable")[:, :SEEDS]
                seed = np.where(np.take_along_axis(limit, likely, axis=1) > -np.inf, first[likely], -1)
                bound = batch.column("bound").to_numpy(zero_copy_only=False)
                if seeds:
                    query, shard = np.repeat(np.arange(len(points)), seed.shape[1]), seed.ravel()
                    query, shard = query[shard >= 0], shard[shard >= 0]
                else:
                    query, cell = np.nonzero((limit >= bound[:, None]) & (counts > 0))
                    times = parts[cell]
                    opens = np.cumsum(times) - times
                    query = np.repeat(query, times)
                    shard = np.repeat(first[cell], times) + np.arange(len(query)) - np.repeat(opens, times)
                    other = (shard[:, None] != seed[query]).all(axis=1)
                    query, shard = query[other], shard[other]
                chosen = batch.take(pa.array(query))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard), chosen.column("query_id"), chosen.column("vec"), chosen.column("bound"), pa.nulls(len(shard), pa.list_(pa.int32()))],
                    ["shard", "query_id", "vec", "bound", "cells"],
                )

        return queries.select("query_id", "vec", "bound").mapInArrow(
            run, "shard bigint, query_id bigint, vec array<double>, bound double, cells array<int>"
        )

    def build(ids: np.ndarray, points: np.ndarray, _: np.ndarray) -> BallTree:
        return BallTree(ids, points)

    def search(tree: BallTree, batch: pa.RecordBatch, queries: np.ndarray):
        own = batch.column("id").to_numpy()
        bound = batch.column("bound").to_numpy(zero_copy_only=False)
        out = []
        for q in range(len(queries)):
            ids, scores = tree.best(queries[q], int(own[q]), k, bound[q])
            out.append((np.full(len(ids), q), ids, scores))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    everything = F.lit(float("-inf"))
    begun = stored(
        search_shards(sharded, probes(asked.withColumn("bound", everything), True), build, search, "bigint"), "tree-seeds"
    )
    best = top_rows(begun, k, F.col("score").desc())
    kth = best.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").cast("double").alias("s"))
    bound = F.coalesce(F.when(F.col("n") >= k, F.col("s") - F.abs("s") * 1e-15), everything)
    bounded = asked.join(kth, "query_id", "left").withColumn("bound", bound)
    rest = search_shards(sharded, probes(bounded, False), build, search, "bigint")
    return top_rows(begun.unionByName(rest), k, F.col("score").desc()).select("query_id", "rank", "vec_id", "score")


ORACLE = f"""
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS e
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
    SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.e, v.e)::BIGINT AS score
    FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % {QUERY_MODULUS} = 0
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {NEIGHBOURS}
"""
