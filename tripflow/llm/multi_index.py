"""Approximate nearest neighbours by an inverted multi-index."""

from __future__ import annotations

import heapq
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
TRAIN_ROWS = 16_384
#: Centroids per half; their pairs are the index's cells, which become finer as entries grow.
CENTROIDS = (16, 512)
#: A query's cells hold together so many entries at least, and this share of the first 2,000;
#: of more entries the share falls with their tenth root, as finer cells lose fewer neighbours.
LEAST_VISITED = 512
VISITED_SHARE = 0.3
SHARED_ROWS = 2_000
MEASURED_ROWS = 50_000  # the share falls no further than recall was measured for


def centroids_for(entries: int) -> int:
    """Eight times the root of the entries, within ``CENTROIDS``."""
    return min(max(round(8 * entries**0.5), CENTROIDS[0]), CENTROIDS[1])


def visited_for(entries: int, share: float) -> int:
    """Entries that a query's cells are to hold."""
    fall = min(SHARED_ROWS / min(max(entries, 1), MEASURED_ROWS), 1.0) ** 0.1 if share < 1 else 1.0
    return min(entries, max(LEAST_VISITED, int(np.ceil(share * fall * entries))))


class MultiIndex:
    """Centroids of both vector halves; a cell is a pair of them."""

    def __init__(self, points: np.ndarray, centroids: int) -> None:
        self.half = (points.shape[1] + 1) // 2
        self.left = centres(points[:, : self.half], centroids)
        self.right = centres(points[:, self.half :], centroids)
        self.cells = max(1, len(self.left) * len(self.right))

    def cell(self, points: np.ndarray) -> np.ndarray:
        left = nearest_centre(points[:, : self.half], self.left)
        right = nearest_centre(points[:, self.half :], self.right)
        return left * len(self.right) + right

    def visit(self, point: np.ndarray, counts: np.ndarray, wanted: int) -> list[int]:
        """Cells by rising sum of both halves' distances, until they hold ``wanted`` entries.

        The heap holds the front of the pairs passed so far (multi-sequence algorithm); a pair
        enters when both pairs before it are out.
        """
        a = ((self.left - point[: self.half]) ** 2).sum(axis=1)
        b = ((self.right - point[self.half :]) ** 2).sum(axis=1)
        order_a, order_b = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
        a, b = a[order_a].tolist(), b[order_b].tolist()
        done = [0] * len(a)  # of each left centroid, how many right ones are passed
        heap = [(a[0] + b[0], 0, 0)]
        found, held = [], 0
        while heap and held < wanted:
            _, i, j = heapq.heappop(heap)
            done[i] = j + 1
            cell = int(order_a[i]) * len(b) + int(order_b[j])
            if counts[cell]:
                found.append(cell)
                held += int(counts[cell])
            if i + 1 < len(a) and done[i + 1] == j:
                heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))
            if j + 1 < len(b) and (i == 0 or done[i - 1] > j + 1):
                heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        return found


class Shard:
    """Entries of a shard, cell by cell; ``measured`` counts the distances computed."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, cells: np.ndarray) -> None:
        order = np.argsort(cells, kind="stable")
        self.ids, self.points = ids[order], points[order]
        self.squares = (self.points * self.points).sum(axis=1)
        self.cells, self.opens = np.unique(cells[order], return_index=True)
        self.ends = np.append(self.opens[1:], len(ids))
        self.measured = 0

    def nearest(self, point: np.ndarray, cells: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the ``k`` nearest entries of the asked cells, the query's own id left out."""
        place = np.flatnonzero(np.isin(self.cells, cells))
        spans = [np.arange(a, z) for a, z in zip(self.opens[place], self.ends[place], strict=True)]
        at = np.concatenate(spans) if spans else np.zeros(0, dtype=np.int64)
        at = at[self.ids[at] != own]
        self.measured += len(at)
        if len(at) > k:
            # the product form may be off in its last digits, so near ties stay in
            rough = self.squares[at] - 2 * (self.points[at] @ point) + float(point @ point)
            limit = np.partition(rough, k - 1)[k - 1]
            at = at[rough <= limit + 1e-9 * (abs(limit) + float(point @ point))]
        apart = np.sqrt(((self.points[at] - point) ** 2).sum(axis=1))
        order = np.lexsort((self.ids[at], apart))[:k]
        return self.ids[at][order], apart[order]


def _with_cell(rows: DataFrame, index: MultiIndex) -> DataFrame:
    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            cell = index.cell(matrix(batch.column(1))) if batch.num_rows else np.zeros(0)
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32))], ["vec_id", "vec", "cell"])

        return step

    return map_batches(rows.select("vec_id", "vec"), "vec_id bigint, vec array<double>, cell int", make)


def _deal_cells(counts: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """First shard of each cell and number of shards it fills.

    Neighbouring small cells share a shard; a cell of more than ``rows`` entries is split.
    """
    first, parts = np.zeros(len(counts), dtype=np.int64), np.ones(len(counts), dtype=np.int64)
    shard, held = 0, 0
    for cell, count in enumerate(counts.tolist()):
        if count > rows:
            shard += held > 0
            first[cell], parts[cell] = shard, -(-count // rows)
            shard, held = shard + int(parts[cell]), 0
            continue
        if held + count > rows:
            shard, held = shard + 1, 0
        first[cell] = shard
        held += count
    return first, parts


def _probes(queries: DataFrame, index: MultiIndex, counts: np.ndarray, first: np.ndarray, parts: np.ndarray, wanted: int) -> DataFrame:
    """One row per query and shard to look into, with the cells to look at there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = matrix(batch.column(1))
            for at, point in enumerate(points):
                cells = np.array(index.visit(point, counts, wanted), dtype=np.int64)
                shard = np.repeat(first[cells], parts[cells])
                opens = np.cumsum(parts[cells]) - parts[cells]
                shard = shard + np.arange(len(shard)) - np.repeat(opens, parts[cells])
                order = np.argsort(shard, kind="stable")
                shard, cells = shard[order], np.repeat(cells, parts[cells])[order]
                own, begins = np.unique(shard, return_index=True)
                offsets = pa.array(np.append(begins, len(cells)).astype(np.int32))
                rows = batch.slice(at, 1).take(pa.array(np.zeros(len(own), dtype=np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(own),
                        rows.column(0),
                        rows.column(1),
                        pa.nulls(len(own), pa.float64()),
                        pa.ListArray.from_arrays(offsets, pa.array(cells.astype(np.int32))),
                    ],
                    ["shard", "query_id", "vec", "bound", "cells"],
                )

    schema = "shard bigint, query_id bigint, vec array<double>, bound double, cells array<int>"
    return queries.mapInArrow(run, schema)


def nearest(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = NEIGHBOURS,
    modulus: int = QUERY_MODULUS,
    centroids: int | None = None,
    share: float = VISITED_SHARE,
    train_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` (Euclidean distance) of the neighbours found.

    Queries are the rows whose id is divisible by ``modulus``; a query's own id is no
    candidate. Every row is indexed; only the centroids are fitted on a sample of at most
    ``train_rows``; there are ``centroids`` for each half, or as many as ``centroids_for`` says. A
    query visits the cells nearest to it until they hold as many entries as ``visited_for``
    makes of ``share`` (1 makes the search exact), and those entries alone are ranked by
    their exact distance, ties by the smaller id. Rows of null id and vectors null, empty, zero, not
    finite or of an odd length take no part; rows repeated in full count once. With no valid
    row the result is empty, and other columns are not read.
    """
    rows = valid_vectors(vectors, id_col, vector_col, allow_zero=False)
    entries = stored_entries(rows, k, "index-rows")
    index = MultiIndex(sample(entries, train_rows), centroids or centroids_for(entries.count()))
    entries = stored(_with_cell(entries, index), "index-entries")
    counts = cell_counts(entries, index.cells)
    total = int(counts.sum())
    first, parts = _deal_cells(counts, shard_rows(total))
    wanted = max(k + 1, visited_for(total, share))
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    queries = queries_of(rows, modulus).repartition(tasks, "query_id")  # few bytes, but much to traverse
    probes = _probes(queries, index, counts, first, parts, wanted)

    def search(held: Shard, batch: pa.RecordBatch, queries: np.ndarray):
        own, asked = batch.column("id").to_numpy(), batch.column("cells")
        out = []
        for q in range(len(queries)):
            ids, apart = held.nearest(queries[q], asked[q].values.to_numpy(), int(own[q]), k)
            out.append((np.full(len(ids), q), ids, apart))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    found = search_shards(in_shards(entries, first, parts), probes, Shard, search, "double")
    return top_rows(found, k, F.col("score").asc()).select("query_id", "rank", "vec_id", "score")
