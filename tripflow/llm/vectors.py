"""What the vector searches share: valid rows, copies, clusters, and the search of shards."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.llm.common import run_starts, spans_of, stored

#: Rows of a shard: a 64th of all, within these limits.
SHARD_ROWS = (256, 4096)
SHARDS = 64


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def valid_vectors(df: DataFrame, id_col: str, vector_col: str, allow_zero: bool) -> DataFrame:
    """``vec_id`` and ``vec`` (doubles) of the rows that take part; equal rows count once.

    Left out are null ids, null and empty vectors, null, NaN and infinite components, where
    asked zero vectors, and vectors of another length than most (the shorter, on a tie).
    """
    rows = df.select(
        F.col(f"`{id_col}`").cast("bigint").alias("vec_id"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vec"),
    ).filter("vec_id IS NOT NULL AND vec IS NOT NULL AND size(vec) > 0")
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.coalesce(finite, F.lit(False)))
    if not allow_zero:
        rows = rows.filter(F.exists("vec", lambda x: x != 0.0))
    lengths = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    length = lengths[0]["n"] if lengths else 1
    return rows.filter(F.size("vec") == length).dropDuplicates(["vec_id", "vec"])


def first_copies(rows: DataFrame, k: int) -> DataFrame:
    """The ``k + 1`` smallest ids of every distinct vector.

    No other copy can be among a query's ``k`` nearest, itself left out, so nothing is
    lost; each task cuts its copies to so many before the shuffle.
    """
    copies = Window.partitionBy("vec").orderBy("vec_id")
    return rows.withColumn("_copy", F.row_number().over(copies)).filter(F.col("_copy") <= k + 1).drop("_copy")


def sample(rows: DataFrame, limit: int) -> np.ndarray:
    """At most ``limit`` vectors, the same ones on every run."""
    found = rows.orderBy(F.xxhash64("vec_id"), "vec_id").select("vec").limit(limit).toArrow()
    if not found.num_rows:
        return np.zeros((0, 1))
    return matrix(found.column(0).combine_chunks())


def nearest_centre(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)


def centres(points: np.ndarray, count: int, rounds: int = 10, seed: int = 7) -> np.ndarray:
    """k-means centres of distinct points; fewer if there are fewer points."""
    if not points.size:
        return np.zeros((min(1, len(points)), points.shape[1]))
    distinct = np.unique(points, axis=0)
    if len(distinct) <= count:
        return distinct
    found = distinct[np.random.default_rng(seed).choice(len(distinct), count, replace=False)]
    for _ in range(rounds):
        near = nearest_centre(points, found)
        for c in range(count):
            own = points[near == c]
            if len(own):
                found[c] = own.mean(axis=0)
    return found


def shard_rows(total: int) -> int:
    return min(max(math.ceil(total / SHARDS), SHARD_ROWS[0]), SHARD_ROWS[1])


def top_rows(found: DataFrame, k: int, best: Column) -> DataFrame:
    """Ranks from 1 within ``query_id``; every task keeps ``k`` rows a query before the shuffle."""
    order = Window.partitionBy("query_id").orderBy(best, "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


Index = Callable[[np.ndarray, np.ndarray, np.ndarray], object]
Search = Callable[[object, pa.RecordBatch, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def search_shards(entries: DataFrame, probes: DataFrame, build: Index, search: Search, score: str) -> DataFrame:
    """Search every shard for the probes sent to it.

    ``entries`` has ``shard``, ``vec_id``, ``vec`` and ``cell``; ``probes`` has ``shard``, ``query_id``,
    ``vec``, ``bound`` and ``cells``. A task meets a shard's entries first and builds its index;
    the probes then stream past it in batches, so that memory is bounded by one shard
    and one batch, however many queries there are.
    """
    stream = entries.select(
        "shard", F.lit(0).alias("kind"), F.col("vec_id").alias("id"), "vec", "cell",
        F.lit(None).cast("double").alias("bound"), F.lit(None).cast("array<int>").alias("cells"),
    ).unionByName(
        probes.select(
            "shard", F.lit(1).alias("kind"), F.col("query_id").alias("id"), "vec",
            F.lit(0).alias("cell"), "bound", "cells",
        )
    ).repartition("shard").sortWithinPartitions("shard", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, index = None, None
        held: list[pa.RecordBatch] = []
        for batch in batches:
            starts = run_starts([batch.column("shard"), batch.column("kind")])
            for first, last in spans_of(starts, batch.num_rows):
                part = batch.slice(first, last - first)
                if part.column("shard")[0].as_py() != shard:
                    shard, index, held = part.column("shard")[0].as_py(), None, []
                if part.column("kind")[0].as_py() == 0:
                    held.append(part)
                    continue
                if index is None:
                    if not held:
                        continue
                    rows = pa.Table.from_batches(held).combine_chunks()
                    index = build(
                        rows.column("id").to_numpy(),
                        matrix(rows.column("vec").combine_chunks()),
                        rows.column("cell").to_numpy(),
                    )
                    held = []
                query, vec_id, value = search(index, part, matrix(part.column("vec")))
                ids = part.column("id").to_numpy()[query]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(vec_id), pa.array(value)], ["query_id", "vec_id", "score"]
                )

    return stream.mapInArrow(run, f"query_id bigint, vec_id bigint, score {score}")


def in_shards(rows: DataFrame, first: np.ndarray, parts: np.ndarray) -> DataFrame:
    """Adds ``shard``: a cell's rows are dealt by id over its ``parts`` shards from ``first`` on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = batch.column("cell").to_numpy()
            deal = batch.column("deal").to_numpy().view(np.uint64) % parts[cell].astype(np.uint64)
            shard = first[cell] + deal.astype(np.int64)
            keep = [batch.column(c) for c in ("vec_id", "vec", "cell")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(shard)], ["vec_id", "vec", "cell", "shard"])

    dealt = rows.select("vec_id", "vec", "cell", F.xxhash64("vec_id").alias("deal"))
    return dealt.mapInArrow(run, "vec_id bigint, vec array<double>, cell int, shard bigint")


def cell_counts(rows: DataFrame, cells: int) -> np.ndarray:
    """Rows per cell; the number of cells is a parameter, so the answer is bounded."""
    counts = np.zeros(cells, dtype=np.int64)
    for row in rows.groupBy("cell").count().toLocalIterator():
        counts[row["cell"]] = row["count"]
    return counts


def queries_of(rows: DataFrame, modulus: int) -> DataFrame:
    return rows.filter(F.col("vec_id") % modulus == 0).select(F.col("vec_id").alias("query_id"), "vec")


def stored_entries(rows: DataFrame, k: int, name: str) -> DataFrame:
    return stored(first_copies(rows, k), name)
