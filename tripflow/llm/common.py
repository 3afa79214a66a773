"""Helpers the operators share: stored intermediate tables and row-wise Arrow tasks."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator, Sequence
from itertools import pairwise
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripflow.session import shared_dir


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written below ``spark.checkpoint.dir`` and read again.

    Cuts the lineage: what follows reads files that outlive any executor.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_in_place(rows: DataFrame, buckets: int, by: str, order: str) -> DataFrame:
    """The rows stored in buckets of the column ``by``, so that what is joined by it comes to them and they stay.

    Rows of one value are to be written by one task, as those of a block are; a task then
    writes a file for each of its blocks.
    """
    spark = rows.sparkSession
    name = f"placed_{uuid4().hex}"
    writer = rows.write.bucketBy(buckets, by).sortBy(by, order).format("parquet")
    writer.option("path", shared_dir(spark, "placed")).saveAsTable(name)
    found = spark.table(name)  # knows its files and buckets from here on
    spark.sql(f"DROP TABLE {name}")  # the entry only: the files lie outside the warehouse
    return found


def dropped(df: DataFrame) -> None:
    """Delete the files of a ``stored`` frame that nothing reads any more."""
    spark = df.sparkSession
    folders = {name.rsplit("/", 1)[0] for name in df.inputFiles()}
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


SAMPLE_FILES = 8  # of a sample, which is of bounded size


def even_sample(rows: DataFrame, by: str, deal: str, each: int, classes: int) -> DataFrame:
    """Up to ``each`` rows for every value of ``by``, the same ones on every run.

    ``deal`` is a column of hashes. Values are counted first and rows thinned by their
    hash to about twice as many as wanted, so the ranking that follows is small however
    many rows a value has. Only the first ``classes`` values in order are sampled.
    """
    counts = rows.groupBy(by).count().orderBy(by).limit(classes).collect()
    chosen = F.lit(False)
    for value, count in counts:
        one_in = max(1, count // (2 * each))
        chosen = F.when(F.col(by) == value, F.pmod(deal, F.lit(one_in)) == 0).otherwise(chosen)
    order = Window.partitionBy(by).orderBy(deal)
    ranked = rows.filter(chosen).withColumn("_place", F.row_number().over(order))
    return ranked.filter(F.col("_place") <= each).drop("_place")


_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20


def hold_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to ``BATCH_BYTES``.

    Long texts make batches of many rows large, and each is held several times over, in
    the JVM, in Arrow and as Python objects. The setting is read when a plan runs, so it
    must stay for the session.
    """
    now = spark.conf.get(_BATCH_BYTES, None)
    if now is None or not now.rstrip("b").isdigit() or not 0 < int(now.rstrip("b")) <= BATCH_BYTES:
        spark.conf.set(_BATCH_BYTES, str(BATCH_BYTES))


def map_batches(
    df: DataFrame, schema: str, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]]
) -> DataFrame:
    """Run ``make`` once per task and its result on each Arrow batch."""
    hold_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            yield step(batch)
        del step
        _give_back()

    return df.mapInArrow(run, schema)


def _give_back() -> None:
    """Return a finished task's memory to the system; Python workers stay for the next tasks.

    What came with the task, its functions among it, refers to itself in circles, which
    only a collection frees.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # no glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def key_runs(
    batches: Iterator[pa.RecordBatch], keys: Sequence[str]
) -> Iterator[pa.RecordBatch | pa.Table]:
    """Regroup batches sorted by ``keys`` so that no run of equal keys is cut.

    Only the unfinished last run is held over from one batch to the next.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        starts = run_starts([batch.column(k) for k in keys])
        same = held and all(held[-1].column(k)[-1] == batch.column(k)[0] for k in keys)
        last = int(starts[-1])
        if same and last == 0:
            held.append(batch)
            continue
        done = held + ([batch.slice(0, last)] if last else [])
        if done:
            yield pa.Table.from_batches(done)
        held = [batch.slice(last)]
    if held:
        yield pa.Table.from_batches(held)


def run_starts(columns: Sequence[pa.Array]) -> np.ndarray:
    """First row of each run of equal values; the columns hold no nulls."""
    rows = len(columns[0])
    new = np.zeros(rows, dtype=bool)
    if rows:
        new[0] = True
    for column in columns:
        values = column.to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def spans_of(starts: np.ndarray, rows: int) -> Iterator[tuple[int, int]]:
    return pairwise([*starts.tolist(), rows])
