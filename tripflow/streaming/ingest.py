"""Incremental ingestion through the streaming file source.

For landing folders whose files share types, ``ingest_incremental`` streams their rows. The
source log remembers every file taken and the sink log every batch written, so a rerun adds
nothing and a crash neither loses nor repeats rows. For folders with drifting types,
``ingest_drifting`` streams the names of new files, and each batch of them is loaded into a
raw table with its load log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tripflow.schemas import RAW_TRIP_SCHEMA, SOURCE_FILE
from tripflow.sources.conform import conform, evolved_schema
from tripflow.sources.trips import load_parts, parts_of, with_lineage


def ingest_incremental(
    spark: SparkSession,
    landing: str,
    target: str,
    checkpoint: str,
    files: T.StructType,
    schema: T.StructType = RAW_TRIP_SCHEMA,
    max_files_per_batch: int | None = None,
) -> None:
    """Append all new files of ``landing`` to ``target``.

    ``files`` is the schema of the landing files, e.g. from ``infer_trip_schema``.
    Columns that ``schema`` does not know are added as DOUBLE; ``read_streamed`` gives rows
    loaded before them NULL there. The stream stops once the files present at its start are
    loaded.
    """
    reader = (
        spark.readStream.schema(files)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
    )
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    query = (
        conform(with_lineage(reader.parquet(landing)), evolved_schema(schema, files))
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .partitionBy(SOURCE_FILE)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def ingest_drifting(
    spark: SparkSession,
    landing: str,
    target: str,
    checkpoint: str,
    on_error: str = "abort",
    schema: T.StructType = RAW_TRIP_SCHEMA,
    max_files_per_batch: int = 1000,
) -> None:
    """Load all new files of ``landing`` into the raw table ``target``, whatever their types.

    Only names are streamed, contents are not read for it. A batch loads its files as
    ``load_new_files`` does, footers first, each schema conformed by itself. It replaces the
    folders of its own parts and then records them, and passes over recorded ones, so a
    batch that is replayed after a crash, or under a new checkpoint, adds nothing. Other
    loads and ``read_raw`` may use the same table.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema(_FILES)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .option("maxFilesPerTrigger", max_files_per_batch)
        .load(landing)
        .select("path")
    )

    def load(batch: DataFrame, number: int) -> None:
        load_parts(batch.sparkSession, parts_of(batch), target, on_error, schema, max_files_per_batch)

    query = files.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(load).start()
    query.awaitTermination()


def read_streamed(spark: SparkSession, target: str) -> DataFrame:
    """Rows of all batches, in the columns of all of them."""
    return spark.read.option("mergeSchema", "true").parquet(target)
