"""What a raw table holds: the parts loaded into it, and its columns.

The log lies inside the table in a folder that readers of the table pass over. Only a
part recorded here counts as loaded, so a load that breaks off between its files and
its record is repeated; it then replaces the folders it left behind. A reload is a table of
its own, with its own log, that takes the former one's place once both are complete.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.sources.generations import Folders, Generations

LOG = "_load_log"
LOG_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("source_file", "part", "unit", "columns")]
    + [T.StructField("loaded_at", T.TimestampType())]
)


class LoadLog:
    def __init__(self, spark: SparkSession, target: str) -> None:
        self.spark = spark
        self.target = Generations(spark, target).current() or target.rstrip("/")
        self.path = f"{self.target}/{LOG}"
        self._folders = Folders(spark, target)

    def begin(self) -> None:
        """Start the log of a new table; refuse a folder that holds anything else."""
        if self._folders.exists(self.path):
            return
        if self._folders.names(self.target):
            raise ValueError(f"{self.target} is not laid out as a raw table")
        self.record([], None)

    def entries(self) -> DataFrame:
        if not self._folders.exists(self.path):
            return self.spark.createDataFrame([], LOG_SCHEMA)
        return self.spark.read.schema(LOG_SCHEMA).parquet(self.path)

    def columns(self) -> T.StructType | None:
        """The table's columns as of its latest load."""
        stated = self.entries().filter("columns IS NOT NULL")
        latest = stated.agg(F.max_by("columns", F.struct("loaded_at", F.length("columns"))).alias("c"))
        found = latest.first()["c"]
        return T.StructType.fromJson(json.loads(found)) if found else None

    def record(self, parts: Sequence[tuple[str | None, str, str | None]], columns: T.StructType | None) -> None:
        """Record parts (source file, part, landing unit) as loaded, in one file; its first row states the columns."""
        rows = [(*part, columns.json() if columns and not n else None) for n, part in enumerate(parts)]
        frame = self.spark.createDataFrame(rows, T.StructType(LOG_SCHEMA.fields[:4]))
        frame.withColumn("loaded_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(self.path)
