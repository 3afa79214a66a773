"""Marts kept up to date by the parts that were loaded since.

Every loaded part has a share, aggregates that add up: for the marts the exact integer sums
of ``cube`` over its own clean trips.
A refresh reads only parts whose share is missing or older than the part, adds their shares
and combines all shares into the marts; raw as a whole is not read again. Shares are
written in batches and then recorded in a log, like loads, so a refresh that breaks off is
repeated; the latest recorded share of a part is the one that counts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.operators.cleaning import Profile, clean, mart_profile
from tripflow.operators.zones import UNKNOWN_BOROUGHS
from tripflow.plans import cube, one_pass
from tripflow.schemas import PART, SOURCE_FILE
from tripflow.sources.generations import Folders
from tripflow.sources.layers import layer_path, materialize
from tripflow.sources.load_log import LoadLog
from tripflow.sources.trips import read_parts

_LOG = "_share_log"
_LOG_SCHEMA = "source_file string, part string, loaded_at timestamp, batch string"
BATCH_PARTS = 1000

Share = Callable[[DataFrame], DataFrame]  # aggregates of trips by ``source_file`` and more


class Shares:
    """The shares of a raw table's parts, stored below ``path``."""

    def __init__(self, spark: SparkSession, raw: str, path: str) -> None:
        self.spark = spark
        self.raw = raw
        self.path = path.rstrip("/")

    def _log(self) -> DataFrame:
        if not Folders(self.spark, self.path).exists(f"{self.path}/{_LOG}"):
            return self.spark.createDataFrame([], _LOG_SCHEMA)
        return self.spark.read.schema(_LOG_SCHEMA).parquet(f"{self.path}/{_LOG}")

    def _recorded(self) -> DataFrame:
        """Parts raw holds, with the time of their last load."""
        entries = LoadLog(self.spark, self.raw).entries()
        return entries.groupBy("source_file", "part").agg(F.max("loaded_at").alias("loaded_at"))

    def missing(self) -> DataFrame:
        """Parts without a share of their last load: ``source_file``, ``part``, ``loaded_at``."""
        held = self._log().alias("held")
        parts = self._recorded().alias("part")
        same = (
            F.col("part.source_file").eqNullSafe(F.col("held.source_file"))
            & (F.col("part.part") == F.col("held.part"))
            & (F.col("part.loaded_at") == F.col("held.loaded_at"))
        )
        return parts.join(held, same, "left_anti")

    def add_missing(self, share: Share, batch_parts: int = BATCH_PARTS) -> int:
        """Compute the missing shares batch by batch; the number of parts read."""
        done = 0
        parts = self.missing().orderBy("source_file", "part").toLocalIterator()
        batch: list = []
        for part in parts:
            batch.append(part)
            if len(batch) == batch_parts:
                done += self._add(batch, share)
                batch = []
        return done + (self._add(batch, share) if batch else 0)

    def _add(self, parts: list, share: Share) -> int:
        trips = read_parts(self.spark, self.raw, [(p["source_file"], p["part"]) for p in parts])
        place = F.concat_ws("/", SOURCE_FILE, PART)  # a share has a column for the file only
        name = uuid4().hex
        file = F.when(F.col("source_file").contains("/"), F.substring_index("source_file", "/", 1))
        shares = share(trips.withColumn(SOURCE_FILE, place)).withColumns(
            {"share_file": file, PART: F.substring_index("source_file", "/", -1)}
        )
        shares.drop("source_file").write.parquet(f"{self.path}/batch={name}")
        rows = [(p["source_file"], p["part"], p["loaded_at"], name) for p in parts]
        self.spark.createDataFrame(rows, _LOG_SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.path}/{_LOG}")
        return len(parts)

    def current(self) -> DataFrame:
        """Shares of the parts that raw holds, each as of its last load."""
        latest = self._recorded().alias("part").join(
            self._log().alias("held"),
            F.col("part.source_file").eqNullSafe(F.col("held.source_file"))
            & (F.col("part.part") == F.col("held.part"))
            & (F.col("part.loaded_at") == F.col("held.loaded_at")),
        )
        # a batch that was recorded twice for a part counts once
        chosen = latest.groupBy(F.col("part.source_file").alias("_file"), F.col("part.part").alias("_of")).agg(
            F.max("held.batch").alias("_batch")
        )
        rows = self.spark.read.option("basePath", self.path).parquet(f"{self.path}/batch=*")
        same = (
            (F.col("batch") == F.col("_batch"))
            & (F.col(PART) == F.col("_of"))
            & (F.col("_file").isNull() | (F.col("_file") == F.col("share_file")))
        )
        return rows.join(chosen, same, "left_semi")


def refresh_marts(
    spark: SparkSession,
    raw: str,
    zones: DataFrame,
    root: str,
    profile: Profile | None = None,
    exclude: Sequence[str] = UNKNOWN_BOROUGHS,
    batch_parts: int = BATCH_PARTS,
) -> dict[str, DataFrame]:
    """Bring the three marts up to what raw (a path) holds now and store them.

    Equal to building them from all of raw, since shares are exact and add up. A profile that
    removes duplicates is refused, as these may lie in two parts.
    """
    profile = profile or mart_profile()
    if profile.unique_by:
        raise ValueError(f"profile {profile.name} compares rows of different parts")
    shares = Shares(spark, raw, layer_path(root, "staging", "trip_shares"))
    shares.add_missing(lambda trips: cube.trip_cube(clean(trips, profile), ["source_file"]), batch_parts)
    # the shares are many and matched with the logs, so all marts take them from one read
    rows = materialize(cube.mart_aggregates(shares.current()), root, "staging", "mart_aggregates")
    return {
        "daily_summary": materialize(one_pass.daily_summary(rows), root, "final", "daily_summary"),
        "zone_analysis": materialize(one_pass.zone_analysis(rows, zones, exclude), root, "final", "zone_analysis"),
        "hourly_patterns": materialize(one_pass.hourly_patterns(rows), root, "final", "hourly_patterns"),
    }
