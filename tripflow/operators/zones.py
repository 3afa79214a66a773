"""Joining trips to the zone dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Boroughs that stand for "no known place".
UNKNOWN_BOROUGHS = ("Unknown", "N/A")


def known_zones(zones: DataFrame, exclude: Sequence[str] = UNKNOWN_BOROUGHS) -> DataFrame:
    return zones.filter(F.col("BOROUGH").isNotNull() & ~F.col("BOROUGH").isin(*exclude)).select(
        F.col("LOCATION_ID").alias("pickup_location_id"),
        F.col("BOROUGH").alias("borough"),
        F.col("ZONE").alias("zone_name"),
        F.col("SERVICE_ZONE").alias("service_zone"),
    )


def enrich_zones(
    trips: DataFrame, zones: DataFrame, exclude: Sequence[str] = UNKNOWN_BOROUGHS
) -> DataFrame:
    """Trips with the names of their pickup zone; unknown boroughs drop out.

    A left join whose right side must be non-NULL is an inner join, so that is what is
    written. There is no broadcast hint: Spark broadcasts the dimension when its size
    is below the session's threshold and otherwise shuffles, splitting hot zones.
    """
    return trips.join(known_zones(zones, exclude), "pickup_location_id")
