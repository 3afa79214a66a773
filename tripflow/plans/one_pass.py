"""All three marts from one read of the clean trips.

Grouping sets aggregate by day, by hourly pattern and by zone side by side. Each task
hands on a few hundred partial rows per set (days of its file, 168 hour slots, the
zones), so the shuffle stays small however many trips there are, and the fact table is
read once where three marts would read it three times.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions.numeric import mean, total
from tripflow.operators.marts import name_zones
from tripflow.operators.zones import UNKNOWN_BOROUGHS

DAILY = ["pickup_date"]
HOURLY = ["pickup_hour", "pickup_dow", "time_period"]
ZONE = ["pickup_location_id"]
KEYS = [*DAILY, *HOURLY, *ZONE]


def mart_aggregates(clean: DataFrame) -> DataFrame:
    """One row per group of any of the sets; ``_set`` tells which."""
    return clean.groupingSets([DAILY, HOURLY, ZONE], *KEYS).agg(
        F.grouping_id().alias("_set"),
        F.count("*").alias("total_trips"),
        total(F.col("total_amount")).alias("total_revenue"),
        mean(F.col("total_amount")).alias("avg_fare"),
        mean(F.col("trip_distance")).alias("avg_distance"),
        F.avg("trip_duration_min").alias("avg_duration_min"),
        mean(F.col("tip_rate")).alias("avg_tip_rate"),
        mean(F.col("avg_speed_mph")).alias("avg_speed_mph"),
    )


def _of_set(aggregates: DataFrame, keys: Sequence[str]) -> DataFrame:
    # grouping_id has a bit per key, the first key highest, set where a set lacks the key
    lacking = sum(1 << i for i, key in enumerate(reversed(KEYS)) if key not in keys)
    return aggregates.filter(F.col("_set") == lacking)


def daily_summary(aggregates: DataFrame) -> DataFrame:
    return _of_set(aggregates, DAILY).select(
        *DAILY,
        "total_trips",
        "total_revenue",
        "avg_distance",
        "avg_duration_min",
        "avg_tip_rate",
        "avg_speed_mph",
    )


def hourly_patterns(aggregates: DataFrame) -> DataFrame:
    return _of_set(aggregates, HOURLY).select(
        *HOURLY, "total_trips", "avg_fare", "avg_duration_min", "avg_tip_rate"
    )


def zone_analysis(
    aggregates: DataFrame, zones: DataFrame, exclude: Sequence[str] = UNKNOWN_BOROUGHS
) -> DataFrame:
    per_zone = _of_set(aggregates, ZONE).select(
        *ZONE,
        F.col("total_trips").alias("total_pickups"),
        "avg_fare",
        "avg_distance",
        "avg_duration_min",
        "avg_tip_rate",
    )
    return name_zones(per_zone, zones, exclude)
