"""A stored rollup per pickup date, hour and zone, for reports sliced after the fact.

Counts and exact sums add up, so marts of any date range follow from the rollup
without reading trips again. It has at most days x 24 x zones rows, but its key is far
finer than a mart's, so building it shuffles more; ``one_pass`` is the cheaper way to
the full marts. ``pipeline.period_marts`` answers from it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions import epoch
from tripflow.functions.numeric import cent_millionths, cents, join_parts, with_rest, without_cents
from tripflow.operators.marts import name_zones
from tripflow.operators.zones import UNKNOWN_BOROUGHS
from tripflow.plans.one_pass import DAILY, HOURLY, KEYS, ZONE

MEASURES = ["total_amount", "trip_distance", "tip_rate", "avg_speed_mph"]


def trip_cube(clean: DataFrame, apart: Sequence[str] = ()) -> DataFrame:
    """The rollup; rows that differ in the columns ``apart`` are kept apart."""
    return clean.groupBy("pickup_date", "pickup_hour", "pickup_location_id", *apart).agg(
        F.count("*").alias("trips"),
        F.sum("trip_duration_min").alias("minutes"),
        F.count("trip_duration_min").alias("minutes_known"),
        *[part for name in MEASURES for part in _parts(name)],
    )


def _parts(name: str) -> list[Column]:
    value = F.col(name)
    return [
        F.sum(cents(value)).alias(f"{name}_cents"),
        F.sum(cent_millionths(value)).alias(f"{name}_millionths"),
        F.sum(without_cents(value)).alias(f"{name}_rest"),
        F.count(value).alias(f"{name}_known"),
    ]


def _total(name: str) -> Column:
    exact = join_parts(F.sum(f"{name}_cents"), F.sum(f"{name}_millionths"))
    return with_rest(exact, F.sum(f"{name}_rest"))


def _mean(name: str) -> Column:
    return F.try_divide(_total(name), F.sum(f"{name}_known"))


def _mean_minutes() -> Column:
    return F.try_divide(F.sum("minutes"), F.sum("minutes_known"))


def mart_aggregates(cube: DataFrame) -> DataFrame:
    """``one_pass.mart_aggregates`` from the rollup: all three marts from one read of it."""
    dow, period = epoch.day_of_week(F.col("pickup_date")), epoch.time_period(F.col("pickup_hour"))
    rows = cube.withColumns({"pickup_dow": dow, "time_period": period})
    return rows.groupingSets([DAILY, HOURLY, ZONE], *KEYS).agg(
        F.grouping_id().alias("_set"),
        F.sum("trips").alias("total_trips"),
        _total("total_amount").alias("total_revenue"),
        _mean("total_amount").alias("avg_fare"),
        _mean("trip_distance").alias("avg_distance"),
        _mean_minutes().alias("avg_duration_min"),
        _mean("tip_rate").alias("avg_tip_rate"),
        _mean("avg_speed_mph").alias("avg_speed_mph"),
    )


def daily_summary(cube: DataFrame) -> DataFrame:
    return cube.groupBy("pickup_date").agg(
        F.sum("trips").alias("total_trips"),
        _total("total_amount").alias("total_revenue"),
        _mean("trip_distance").alias("avg_distance"),
        _mean_minutes().alias("avg_duration_min"),
        _mean("tip_rate").alias("avg_tip_rate"),
        _mean("avg_speed_mph").alias("avg_speed_mph"),
    )


def hourly_patterns(cube: DataFrame) -> DataFrame:
    dow = epoch.day_of_week(F.col("pickup_date")).alias("pickup_dow")
    period = epoch.time_period(F.col("pickup_hour")).alias("time_period")
    return cube.groupBy("pickup_hour", dow, period).agg(
        F.sum("trips").alias("total_trips"),
        _mean("total_amount").alias("avg_fare"),
        _mean_minutes().alias("avg_duration_min"),
        _mean("tip_rate").alias("avg_tip_rate"),
    )


def zone_analysis(
    cube: DataFrame, zones: DataFrame, exclude: Sequence[str] = UNKNOWN_BOROUGHS
) -> DataFrame:
    per_zone = cube.groupBy("pickup_location_id").agg(
        F.sum("trips").alias("total_pickups"),
        _mean("total_amount").alias("avg_fare"),
        _mean("trip_distance").alias("avg_distance"),
        _mean_minutes().alias("avg_duration_min"),
        _mean("tip_rate").alias("avg_tip_rate"),
    )
    return name_zones(per_zone, zones, exclude)
