"""Marts and metric views over clean trips.

Every aggregation is a partial and a final hash aggregate on a small key. Means of
``avg_fare`` are means of the total amount, as their consumers expect.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions import epoch
from tripflow.functions.numeric import (
    mean,
    rounded_mean,
    rounded_ratio,
    rounded_total,
    to_km,
    total,
)
from tripflow.operators.zones import UNKNOWN_BOROUGHS, known_zones


def daily_summary(clean: DataFrame) -> DataFrame:
    return clean.groupBy("pickup_date").agg(
        F.count("*").alias("total_trips"),
        total(F.col("total_amount")).alias("total_revenue"),
        mean(F.col("trip_distance")).alias("avg_distance"),
        F.avg("trip_duration_min").alias("avg_duration_min"),
        mean(F.col("tip_rate")).alias("avg_tip_rate"),
        mean(F.col("avg_speed_mph")).alias("avg_speed_mph"),
    )


def hourly_patterns(clean: DataFrame) -> DataFrame:
    return clean.groupBy("pickup_hour", "pickup_dow", "time_period").agg(
        F.count("*").alias("total_trips"),
        mean(F.col("total_amount")).alias("avg_fare"),
        F.avg("trip_duration_min").alias("avg_duration_min"),
        mean(F.col("tip_rate")).alias("avg_tip_rate"),
    )


def zone_analysis(
    clean: DataFrame, zones: DataFrame, exclude: Sequence[str] = UNKNOWN_BOROUGHS
) -> DataFrame:
    """Pickups per zone, aggregated before the join: only one row per zone id is joined."""
    per_zone = clean.groupBy("pickup_location_id").agg(
        F.count("*").alias("total_pickups"),
        mean(F.col("total_amount")).alias("avg_fare"),
        mean(F.col("trip_distance")).alias("avg_distance"),
        F.avg("trip_duration_min").alias("avg_duration_min"),
        mean(F.col("tip_rate")).alias("avg_tip_rate"),
    )
    return name_zones(per_zone, zones, exclude)


def name_zones(
    per_zone: DataFrame, zones: DataFrame, exclude: Sequence[str] = UNKNOWN_BOROUGHS
) -> DataFrame:
    """Zone names for per-zone figures.

    Should the dimension list an id twice under the same names, each trip counts once
    per listing, as joining trip by trip would give.
    """
    names = ["pickup_location_id", "borough", "zone_name", "service_zone"]
    listed = known_zones(zones, exclude).groupBy(*names).agg(F.count("*").alias("_listings"))
    figures = [c for c in per_zone.columns if c not in ("pickup_location_id", "total_pickups")]
    return per_zone.join(listed, "pickup_location_id").select(
        "borough",
        "zone_name",
        "service_zone",
        "pickup_location_id",
        (F.col("total_pickups") * F.col("_listings")).alias("total_pickups"),
        *figures,
    )


def daily_metrics(trips: DataFrame) -> DataFrame:
    minutes = epoch.minutes_between_times(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    per_day = (
        trips.withColumns(
            {
                "trip_date": F.to_date("pickup_datetime"),
                "_km": to_km(F.col("trip_distance")),
                "_minutes": minutes,
            }
        )
        .groupBy("trip_date")
        .agg(
            F.count("*").alias("total_trips"),
            F.sum("passenger_count").alias("total_passengers"),
            rounded_total(F.col("_km")).alias("total_distance_km"),
            rounded_mean(F.col("_km")).alias("avg_distance_km"),
            F.sum("_minutes").alias("total_duration_minutes"),
            rounded_total(F.col("total_amount")).alias("total_revenue"),
            rounded_total(F.col("fare_amount")).alias("total_fare_revenue"),
            rounded_total(F.col("tip_amount")).alias("total_tips"),
            rounded_total(F.col("tolls_amount")).alias("total_tolls"),
            rounded_ratio(
                total(F.col("tip_amount")), total(F.col("fare_amount")), 100.0
            ).alias("global_tip_percentage"),
            rounded_ratio(total(F.col("total_amount")), F.sum("_minutes")).alias(
                "revenue_per_minute"
            ),
        )
    )
    # year and month follow from the date, so they need no place in the group key
    return per_day.select(
        "trip_date",
        F.year("trip_date").alias("trip_year"),
        F.month("trip_date").alias("trip_month"),
        *per_day.columns[1:],
    )


def payment_metrics(trips: DataFrame) -> DataFrame:
    return trips.groupBy("payment_type_id", "passenger_count").agg(
        F.count("*").alias("total_trips"),
        rounded_total(F.col("total_amount")).alias("total_revenue"),
        rounded_mean(F.col("total_amount")).alias("avg_total_amount"),
        rounded_total(F.col("tip_amount")).alias("total_tips_gained"),
        rounded_mean(F.col("tip_amount")).alias("avg_tip_amount"),
        rounded_ratio(total(F.col("tip_amount")), total(F.col("fare_amount")), 100.0).alias(
            "tip_ratio_percentage"
        ),
    )


def route_metrics(trips: DataFrame) -> DataFrame:
    return (
        trips.withColumn("_km", to_km(F.col("trip_distance")))
        .groupBy("pickup_location_id", "dropoff_location_id")
        .agg(
            F.count("*").alias("total_trips_on_route"),
            rounded_total(F.col("total_amount")).alias("total_revenue_on_route"),
            rounded_mean(F.col("total_amount")).alias("avg_price_per_trip"),
            rounded_mean(F.col("_km")).alias("avg_distance_km_on_route"),
            rounded_mean(F.col("tip_amount")).alias("avg_tip_on_route"),
            rounded_ratio(total(F.col("tip_amount")), total(F.col("fare_amount")), 100.0).alias(
                "tip_percentage_on_route"
            ),
        )
    )
