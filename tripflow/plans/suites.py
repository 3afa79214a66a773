"""Expectation suites of the staging table and the marts."""

from __future__ import annotations

from tripflow.operators.expectations import (
    Check,
    accepted_values,
    max_value,
    min_value,
    not_null,
    unique,
)


def _all_present(*columns: str) -> list[Check]:
    return [not_null(c) for c in columns]


# Accepted codes, labels and bounds of every model.
STAGING_SUITE = [
    *_all_present(
        "vendor_id",
        "pickup_datetime",
        "dropoff_datetime",
        "passenger_count",
        "trip_distance",
        "fare_amount",
        "payment_type",
        "pickup_location_id",
        "dropoff_location_id",
        "trip_duration_min",
        "avg_speed_mph",
        "tip_rate",
        "distance_category",
        "time_period",
        "source_file",
        "pickup_date",
    ),
    accepted_values("vendor_id", [1, 2]),
    accepted_values("payment_type", [1, 2, 3, 4, 5, 6]),
    accepted_values("distance_category", ["short", "medium", "long", "very_long"]),
    accepted_values("time_period", ["morning_rush", "evening_rush", "night", "daytime"]),
    min_value("passenger_count", 1),
    max_value("passenger_count", 6),
    min_value("trip_distance", 0),
    max_value("trip_distance", 50),
    min_value("fare_amount", 0),
    min_value("trip_duration_min", 1),
    max_value("trip_duration_min", 300),
    max_value("avg_speed_mph", 100),
    min_value("tip_rate", 0),
    max_value("tip_rate", 1),
]

DAILY_SUITE = [
    *_all_present(
        "pickup_date",
        "total_trips",
        "total_revenue",
        "avg_distance",
        "avg_duration_min",
        "avg_speed_mph",
    ),
    unique("pickup_date"),
    min_value("total_trips", 1),
    min_value("total_revenue", 0),
    max_value("avg_distance", 50),
    max_value("avg_duration_min", 300),
    max_value("avg_speed_mph", 100),
]

ZONE_SUITE = [
    *_all_present(
        "borough",
        "zone_name",
        "service_zone",
        "pickup_location_id",
        "total_pickups",
        "avg_fare",
        "avg_distance",
        "avg_tip_rate",
    ),
    unique("pickup_location_id"),
    min_value("total_pickups", 1),
    min_value("avg_fare", 0),
    max_value("avg_distance", 50),
    min_value("avg_tip_rate", 0),
    max_value("avg_tip_rate", 1),
]

HOURLY_SUITE = [
    *_all_present("pickup_hour", "pickup_dow", "total_trips", "avg_fare", "avg_tip_rate"),
    min_value("pickup_hour", 0),
    max_value("pickup_hour", 23),
    min_value("pickup_dow", 0),
    max_value("pickup_dow", 6),
    min_value("total_trips", 1),
    min_value("avg_fare", 0),
    min_value("avg_tip_rate", 0),
    max_value("avg_tip_rate", 1),
]
