"""Dashboard and BI questions over clean trips; all return small, lazy DataFrames."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions import epoch
from tripflow.functions.labels import payment_label
from tripflow.functions.numeric import exact_sum, mean, total, with_rest, without_cents
from tripflow.operators.zones import UNKNOWN_BOROUGHS, known_zones


def slice_period(
    clean: DataFrame,
    year: int | None = None,
    quarter: int | None = None,
    month: int | None = None,
    day: int | None = None,
) -> DataFrame:
    """Trips whose pickup date matches every given calendar part.

    Stored staging is laid out by ``year`` and ``month``; where these columns are
    present they are filtered too, so that only matching folders are read.
    """
    date = F.col("pickup_date")
    if year is not None:
        # a date range, unlike year(date) = n, prunes row groups
        clean = clean.filter(date.between(dt.date(year, 1, 1), dt.date(year, 12, 31)))
    for part, wanted in ((F.quarter, quarter), (F.month, month), (F.dayofmonth, day)):
        if wanted is not None:
            clean = clean.filter(part(date) == wanted)
    for folder, wanted in (("year", year), ("month", month)):
        if wanted is not None and folder in clean.columns:
            clean = clean.filter(F.col(folder) == wanted)
    if quarter is not None and "month" in clean.columns:
        clean = clean.filter(F.col("month").between(3 * quarter - 2, 3 * quarter))
    return clean


def kpis(clean: DataFrame, **period: int) -> DataFrame:
    return slice_period(clean, **period).agg(
        F.count("*").alias("total_trips"),
        total(F.col("total_amount")).alias("total_revenue"),
        mean(F.col("total_amount")).alias("mean_ticket"),
        mean(F.col("trip_distance")).alias("mean_distance"),
    )


def _trips_by(clean: DataFrame, key: Column | str) -> DataFrame:
    return clean.groupBy(key).agg(F.count("*").alias("trips"))


def trips_per_day(clean: DataFrame) -> DataFrame:
    return _trips_by(clean, "pickup_date").orderBy("pickup_date")


def trips_per_hour(clean: DataFrame) -> DataFrame:
    return _trips_by(clean, "pickup_hour").orderBy("pickup_hour")


def top_zones(clean: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` busiest pickup zones; equal counts go by zone id."""
    counts = _trips_by(clean, "pickup_location_id")
    return counts.orderBy(F.desc("trips"), "pickup_location_id").limit(k)


def payment_mix(clean: DataFrame) -> DataFrame:
    counts = _trips_by(clean, "payment_type")
    labelled = counts.withColumn("payment_label", payment_label(F.col("payment_type")))
    return labelled.orderBy(F.desc("trips"), "payment_type")


def load_recap(raw: DataFrame) -> DataFrame:
    """Raw trips per year and month of pickup; rows without a pickup time are left out."""
    day = epoch.epoch_date(F.col("tpep_pickup_datetime"))
    per_month = (
        raw.filter(F.col("tpep_pickup_datetime").isNotNull())
        .groupBy(F.trunc(day, "month").alias("_month"))
        .agg(F.count("*").alias("trips"))
    )
    return per_month.select(
        F.year("_month").alias("year"), F.month("_month").alias("month"), "trips"
    ).orderBy("year", "month")


def dow_hour_matrix(clean: DataFrame) -> DataFrame:
    """Trips by day of week, one column per hour ``hour_00`` to ``hour_23``."""
    counts = clean.groupBy("pickup_dow").pivot("pickup_hour", list(range(24))).count().na.fill(0)
    return counts.select(
        "pickup_dow", *[F.col(str(hour)).alias(f"hour_{hour:02d}") for hour in range(24)]
    )


def borough_revenue(
    clean: DataFrame, zones: DataFrame, exclude: Sequence[str] = UNKNOWN_BOROUGHS
) -> DataFrame:
    """Trips and revenue per borough, summed per zone id before the join."""
    amount = F.col("total_amount")
    per_zone = clean.groupBy("pickup_location_id").agg(
        F.count("*").alias("_trips"),
        exact_sum(amount).alias("_revenue"),
        F.sum(without_cents(amount)).alias("_rest"),
    )
    named = per_zone.join(known_zones(zones, exclude), "pickup_location_id")
    return named.groupBy("borough").agg(
        F.sum("_trips").alias("total_trips"),
        with_rest(F.sum("_revenue"), F.sum("_rest")).alias("total_revenue"),
    )


def distance_fare_points(zone_mart: DataFrame) -> DataFrame:
    """Scatter points: mean distance against mean fare per zone."""
    return zone_mart.select("zone_name", "borough", "avg_distance", "avg_fare", "total_pickups")


def speed_by_year(clean: DataFrame) -> DataFrame:
    return clean.groupBy(F.year("pickup_date").alias("year")).agg(
        mean(F.col("avg_speed_mph")).alias("avg_speed_mph"), F.count("*").alias("trips")
    )


def revenue_tip_trend(clean: DataFrame, period: str = "month") -> DataFrame:
    """Revenue and mean tip rate per calendar period: week, month, quarter or year."""
    return clean.groupBy(F.trunc("pickup_date", period).alias("period_start")).agg(
        total(F.col("total_amount")).alias("total_revenue"),
        mean(F.col("tip_rate")).alias("avg_tip_rate"),
    )
