"""Renaming, typing and enrichment of raw trips.

Three staging layouts exist because three consumers read them: ``enriched`` feeds
the marts, ``billing`` the metric views, ``dashboard`` the dashboard queries.
Calendar parts and durations come straight from the raw microseconds.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions import epoch
from tripflow.functions.labels import distance_category
from tripflow.functions.numeric import fill_zero, guarded_ratio, speed_mph
from tripflow.schemas import INGESTION_DATE, SOURCE_FILE


# Staging names of raw columns.
SHARED_NAMES = {
    "VendorID": "vendor_id",
    "passenger_count": "passenger_count",
    "trip_distance": "trip_distance",
    "PULocationID": "pickup_location_id",
    "DOLocationID": "dropoff_location_id",
    "fare_amount": "fare_amount",
    "tip_amount": "tip_amount",
    "total_amount": "total_amount",
}
ENRICHED_NAMES = SHARED_NAMES | {
    "payment_type": "payment_type",
    "congestion_surcharge": "congestion_surcharge",
    "cbd_congestion_fee": "cbd_congestion_fee",
    SOURCE_FILE: "source_file",
    INGESTION_DATE: "ingestion_date",
}
BILLING_NAMES = SHARED_NAMES | {
    "RatecodeID": "rate_code_id",
    "store_and_fwd_flag": "store_and_fwd_flag",
    "payment_type": "payment_type_id",
    "extra": "extra_amount",
    "mta_tax": "mta_tax",
    "tolls_amount": "tolls_amount",
    "improvement_surcharge": "improvement_surcharge",
    SOURCE_FILE: "source_file",
}
BILLING_SURCHARGES = {
    "congestion_surcharge": "congestion_surcharge",
    "Airport_fee": "airport_fee",
    "cbd_congestion_fee": "cbd_congestion_fee",
}
DASHBOARD_NAMES = SHARED_NAMES | {
    "RatecodeID": "ratecode_id",
    "payment_type": "payment_type",
    "store_and_fwd_flag": "store_and_fwd_flag",
    "extra": "extra",
    "mta_tax": "mta_tax",
    "tolls_amount": "tolls_amount",
    "improvement_surcharge": "improvement_surcharge",
    "congestion_surcharge": "congestion_surcharge",
    "Airport_fee": "airport_fee",
}


def renamed(mapping: Mapping[str, str]) -> list[Column]:
    return [F.col(raw).alias(name) for raw, name in mapping.items()]


def standardize(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Keep the mapped columns under their staging names."""
    return df.select(*renamed(mapping))


def pickup_us() -> Column:
    return F.col("tpep_pickup_datetime")


def dropoff_us() -> Column:
    return F.col("tpep_dropoff_datetime")


def trip_minutes() -> Column:
    return epoch.minutes_between(pickup_us(), dropoff_us())


def _times() -> list[Column]:
    return [
        epoch.from_micros(pickup_us()).alias("pickup_datetime"),
        epoch.from_micros(dropoff_us()).alias("dropoff_datetime"),
    ]


def enriched(raw: DataFrame) -> DataFrame:
    """Mart input: duration, speed, tip rate, calendar parts and buckets."""
    base = raw.select(
        *renamed(ENRICHED_NAMES),
        *_times(),
        trip_minutes().alias("trip_duration_min"),
        epoch.epoch_hour(pickup_us()).alias("pickup_hour"),
        epoch.epoch_date(pickup_us()).alias("pickup_date"),
    )
    miles, minutes = F.col("trip_distance"), F.col("trip_duration_min")
    return base.withColumns(
        {
            "avg_speed_mph": speed_mph(miles, minutes),
            "tip_rate": guarded_ratio(F.col("tip_amount"), F.col("fare_amount")),
            "pickup_dow": epoch.day_of_week(F.col("pickup_date")),
            "pickup_month": F.monthname("pickup_date"),
            "distance_category": distance_category(miles),
            "time_period": epoch.time_period(F.col("pickup_hour")),
        }
    )


FILE_MONTH = "_file_month"


def with_file_month(raw: DataFrame) -> DataFrame:
    """Adds the month of the source file, parsed once per row.

    A generator of one row holds it: the optimizer would repeat a plain expression in the
    filter and in the output, while filters on other columns still pass through to the scan.
    """
    month = F.explode(F.array(epoch.file_month(F.col(SOURCE_FILE))))
    return raw.select("*", month.alias(FILE_MONTH))


def billing(raw: DataFrame) -> DataFrame:
    """Metric-view input: every charge, surcharges filled, the file's month."""
    if FILE_MONTH not in raw.columns:
        raw = with_file_month(raw)
    return raw.select(
        *renamed(BILLING_NAMES),
        *_times(),
        *[fill_zero(F.col(raw_name)).alias(n) for raw_name, n in BILLING_SURCHARGES.items()],
        F.col(FILE_MONTH).alias("file_target_date"),
    )


def dashboard(raw: DataFrame) -> DataFrame:
    """Dashboard input: charges, duration, day name and hour."""
    return raw.select(
        *renamed(DASHBOARD_NAMES),
        *_times(),
        trip_minutes().alias("trip_duration_min"),
        epoch.epoch_date(pickup_us()).alias("pickup_date"),
        epoch.epoch_hour(pickup_us()).alias("pickup_hour"),
        F.dayname(epoch.epoch_date(pickup_us())).alias("pickup_dayname"),
    )
