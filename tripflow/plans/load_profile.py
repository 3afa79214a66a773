"""All reports on a load from one read of raw.

Trips are counted once per file, pickup date and dropoff date, which is all the reports'
keys and tests by month depend on. Counts add up and extremes combine, so five reports are
small projections of these groups, and groups kept per loaded part serve loads that come later.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.functions import epoch
from tripflow.functions.numeric import round_half_away
from tripflow.plans.refresh import BATCH_PARTS, Shares
from tripflow.schemas import SOURCE_FILE
from tripflow.sources.layers import layer_path, materialize

KEYS = ("source_file", "pickup_date", "dropoff_date")
_COUNTS = (
    "total_trips",
    "non_positive_distances",
    "excessive_distances",
    "free_long_trips",
    "negative_amounts",
    "zero_amounts",
    "excessive_amounts",
)


def load_profile(raw: DataFrame) -> DataFrame:
    """Counts and extremes per file, pickup date and dropoff date, nulls being groups of their own."""
    miles, amount = F.col("trip_distance"), F.col("total_amount")
    return raw.groupBy(
        F.col(SOURCE_FILE).alias("source_file"),
        epoch.epoch_date(F.col("tpep_pickup_datetime")).alias("pickup_date"),
        epoch.epoch_date(F.col("tpep_dropoff_datetime")).alias("dropoff_date"),
    ).agg(
        F.count("*").alias("total_trips"),
        F.count_if(miles <= 0).alias("non_positive_distances"),
        F.count_if(miles > 100).alias("excessive_distances"),
        F.count_if((miles > 5) & (amount <= 3.5)).alias("free_long_trips"),
        F.max(miles).alias("longest_distance"),
        F.count_if(amount < 0).alias("negative_amounts"),
        F.count_if(amount == 0).alias("zero_amounts"),
        F.count_if(amount > 500).alias("excessive_amounts"),
        F.min(F.when(amount < 0, amount)).alias("worst_negative"),
        F.max(amount).alias("highest_amount"),
    )


def _per_file(profile: DataFrame, *columns: Column) -> DataFrame:
    return profile.groupBy("source_file").agg(F.sum("total_trips").alias("total_trips"), *columns)


def _summed(*names: str) -> list[Column]:
    return [F.sum(name).alias(name) for name in names]


def file_month_anomalies(profile: DataFrame) -> DataFrame:
    month = F.col("_month")
    early = F.col("pickup_date") < F.date_sub(month, 1)
    past = (F.col("pickup_date") < month) & (F.col("dropoff_date") < month)

    def trips(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("total_trips")).otherwise(0))

    dated = profile.withColumn("_month", epoch.file_month(F.col("source_file")))
    found = _per_file(dated, trips(early).alias("pickup_anomalies"), trips(past).alias("past_dropoff_anomalies"))
    return found.withColumn("file_month", epoch.file_month_text(F.col("source_file")))


def distance_profile(profile: DataFrame) -> DataFrame:
    longest = round_half_away(F.max("longest_distance")).alias("longest_distance")
    return _per_file(profile, *_summed("non_positive_distances", "excessive_distances", "free_long_trips"), longest)


def amount_profile(profile: DataFrame) -> DataFrame:
    return _per_file(
        profile,
        *_summed("negative_amounts", "zero_amounts", "excessive_amounts"),
        round_half_away(F.min("worst_negative")).alias("worst_negative"),
        round_half_away(F.max("highest_amount")).alias("highest_amount"),
    )


def anomaly_rates(profile: DataFrame) -> DataFrame:
    def rate(count: str) -> Column:
        return round_half_away(F.sum(count) * 100.0 / F.sum("total_trips"))

    return _per_file(
        profile,
        rate("non_positive_distances").alias("non_positive_distance_pct"),
        rate("excessive_distances").alias("excessive_distance_pct"),
        rate("free_long_trips").alias("free_long_trip_pct"),
        rate("negative_amounts").alias("negative_amount_pct"),
        rate("zero_amounts").alias("zero_amount_pct"),
        rate("excessive_amounts").alias("excessive_amount_pct"),
    )


def load_recap(profile: DataFrame) -> DataFrame:
    dated = profile.filter("pickup_date IS NOT NULL").groupBy(F.trunc("pickup_date", "month").alias("_month"))
    return (
        dated.agg(F.sum("total_trips").alias("trips"))
        .select(F.year("_month").alias("year"), F.month("_month").alias("month"), "trips")
        .orderBy("year", "month")
    )


REPORTS = {
    "file_month_anomalies": file_month_anomalies,
    "distance_profile": distance_profile,
    "amount_profile": amount_profile,
    "anomaly_rates": anomaly_rates,
    "load_recap": load_recap,
}


def reports(profile: DataFrame) -> dict[str, DataFrame]:
    return {name: report(profile) for name, report in REPORTS.items()}


def build_load_reports(raw: DataFrame, root: str) -> dict[str, DataFrame]:
    """The five reports over the stored groups: raw is read once, when those are written."""
    return reports(materialize(load_profile(raw), root, "staging", "load_profile"))


def refresh_load_reports(
    spark: SparkSession, raw: str, root: str, batch_parts: int = BATCH_PARTS
) -> dict[str, DataFrame]:
    """The five reports on what raw (a path) holds now, reading parts loaded since the last refresh only."""
    shares = Shares(spark, raw, layer_path(root, "staging", "load_shares"))
    shares.add_missing(load_profile, batch_parts)
    groups = shares.current().withColumnRenamed("share_file", "source_file")
    combined = groups.groupBy(*KEYS).agg(
        *_summed(*_COUNTS),
        *[F.max(c).alias(c) for c in ("longest_distance", "highest_amount")],
        F.min("worst_negative").alias("worst_negative"),
    )
    return reports(materialize(combined, root, "final", "load_profile"))
