"""Data-quality reports over raw trips, one scan each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions import epoch
from tripflow.functions.numeric import round_half_away
from tripflow.operators.cleaning import Profile, passes
from tripflow.schemas import SOURCE_FILE


def file_month_anomalies(raw: DataFrame) -> DataFrame:
    """Per file: pickups over a day before its month, and trips wholly before it.

    Trips are first counted per file, pickup date and dropoff date, which is all the
    tests depend on; file names are then parsed once per such group, not per trip.
    """
    per_day = raw.groupBy(
        F.col(SOURCE_FILE).alias("source_file"),
        epoch.epoch_date(F.col("tpep_pickup_datetime")).alias("_pickup"),
        epoch.epoch_date(F.col("tpep_dropoff_datetime")).alias("_dropoff"),
    ).agg(F.count("*").alias("_trips"))
    month = F.col("_month")
    early = F.col("_pickup") < F.date_sub(month, 1)
    past = (F.col("_pickup") < month) & (F.col("_dropoff") < month)
    return (
        per_day.withColumn("_month", epoch.file_month(F.col("source_file")))
        .groupBy("source_file")
        .agg(
            F.sum("_trips").alias("total_trips"),
            _summed_if(early, "_trips").alias("pickup_anomalies"),
            _summed_if(past, "_trips").alias("past_dropoff_anomalies"),
        )
        .withColumn("file_month", epoch.file_month_text(F.col("source_file")))
    )


def _summed_if(condition: Column, column: str) -> Column:
    return F.sum(F.when(condition, F.col(column)).otherwise(0))


def distance_profile(raw: DataFrame) -> DataFrame:
    miles = F.col("trip_distance")
    return raw.groupBy(F.col(SOURCE_FILE).alias("source_file")).agg(
        F.count("*").alias("total_trips"),
        F.count_if(miles <= 0).alias("non_positive_distances"),
        F.count_if(miles > 100).alias("excessive_distances"),
        round_half_away(F.max(miles)).alias("longest_distance"),
        F.count_if((miles > 5) & (F.col("total_amount") <= 3.5)).alias("free_long_trips"),
    )


def amount_profile(raw: DataFrame) -> DataFrame:
    amount = F.col("total_amount")
    return raw.groupBy(F.col(SOURCE_FILE).alias("source_file")).agg(
        F.count("*").alias("total_trips"),
        F.count_if(amount < 0).alias("negative_amounts"),
        round_half_away(F.min(F.when(amount < 0, amount))).alias("worst_negative"),
        F.count_if(amount == 0).alias("zero_amounts"),
        F.count_if(amount > 500).alias("excessive_amounts"),
        round_half_away(F.max(amount)).alias("highest_amount"),
    )


def frequency(df: DataFrame, column: str) -> DataFrame:
    """Rows per value; NULL is a value of its own."""
    return df.groupBy(column).agg(F.count("*").alias("trips"))


def frequency_share(df: DataFrame, column: str) -> DataFrame:
    """Frequencies with their share in percent.

    The total is a scalar summed over the counted values, not over the data again.
    """
    counts = frequency(df, column)
    whole = counts.agg(F.sum("trips")).scalar()
    return counts.withColumn("share_pct", round_half_away(F.col("trips") * 100.0 / whole))


def co_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many rows miss each column, and how many miss all of them."""
    missing = {c: F.col(c).isNull() for c in columns}
    together = None
    for flag in missing.values():
        together = flag if together is None else together & flag
    return df.agg(
        F.count("*").alias("total_rows"),
        *[F.count_if(flag).alias(f"null_{c}") for c, flag in missing.items()],
        F.count_if(together).alias("null_together"),
    )


def violations(raw: DataFrame, profile: Profile) -> DataFrame:
    """Rows breaking each rule of a profile; all rules share one scan."""
    rules = profile.rules()
    counted = profile.prepare(raw).agg(
        *[F.count_if(~F.coalesce(r.good, F.lit(False))).alias(r.name) for r in rules]
    )
    pairs = [F.struct(F.lit(r.name).alias("rule"), F.col(r.name).alias("rows")) for r in rules]
    return counted.select(F.inline(F.array(*pairs)))


def retention(raw: DataFrame, profile: Profile) -> DataFrame:
    """Rows before and after the profile's rules, counted in one scan."""
    counted = profile.prepare(raw).agg(
        F.count("*").alias("raw_rows"), F.count_if(passes(profile)).alias("clean_rows")
    )
    share = F.try_divide(F.col("clean_rows") * 100.0, F.col("raw_rows"))
    return counted.withColumn("retention_pct", round_half_away(share))


def anomaly_rates(raw: DataFrame) -> DataFrame:
    """Distance and amount anomalies per file, in percent of its trips."""
    miles, amount = F.col("trip_distance"), F.col("total_amount")

    def rate(condition: Column) -> Column:
        return round_half_away(F.count_if(condition) * 100.0 / F.count("*"))

    return raw.groupBy(F.col(SOURCE_FILE).alias("source_file")).agg(
        F.count("*").alias("total_trips"),
        rate(miles <= 0).alias("non_positive_distance_pct"),
        rate(miles > 100).alias("excessive_distance_pct"),
        rate((miles > 5) & (amount <= 3.5)).alias("free_long_trip_pct"),
        rate(amount < 0).alias("negative_amount_pct"),
        rate(amount == 0).alias("zero_amount_pct"),
        rate(amount > 500).alias("excessive_amount_pct"),
    )
