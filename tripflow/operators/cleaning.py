"""Cleaning profiles as named rules.

A rule is a name and the predicate a good row satisfies; a NULL outcome removes the
row. One rule list drives filtering, violation counts and retention. Predicates are
stated on raw columns so that plain comparisons, the pickup window among them, are
pushed into the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions import epoch
from tripflow.operators import standardize as std
from tripflow.operators.dedup import dedup_keep_first


@dataclass(frozen=True)
class Rule:
    name: str
    good: Column


@dataclass(frozen=True)
class Profile:
    name: str
    rules: Callable[[], Sequence[Rule]]
    layout: Callable[[DataFrame], DataFrame]
    unique_by: tuple[str, ...] = ()
    first_by: tuple[str, ...] = ()
    derived: tuple[str, ...] = ()  # columns that follow from others, so they break no tie
    prepare: Callable[[DataFrame], DataFrame] = lambda raw: raw  # adds what several rules or columns use


def _pickup_within(start: str, end: str) -> Column:
    pickup = std.pickup_us()
    return (pickup >= epoch.literal_micros(start)) & (pickup < epoch.literal_micros(end))


def file_month_ok(pickup_date: Column, month: Column) -> Column:
    """Pickup in the file's month, or on the day before it starts.

    So the month equals the pickup's own month or the day after the pickup, which
    needs the file name parsed only once per row.
    """
    return month.isin(F.trunc(pickup_date, "month"), F.date_add(pickup_date, 1))


def mart_profile(start: str = "2024-01-01", end: str = "2027-01-01") -> Profile:
    """Profile A: input of the marts."""

    def rules() -> list[Rule]:
        miles, fare, riders = F.col("trip_distance"), F.col("fare_amount"), F.col("passenger_count")
        minutes = std.trip_minutes()
        return [
            Rule("fare", fare > 0),
            Rule("distance", (miles > 0) & (miles < 50)),
            Rule("passengers", (riders > 0) & (riders <= 5)),
            Rule("tip_rate", F.try_divide(F.col("tip_amount"), fare) <= 1),
            Rule("period", _pickup_within(start, end)),
            Rule("duration", (minutes > 0) & (minutes < 300)),
            Rule("speed", F.try_divide(miles, minutes / F.lit(60.0)) <= 100),
        ]

    return Profile("A", rules, std.enriched)


def billing_profile() -> Profile:
    """Profile B: input of the metric views, deduplicated on the business key."""

    def rules() -> list[Rule]:
        pickup_date = epoch.epoch_date(std.pickup_us())
        return [
            Rule("chronology", std.dropoff_us() > std.pickup_us()),
            Rule("total", F.col("total_amount").between(3.5, 500.0)),
            Rule("fare", F.col("fare_amount") >= 2.5),
            Rule("distance", F.col("trip_distance").between(0.1, 100.0)),
            Rule("passengers", F.col("passenger_count").between(1, 5)),
            Rule("file_month", file_month_ok(pickup_date, F.col(std.FILE_MONTH))),
        ]

    return Profile(
        "B",
        rules,
        std.billing,
        # pickup time leads: it is the most selective key, so sorting rarely looks past it
        unique_by=(
            "pickup_datetime",
            "dropoff_datetime",
            "vendor_id",
            "pickup_location_id",
            "dropoff_location_id",
            "trip_distance",
            "total_amount",
        ),
        first_by=("source_file",),
        derived=("file_target_date",),
        prepare=std.with_file_month,
    )


def dashboard_profile(start: str = "2024-01-01", end: str = "2025-03-01") -> Profile:
    """Profile C: input of the dashboard; unknown passenger counts stay."""

    def rules() -> list[Rule]:
        miles, riders = F.col("trip_distance"), F.col("passenger_count")
        return [
            Rule("period", _pickup_within(start, end)),
            Rule("chronology", std.dropoff_us() > std.pickup_us()),
            Rule("distance", (miles > 0) & (miles < 1000)),
            Rule("amounts", (F.col("fare_amount") >= 0) & (F.col("total_amount") >= 0)),
            Rule("passengers", riders.isNull() | (riders > 0)),
        ]

    return Profile("C", rules, std.dashboard)


def passes(profile: Profile) -> Column:
    return reduce(Column.__and__, [rule.good for rule in profile.rules()])


def keep_good(raw: DataFrame, profile: Profile) -> DataFrame:
    """Raw rows that satisfy every rule, in raw columns and those the profile prepares."""
    return profile.prepare(raw).filter(passes(profile))


def clean(raw: DataFrame, profile: Profile) -> DataFrame:
    """Good rows in the profile's staging layout, one per business key if it has one."""
    staged = profile.layout(keep_good(raw, profile))
    if not profile.unique_by:
        return staged
    settled = {*profile.unique_by, *profile.first_by, *profile.derived}
    ties = [c for c in staged.columns if c not in settled]
    return dedup_keep_first(staged, profile.unique_by, profile.first_by, ties)


def ratecode_policy(
    df: DataFrame, column: str = "RatecodeID", mode: str = "null_unknown"
) -> DataFrame:
    """Treat rate codes: ``null_unknown`` maps 99 to NULL, ``drop_unknown`` keeps 1 to 6."""
    code = F.col(column)
    if mode == "null_unknown":
        return df.withColumn(column, F.when(code != 99, code))
    if mode == "drop_unknown":
        return df.filter(code.between(1, 6))
    raise ValueError(f"unknown rate code mode: {mode}")
