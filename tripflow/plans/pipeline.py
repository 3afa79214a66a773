"""Raw to staging to final, with the suites run on the stored tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.operators import dashboards, marts
from tripflow.operators.cleaning import (
    Profile,
    billing_profile,
    clean,
    dashboard_profile,
    mart_profile,
)
from tripflow.operators.expectations import run_suite
from tripflow.operators.zones import UNKNOWN_BOROUGHS
from tripflow.plans import cube, one_pass, suites
from tripflow.sources.layers import materialize


@dataclass(frozen=True)
class Built:
    staging: DataFrame
    daily: DataFrame
    zone: DataFrame
    hourly: DataFrame
    tests: DataFrame


def _staged(raw: DataFrame, profile: Profile, root: str, name: str) -> DataFrame:
    """Clean trips stored by pickup year and month."""
    trips = clean(raw, profile)
    day = F.col("pickup_date") if "pickup_date" in trips.columns else F.to_date("pickup_datetime")
    laid_out = trips.withColumns({"year": F.year(day), "month": F.month(day)})
    return materialize(laid_out, root, "staging", name, partition_by=["year", "month"])


def build(
    raw: DataFrame,
    zones: DataFrame,
    root: str,
    profile: Profile | None = None,
    exclude: Sequence[str] = UNKNOWN_BOROUGHS,
) -> Built:
    """Build and store the staging table and the marts, and test all four.

    Raw is read once, staging once for all marts and once for its suite. Staging is
    laid out by pickup year and month, so filters on these prune folders; raw comes in
    monthly files, so each writing task meets few months and no shuffle is needed.
    A failing step raises, so no mart is built on a missing staging table.
    """
    staging = _staged(raw, profile or mart_profile(), root, "clean_trips")
    groups = materialize(one_pass.mart_aggregates(staging), root, "staging", "mart_aggregates")
    daily = materialize(one_pass.daily_summary(groups), root, "final", "daily_summary")
    zone = materialize(
        one_pass.zone_analysis(groups, zones, exclude), root, "final", "zone_analysis"
    )
    hourly = materialize(one_pass.hourly_patterns(groups), root, "final", "hourly_patterns")
    tests = (
        run_suite(staging, "stg_clean_trips", suites.STAGING_SUITE)
        .unionByName(run_suite(daily, "daily_summary", suites.DAILY_SUITE))
        .unionByName(run_suite(zone, "zone_analysis", suites.ZONE_SUITE))
        .unionByName(run_suite(hourly, "hourly_patterns", suites.HOURLY_SUITE))
    )
    return Built(staging, daily, zone, hourly, tests)


def build_views(
    raw: DataFrame, root: str, profile: Profile | None = None
) -> dict[str, DataFrame]:
    """Store the deduplicated billing trips and register the metric views over them.

    The views are lazy; storing the trips spares each of them the deduplication.
    """
    staging = _staged(raw, profile or billing_profile(), root, "billing_trips")
    views = {
        "v_daily_metrics": marts.daily_metrics,
        "v_avg_payments": marts.payment_metrics,
        "v_top_zones": marts.route_metrics,
    }
    return {
        name: materialize(metrics(staging), root, "final", name, kind="view")
        for name, metrics in views.items()
    }


def build_dashboard(
    raw: DataFrame, root: str, profile: Profile | None = None, **period: int
) -> dict[str, DataFrame]:
    """Store the dashboard trips and give its five questions over them, for a period if given."""
    stored = _staged(raw, profile or dashboard_profile(), root, "dashboard_trips")
    staging = dashboards.slice_period(stored, **period)
    return {
        "kpis": dashboards.kpis(staging),
        "trips_per_day": dashboards.trips_per_day(staging),
        "trips_per_hour": dashboards.trips_per_hour(staging),
        "top_zones": dashboards.top_zones(staging),
        "payment_mix": dashboards.payment_mix(staging),
    }


def build_rollup(raw: DataFrame, root: str, profile: Profile | None = None) -> DataFrame:
    """Store the rollup of the clean trips by pickup date, hour and zone."""
    return materialize(cube.trip_cube(clean(raw, profile or mart_profile())), root, "final", "trip_cube")


def period_marts(
    rollup: DataFrame,
    zones: DataFrame,
    first: dt.date,
    last: dt.date,
    exclude: Sequence[str] = UNKNOWN_BOROUGHS,
) -> dict[str, DataFrame]:
    """The three marts of any range of days, from the stored rollup alone."""
    days = rollup.filter(F.col("pickup_date").between(first, last))
    return {
        "daily_summary": cube.daily_summary(days),
        "zone_analysis": cube.zone_analysis(days, zones, exclude),
        "hourly_patterns": cube.hourly_patterns(days),
    }
