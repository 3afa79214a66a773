from __future__ import annotations

import datetime as dt

import pytest
from helpers import plan, raw_trips
from pyspark.sql import functions as F

from tripflow.operators import dashboards, marts, profiling
from tripflow.operators.cleaning import billing_profile, clean, mart_profile
from tripflow.operators.zones import enrich_zones
from tripflow.plans import cube, one_pass
from tripflow.schemas import ZONE_SCHEMA

ZONES = [
    (10, "North", "Hill", "Boro"),
    (11, "South", "Dale", "Boro"),
    (12, "Unknown", "Nowhere", None),
    (13, "N/A", "Nowhere", None),
    (14, None, "Lost", None),
]


def trips(spark):
    return clean(
        raw_trips(
            spark,
            *[{"PULocationID": 10, "total_amount": 10.0 + i} for i in range(4)],
            {"PULocationID": 11, "total_amount": 30.1},
            {"PULocationID": 12},
            {"PULocationID": 13},
            {"PULocationID": 14},
            {"PULocationID": 15},
        ),
        mart_profile(),
    )


def by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_unknown_places_drop_out(spark):
    zones = spark.createDataFrame(ZONES, ZONE_SCHEMA)
    found = by(marts.zone_analysis(trips(spark), zones), "pickup_location_id")
    assert set(found) == {10, 11}
    assert found[10]["total_pickups"] == 4
    assert found[10]["avg_fare"] == 11.5
    joined = enrich_zones(trips(spark), zones)
    assert joined.count() == 5


def test_zone_listed_twice_counts_as_in_a_join(spark):
    zones = spark.createDataFrame([*ZONES, ZONES[0], (11, "South", "Dell", "Boro")], ZONE_SCHEMA)
    mart = marts.zone_analysis(trips(spark), zones)
    per_trip = enrich_zones(trips(spark), zones).groupBy("zone_name").count()
    assert {r.zone_name: r.total_pickups for r in mart.collect()} == {
        r.zone_name: r["count"] for r in per_trip.collect()
    }
    assert {r.zone_name: r.avg_fare for r in mart.collect()}["Hill"] == 11.5


def test_zone_mart_aggregates_before_joining(spark):
    zones = spark.createDataFrame(ZONES, ZONE_SCHEMA)
    tree = plan(marts.zone_analysis(trips(spark), zones)).split("(1) ")[0]
    join = tree.index("Join")
    assert "HashAggregate" in tree[join:]
    assert "HashAggregate" not in tree[:join]
    assert "Cartesian" not in tree


@pytest.mark.parametrize(
    "plans, prepare", [(cube, cube.trip_cube), (one_pass, one_pass.mart_aggregates)]
)
def test_shared_aggregates_give_the_same_marts(spark, plans, prepare):
    zones = spark.createDataFrame(ZONES, ZONE_SCHEMA)
    clean_trips = trips(spark).unionByName(
        trips(spark).limit(1).withColumn("pickup_location_id", F.lit(None).cast("int"))
    )
    shared = prepare(clean_trips)
    for direct, derived in (
        (marts.daily_summary(clean_trips), plans.daily_summary(shared)),
        (marts.hourly_patterns(clean_trips), plans.hourly_patterns(shared)),
        (marts.zone_analysis(clean_trips, zones), plans.zone_analysis(shared, zones)),
    ):
        columns = direct.columns
        assert sorted(map(tuple, direct.collect())) == sorted(
            map(tuple, derived.select(*columns).collect())
        )


def test_one_pass_reads_trips_once(spark, tmp_path):
    path = str(tmp_path / "clean")
    trips(spark).write.parquet(path)
    tree = plan(one_pass.mart_aggregates(spark.read.parquet(path))).split("(1) ")[0]
    assert tree.count("Scan parquet") == 1
    assert tree.count("Exchange") == 1


def test_metrics_over_zero_fares_are_null(spark):
    raw = raw_trips(spark, {}, {"PULocationID": 11})
    staged = clean(raw, billing_profile()).withColumn("fare_amount", 0 * F.col("fare_amount"))
    assert marts.payment_metrics(staged).first().tip_ratio_percentage is None
    daily = marts.daily_metrics(staged).first()
    assert daily.global_tip_percentage is None
    assert daily.trip_date == dt.date(2024, 5, 10)
    assert (daily.trip_year, daily.trip_month, daily.total_duration_minutes) == (2024, 5, 30)
    assert daily.revenue_per_minute == 1.13  # 34 / 30


def test_top_zones_breaks_ties_by_id(spark):
    raw = raw_trips(spark, *[{"PULocationID": z} for z in (7, 3, 5, 5, 9)])
    top = dashboards.top_zones(clean(raw, mart_profile()), 3)
    assert [tuple(r) for r in top.collect()] == [(5, 2), (3, 1), (7, 1)]
    assert "TakeOrderedAndProject" in plan(top)


def test_kpi_slices(spark):
    staged = clean(
        raw_trips(
            spark,
            {},
            {"tpep_pickup_datetime": "2025-05-10 08:30:00",
             "tpep_dropoff_datetime": "2025-05-10 08:45:00"},
            {"tpep_pickup_datetime": "2024-08-01 08:30:00",
             "tpep_dropoff_datetime": "2024-08-01 08:45:00"},
        ),
        mart_profile(),
    )

    def count(**period):
        return dashboards.kpis(staged, **period).first().total_trips

    assert count() == 3
    assert (count(year=2024), count(quarter=2), count(month=8), count(day=10)) == (2, 2, 1, 2)
    assert count(year=2024, month=5, day=10) == 1
    nothing = dashboards.kpis(staged, year=1999).first()
    assert (nothing.total_trips, nothing.total_revenue, nothing.mean_ticket) == (0, None, None)


def test_load_recap_leaves_out_unknown_times(spark):
    raw = raw_trips(spark, {}, {"tpep_pickup_datetime": None}, {})
    assert [tuple(r) for r in dashboards.load_recap(raw).collect()] == [(2024, 5, 2)]


def test_anomalies_around_the_file_month(spark):
    june = {"_source_file": "trips_2024-06.parquet"}

    def trip(pickup, dropoff):
        return june | {"tpep_pickup_datetime": pickup, "tpep_dropoff_datetime": dropoff}

    raw = raw_trips(
        spark,
        trip("2024-05-31 00:00:00", "2024-05-31 00:10:00"),  # day before: past, not anomalous
        trip("2024-05-30 23:59:59", "2024-05-31 00:10:00"),  # earlier: both
        trip("2024-05-31 23:50:00", "2024-06-01 00:10:00"),  # ends inside
        trip("2024-07-02 00:00:00", "2024-07-02 00:10:00"),  # late pickups are not counted
        trip("2008-01-01 00:00:00", None),
        {"_source_file": "nameless.parquet"},
    )
    found = by(profiling.file_month_anomalies(raw), "source_file")
    june_row = found["trips_2024-06.parquet"]
    assert (june_row["total_trips"], june_row["pickup_anomalies"]) == (5, 2)
    assert june_row["past_dropoff_anomalies"] == 2
    assert found["nameless.parquet"]["file_month"] is None
    assert found["nameless.parquet"]["pickup_anomalies"] == 0


def test_frequency_share_reads_the_data_once(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw_trips(spark, *[{"RatecodeID": c} for c in (1, 1, 99, None)]).write.parquet(path)
    shares = profiling.frequency_share(spark.read.parquet(path), "RatecodeID")
    assert {r.RatecodeID: r.share_pct for r in shares.collect()} == {1: 50.0, 99: 25.0, None: 25.0}
    tree = plan(shares)
    assert "Cartesian" not in tree and "NestedLoop" not in tree
    executed = shares._jdf.queryExecution()
    executed.executedPlan().executeCollect()
    assert "ReusedExchange" in executed.executedPlan().toString()
