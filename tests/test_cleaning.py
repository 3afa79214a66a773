from __future__ import annotations

import pytest
from helpers import plan, raw_trips

from tripflow.operators import cleaning, profiling
from tripflow.operators.standardize import billing, dashboard, enriched

A = cleaning.mart_profile()
B = cleaning.billing_profile()
C = cleaning.dashboard_profile()


def kept(spark, profile, **change) -> bool:
    return cleaning.clean(raw_trips(spark, change), profile).count() == 1


def trip_of(minutes: float) -> dict:
    seconds = round(minutes * 60)
    hours, rest = divmod(seconds, 3600)
    return {
        "tpep_pickup_datetime": "2024-05-10 01:00:00",
        "tpep_dropoff_datetime": f"2024-05-10 {1 + hours:02d}:{rest // 60:02d}:{rest % 60:02d}",
    }


CASES = [
    (A, {}, True),
    (A, {"fare_amount": 0.0}, False),
    (A, {"fare_amount": None}, False),
    (A, {"trip_distance": 0.0}, False),
    (A, {"trip_distance": 0.01}, True),
    (A, {"trip_distance": 49.99} | trip_of(60), True),
    (A, {"trip_distance": 50.0} | trip_of(60), False),
    (A, {"passenger_count": 0.0}, False),
    (A, {"passenger_count": None}, False),
    (A, {"passenger_count": 5.0}, True),
    (A, {"passenger_count": 6.0}, False),
    (A, {"tip_amount": 12.0}, True),
    (A, {"tip_amount": 12.01}, False),
    (A, {"tip_amount": None}, False),
    (A, trip_of(0.9), False),
    (A, {"trip_distance": 1.0} | trip_of(1), True),
    (A, trip_of(299), True),
    (A, trip_of(300), False),
    (A, {"trip_distance": 25.0} | trip_of(15), True),  # exactly 100 mph
    (A, {"trip_distance": 25.01} | trip_of(15), False),
    (A, {"tpep_pickup_datetime": "2023-12-31 23:59:59",
         "tpep_dropoff_datetime": "2024-01-01 00:20:00"}, False),
    (A, {"tpep_pickup_datetime": "2024-01-01 00:00:00",
         "tpep_dropoff_datetime": "2024-01-01 00:20:00"}, True),
    (A, {"tpep_pickup_datetime": "2027-01-01 00:00:00",
         "tpep_dropoff_datetime": "2027-01-01 00:20:00"}, False),
    (B, {}, True),
    (B, {"total_amount": 3.5}, True),
    (B, {"total_amount": 3.49}, False),
    (B, {"total_amount": 500.0}, True),
    (B, {"total_amount": 500.01}, False),
    (B, {"fare_amount": 2.5}, True),
    (B, {"fare_amount": 2.49}, False),
    (B, {"trip_distance": 0.1}, True),
    (B, {"trip_distance": 0.09}, False),
    (B, {"trip_distance": 100.0}, True),
    (B, {"trip_distance": 100.01}, False),
    (B, {"passenger_count": None}, False),
    (B, {"passenger_count": 6.0}, False),
    (B, {"tpep_dropoff_datetime": "2024-05-10 08:30:00"}, False),
    (B, {"_source_file": "trips_2024-06.parquet"}, False),
    (B, {"_source_file": "trips_2024-06.parquet",
         "tpep_pickup_datetime": "2024-05-31 00:00:00",
         "tpep_dropoff_datetime": "2024-05-31 00:10:00"}, True),
    (B, {"_source_file": "trips_2024-06.parquet",
         "tpep_pickup_datetime": "2024-05-30 23:59:59",
         "tpep_dropoff_datetime": "2024-05-31 00:10:00"}, False),
    (B, {"_source_file": "trips_2024-04.parquet"}, False),
    (B, {"_source_file": "trips.parquet"}, False),
    (C, {}, True),
    (C, {"passenger_count": None}, True),
    (C, {"passenger_count": 0.0}, False),
    (C, {"passenger_count": 9.0}, True),
    (C, {"trip_distance": 999.0}, True),
    (C, {"trip_distance": 1000.0}, False),
    (C, {"fare_amount": 0.0}, True),
    (C, {"fare_amount": -0.01}, False),
    (C, {"total_amount": -1.0}, False),
    (C, {"tpep_pickup_datetime": "2025-03-01 00:00:00",
         "tpep_dropoff_datetime": "2025-03-01 00:10:00"}, False),
]


@pytest.mark.parametrize(
    "profile", [A, B, C], ids=["mart", "billing", "dashboard"]
)
def test_rule_boundaries(spark, profile):
    cases = [(i, change, good) for i, (p, change, good) in enumerate(CASES) if p is profile]
    # the vendor id names the case, so all cases pass through one job
    raw = raw_trips(spark, *[change | {"VendorID": i} for i, change, _ in cases])
    found = {r.vendor_id for r in cleaning.clean(raw, profile).collect()}
    assert found == {i for i, _, good in cases if good}


def test_violations_count_null_as_broken(spark):
    raw = raw_trips(spark, {}, {"passenger_count": None}, {"fare_amount": 0.0})
    found = {r.rule: r.rows for r in profiling.violations(raw, A).collect()}
    assert found["passengers"] == 1
    assert found["fare"] == 1
    assert found["tip_rate"] == 1  # a ratio over zero is unknown
    assert found["distance"] == 0


def test_retention_of_nothing(spark):
    empty = raw_trips(spark, {}).filter("VendorID = 0")
    assert profiling.retention(empty, A).first().retention_pct is None


def test_profiles_disagree_on_unknown_passengers(spark):
    raw = raw_trips(spark, {"passenger_count": None})
    assert [cleaning.clean(raw, p).count() for p in (A, B, C)] == [0, 0, 1]


def test_layout_columns(spark):
    raw = raw_trips(spark, {})
    assert len(enriched(raw).columns) == 24
    assert len(billing(raw).columns) == 22
    assert len(dashboard(raw).columns) == 23
    row = enriched(raw).first()
    assert (row.trip_duration_min, row.avg_speed_mph, row.tip_rate) == (15, 12.0, 0.25)
    assert (row.pickup_hour, row.pickup_dow, row.pickup_month) == (8, 5, "May")
    assert (row.distance_category, row.time_period) == ("medium", "morning_rush")
    assert billing(raw).first().airport_fee == 0.0
    assert dashboard(raw).first().pickup_dayname == "Fri"


def test_ratecode_policy(spark):
    raw = raw_trips(spark, *[{"RatecodeID": c} for c in (1, 6, 99, None)])
    mapped = [r.RatecodeID for r in cleaning.ratecode_policy(raw).collect()]
    assert sorted(mapped, key=str) == [1, 6, None, None]
    known = cleaning.ratecode_policy(raw, mode="drop_unknown").collect()
    assert sorted(r.RatecodeID for r in known) == [1, 6]
    with pytest.raises(ValueError, match="mode"):
        cleaning.ratecode_policy(raw, mode="other")


def test_plain_rules_reach_the_parquet_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw_trips(spark, {}).write.parquet(path)
    text = plan(cleaning.clean(spark.read.parquet(path), A).select("trip_distance"))
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line)
    for name in (
        "GreaterThan(fare_amount,0.0)",
        "LessThan(trip_distance,50.0)",
        "LessThanOrEqual(passenger_count,5.0)",
        "GreaterThanOrEqual(tpep_pickup_datetime,1704067200000000)",
        "LessThan(tpep_pickup_datetime,1798761600000000)",
    ):
        assert name in pushed
    read = next(line for line in text.splitlines() if "ReadSchema" in line)
    assert "mta_tax" not in read and "_source_file" not in read
