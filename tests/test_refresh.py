from __future__ import annotations

import pytest
from helpers import raw_trips
from pyspark.sql import functions as F

from tripflow.operators import marts
from tripflow.operators.cleaning import billing_profile, clean, mart_profile
from tripflow.plans import refresh
from tripflow.plans.refresh import Shares, refresh_marts
from tripflow.schemas import ZONE_SCHEMA
from tripflow.sources import trips as src
from tripflow.sources.layers import layer_path


def rows_of(df):
    return sorted(map(str, df.collect()))


def check(spark, raw, root, zones):
    found = refresh_marts(spark, raw, zones, root)
    trips = clean(src.read_raw(spark, raw), mart_profile())
    assert rows_of(found["daily_summary"]) == rows_of(marts.daily_summary(trips))
    assert rows_of(found["hourly_patterns"]) == rows_of(marts.hourly_patterns(trips))
    assert rows_of(found["zone_analysis"]) == rows_of(marts.zone_analysis(trips, zones))
    return found["daily_summary"]


def land(spark, folder, month, *changes):
    rows = raw_trips(spark, *[{"_source_file": f"trips 2024-{month}.parquet"} | c for c in changes])
    rows.drop("_ingestion_date").write.mode("append").partitionBy("_source_file").parquet(folder)


def test_refresh_reads_new_parts_only(spark, tmp_path, monkeypatch):
    landing, raw, root = f"{tmp_path}/landing", f"{tmp_path}/raw", str(tmp_path / "lake")
    zones = spark.createDataFrame([(10, "North", "Hill", "Boro")], ZONE_SCHEMA)
    read = []
    read_parts = refresh.read_parts
    monkeypatch.setattr(refresh, "read_parts", lambda s, t, parts: read.append(parts) or read_parts(s, t, parts))
    land(spark, landing, "05", {}, {"tip_amount": 2.5}, {"fare_amount": -1.0})
    src.load_new_files(spark, landing, raw)
    check(spark, raw, root, zones)
    first = {part for parts in read for part in parts}
    read.clear()
    assert check(spark, raw, root, zones).count() and not read  # nothing new, nothing read
    land(spark, landing, "06", {"tpep_pickup_datetime": "2024-06-01 10:00:00", "tpep_dropoff_datetime": "2024-06-01 10:20:00"})
    land(spark, landing, "05", {"total_amount": 99.0})  # a late part of a month already refreshed
    src.load_new_files(spark, landing, raw)
    check(spark, raw, root, zones)
    assert read and not first & {part for parts in read for part in parts}
    read.clear()
    src.write_raw(raw_trips(spark, {}, {"PULocationID": 11}), raw)
    check(spark, raw, root, zones)
    assert [file for parts in read for file, _ in parts] == [None]


def test_a_part_loaded_again_replaces_its_share(spark, tmp_path):
    landing, raw, root = f"{tmp_path}/landing", f"{tmp_path}/raw", str(tmp_path / "lake")
    zones = spark.createDataFrame([(10, "North", "Hill", "Boro")], ZONE_SCHEMA)
    land(spark, landing, "05", {}, {})
    src.load_new_files(spark, landing, raw)
    check(spark, raw, root, zones)
    shares = Shares(spark, raw, layer_path(root, "staging", "trip_shares"))
    log = src.LoadLog(spark, raw)
    part = log.entries().filter("unit IS NOT NULL").first()
    log.record([(part["source_file"], part["part"], part["unit"])], log.columns())
    assert shares.missing().count() == 1
    before = spark.read.parquet(f"{shares.path}/batch=*").count()
    assert check(spark, raw, root, zones).agg(F.sum("total_trips")).first()[0] == 2
    assert spark.read.parquet(f"{shares.path}/batch=*").count() > before
    src.write_raw(raw_trips(spark, {}), raw, "overwrite")
    assert check(spark, raw, root, zones).agg(F.sum("total_trips")).first()[0] == 1
    with pytest.raises(ValueError, match="different parts"):
        refresh_marts(spark, raw, zones, root, billing_profile())


def test_a_refresh_that_breaks_off_is_repeated(spark, tmp_path, monkeypatch):
    landing, raw, root = f"{tmp_path}/landing", f"{tmp_path}/raw", str(tmp_path / "lake")
    zones = spark.createDataFrame([(10, "North", "Hill", "Boro")], ZONE_SCHEMA)
    land(spark, landing, "05", {}, {})
    land(spark, landing, "07", {})
    src.load_new_files(spark, landing, raw)
    make = refresh.cube.trip_cube
    monkeypatch.setattr(refresh.cube, "trip_cube", lambda *a: make(*a).filter(F.raise_error(F.lit("lost")).isNull()))
    with pytest.raises(Exception, match="lost"):
        refresh_marts(spark, raw, zones, root, batch_parts=1)
    monkeypatch.setattr(refresh.cube, "trip_cube", make)
    check(spark, raw, root, zones)


def test_a_refresh_reads_the_shares_once(spark, tmp_path, monkeypatch):
    landing, raw, root = f"{tmp_path}/landing", f"{tmp_path}/raw", str(tmp_path / "lake")
    zones = spark.createDataFrame([(10, "North", "Hill", "Boro"), (None, "South", None, None)], ZONE_SCHEMA)
    stored = []

    def materialize(df, folder, layer, name):
        stored.append((name, sum("trip_shares" in path for path in df.inputFiles())))
        return build(df, folder, layer, name)

    build = refresh.materialize
    monkeypatch.setattr(refresh, "materialize", materialize)
    land(spark, landing, "05", {}, {"PULocationID": None}, {"total_amount": float("nan")}, {"total_amount": float("inf")})
    land(spark, landing, "06", {"PULocationID": 11, "tip_amount": None}, {"trip_distance": None})
    src.load_new_files(spark, landing, raw)
    check(spark, raw, root, zones)
    assert sorted(name for name, _ in stored) == ["daily_summary", "hourly_patterns", "mart_aggregates", "zone_analysis"]
    assert [name for name, files in stored if files] == ["mart_aggregates"]
