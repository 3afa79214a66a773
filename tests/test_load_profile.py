from __future__ import annotations

from helpers import plan, raw_trips

from tripflow.operators import dashboards, profiling
from tripflow.plans import load_profile, refresh
from tripflow.sources import trips as src
from tripflow.sources.trips import read_parts

ODD = [
    {},
    {"trip_distance": -1.0, "total_amount": float("nan")},
    {"trip_distance": 101.5, "total_amount": 600.0},
    {"trip_distance": 6.0, "total_amount": 0.0},
    {"total_amount": -3.555},
    {"total_amount": -9.0, "tpep_pickup_datetime": "2024-03-01 10:00:00"},
    {"tpep_pickup_datetime": "2024-04-02 10:00:00", "tpep_dropoff_datetime": "2024-04-02 10:05:00"},
    {"tpep_pickup_datetime": None, "trip_distance": None, "total_amount": None},
    {"tpep_dropoff_datetime": None},
    {"_source_file": "trips_2024-06.parquet", "trip_distance": float("inf")},
    {"_source_file": "unnamed.parquet", "total_amount": 500.0},
    {"_source_file": None, "trip_distance": 0.0},
]


def rows_of(df):
    return sorted(str(sorted(row.asDict().items())) for row in df.collect())


def single(raw):
    return {
        "file_month_anomalies": profiling.file_month_anomalies(raw),
        "distance_profile": profiling.distance_profile(raw),
        "amount_profile": profiling.amount_profile(raw),
        "anomaly_rates": profiling.anomaly_rates(raw),
        "load_recap": dashboards.load_recap(raw),
    }


def check(found, raw):
    wanted = single(raw)
    assert set(found) == set(wanted) == set(load_profile.REPORTS)
    for name, report in found.items():
        assert rows_of(report) == rows_of(wanted[name]), name
        assert dict(report.dtypes) == dict(wanted[name].dtypes), name


def test_reports_of_odd_rows(spark):
    raw = raw_trips(spark, *ODD)
    check(load_profile.reports(load_profile.load_profile(raw)), raw)
    check(load_profile.reports(load_profile.load_profile(raw.limit(0))), raw.limit(0))


def test_raw_is_read_once_for_all_reports(spark, tmp_path):
    raw_trips(spark, *ODD).write.parquet(f"{tmp_path}/trips")
    raw = spark.read.parquet(f"{tmp_path}/trips")
    grouped = load_profile.load_profile(raw)
    assert plan(grouped).count("Scan parquet") == 2  # the scan in the tree and its details
    for name, report in load_profile.build_load_reports(raw, f"{tmp_path}/lake").items():
        text = plan(report)
        assert text.count("Scan parquet") == 2 and "load_profile" in text and f"{tmp_path}/trips" not in text, name


def test_refresh_reads_parts_loaded_since(spark, tmp_path, monkeypatch):
    landing, raw, root = f"{tmp_path}/landing", f"{tmp_path}/raw", f"{tmp_path}/lake"
    read = []
    monkeypatch.setattr(refresh, "read_parts", lambda s, t, parts: read.extend(parts) or read_parts(s, t, parts))

    def land(changes):
        rows = raw_trips(spark, *[c for c in changes if c.get("_source_file", "x")])
        rows.drop("_ingestion_date").write.mode("append").partitionBy("_source_file").parquet(landing)
        src.load_new_files(spark, landing, raw)

    land(ODD)
    check(load_profile.refresh_load_reports(spark, raw, root), src.read_raw(spark, raw))
    first = set(read)
    read.clear()
    land(ODD[:3])  # more parts of the same months
    src.write_raw(raw_trips(spark, *ODD), raw)  # written directly, a file without a name among them
    check(load_profile.refresh_load_reports(spark, raw, root, batch_parts=1), src.read_raw(spark, raw))
    assert read and not first & set(read)
    read.clear()
    check(load_profile.refresh_load_reports(spark, raw, root), src.read_raw(spark, raw))
    assert not read


def test_a_months_read_lists_that_month_only(spark, tmp_path):
    landing, raw = f"{tmp_path}/landing", f"{tmp_path}/raw"
    months = [{"_source_file": f"trips 2024-{m:02d}.parquet"} for m in range(1, 6)]
    rows = raw_trips(spark, *months, *months)
    rows.drop("_ingestion_date").write.partitionBy("_source_file").parquet(landing)
    src.load_new_files(spark, landing, raw)
    src.write_raw(rows, raw)
    wanted = [months[1]["_source_file"], months[3]["_source_file"]]
    chosen = src.read_raw(spark, raw, [*wanted, "trips 2050-01.parquet", wanted[0]])
    every = src.read_raw(spark, raw)
    assert chosen.schema == every.schema
    assert rows_of(chosen) == rows_of(every.filter(every["_source_file"].isin(wanted)))
    listed = {path.rsplit("/", 3)[1] for path in chosen.inputFiles()}
    assert len(listed) == 2 and chosen.count() == 8
    assert src.read_raw(spark, raw, []).count() == src.read_raw(spark, raw, ["no such"]).count() == 0


def test_an_unrecorded_part_of_a_month_is_not_read(spark, tmp_path):
    raw = f"{tmp_path}/raw"
    src.write_raw(raw_trips(spark, {}, {}), raw)
    file = "trips_2024-05.parquet"
    left = raw_trips(spark, {}).drop("_source_file")
    left.write.parquet(f"{raw}/_source_file={file}/_part=broken")
    assert src.read_raw(spark, raw, [file]).count() == 2
