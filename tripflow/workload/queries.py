"""Every operator as a query over the shared test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.functions import epoch
from tripflow.functions.labels import distance_category, payment_label
from tripflow.functions.numeric import fill_zero, guarded_ratio, speed_mph, to_km
from tripflow.operators import cleaning, dashboards, dedup, expectations, marts, profiling
from tripflow.operators import standardize as std
from tripflow.operators.zones import enrich_zones
from tripflow.plans import cube, load_profile, one_pass, suites
from tripflow.plans.pipeline import (
    build,
    build_dashboard,
    build_rollup,
    build_views,
    period_marts,
)
from tripflow.plans.refresh import refresh_marts
from tripflow.schemas import BUSINESS_COLUMNS, RAW_TRIP_SCHEMA, SOURCE_FILE
from tripflow.session import files_kept_open, shared_dir
from tripflow.sources.conform import evolve
from tripflow.sources.layers import layer_path, materialize, read_layer
from tripflow.sources.trips import (
    infer_trip_schema,
    load_new_files,
    monthly_paths,
    read_raw,
    read_trips,
    write_raw,
)
from tripflow.sources.zones import write_zones
from tripflow.streaming.ingest import ingest_drifting, ingest_incremental, read_streamed
from tripflow.workload.tables import EXCLUDED, PERIOD, trips_raw, zones

Query = Callable[[SparkSession, str], DataFrame]

PROFILE_A = cleaning.mart_profile(*PERIOD)
PROFILE_B = cleaning.billing_profile()
PROFILE_C = cleaning.dashboard_profile(*PERIOD)


def _over_raw(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(trips_raw(spark, sf_dir))


def _over_clean(
    profile: cleaning.Profile, operator: Callable[[DataFrame], DataFrame] = lambda df: df
) -> Query:
    return lambda spark, sf_dir: operator(cleaning.clean(trips_raw(spark, sf_dir), profile))


def _over_clean_and_zones(operator: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return operator(
            cleaning.clean(trips_raw(spark, sf_dir), PROFILE_A), zones(spark, sf_dir)
        )

    return run


def _trip_key() -> list[Column]:
    """Columns that tell trips apart in row-level results."""
    return [
        F.col("tpep_pickup_datetime").alias("pickup_us"),
        F.col("tpep_dropoff_datetime").alias("dropoff_us"),
        F.col("PULocationID").alias("pickup_location_id"),
        F.col("DOLocationID").alias("dropoff_location_id"),
    ]


def _row_level(**columns: Callable[[], Column]) -> Query:
    return _over_raw(
        lambda raw: raw.select(*_trip_key(), *[make().alias(n) for n, make in columns.items()])
    )


def _pickup_date() -> Column:
    return epoch.epoch_date(std.pickup_us())


# --- projections -----------------------------------------------------------------

PROJECTIONS: dict[str, Query] = {
    "std_trips": _over_raw(
        lambda raw: std.standardize(raw, std.DASHBOARD_NAMES | {SOURCE_FILE: "source_file"})
    ),
    "trip_times": _row_level(
        pickup_datetime=lambda: epoch.from_micros(std.pickup_us()),
        dropoff_datetime=lambda: epoch.from_micros(std.dropoff_us()),
    ),
    "calendar_parts": _row_level(
        pickup_hour=lambda: epoch.epoch_hour(std.pickup_us()),
        pickup_dow=lambda: epoch.day_of_week(_pickup_date()),
        pickup_date=_pickup_date,
        pickup_month=lambda: F.monthname(_pickup_date()),
        pickup_dayname=lambda: F.dayname(_pickup_date()),
        pickup_year=lambda: F.year(_pickup_date()),
        pickup_month_number=lambda: F.month(_pickup_date()),
    ),
    "duration_speed_tip": _row_level(
        trip_duration_min=std.trip_minutes,
        avg_speed_mph=lambda: speed_mph(F.col("trip_distance"), std.trip_minutes()),
        tip_rate=lambda: guarded_ratio(F.col("tip_amount"), F.col("fare_amount")),
    ),
    "distance_bucket": _row_level(
        trip_distance=lambda: F.col("trip_distance"),
        distance_category=lambda: distance_category(F.col("trip_distance")),
    ),
    "time_period": _row_level(
        time_period=lambda: epoch.time_period(epoch.epoch_hour(std.pickup_us()))
    ),
    "fill_surcharges": _row_level(
        congestion_surcharge=lambda: fill_zero(F.col("congestion_surcharge")),
        airport_fee=lambda: fill_zero(F.col("Airport_fee")),
        cbd_congestion_fee=lambda: fill_zero(F.col("cbd_congestion_fee")),
    ),
    "file_month": _row_level(
        source_file=lambda: F.col(SOURCE_FILE),
        file_month_text=lambda: epoch.file_month_text(F.col(SOURCE_FILE)),
        file_target_date=lambda: epoch.file_month(F.col(SOURCE_FILE)),
    ),
    "km": _row_level(distance_km=lambda: to_km(F.col("trip_distance"))),
    "payment_label": _row_level(
        payment_type=lambda: F.col("payment_type"),
        payment_label=lambda: payment_label(F.col("payment_type")),
    ),
}

# --- cleaning --------------------------------------------------------------------


def _billing_before_dedup(raw: DataFrame) -> DataFrame:
    return PROFILE_B.layout(cleaning.keep_good(raw, PROFILE_B))


CLEANING: dict[str, Query] = {
    "clean_a": _over_clean(PROFILE_A, lambda df: df.drop("ingestion_date")),
    "clean_b": _over_clean(PROFILE_B),
    "clean_b_before_dedup": _over_raw(_billing_before_dedup),
    "clean_c": _over_clean(PROFILE_C),
    "file_month_ok": _row_level(
        source_file=lambda: F.col(SOURCE_FILE),
        in_file_month=lambda: cleaning.file_month_ok(
            _pickup_date(), epoch.file_month(F.col(SOURCE_FILE))
        ),
    ),
    "ratecode_policy": _over_raw(
        lambda raw: profiling.frequency(cleaning.ratecode_policy(raw), "RatecodeID")
    ),
    "ratecode_known_only": _over_raw(
        lambda raw: cleaning.ratecode_policy(raw, mode="drop_unknown").select(
            *_trip_key(), "RatecodeID"
        )
    ),
    "dedup_first": _over_raw(
        lambda raw: dedup.dedup_keep_first(
            raw.select(*BUSINESS_COLUMNS, F.col(SOURCE_FILE).alias("source_file")),
            [
                "tpep_pickup_datetime",
                "tpep_dropoff_datetime",
                "VendorID",
                "PULocationID",
                "DOLocationID",
                "trip_distance",
                "total_amount",
            ],
            ["source_file"],
        )
    ),
    "dup_report": _over_raw(
        lambda raw: dedup.duplicate_report(raw, BUSINESS_COLUMNS, SOURCE_FILE).withColumnRenamed(
            SOURCE_FILE, "source_file"
        )
    ),
    "zone_join": _over_clean_and_zones(
        lambda trips, z: enrich_zones(trips, z, EXCLUDED).select(
            "pickup_datetime",
            "dropoff_datetime",
            "pickup_location_id",
            "dropoff_location_id",
            "borough",
            "zone_name",
            "service_zone",
            "total_amount",
        )
    ),
}

# --- marts -----------------------------------------------------------------------


def _cube_mart(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return _over_clean(PROFILE_A, lambda df: operator(cube.trip_cube(df)))


def _one_pass_mart(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return _over_clean(PROFILE_A, lambda df: operator(one_pass.mart_aggregates(df)))


def _with_odd_amounts(raw: DataFrame) -> DataFrame:
    """Some trips of no number and some of infinite amount, as a broken meter reports them."""
    second = F.pmod(F.expr("tpep_pickup_datetime div 1000000"), F.lit(997))
    odd = F.when(second == 3, float("nan")).when(second == 5, float("inf"))
    return raw.withColumn("total_amount", odd.otherwise(F.col("total_amount")))


MARTS: dict[str, Query] = {
    "nonfinite_amounts": _over_raw(
        lambda raw: marts.daily_summary(cleaning.clean(_with_odd_amounts(raw), PROFILE_A))
    ),
    "daily_summary": _over_clean(PROFILE_A, marts.daily_summary),
    "zone_analysis": _over_clean_and_zones(lambda t, z: marts.zone_analysis(t, z, EXCLUDED)),
    "hourly_patterns": _over_clean(PROFILE_A, marts.hourly_patterns),
    "daily_metrics": _over_clean(PROFILE_B, marts.daily_metrics),
    "payment_metrics": _over_clean(PROFILE_B, marts.payment_metrics),
    "route_metrics": _over_clean(PROFILE_B, marts.route_metrics),
    "cube_daily_summary": _cube_mart(cube.daily_summary),
    "cube_hourly_patterns": _cube_mart(cube.hourly_patterns),
    "cube_zone_analysis": _over_clean_and_zones(
        lambda t, z: cube.zone_analysis(cube.trip_cube(t), z, EXCLUDED)
    ),
    "one_pass_daily_summary": _one_pass_mart(one_pass.daily_summary),
    "one_pass_hourly_patterns": _one_pass_mart(one_pass.hourly_patterns),
    "one_pass_zone_analysis": _over_clean_and_zones(
        lambda t, z: one_pass.zone_analysis(one_pass.mart_aggregates(t), z, EXCLUDED)
    ),
}

# --- dashboards ------------------------------------------------------------------

DASHBOARDS: dict[str, Query] = {
    "kpis": _over_clean(PROFILE_C, dashboards.kpis),
    "trips_per_day": _over_clean(PROFILE_C, dashboards.trips_per_day),
    "trips_per_hour": _over_clean(PROFILE_C, dashboards.trips_per_hour),
    "top_zones": _over_clean(PROFILE_C, dashboards.top_zones),
    "payment_mix": _over_clean(PROFILE_C, dashboards.payment_mix),
    "load_recap": _over_raw(dashboards.load_recap),
    "dow_hour_matrix": _over_clean(PROFILE_A, dashboards.dow_hour_matrix),
    "top20_zones": _over_clean(PROFILE_A, lambda df: dashboards.top_zones(df, 20)),
    "borough_revenue": _over_clean_and_zones(
        lambda t, z: dashboards.borough_revenue(t, z, EXCLUDED)
    ),
    "distance_fare_points": _over_clean_and_zones(
        lambda t, z: dashboards.distance_fare_points(marts.zone_analysis(t, z, EXCLUDED))
    ),
    "speed_by_year": _over_clean(PROFILE_A, dashboards.speed_by_year),
    "revenue_tip_trend": _over_clean(PROFILE_A, dashboards.revenue_tip_trend),
    "kpis_sliced": _over_clean(
        PROFILE_A, lambda df: dashboards.kpis(df, year=1998, quarter=2, month=5)
    ),
}

# --- profiling and expectations --------------------------------------------------

PROFILING: dict[str, Query] = {
    "file_month_anomalies": _over_raw(profiling.file_month_anomalies),
    "distance_profile": _over_raw(profiling.distance_profile),
    "amount_profile": _over_raw(profiling.amount_profile),
    "freq_passengers": _over_raw(lambda raw: profiling.frequency(raw, "passenger_count")),
    "freq_ratecode": _over_raw(lambda raw: profiling.frequency(raw, "RatecodeID")),
    "freq_share": _over_raw(lambda raw: profiling.frequency_share(raw, "RatecodeID")),
    "co_null": _over_raw(lambda raw: profiling.co_null(raw, ["RatecodeID", "passenger_count"])),
    "violations_a": _over_raw(lambda raw: profiling.violations(raw, PROFILE_A)),
    "violations_b": _over_raw(lambda raw: profiling.violations(raw, PROFILE_B)),
    "violations_c": _over_raw(lambda raw: profiling.violations(raw, PROFILE_C)),
    "retention": _over_raw(lambda raw: profiling.retention(raw, PROFILE_A)),
    "anomaly_rates": _over_raw(profiling.anomaly_rates),
}


def _suite(model: str, operator: Callable[[DataFrame], DataFrame], checks: list) -> Query:
    return _over_clean(
        PROFILE_A, lambda df: expectations.run_suite(operator(df), model, checks)
    )


SUITES: dict[str, Query] = {
    "suite_stg": _suite("stg_clean_trips", lambda df: df, suites.STAGING_SUITE),
    "suite_daily": _suite("daily_summary", marts.daily_summary, suites.DAILY_SUITE),
    "suite_hourly": _suite("hourly_patterns", marts.hourly_patterns, suites.HOURLY_SUITE),
    "suite_zone": _over_clean_and_zones(
        lambda t, z: expectations.run_suite(
            marts.zone_analysis(t, z, EXCLUDED), "zone_analysis", suites.ZONE_SUITE
        )
    ),
    "suite_raw": _over_raw(
        lambda raw: expectations.run_suite(
            raw.withColumnsRenamed(std.ENRICHED_NAMES),
            "raw_trips",
            [
                expectations.not_null("passenger_count"),
                expectations.accepted_values("payment_type", [1, 2, 3, 4, 5, 6]),
                expectations.min_value("trip_distance", 0),
                expectations.max_value("trip_distance", 50),
                expectations.unique("pickup_location_id"),
            ],
        )
    ),
    "failing_rows": _over_raw(
        lambda raw: expectations.failing_rows(
            raw.select(*_trip_key(), "trip_distance"), expectations.max_value("trip_distance", 50)
        )
    ),
}

# --- sources, sinks and ingestion ------------------------------------------------


def _land(df: DataFrame, landing: str) -> None:
    """Write trips as monthly files; rebalancing splits a month too large for one task."""
    balanced = df.hint("rebalance", SOURCE_FILE)
    with files_kept_open(df.sparkSession):
        balanced.write.mode("append").partitionBy(SOURCE_FILE).parquet(landing)


def _as_first_half(raw: DataFrame) -> DataFrame:
    """Trips of files up to 1998 as an older exporter wrote them: other types and case."""
    return raw.filter(F.col(SOURCE_FILE) < "trips_1999").select(
        F.col("VendorID").cast("bigint").alias("vendorid"),
        *[c for c in BUSINESS_COLUMNS[1:] if c not in ("RatecodeID", "Airport_fee")],
        F.col("RatecodeID").cast("double").alias("RatecodeID"),
        F.col("Airport_fee").alias("airport_fee"),
        SOURCE_FILE,
    )


def _as_second_half(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col(SOURCE_FILE) >= "trips_1999").drop("_ingestion_date")


def _mixed_landing(spark: SparkSession, sf_dir: str, landing: str) -> None:
    raw = trips_raw(spark, sf_dir)
    _land(_as_first_half(raw), landing)
    _land(_as_second_half(raw), landing)


def _without_load_time(df: DataFrame) -> DataFrame:
    names = [f.name for f in RAW_TRIP_SCHEMA.fields if f.name != "_ingestion_date"]
    return df.select(*names).withColumnRenamed(SOURCE_FILE, "source_file")


def read_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly files of two schema generations read as one table."""
    landing = shared_dir(spark, "landing")
    _mixed_landing(spark, sf_dir, landing)
    return _without_load_time(read_trips(spark, f"{landing}/*"))


def schema_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Older trips without the newest fee, then newer ones that bring it."""
    raw = trips_raw(spark, sf_dir).drop("_ingestion_date")
    older = raw.filter(F.col(SOURCE_FILE) < "trips_1999").drop("cbd_congestion_fee")
    newer = raw.filter(F.col(SOURCE_FILE) >= "trips_1999")
    return evolve(older, newer).withColumnRenamed(SOURCE_FILE, "source_file")


def load_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings of differing types loaded in three runs, the last one a rerun."""
    work = shared_dir(spark, "incremental")
    landing, target = f"{work}/landing", layer_path(work, "raw", "trips")
    raw = trips_raw(spark, sf_dir)
    _land(_as_first_half(raw), landing)
    load_new_files(spark, landing, target)
    _land(_as_second_half(raw), landing)
    load_new_files(spark, landing, target)
    load_new_files(spark, landing, target)
    return _without_load_time(read_raw(spark, target))


def stream_drifting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings of differing types as a stream, then all batches again under a new checkpoint."""
    work = shared_dir(spark, "drifting")
    landing, target = f"{work}/landing", layer_path(work, "raw", "trips")
    raw = trips_raw(spark, sf_dir)
    _land(_as_first_half(raw), landing)
    ingest_drifting(spark, landing, target, f"{work}/checkpoint")
    _land(_as_second_half(raw), landing)
    for checkpoint in ("checkpoint", "checkpoint", "another"):
        ingest_drifting(spark, landing, target, f"{work}/{checkpoint}")
    return _without_load_time(read_raw(spark, target))


def stream_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through the streaming file source, for files that share their types."""
    work = shared_dir(spark, "stream")
    landing, target = f"{work}/landing", layer_path(work, "raw", "trips")
    raw = trips_raw(spark, sf_dir).drop("_ingestion_date")
    _land(raw.filter(F.col(SOURCE_FILE) < "trips_1999"), landing)
    files = infer_trip_schema(spark, [f"{landing}/*"])
    ingest_incremental(spark, landing, target, f"{work}/checkpoint", files)
    _land(raw.filter(F.col(SOURCE_FILE) >= "trips_1999"), landing)
    ingest_incremental(spark, landing, target, f"{work}/checkpoint", files)
    ingest_incremental(spark, landing, target, f"{work}/checkpoint", files)
    return _without_load_time(spark.read.parquet(target))


def overwrite_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written, appended to, then reloaded in full: only the reload remains."""
    target = layer_path(shared_dir(spark, "reload"), "raw", "trips")
    raw = trips_raw(spark, sf_dir)
    write_raw(raw.filter("payment_type = 1"), target, "append")
    write_raw(raw.filter("payment_type = 2"), target, "append")
    write_raw(raw, target, "overwrite")
    return profiling.frequency(read_raw(spark, target), "payment_type")


def _breaking(rows: DataFrame) -> DataFrame:
    """The rows with a column whose computation ends the task."""
    return rows.withColumn("passenger_count", F.when(F.col("VendorID") > 0, F.raise_error(F.lit("broken on purpose"))))


def _expect_failure(work: Callable[[], object]) -> None:
    try:
        work()
    except PySparkException:
        return
    raise RuntimeError("this was to fail")


def rebuild_after_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart whose rebuild failed in a task: its former rows are still there."""
    root, raw = shared_dir(spark, "rebuild"), trips_raw(spark, sf_dir)

    def rebuild(rows: DataFrame) -> None:
        staged = materialize(cleaning.clean(rows, PROFILE_A), root, "staging", "clean_trips")
        materialize(marts.daily_summary(staged), root, "final", "daily_summary")

    rebuild(raw)
    _expect_failure(lambda: rebuild(_breaking(raw)))
    _expect_failure(lambda: materialize(_breaking(raw), root, "final", "daily_summary"))
    return read_layer(spark, root, "final", "daily_summary")


def reload_after_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw table whose reload failed in a task: its former loads and their log are still there."""
    work = shared_dir(spark, "reload-failure")
    landing, target = f"{work}/landing", layer_path(work, "raw", "trips")
    raw = trips_raw(spark, sf_dir)
    _land(raw.drop("_ingestion_date"), landing)
    load_new_files(spark, landing, target)
    write_raw(raw.filter("payment_type = 1"), target)
    _expect_failure(lambda: write_raw(_breaking(raw), target, "overwrite"))
    again = len(load_new_files(spark, landing, target).loaded)
    found = profiling.frequency(read_raw(spark, target), "payment_type")
    return found.withColumn("loaded_again", F.lit(again).cast("bigint"))


def _refreshed(mart: str) -> Query:
    """A mart refreshed after each of two landings and after rows written directly; only new parts are read."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        work = shared_dir(spark, "refresh")
        landing, target = f"{work}/landing", layer_path(work, "raw", "trips")
        raw = trips_raw(spark, sf_dir)
        files, known = raw.filter("payment_type <> 2").drop("_ingestion_date"), zones(spark, sf_dir)
        for landed in (files.filter(F.col(SOURCE_FILE) < "trips_1998"), files.filter(F.col(SOURCE_FILE) >= "trips_1998")):
            _land(landed, landing)
            load_new_files(spark, landing, target)
            refresh_marts(spark, target, known, work, PROFILE_A, EXCLUDED)
        write_raw(raw.filter("payment_type = 2"), target)
        return refresh_marts(spark, target, known, work, PROFILE_A, EXCLUDED)[mart]

    return run


def _load_report(name: str) -> Query:
    """A report from the groups stored after one read of raw."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return load_profile.build_load_reports(trips_raw(spark, sf_dir), shared_dir(spark, "profile"))[name]

    return run


def _refreshed_report(name: str) -> Query:
    """A report refreshed after each of two landings and after rows written directly; only new parts are read."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        work = shared_dir(spark, "profile")
        landing, target = f"{work}/landing", layer_path(work, "raw", "trips")
        raw = trips_raw(spark, sf_dir)
        files = raw.filter("payment_type <> 2").drop("_ingestion_date")
        for landed in (files.filter(F.col(SOURCE_FILE) < "trips_1998"), files.filter(F.col(SOURCE_FILE) >= "trips_1998")):
            _land(landed, landing)
            load_new_files(spark, landing, target)
            load_profile.refresh_load_reports(spark, target, work)
        write_raw(raw.filter("payment_type = 2"), target)
        return load_profile.refresh_load_reports(spark, target, work)[name]

    return run


def read_loaded_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of some months of raw, loaded and written directly; other months are not listed."""
    work = shared_dir(spark, "months")
    landing, target = f"{work}/landing", layer_path(work, "raw", "trips")
    raw = trips_raw(spark, sf_dir)
    _land(raw.filter("payment_type <> 2").drop("_ingestion_date"), landing)
    load_new_files(spark, landing, target)
    write_raw(raw.filter("payment_type = 2"), target)
    months = [f"trips_{year}-{month:02d}.parquet" for year in (1996, 1997, 2044) for month in range(1, 13)]
    return profiling.distance_profile(read_raw(spark, target, months))


def append_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = layer_path(shared_dir(spark, "append"), "raw", "trips")
    raw = trips_raw(spark, sf_dir)
    write_raw(raw.filter("payment_type <= 3"), target, "append")
    write_raw(raw.filter("payment_type > 3"), target, "append")
    return profiling.frequency(read_raw(spark, target), "payment_type")


def append_after_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows appended to a table that files were loaded into, and files loaded after that."""
    work = shared_dir(spark, "append-after-load")
    landing, target = f"{work}/landing", layer_path(work, "raw", "trips")
    raw = trips_raw(spark, sf_dir)
    files = raw.drop("_ingestion_date")
    _land(files.filter(F.col(SOURCE_FILE) < "trips_1995"), landing)
    load_new_files(spark, landing, target)
    write_raw(raw.filter("payment_type = 1"), target, "append")
    _land(files.filter(F.col(SOURCE_FILE) >= "trips_1995"), landing)
    load_new_files(spark, landing, target)
    return profiling.frequency(read_raw(spark, target), "payment_type")


def ingest_late_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month folders that receive further part files after they were loaded."""
    work = shared_dir(spark, "late-parts")
    landing, target = f"{work}/landing", layer_path(work, "raw", "trips")
    files = trips_raw(spark, sf_dir).drop("_ingestion_date")
    for chosen in ("payment_type <= 2", "payment_type > 2", "false"):
        _land(files.filter(chosen), landing)
        load_new_files(spark, landing, target)
    return _without_load_time(read_raw(spark, target))


def ingest_skip_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file that is no Parquet file among the landing files: all others are loaded."""
    work = shared_dir(spark, "skip-bad")
    landing, target = f"{work}/landing", layer_path(work, "raw", "trips")
    _land(trips_raw(spark, sf_dir).drop("_ingestion_date"), landing)
    damaged = spark._jvm.org.apache.hadoop.fs.Path(f"{landing}/trips_2050-01.parquet")
    out = damaged.getFileSystem(spark._jsc.hadoopConfiguration()).create(damaged)
    out.writeBytes("not a parquet file")
    out.close()
    report = load_new_files(spark, landing, target, on_error="skip")
    skipped = F.lit(len(report.skipped)).cast("bigint")
    return _without_load_time(read_raw(spark, target)).withColumn("skipped_files", skipped)


def _generations(raw: DataFrame) -> list[DataFrame]:
    """Trips of an exporter with a fee no schema knows, then of one with a second such fee."""
    files = raw.drop("_ingestion_date").withColumn("night_fee", F.col("VendorID") * 0.25)
    first = files.filter(F.col(SOURCE_FILE) < "trips_1999").drop("cbd_congestion_fee")
    second = files.filter(F.col(SOURCE_FILE) >= "trips_1999")
    return [first, second.withColumn("port_fee", (F.col("PULocationID") + 1).cast("int"))]


def ingest_evolving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that appear from one landing to the next, in batch and as a stream."""
    work = shared_dir(spark, "evolving")
    landing, target, sink = f"{work}/landing", layer_path(work, "raw", "trips"), f"{work}/sink"
    for generation in [*_generations(trips_raw(spark, sf_dir)), None]:
        if generation is not None:
            _land(generation, landing)
        load_new_files(spark, landing, target)
        files = infer_trip_schema(spark, [f"{landing}/*"])
        ingest_incremental(spark, landing, sink, f"{work}/checkpoint", files)
    batch = read_raw(spark, target).withColumn("via", F.lit("batch"))
    stream = read_streamed(spark, sink).withColumn("via", F.lit("stream"))
    both = batch.unionByName(stream)
    return both.drop("_ingestion_date").withColumnRenamed(SOURCE_FILE, "source_file")


def lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips per source file as found from the paths of the files read."""
    landing = shared_dir(spark, "lineage")
    _land(trips_raw(spark, sf_dir).drop("_ingestion_date"), landing)
    trips = read_trips(spark, f"{landing}/*")
    return trips.groupBy(F.col(SOURCE_FILE).alias("source_file")).agg(
        F.count("*").alias("trips"),
        F.count_if(F.col("_ingestion_date").isNull()).alias("without_load_time"),
    )


def zones_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones loaded into raw twice: the second load replaces the first; N/A comes back as NULL."""
    work = shared_dir(spark, "zones")
    path, target = f"{work}/csv", layer_path(work, "raw", "zones")
    marked = zones(spark, sf_dir).withColumn(
        "BOROUGH", F.when(F.col("BOROUGH") == "AFRICA", "N/A").otherwise(F.col("BOROUGH"))
    )
    renamed = marked.toDF("LocationID", "Borough", "Zone", "service_zone")
    renamed.write.option("header", "true").csv(path)
    write_zones(spark, path, target)
    return write_zones(spark, path, target)


def read_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly files of three years picked by one glob; the last year has none."""
    landing = shared_dir(spark, "monthly")
    _land(trips_raw(spark, sf_dir).drop("_ingestion_date"), landing)
    pattern = f"{SOURCE_FILE}=trips_{{year}}-{{month}}.parquet"
    trips = read_trips(spark, monthly_paths(landing, [1996, 1997, 2044], pattern))
    return profiling.distance_profile(trips)


def _view(name: str) -> Query:
    """A metric view over the stored billing trips."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = shared_dir(spark, "views")
        return build_views(trips_raw(spark, sf_dir), root, PROFILE_B)[name]

    return run


def _panel(name: str, **period: int) -> Query:
    """A dashboard question over the stored dashboard trips."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = shared_dir(spark, "dashboard")
        return build_dashboard(trips_raw(spark, sf_dir), root, PROFILE_C, **period)[name]

    return run


def _of_period(mart: str) -> Query:
    """A mart of half a year from the stored rollup."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rollup = build_rollup(trips_raw(spark, sf_dir), shared_dir(spark, "rollup"), PROFILE_A)
        half = (dt.date(1996, 4, 1), dt.date(1996, 9, 30))
        return period_marts(rollup, zones(spark, sf_dir), *half, EXCLUDED)[mart]

    return run


def pipeline_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw to marts through stored layers; the outcome of all suites."""
    built = build(
        trips_raw(spark, sf_dir),
        zones(spark, sf_dir),
        shared_dir(spark, "pipeline"),
        PROFILE_A,
        EXCLUDED,
    )
    return built.tests


INGESTION: dict[str, Query] = {
    "read_conform": read_conform,
    "schema_evolve": schema_evolve,
    "ingest_incremental": load_incremental,
    "ingest_stream": stream_incremental,
    "overwrite_reload": overwrite_reload,
    "append_load": append_load,
    "append_after_load": append_after_load,
    "ingest_stream_drifting": stream_drifting,
    "rebuild_after_failure": rebuild_after_failure,
    "reload_after_failure": reload_after_failure,
    **{f"refresh_{m}": _refreshed(m) for m in ("daily_summary", "zone_analysis", "hourly_patterns")},
    **{f"profile_{r}": _load_report(r) for r in load_profile.REPORTS},
    **{f"profile_refresh_{r}": _refreshed_report(r) for r in ("file_month_anomalies", "amount_profile")},
    "read_loaded_months": read_loaded_months,
    "ingest_late_parts": ingest_late_parts,
    "ingest_skip_bad": ingest_skip_bad,
    "ingest_evolving": ingest_evolving,
    "lineage": lineage,
    "zones_csv": zones_csv,
    "read_monthly": read_monthly,
    "staged_view": _view("v_avg_payments"),
    "staged_daily_view": _view("v_daily_metrics"),
    "staged_route_view": _view("v_top_zones"),
    "staged_kpis": _panel("kpis"),
    "staged_kpis_sliced": _panel("kpis", year=1998, quarter=2),
    "staged_top_zones": _panel("top_zones"),
    "period_daily_summary": _of_period("daily_summary"),
    "period_zone_analysis": _of_period("zone_analysis"),
    "period_hourly_patterns": _of_period("hourly_patterns"),
    "pipeline_tests": pipeline_tests,
}

QUERIES: dict[str, Query] = (
    PROJECTIONS | CLEANING | MARTS | DASHBOARDS | PROFILING | SUITES | INGESTION
)
