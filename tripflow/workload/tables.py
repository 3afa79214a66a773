"""Trip-shaped views over the shared test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.functions import epoch
from tripflow.schemas import SOURCE_FILE

# The tables hold no trips, so order lines stand in; the period and the excluded
# region replace the published window and the unknown boroughs.
PERIOD = ("1996-01-01", "2001-01-01")
EXCLUDED = ("MIDDLE EAST", "N/A")


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def trips_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips: one per order line, every fiftieth order doubled as exact duplicates."""
    line = _read(spark, sf_dir, "lineitem")
    order, part, supp, number = (
        F.col(f"l_{c}") for c in ("orderkey", "partkey", "suppkey", "linenumber")
    )
    shipped = F.col("_shipped")
    second_of_day = (part * 7919 + order * 31) % 86400
    seconds_driven = (order * 13 + part * 7 + number) % 21600 - 300
    fare = F.col("l_extendedprice") / 1e3 - 2.0
    tip = fare * F.col("l_discount") * 12.0
    tolls = F.col("l_tax") * 100.0
    named_month = F.when(
        order % 97 == 0, F.add_months(F.col("l_shipdate").cast("date"), 1)
    ).otherwise(F.col("l_shipdate").cast("date"))
    rate = supp % 10
    # the ship date (it has no time of day) in microseconds, twice for an order to be doubled
    once = F.unix_date(F.col("l_shipdate").cast("date")) * F.lit(epoch.DAY)
    copies = F.array_repeat(once, F.when(order % 50 == 0, 2).otherwise(1))
    return line.select("*", F.explode(copies).alias("_shipped")).select(
        (number % 2 + 1).cast("int").alias("VendorID"),
        (shipped + second_of_day * 1_000_000).alias("tpep_pickup_datetime"),
        (shipped + (second_of_day + seconds_driven) * 1_000_000).alias("tpep_dropoff_datetime"),
        F.nullif(F.col("l_quantity") % 8, F.lit(7.0)).alias("passenger_count"),
        (F.col("l_quantity") * 1.3 - 2.0).alias("trip_distance"),
        F.when(rate == 0, 99).when(rate < 7, rate).cast("int").alias("RatecodeID"),
        F.col("l_returnflag").alias("store_and_fwd_flag"),
        (supp % 25).cast("int").alias("PULocationID"),
        (part % 25).cast("int").alias("DOLocationID"),
        number.cast("int").alias("payment_type"),
        fare.alias("fare_amount"),
        F.lit(0.5).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        tip.alias("tip_amount"),
        tolls.alias("tolls_amount"),
        F.lit(1.0).alias("improvement_surcharge"),
        (F.col("l_extendedprice") / 1e3 + tip + tolls).alias("total_amount"),
        F.when(F.col("l_linestatus") == "O", 2.5).alias("congestion_surcharge"),
        F.when(F.col("l_returnflag") == "R", 1.75).alias("Airport_fee"),
        F.when(supp % 3 == 0, 0.75).alias("cbd_congestion_fee"),
        F.concat(
            F.lit("trips_"), F.date_format(named_month, "yyyy-MM"), F.lit(".parquet")
        ).alias(SOURCE_FILE),
        F.to_timestamp(F.lit("2026-01-01 00:00:00")).alias("_ingestion_date"),
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones: nations as zones, their regions as boroughs."""
    nation = _read(spark, sf_dir, "nation")
    region = _read(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("LOCATION_ID"),
        F.col("r_name").alias("BOROUGH"),
        F.col("n_name").alias("ZONE"),
        F.concat(F.col("r_name"), F.lit(" zone")).alias("SERVICE_ZONE"),
    )
