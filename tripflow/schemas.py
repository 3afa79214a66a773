"""Pinned schemas. Column names and their order are fixed by the data format."""

from __future__ import annotations

from pyspark.sql import types as T

# The published trip record layout.
BUSINESS_FIELDS = [
    T.StructField("VendorID", T.IntegerType()),
    T.StructField("tpep_pickup_datetime", T.LongType()),  # epoch microseconds
    T.StructField("tpep_dropoff_datetime", T.LongType()),  # epoch microseconds
    T.StructField("passenger_count", T.DoubleType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("RatecodeID", T.IntegerType()),
    T.StructField("store_and_fwd_flag", T.StringType()),
    T.StructField("PULocationID", T.IntegerType()),
    T.StructField("DOLocationID", T.IntegerType()),
    T.StructField("payment_type", T.IntegerType()),
    T.StructField("fare_amount", T.DoubleType()),
    T.StructField("extra", T.DoubleType()),
    T.StructField("mta_tax", T.DoubleType()),
    T.StructField("tip_amount", T.DoubleType()),
    T.StructField("tolls_amount", T.DoubleType()),
    T.StructField("improvement_surcharge", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("congestion_surcharge", T.DoubleType()),
    T.StructField("Airport_fee", T.DoubleType()),
]
BUSINESS_COLUMNS = [f.name for f in BUSINESS_FIELDS]

SOURCE_FILE = "_source_file"
INGESTION_DATE = "_ingestion_date"
PART = "_part"  # part file of a monthly file, in raw's folder layout only

RAW_TRIP_SCHEMA = T.StructType(
    BUSINESS_FIELDS
    + [
        T.StructField("cbd_congestion_fee", T.DoubleType()),
        T.StructField(SOURCE_FILE, T.StringType()),
        T.StructField(INGESTION_DATE, T.TimestampType()),
    ]
)

ZONE_SCHEMA = T.StructType(
    [
        T.StructField("LOCATION_ID", T.IntegerType()),
        T.StructField("BOROUGH", T.StringType()),
        T.StructField("ZONE", T.StringType()),
        T.StructField("SERVICE_ZONE", T.StringType()),
    ]
)
