from __future__ import annotations

import contextlib
import datetime as dt
import io

from tripflow.schemas import RAW_TRIP_SCHEMA

GOOD_TRIP = {
    "VendorID": 1,
    "tpep_pickup_datetime": "2024-05-10 08:30:00",
    "tpep_dropoff_datetime": "2024-05-10 08:45:00",
    "passenger_count": 1.0,
    "trip_distance": 3.0,
    "RatecodeID": 1,
    "store_and_fwd_flag": "N",
    "PULocationID": 10,
    "DOLocationID": 20,
    "payment_type": 1,
    "fare_amount": 12.0,
    "extra": 0.5,
    "mta_tax": 0.5,
    "tip_amount": 3.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 1.0,
    "total_amount": 17.0,
    "congestion_surcharge": None,
    "Airport_fee": None,
    "cbd_congestion_fee": None,
    "_source_file": "trips_2024-05.parquet",
    "_ingestion_date": dt.datetime(2026, 1, 1),
}


def micros(moment: str) -> int:
    since = dt.datetime.fromisoformat(moment) - dt.datetime(1970, 1, 1)
    return since // dt.timedelta(microseconds=1)


def raw_trips(spark, *changes: dict):
    """Raw trips: a good trip per argument, changed as given. Times are ISO texts."""
    rows = []
    for change in changes:
        trip = GOOD_TRIP | change
        for name in ("tpep_pickup_datetime", "tpep_dropoff_datetime"):
            if isinstance(trip[name], str):
                trip[name] = micros(trip[name])
        rows.append(tuple(trip[f.name] for f in RAW_TRIP_SCHEMA.fields))
    return spark.createDataFrame(rows, RAW_TRIP_SCHEMA)


def plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()
