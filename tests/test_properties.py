"""Operators against brute force on random rows."""

from __future__ import annotations

import datetime as dt
from collections import Counter

from helpers import GOOD_TRIP, raw_trips
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripflow.functions import epoch
from tripflow.operators import cleaning, dedup, expectations, profiling
from tripflow.schemas import RAW_TRIP_SCHEMA

few = settings(
    max_examples=15,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
EPOCH = dt.datetime(1970, 1, 1)
moments = st.datetimes(dt.datetime(1960, 1, 1), dt.datetime(2060, 1, 1))
small = st.one_of(st.none(), st.integers(0, 3))


def us(moment: dt.datetime) -> int:
    return (moment - EPOCH) // dt.timedelta(microseconds=1)


def shuffled(df):
    return df.repartition(5)


@few
@given(st.lists(st.tuples(moments, moments), min_size=1, max_size=50))
def test_calendar_arithmetic(spark, pairs):
    df = spark.createDataFrame([(us(a), us(b)) for a, b in pairs], "a bigint, b bigint")
    a, b = F.col("a"), F.col("b")
    found = df.select(
        epoch.minutes_between(a, b),
        epoch.epoch_date(a),
        epoch.epoch_hour(a),
        epoch.day_of_week(epoch.epoch_date(a)),
        epoch.from_micros(a),
        epoch.to_micros(epoch.from_micros(b)),
    ).collect()

    def minute(moment):
        return (moment.replace(second=0, microsecond=0) - EPOCH) // dt.timedelta(minutes=1)

    assert [tuple(r) for r in found] == [
        (minute(y) - minute(x), x.date(), x.hour, x.isoweekday() % 7, x, us(y)) for x, y in pairs
    ]


@few
@given(
    st.lists(
        st.tuples(
            st.dates(dt.date(2024, 1, 1), dt.date(2025, 3, 31)),
            st.sampled_from([dt.timedelta(0), dt.timedelta(hours=23), dt.timedelta(hours=5)]),
            st.integers(-2, 2),
        ),
        min_size=1,
        max_size=60,
    )
)
def test_file_month_rule(spark, cases):
    rows, wanted = [], []
    for day, time, shift in cases:
        pickup = dt.datetime.combine(day, dt.time()) + time
        index = day.year * 12 + day.month - 1 + shift
        first = dt.datetime(index // 12, index % 12 + 1, 1)
        rows.append((us(pickup), f"trips_{first:%Y-%m}.parquet"))
        same_month = (pickup.year, pickup.month) == (first.year, first.month)
        wanted.append(same_month or first - dt.timedelta(days=1) <= pickup <= first)
    df = spark.createDataFrame(rows, "p bigint, f string")
    rule = cleaning.file_month_ok(epoch.epoch_date(F.col("p")), epoch.file_month(F.col("f")))
    assert [r[0] for r in df.select(rule).collect()] == wanted


@few
@given(st.lists(st.tuples(small, small, small, small), min_size=1, max_size=60))
def test_dedup_keeps_the_least_row_of_each_key(spark, rows):
    df = shuffled(spark.createDataFrame(rows, "a int, b int, c int, d int"))
    found = dedup.dedup_keep_first(df, ["a", "b"], ["c"]).collect()

    def nulls_first(values):
        return [(v is not None, v or 0) for v in values]

    wanted = {}
    for row in sorted(rows, key=lambda r: nulls_first(r[2:])):
        wanted.setdefault(row[:2], row)
    assert Counter(tuple(r) for r in found) == Counter(wanted.values())


@few
@given(
    st.lists(st.tuples(st.sampled_from("xy"), small, small), min_size=1, max_size=60),
    st.sampled_from([64, 1 << 14]),
)
def test_duplicate_report_counts(spark, rows, limit):
    df = shuffled(spark.createDataFrame(rows, "f string, a int, b int"))
    found = {r.f: tuple(r)[1:] for r in dedup.duplicate_report(df, ["a", "b"], "f", limit).collect()}
    wanted = {}
    for (file, *_), copies in Counter(rows).items():
        if copies > 1:
            groups, affected, extra = wanted.get(file, (0, 0, 0))
            wanted[file] = (groups + 1, affected + copies, extra + copies - 1)
    assert found == wanted


@few
@given(st.lists(st.tuples(small, small), min_size=1, max_size=60))
def test_suite_counts(spark, rows):
    df = shuffled(spark.createDataFrame(rows, "k int, v int"))
    report = expectations.run_suite(
        df,
        "m",
        [
            expectations.unique("k"),
            expectations.not_null("v"),
            expectations.max_value("v", 2),
            expectations.accepted_values("v", [0, 1]),
        ],
    )
    values = [v for _, v in rows]
    keys = Counter(k for k, _ in rows if k is not None)
    assert {r.test: r.failures for r in report.collect()} == {
        "unique": sum(n > 1 for n in keys.values()),
        "not_null": values.count(None),
        "max_value": sum(v is not None and v > 2 for v in values),
        "accepted_values": sum(v is not None and v > 1 for v in values),
    }


changes = st.fixed_dictionaries(
    {},
    optional={
        "trip_distance": st.sampled_from([None, -1.0, 0.0, 0.1, 5.0, 50.0, 101.0, 1000.0]),
        "fare_amount": st.sampled_from([None, -3.0, 0.0, 2.49, 2.5, 40.0]),
        "total_amount": st.sampled_from([None, -3.0, 0.0, 3.5, 500.0, 500.01]),
        "tip_amount": st.sampled_from([None, 0.0, 2.5, 41.0]),
        "passenger_count": st.sampled_from([None, 0.0, 1.0, 5.0, 6.0]),
    },
)


@few
@given(st.lists(changes, min_size=1, max_size=40))
def test_rules_agree_with_retention_and_violations(spark, trips):
    raw = shuffled(raw_trips(spark, *trips))
    profile = cleaning.mart_profile()

    def good(trip):
        miles, fare, tip, riders = (
            trip[c] for c in ("trip_distance", "fare_amount", "tip_amount", "passenger_count")
        )
        return (
            None not in (miles, fare, tip, riders)
            and fare > 0
            and 0 < miles < 50
            and 0 < riders <= 5
            and tip / fare <= 1
            and miles / (15 / 60) <= 100
        )

    wanted = sum(good(GOOD_TRIP | trip) for trip in trips)
    assert cleaning.keep_good(raw, profile).count() == wanted
    kept = profiling.retention(raw, profile).first()
    assert (kept.raw_rows, kept.clean_rows) == (len(trips), wanted)
    broken = sum(r.rows for r in profiling.violations(raw, profile).collect())
    assert (broken == 0) == (wanted == len(trips))
    assert raw.schema == RAW_TRIP_SCHEMA
