from __future__ import annotations

import datetime as dt
from decimal import ROUND_HALF_EVEN, Decimal

import pytest
from helpers import micros
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripflow.functions import epoch, labels, numeric


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_minutes_count_boundaries(spark):
    pairs = [
        ("2024-05-10 00:00:59", "2024-05-10 00:01:01", 1),
        ("2024-05-10 00:00:00", "2024-05-10 00:00:59", 0),
        ("2024-05-10 00:00:59.999999", "2024-05-10 00:01:00", 1),
        ("2024-05-10 10:00:00", "2024-05-10 09:59:59", -1),
        ("1969-12-31 23:59:59", "1970-01-01 00:00:00", 1),
        ("1969-12-31 23:58:30", "1969-12-31 23:59:10", 1),
        ("2024-02-28 23:00:00", "2024-03-01 01:00:00", 1560),
    ]
    rows = [(micros(a), micros(b)) for a, b, _ in pairs]
    a, b = F.col("a"), F.col("b")
    found = values(
        spark,
        rows,
        "a bigint, b bigint",
        epoch.minutes_between(a, b),
        epoch.minutes_between_times(epoch.from_micros(a), epoch.from_micros(b)),
    )
    assert found == [(wanted, wanted) for *_, wanted in pairs]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_do_not_depend_on_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        us = F.col("us")
        found = values(
            spark,
            [(micros("2024-03-10 02:30:15.000001"),), (micros("1969-12-31 23:00:00"),)],
            "us bigint",
            epoch.from_micros(us),
            epoch.to_micros(epoch.from_micros(us)) == us,
            epoch.epoch_date(us),
            epoch.epoch_hour(us),
            epoch.day_of_week(epoch.epoch_date(us)),
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found == [
        (dt.datetime(2024, 3, 10, 2, 30, 15, 1), True, dt.date(2024, 3, 10), 2, 0),
        (dt.datetime(1969, 12, 31, 23), True, dt.date(1969, 12, 31), 23, 3),
    ]


def test_time_period_edges(spark):
    wanted = {
        0: "night", 4: "night", 5: "daytime", 6: "daytime", 7: "morning_rush",
        9: "morning_rush", 10: "daytime", 16: "daytime", 17: "evening_rush",
        19: "evening_rush", 20: "daytime", 21: "daytime", 22: "night", 23: "night",
    }
    rows = [(h,) for h in wanted]
    found = values(spark, rows, "h int", "h", epoch.time_period(F.col("h")))
    assert dict(found) == wanted


def test_distance_category_edges(spark):
    wanted = [
        (0.0, "short"), (0.99, "short"), (1.0, "medium"), (4.99, "medium"), (5.0, "long"),
        (14.99, "long"), (15.0, "very_long"), (100.0, "very_long"), (None, "very_long"),
    ]
    rows = [(miles,) for miles, _ in wanted]
    assert values(spark, rows, "m double", "m", labels.distance_category(F.col("m"))) == wanted


def test_file_month(spark):
    wanted = [
        ("trips_2024-02.parquet", "2024-02", dt.date(2024, 2, 1)),
        ("x_2024-13.parquet", "2024-13", None),
        ("no_month.parquet", None, None),
        ("a_1999-12_b_2024-01.parquet", "1999-12", dt.date(1999, 12, 1)),
        (None, None, None),
    ]
    name = F.col("n")
    rows = [(n,) for n, *_ in wanted]
    found = values(
        spark, rows, "n string", "n", epoch.file_month_text(name), epoch.file_month(name)
    )
    assert found == wanted


def test_guards_against_zero(spark):
    a, b = F.col("a"), F.col("b")
    rows = [(6.0, 3.0), (6.0, 0.0), (6.0, -3.0), (6.0, None)]
    ratio = values(spark, rows, "a double, b double", numeric.guarded_ratio(a, b))
    assert [r[0] for r in ratio] == [2.0, 0.0, 0.0, 0.0]
    speeds = values(spark, [(10.0, 30), (10.0, 0)], "a double, b bigint", numeric.speed_mph(a, b))
    assert [s[0] for s in speeds] == [20.0, 0.0]


def test_payment_labels(spark):
    found = values(
        spark, [(0,), (6,), (7,), (None,)], "c int", labels.payment_label(F.col("c"))
    )
    assert [f[0] for f in found] == ["Non renseigné", "Annulé", "Autre", "Autre"]


def test_rounding_is_half_away_from_zero(spark):
    rows = [(2.345678,), (-2.345678,), (0.125,), (-0.125,), (None,)]
    found = values(spark, rows, "v double", numeric.round_half_away(F.col("v")))
    assert [f[0] for f in found] == [2.35, -2.35, 0.13, -0.13, None]


@settings(
    max_examples=25,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(
    amounts=st.lists(
        st.one_of(
            st.none(),
            st.integers(-10_000_000, 90_000_000).map(lambda c: c / 100),
            st.floats(-1e4, 1e4, allow_nan=False),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_exact_sum_is_the_decimal_sum(spark, amounts):
    df = spark.createDataFrame([(a,) for a in amounts], "v double").repartition(3)
    value = F.col("v")
    found, count = df.agg(numeric.exact_sum(value), F.count(value)).first()
    known = [a for a in amounts if a is not None]
    if not known:
        assert found is None and count == 0
        return
    step = Decimal("1E-8")
    wanted = sum(Decimal(a).quantize(step, ROUND_HALF_EVEN) for a in known)
    # a value may round either way when it lies within an ulp of half a step
    assert abs(found - wanted) <= step * len(known)
    if all(a == round(a, 2) for a in known):
        assert found == sum(Decimal(str(round(a, 2))) for a in known)


def test_exact_sum_ignores_order(spark):
    rows = [(0.1 * i * (-1) ** i,) for i in range(5000)]
    df = spark.createDataFrame(rows, "v double")
    sums = {
        df.repartition(n).agg(numeric.total(F.col("v"))).first()[0] for n in (1, 2, 3, 7, 16)
    }
    assert len(sums) == 1


def test_exact_sum_refuses_to_wrap(spark):
    df = spark.createDataFrame([(9e16,)] * 3, "v double")
    with pytest.raises(Exception, match="OVERFLOW"):
        df.agg(numeric.total(F.col("v"))).collect()


def test_sums_with_values_that_have_no_cents(spark):
    rows = [(1, 0.1), (1, 0.2), (2, float("nan")), (2, 1.0), (3, float("inf")), (3, 2.0), (4, None)]
    rows += [(6, float("inf")), (6, float("-inf"))]
    df = spark.createDataFrame(rows, "k int, v double")
    found = df.groupBy("k").agg(
        numeric.total(F.col("v")).alias("t"),
        numeric.mean(F.col("v")).alias("m"),
        numeric.rounded_total(F.col("v")).alias("rt"),
        numeric.rounded_mean(F.col("v")).alias("rm"),
    )
    got = {r.k: tuple(map(str, r[1:])) for r in found.collect()}
    assert got == {
        1: ("0.3", "0.15", "0.3", "0.15"),
        2: ("nan",) * 4,
        3: ("inf",) * 4,
        4: ("None",) * 4,
        6: ("nan",) * 4,
    }
