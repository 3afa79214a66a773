from __future__ import annotations

import pytest
from helpers import plan

from tripflow.operators.expectations import (
    Check,
    accepted_values,
    failing_rows,
    max_value,
    min_value,
    not_null,
    run_suite,
    unique,
)
from tripflow.plans import suites

ROWS = [(1, 5.0, "a"), (1, None, "b"), (2, 9.0, None), (None, 1.0, "z"), (None, 1.0, "a")]
SCHEMA = "k int, v double, s string"
CHECKS = [
    not_null("v"),
    accepted_values("s", ["a", "b"]),
    min_value("v", 2),
    max_value("v", 8),
    unique("k"),
]


def outcomes(report):
    return {(r.column_name, r.test): (r.failures, r.passed) for r in report.collect()}


def test_failures_per_test(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    found = outcomes(run_suite(df, "m", CHECKS))
    assert found == {
        ("v", "not_null"): (1, False),
        ("s", "accepted_values"): (1, False),  # NULL passes
        ("v", "min_value"): (2, False),
        ("v", "max_value"): (1, False),
        ("k", "unique"): (1, False),  # NULL keys are no duplicates
    }
    for check in CHECKS:
        assert failing_rows(df, check).count() == found[check.column, check.test][0]


def test_empty_model_passes(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert all(passed for _, passed in outcomes(run_suite(df, "m", CHECKS)).values())
    assert all(passed for _, passed in outcomes(run_suite(df, "m", CHECKS[:4])).values())


def test_several_unique_columns(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    found = outcomes(run_suite(df, "m", [unique("k"), unique("s"), not_null("s")]))
    assert found == {
        ("k", "unique"): (1, False),
        ("s", "unique"): (1, False),
        ("s", "not_null"): (1, False),
    }


def test_a_uniqueness_test_reads_and_shuffles_its_key_alone(spark, tmp_path):
    path = str(tmp_path / "model")
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(path)
    text = plan(run_suite(spark.read.parquet(path), "m", CHECKS))
    schemas = [x.split(": ", 1)[1] for x in text.splitlines() if x.startswith("ReadSchema")]
    assert schemas == ["struct<v:double,s:string>", "struct<k:int>"]
    keyed = [x for x in text.splitlines() if x.startswith("Arguments: hashpartitioning")]
    assert len(keyed) == 1
    assert "Functions [1]: [partial_count(1)]" in text


def test_suite_sizes():
    sizes = [
        len(s)
        for s in (
            suites.STAGING_SUITE,
            suites.DAILY_SUITE,
            suites.ZONE_SUITE,
            suites.HOURLY_SUITE,
        )
    ]
    assert sizes == [30, 12, 14, 13]


def test_unknown_test_is_refused(spark):
    with pytest.raises(ValueError, match="row-wise"):
        Check("v", "median").failing()
