"""Expectation tests on a model: each counts the rows that fail it.

All row-wise tests of a suite are conditional counts in one global aggregation, a row per
task. A uniqueness test reads its column alone and groups by it, so only keys and
counts are shuffled; counts are combined first, so a repeated value does not
concentrate rows on one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    column: str
    test: str
    argument: object = None

    def failing(self) -> Column:
        """Predicate of a failing row. NULL passes all tests but ``not_null``."""
        value = F.col(self.column)
        match self.test:
            case "not_null":
                return value.isNull()
            case "accepted_values":
                return ~value.isin(*self.argument)
            case "min_value":
                return value < self.argument
            case "max_value":
                return value > self.argument
        raise ValueError(f"{self.test} is not a row-wise test")


def not_null(column: str) -> Check:
    return Check(column, "not_null")


def unique(column: str) -> Check:
    return Check(column, "unique")


def accepted_values(column: str, values: Sequence[object]) -> Check:
    return Check(column, "accepted_values", tuple(values))


def min_value(column: str, bound: float) -> Check:
    return Check(column, "min_value", bound)


def max_value(column: str, bound: float) -> Check:
    return Check(column, "max_value", bound)


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    """The rows a test rejects; for ``unique``, the repeated values and their counts."""
    if check.test == "unique":
        counts = df.filter(F.col(check.column).isNotNull()).groupBy(check.column)
        return counts.agg(F.count("*").alias("copies")).filter("copies > 1")
    return df.filter(check.failing())


def run_suite(df: DataFrame, model: str, checks: Sequence[Check]) -> DataFrame:
    """One row per test: model, column, test, failures and whether it passed."""
    row_wise = [c for c in checks if c.test != "unique"]
    counts = [F.count_if(c.failing()).alias(f"_{i}") for i, c in enumerate(row_wise)]
    parts = [_report(df.agg(*counts), model, row_wise)] if row_wise else []
    for key in dict.fromkeys(c.column for c in checks if c.test == "unique"):
        repeated = failing_rows(df, unique(key)).agg(F.count("*").alias("_0"))
        parts.append(_report(repeated, model, [unique(key)]))
    return reduce(DataFrame.unionByName, parts)


def _report(counted: DataFrame, model: str, checks: Sequence[Check]) -> DataFrame:
    lines = [
        F.struct(
            F.lit(model).alias("model"),
            F.lit(c.column).alias("column_name"),
            F.lit(c.test).alias("test"),
            F.col(f"_{i}").alias("failures"),
            (F.col(f"_{i}") == 0).alias("passed"),
        )
        for i, c in enumerate(checks)
    ]
    return counted.select(F.inline(F.array(*lines)))
