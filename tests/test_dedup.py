from __future__ import annotations

import pytest
from helpers import plan, raw_trips
from pyspark.sql import functions as F

from tripflow.operators import dedup
from tripflow.operators.cleaning import billing_profile, clean, keep_good
from tripflow.operators.dedup import dedup_keep_first, duplicate_report
from tripflow.schemas import BUSINESS_COLUMNS, SOURCE_FILE


def test_first_file_wins_and_ties_are_settled(spark):
    raw = raw_trips(
        spark,
        {"_source_file": "trips_2024-05.parquet", "tip_amount": 2.0},
        {"_source_file": "a_trips_2024-05.parquet", "tip_amount": 4.0},
        {"_source_file": "a_trips_2024-05.parquet", "tip_amount": 3.0},
        {"PULocationID": 11},
    )
    for slices in (1, 4):
        found = clean(raw.repartition(slices), billing_profile()).orderBy("pickup_location_id")
        assert [(r.source_file, r.tip_amount) for r in found.collect()] == [
            ("a_trips_2024-05.parquet", 3.0),
            ("trips_2024-05.parquet", 3.0),
        ]


def test_null_keys_are_one_group(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), (1, 3)], "k int, v int")
    found = dedup_keep_first(df, ["k"], ["v"]).collect()
    assert sorted((r.k or 0, r.v) for r in found) == [(0, 1), (1, 3)]


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(0, 30_000, 1, 6).selectExpr("if(id % 3 = 0, -1, id) AS k", "id AS v")
    kept = dedup_keep_first(df, ["k"], ["v"])
    text = plan(kept)
    # one limit before and one after the exchange
    assert text.split("(1) ")[0].count("WindowGroupLimit") == 2
    assert kept.count() == 20_001
    assert kept.filter("k = -1").first().v == 0


@pytest.mark.parametrize("bits", [1 << 16, 64])
def test_report_counts_per_file_and_keeps_nulls_equal(spark, bits):
    raw = raw_trips(
        spark,
        *[{"passenger_count": None}] * 3,
        *[{"PULocationID": 99}] * 2,
        {"tip_amount": 1.0},
        {"_source_file": "trips_2024-06.parquet"},
    )
    found = duplicate_report(raw, BUSINESS_COLUMNS, SOURCE_FILE, bits).collect()
    assert [tuple(r) for r in found] == [("trips_2024-05.parquet", 2, 5, 3)]


def test_shared_fingerprint_is_no_duplicate(spark):
    # a NULL leaves the fingerprint as it is, so these two rows share one
    df = spark.createDataFrame([("f", None, 1), ("f", 1, None)], "file string, a int, b int")
    assert df.select(F.xxhash64("file", "a", "b")).distinct().count() == 1
    assert duplicate_report(df, ["a", "b"], "file").count() == 0


@pytest.mark.parametrize("bits", [1 << 16, 64])
def test_bitmap_size_does_not_change_the_answer(spark, bits):
    df = spark.range(3000).selectExpr("if(id % 7 = 0, id div 70, id) AS k", "id AS v")
    found = dedup_keep_first(df, ["k"], ["v"], bits=bits).collect()
    first = {}
    for v in range(3000):
        first.setdefault(v // 70 if v % 7 == 0 else v, v)
    assert sorted((r.k, r.v) for r in found) == sorted(first.items())


def test_definition_runs_no_job(spark):
    raw = raw_trips(spark, {}, {})
    spark.sparkContext.setJobGroup("definition", "")
    duplicate_report(raw, BUSINESS_COLUMNS, SOURCE_FILE)
    clean(raw, billing_profile())
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("definition")


def test_only_suspects_are_sorted_and_shuffled(spark, tmp_path):
    """Rows whose key is not repeated reach neither the sort nor the shuffle of whole rows."""
    raw = raw_trips(spark, *[{"PULocationID": n} for n in range(500)], *[{"tip_amount": 2.0}] * 2)
    raw.write.parquet(f"{tmp_path}/raw")
    found = clean(spark.read.parquet(f"{tmp_path}/raw"), billing_profile())
    found.write.parquet(f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 500
    text = plan(found)
    tree = text.split("(1) ")[0]
    main = tree.split("Subqueries")[0]
    assert main.count("Window (") == 1 and main.count("Union") == 1
    passing, sorted_ = main.split("Scan parquet")[0], main.split("Scan parquet")[1]
    assert "Exchange" not in passing and "Sort" not in passing
    assert "Sort" in main


def test_file_month_is_parsed_once_per_row(spark, tmp_path):
    raw_trips(spark, {}).write.parquet(f"{tmp_path}/raw")
    staged = billing_profile().layout(keep_good(spark.read.parquet(f"{tmp_path}/raw"), billing_profile()))
    assert plan(staged).count("regexp_extract(") == 1
    pushed = next(x for x in plan(staged).splitlines() if x.startswith("PushedFilters"))
    assert "fare_amount" in pushed and "total_amount" in pushed


def test_untouched_rows_bypass_the_sort_however_many_keys_repeat(spark):
    """More repeated keys than bits of the least bitmap, which grows with them."""
    repeated, single = 150_000, 100_000
    assert repeated > 64 * dedup._LEAST_WORDS
    df = spark.range(2 * repeated + single).selectExpr(f"if(id < {2 * repeated}, id div 2, id) AS k", "id AS v")
    looked_at = dedup._printed(df, ["k"]).filter(dedup._may_repeat(df, ["k"], dedup.BITS))
    chance = looked_at.filter(f"k >= {2 * repeated}").count()
    assert looked_at.count() - chance == 2 * repeated and chance < single / 10
    assert dedup_keep_first(df, ["k"], ["v"]).agg(F.count("*"), F.sum("v")).first()[:] == (
        repeated + single, repeated * (repeated - 1) + sum(range(2 * repeated, 2 * repeated + single)),
    )
