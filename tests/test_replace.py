"""Tables stay readable while they are replaced, and when that fails."""

from __future__ import annotations

import os

import pytest
from helpers import raw_trips
from pyspark.sql import functions as F

from tripflow.sources import trips as src
from tripflow.sources.generations import Generations, read_table, replace_table
from tripflow.sources.layers import layer_path, materialize, read_layer


def broken(df):
    """The rows, one of which ends its task."""
    return df.withColumn("bad", F.when(F.rand() >= 0, F.raise_error(F.lit("lost"))).cast("string")).drop("bad").filter(
        F.when(F.rand() >= 0, F.raise_error(F.lit("lost")).cast("boolean"))
    )


def test_a_broken_rebuild_leaves_the_mart(spark, tmp_path):
    root = str(tmp_path)
    df = spark.range(50).withColumn("p", F.col("id") % 3)
    held = materialize(df, root, "final", "mart", partition_by=["p"])
    with pytest.raises(Exception, match="lost"):
        materialize(broken(df), root, "final", "mart", partition_by=["p"])
    assert read_layer(spark, root, "final", "mart").count() == held.count() == 50
    assert materialize(df.limit(7), root, "final", "mart").count() == 7
    assert read_layer(spark, root, "final", "mart").count() == 7
    assert held.count() == 50  # who read the former build still can
    builds = os.listdir(f"{layer_path(root, 'final', 'mart')}/_generations")
    assert len([b for b in builds if not b.startswith(".")]) == 2  # and what the broken one left is gone


def test_a_mart_may_be_rebuilt_from_itself(spark, tmp_path):
    for _ in range(3):
        rows = read_table(spark, f"{tmp_path}/t") if os.path.exists(f"{tmp_path}/t") else spark.range(1)
        replace_table(rows.unionAll(rows), f"{tmp_path}/t")
    assert read_table(spark, f"{tmp_path}/t").count() == 8


def test_an_unfinished_pointer_does_not_count(spark, tmp_path):
    replace_table(spark.range(3), f"{tmp_path}/t")
    table = Generations(spark, f"{tmp_path}/t")
    folder = table.fresh()
    spark.range(9).write.parquet(folder)
    table._folders.create(f"{tmp_path}/t/_current/{folder.rsplit('/', 1)[1][:8]}", folder.rsplit("/", 1)[1])
    assert read_table(spark, f"{tmp_path}/t").count() == 3
    replace_table(spark.range(5), f"{tmp_path}/t")
    assert read_table(spark, f"{tmp_path}/t").count() == 5
    with pytest.raises(Exception, match="exist"):
        table.switch(folder)  # its number is taken
    with pytest.raises(ValueError, match="no complete build"):
        read_table(spark, f"{tmp_path}/nothing")


def test_a_broken_reload_leaves_raw_and_its_log(spark, tmp_path):
    landing, target = f"{tmp_path}/landing", f"{tmp_path}/raw"
    files = raw_trips(spark, {}, {"_source_file": "trips_2024-06.parquet"}).drop("_ingestion_date")
    files.write.partitionBy("_source_file").parquet(landing)
    src.load_new_files(spark, landing, target)
    src.write_raw(raw_trips(spark, {}, {}, {}), target)
    for mode in ("overwrite", "append"):
        with pytest.raises(Exception, match="lost"):
            src.write_raw(broken(raw_trips(spark, {})), target, mode)
        assert src.read_raw(spark, target).count() == 5
        assert src.load_new_files(spark, landing, target) == src.LoadReport([], [])
    held = src.read_raw(spark, target)
    src.write_raw(raw_trips(spark, {}, {}), target, "overwrite")
    assert src.read_raw(spark, target).count() == 2 and held.count() == 5
    assert len(src.load_new_files(spark, landing, target).loaded) == 2  # the reload forgot them
    src.write_raw(raw_trips(spark, {}, {}), target)
    assert src.read_raw(spark, target).count() == 6
    src.write_raw(src.read_raw(spark, target), target, "overwrite")  # from its own rows
    assert src.read_raw(spark, target).count() == 6
    assert not [n for n in os.listdir(target) if n.startswith("_source_file=")]
