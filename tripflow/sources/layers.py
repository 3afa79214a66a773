"""Layer addressing and materialisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tripflow.sources.generations import read_table, replace_table

LAYERS = ("raw", "staging", "final")


def layer_path(root: str, layer: str, name: str) -> str:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer: {layer}")
    return f"{root.rstrip('/')}/{layer}/{name}"


def materialize(
    df: DataFrame,
    root: str,
    layer: str,
    name: str,
    kind: str = "table",
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Store a model as Parquet (replacing it) or register it as a temporary view.

    A table is written in full before it takes the place of the former one, so a build that
    fails leaves that as it was; ``read_layer`` gives the last complete build.
    """
    path = layer_path(root, layer, name)
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df.sparkSession.table(name)
    if kind != "table":
        raise ValueError(f"unknown materialisation: {kind}")
    return replace_table(df, path, partition_by)


def read_layer(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    """A stored model as of its last complete build."""
    return read_table(spark, layer_path(root, layer, name))
