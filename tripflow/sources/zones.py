"""Loading the zone dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripflow.schemas import ZONE_SCHEMA
from tripflow.sources.generations import replace_table


def load_zones(spark: SparkSession, csv: str) -> DataFrame:
    """Zones from a CSV with a header; columns are taken by position, ``N/A`` is NULL."""
    return (
        spark.read.schema(ZONE_SCHEMA)
        .option("header", "true")
        .option("enforceSchema", "true")
        .option("nullValue", "N/A")
        .csv(csv)
    )


def write_zones(spark: SparkSession, csv: str, target: str) -> DataFrame:
    """Replace the raw zone table by the CSV's zones; the table as written."""
    return replace_table(load_zones(spark, csv), target)
