"""Connected components of an edge table, as rounds of joins over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import dropped, stored


ROWS_PER_FILE = 100_000


def joined_apart(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join on ``key`` so that adaptive execution can split a hot key's rows.

    It splits only where both sides are shuffled for the join itself. A side that was
    aggregated by the key would not be, so the join also compares a bit of the key.
    """
    bit = F.col(key).bitwiseAND(1).alias("_bit")
    return left.select("*", bit).join(right.select("*", bit), [key, "_bit"], how).drop("_bit")


def _nearest(pairs: DataFrame) -> DataFrame:
    """Pairs (u, v) with the smallest of u and its neighbours as m."""
    least = pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return joined_apart(pairs, least, "u")


def _both_ways(edges: DataFrame) -> DataFrame:
    turned = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    return edges.unionByName(turned)


def _round(edges: DataFrame) -> DataFrame:
    """A large-star and a small-star step."""
    large = _nearest(_both_ways(edges)).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = large.filter("u <> v").distinct()
    small = _nearest(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    kept = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        small.select("u", F.col("m").alias("v"))
    )
    return kept.filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Smallest node each linked node reaches: columns ``node`` and ``root``.

    ``edges`` has the columns ``u`` and ``v`` without nulls. Large-star and small-star
    steps alternate (Kiveris et al., 2014): a node's larger, then its smaller neighbours
    are joined to its smallest one. The number of edges never grows and the rounds are
    logarithmic in the longest path, so nothing is gathered for a whole component. Each
    round is stored, in files of about ``ROWS_PER_FILE`` edges.
    """
    edges = stored(edges.filter("u <> v").distinct(), "star-edges")
    while True:
        files = max(1, -(-edges.count() // ROWS_PER_FILE))
        after = stored(_round(edges).coalesce(files), "star-edges")
        dropped(edges)
        edges = after
        roots = edges.select(F.col("v").alias("u")).distinct()
        counts = edges.agg(F.count("*").alias("rows"), F.count_distinct("u").alias("nodes")).first()
        if counts["rows"] == counts["nodes"] and edges.join(roots, "u", "left_semi").isEmpty():
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
