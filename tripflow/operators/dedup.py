"""Duplicate removal and duplicate reports.

Both first count 64-bit fingerprints, which is all that is shuffled for every row, and mark
those that repeat in a bitmap of 16 bits or more for each. A row whose bit is not set has
no duplicate and passes by; only the others are sorted or grouped on whole rows. A row
that shares a bit by chance is merely looked at, so the answer does not depend on the
bitmap's size. It grows with the repeated keys to ``BITS``, which 16 million of them fill to a
sixteenth, and a hundred million to a third; beyond that more and more rows are looked at.
The input is read more than once, so it must be the same each time, as files and stored
tables are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = 1 << 28  # of the largest bitmap, 32 MB for every task
_BITS_PER_KEY = 16
_LEAST_WORDS = 1 << 10

_PRINT = "_print"


def _printed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adds the fingerprint of ``columns``.

    A generator of one row holds it, since the optimizer would repeat the expression, and
    all that the columns are computed from, wherever the fingerprint is used.
    """
    return df.select("*", F.explode(F.array(F.xxhash64(*columns))).alias(_PRINT))


def _words(keys: Column, bits: int) -> Column:
    """Words of 64 bits for so many repeated keys: a power of two."""
    wanted = F.greatest(keys * (_BITS_PER_KEY / 64), F.lit(1.0))
    power = F.ceil(F.log2(wanted)).cast("int")
    words = F.call_function("shiftleft", F.lit(1).cast("bigint"), power)
    return F.least(F.greatest(words, F.lit(_LEAST_WORDS)), F.lit(max(bits // 64, 1)).cast("bigint"))


def _may_repeat(df: DataFrame, columns: Sequence[str], bits: int) -> Column:
    """Whether another row may equal a row with fingerprint in ``columns``; a scalar subquery holds the bitmap."""
    counted = df.groupBy(F.xxhash64(*columns).alias("_key")).agg(F.count("*").alias("_rows"))
    repeated = counted.filter("_rows > 1").select("_key")
    size = repeated.agg(_words(F.count("*"), bits).alias("words"))
    bit = F.pmod(F.col("_key"), size.scalar() * 64)
    marked = (
        repeated.select(F.shiftright(bit, 6).alias("_word"), bit.bitwiseAND(63).cast("int").alias("_bit"))
        .groupBy("_word")
        .agg(F.expr("bit_or(shiftleft(1L, _bit))").alias("_bits"))
    )
    whole = df.sparkSession.range(1).select(F.explode(F.sequence(F.lit(0).cast("bigint"), size.scalar() - 1)).alias("id"))
    filled = whole.join(marked, F.col("id") == F.col("_word"), "left")
    listed = F.collect_list(F.struct("id", F.coalesce("_bits", F.lit(0).cast("bigint")).alias("_bits")))
    bitmap = filled.agg(F.transform(F.array_sort(listed), lambda x: x["_bits"]).alias("bitmap")).scalar()
    place = F.pmod(F.col(_PRINT), F.size(bitmap) * F.lit(64).cast("bigint"))
    word = F.get(bitmap, F.shiftright(place, 6).cast("int"))
    return F.call_function("shiftright", word, place.bitwiseAND(63).cast("int")).bitwiseAND(1) == 1


def dedup_keep_first(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    tie_breakers: Sequence[str] | None = None,
    bits: int = BITS,
) -> DataFrame:
    """One row per key, the first by ``order``.

    ``order`` alone may tie, so the remaining columns break ties and reruns agree;
    pass ``tie_breakers`` to name them. NULL keys form one group. Rows of a key that cannot
    repeat take no part in the sort and its shuffle. For the others ``row_number() = 1``
    becomes a partial window group limit: every map task keeps a single row per key
    before the shuffle, so a key holding much of the data cannot overload one task.
    """
    if tie_breakers is None:
        tie_breakers = [c for c in df.columns if c not in {*keys, *order}]
    first = Window.partitionBy(*keys).orderBy(
        *[F.col(c).asc_nulls_first() for c in (*order, *tie_breakers)]
    )
    suspect, printed = _may_repeat(df, keys, bits), _printed(df, keys)
    ranked = printed.filter(suspect).withColumn("_rank", F.row_number().over(first))
    kept = printed.filter(~suspect).unionByName(ranked.filter("_rank = 1").drop("_rank"))
    return kept.drop(_PRINT)


def duplicate_report(
    df: DataFrame, columns: Sequence[str], by: str, bits: int = BITS
) -> DataFrame:
    """Per ``by`` value: groups of identical rows, rows in them, rows to remove.

    Rows are grouped on all their columns, so those that merely share a fingerprint part.
    Copies are counted before the shuffle, so a row repeated very often does no harm.
    """
    every = [by, *columns]
    suspects = _printed(df, every).filter(_may_repeat(df, every, bits))
    groups = suspects.groupBy(by, *columns).agg(F.count("*").alias("_copies")).filter("_copies > 1")
    return groups.groupBy(by).agg(
        F.count("*").alias("identical_groups"),
        F.sum("_copies").alias("affected_rows"),
        F.sum(F.col("_copies") - 1).alias("rows_to_remove"),
    )
