"""Bringing differing file schemas to one table schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.functions import epoch


def _as_type(column: Column, source: T.DataType, target: T.DataType) -> Column:
    if isinstance(target, T.LongType):
        # times may arrive as timestamps, and a plain cast would yield seconds
        if isinstance(source, T.TimestampNTZType):
            return epoch.to_micros(column)
        if isinstance(source, T.TimestampType):
            return F.unix_micros(column)
    return column if source == target else column.cast(target)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns matched by name without regard to case, cast; absent ones become NULL.

    Columns that differ in nothing but case would answer to one name, and are refused.
    """
    names = [f.name.lower() for f in df.schema.fields]
    if len(set(names)) < len(names):
        raise ValueError(f"columns differ in case only: {sorted({n for n in names if names.count(n) > 1})}")
    present = {f.name.lower(): f for f in df.schema.fields}
    columns = []
    for field in schema.fields:
        found = present.get(field.name.lower())
        if found is None:
            value = F.lit(None).cast(field.dataType)
        else:
            value = _as_type(F.col(f"`{found.name}`"), found.dataType, field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def evolved_schema(existing: T.StructType, new: T.StructType) -> T.StructType:
    """The existing fields, plus a nullable DOUBLE for each column only ``new`` has."""
    known = {f.name.lower() for f in existing.fields}
    added = [T.StructField(f.name, T.DoubleType()) for f in new.fields if f.name.lower() not in known]
    return T.StructType([*existing.fields, *added])


def evolve(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Append rows whose schema has drifted; old rows hold NULL in added columns."""
    schema = evolved_schema(existing.schema, new.schema)
    return conform(existing, schema).unionByName(conform(new, schema))


# Fixed order: numeric types from narrow to wide.
_NUMERIC = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()]


_TIMES = (T.TimestampType, T.TimestampNTZType, T.LongType)


def _wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrower of two types' common type; times and BIGINT meet in BIGINT microseconds."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in _NUMERIC and b in _NUMERIC:
        wide = _NUMERIC[max(_NUMERIC.index(a), _NUMERIC.index(b))]
        # FLOAT cannot hold every INT or BIGINT
        return T.DoubleType() if isinstance(wide, T.FloatType) else wide
    if isinstance(a, _TIMES) and isinstance(b, _TIMES):
        return T.LongType()
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        whole = max(a.precision - a.scale, b.precision - b.scale)
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
    if all(isinstance(x, T.DecimalType) or x in _NUMERIC for x in (a, b)):
        return T.DoubleType()
    raise ValueError(f"no common type of {a.simpleString()} and {b.simpleString()}")


def merged_schema(schemas: list[T.StructType]) -> T.StructType:
    """All columns in order of first appearance, each in the widest type seen."""

    def merge(left: T.StructType, right: T.StructType) -> T.StructType:
        incoming = {f.name.lower(): f.dataType for f in right.fields}
        kept = [
            T.StructField(f.name, _wider(f.dataType, incoming.get(f.name.lower(), T.NullType())))
            for f in left.fields
        ]
        names = {f.name.lower() for f in left.fields}
        added = [T.StructField(f.name, f.dataType) for f in right.fields if f.name.lower() not in names]
        return T.StructType(kept + added)

    return reduce(merge, schemas)
