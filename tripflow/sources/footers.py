"""Schemas of many Parquet files from one distributed pass over their footers."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

_SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"
_UNSIGNED = {
    pa.uint8(): T.ShortType(),
    pa.uint16(): T.IntegerType(),
    pa.uint32(): T.LongType(),
    pa.uint64(): T.DecimalType(20, 0),
}


def _open(path: str) -> pa.NativeFile:
    local = re.match(r"(?:file:/*|(?=/))(.*)", path)
    if local:
        return pyarrow.fs.LocalFileSystem().open_input_file("/" + local.group(1).lstrip("/"))
    store, name = pyarrow.fs.FileSystem.from_uri(quote(path, safe=":/@"))
    return store.open_input_file(name)


def _field_type(kind: pa.DataType, physical: str) -> T.DataType:
    if physical == "INT96":
        return T.TimestampType()
    if kind in _UNSIGNED:
        return _UNSIGNED[kind]
    if pa.types.is_dictionary(kind):
        return _field_type(kind.value_type, physical)
    return from_arrow_type(kind, prefer_timestamp_ntz=True)


def _schema(parquet: pq.ParquetFile) -> T.StructType:
    written = (parquet.metadata.metadata or {}).get(_SPARK_SCHEMA)
    if written:
        return T.StructType.fromJson(json.loads(written))
    physical = {c.path: c.physical_type for c in map(parquet.schema.column, range(len(parquet.schema)))}
    return T.StructType([T.StructField(f.name, _field_type(f.type, physical.get(f.name, ""))) for f in parquet.schema_arrow])


def footers(files: DataFrame) -> DataFrame:
    """Adds to ``files`` (with a column ``path``) ``columns``, the schema as JSON, and ``rows``, or ``damage``.

    All stay NULL for a store that only Spark reads; ``spark_schema`` then asks Spark.
    """
    names = [*files.columns, "columns", "rows", "damage"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[str | None] = []
            rows: list[int | None] = []
            damage: list[str | None] = []
            for path in batch.column("path").to_pylist():
                found = held = wrong = None
                try:
                    file = _open(path)
                except (pa.ArrowInvalid, ImportError, NotImplementedError):
                    pass  # no file system of that scheme here
                else:
                    with file:
                        try:
                            parquet = pq.ParquetFile(file)
                            found, held = _schema(parquet).json(), parquet.metadata.num_rows
                        except (pa.ArrowInvalid, OSError) as error:
                            # an OSError is a failed read, unless the bytes read make no sense
                            if isinstance(error, OSError) and "deserialize" not in str(error):
                                raise
                            wrong = str(error)
                columns.append(found)
                rows.append(held)
                damage.append(wrong)
            added = [pa.array(columns, pa.string()), pa.array(rows, pa.int64()), pa.array(damage, pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names)

    added = (("columns", T.StringType()), ("rows", T.LongType()), ("damage", T.StringType()))
    schema = T.StructType([*files.schema, *[T.StructField(*f) for f in added]])
    return files.mapInArrow(read, schema)


def spark_schema(spark: SparkSession, path: str) -> T.StructType:
    return spark.read.parquet(path).schema
