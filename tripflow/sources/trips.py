"""Loading monthly trip files into the raw layer.

A monthly file is a Parquet file, or a folder of part files whose name ends in
``.parquet``. Raw is partitioned by the monthly file and the part, and a load replaces the
folders of its own parts, so a load that is run again cannot add its rows twice. What is
loaded is what the load log says, not which folders exist.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import unquote
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.schemas import INGESTION_DATE, PART, RAW_TRIP_SCHEMA, SOURCE_FILE
from tripflow.session import files_kept_open
from tripflow.sources.conform import conform, evolved_schema, merged_schema
from tripflow.sources.footers import footers, spark_schema
from tripflow.sources.generations import Folders, Generations
from tripflow.sources.load_log import LoadLog

# File naming of the published monthly files.
MONTHLY_PATTERN = "yellow_tripdata_{year}-{month}.parquet"
_MONTHS = "{01,02,03,04,05,06,07,08,09,10,11,12}"

_SPARK_ERRORS = (PySparkException, Py4JJavaError)
# The conditions by which Spark names a file it cannot read.
_DAMAGED = ("FAILED_READ_FILE.NO_HINT", "FAILED_READ_FILE.CANNOT_READ_FILE_FOOTER")


class DamagedFileError(ValueError):
    """A file that is no readable Parquet file."""


def monthly_paths(base: str, years: Iterable[int], pattern: str = MONTHLY_PATTERN) -> str:
    """One glob over all months of the given years; months without a file match nothing."""
    listed = "{" + ",".join(str(y) for y in years) + "}"
    return f"{base.rstrip('/')}/{pattern.format(year=listed, month=_MONTHS)}"


def _folder(path: Column) -> Column:
    return F.substring_index(F.substring_index(path, "/", -2), "/", 1)


def source_name(path: Column) -> Column:
    """Monthly file name of a data file: its own, or that of the folder it is a part of.

    Plain string splitting, since this runs for every row read. A folder may be written
    by ``partitionBy``, so a ``column=`` in front of the name is dropped.
    """
    folder = _folder(path)
    return F.when(
        folder.endswith(".parquet"), F.substring_index(folder, "=", -1)
    ).otherwise(F.substring_index(path, "/", -1))


def _decoded(name: Column) -> Column:
    """Name from a URI; unlike in a query string, a plus sign there is just that."""
    plain = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    return F.when(name.contains("%"), plain).otherwise(name)


def with_lineage(df: DataFrame) -> DataFrame:
    """Add the source file name and the load time to a frame read from files."""
    return df.select(
        "*",
        _decoded(source_name(F.col("_metadata.file_path"))).alias(SOURCE_FILE),
        F.current_timestamp().alias(INGESTION_DATE),
    )


@dataclass
class FileGroups:
    """Files by common columns and types, files that could not be read, and rows by the footers (if known)."""

    groups: list[tuple[list[str], T.StructType]] = field(default_factory=list)
    unreadable: list[str] = field(default_factory=list)
    rows: dict[str, int] = field(default_factory=dict)

    def paths_of(self, schema: T.StructType) -> list[str]:
        """Paths of the group of the same columns and types, which is opened if there is none."""
        kinds = {f.name.lower(): f.dataType for f in schema.fields}
        for known, existing in self.groups:
            if kinds == {f.name.lower(): f.dataType for f in existing.fields}:
                return known
        self.groups.append(([], schema))
        return self.groups[-1][0]


def _schemas(found: DataFrame) -> dict[str, T.StructType]:
    """Each schema of the files once, by its digest; one row a schema reaches the driver."""
    known = found.filter("columns IS NOT NULL").groupBy("schema_id")
    rows = known.agg(F.min("path").alias("path"), F.min("columns").alias("columns")).orderBy("path").collect()
    return {r["schema_id"]: T.StructType.fromJson(json.loads(r["columns"])) for r in rows}


@contextmanager
def _footers_once(files: DataFrame) -> Iterator[tuple[DataFrame, dict[str, T.StructType]]]:
    """Files with the digest of their schema in place of the schema, and the schemas by digest.

    The footers are kept while they are in use, so that they are read once.
    """
    found = footers(files).withColumn("schema_id", F.sha2("columns", 256)).persist()
    try:
        yield found.drop("columns"), _schemas(found)
    finally:
        found.unpersist()


def _grouped(
    spark: SparkSession, files: Iterable[Row], schemas: Mapping[str, T.StructType], on_error: str
) -> FileGroups:
    found = FileGroups()
    paths_of: dict[str, list[str]] = {}
    for file in files:
        if file["damage"] is not None:
            if on_error != "skip":
                raise DamagedFileError(f"{file['path']}: {file['damage']}")
            found.unreadable.append(file["path"])
        elif (schema := file["schema_id"]) is not None:
            if schema not in paths_of:
                paths_of[schema] = found.paths_of(schemas[schema])
            paths_of[schema].append(file["path"])
            found.rows[file["path"]] = file["rows"]
        else:
            try:
                found.paths_of(spark_schema(spark, file["path"])).append(file["path"])
            except _SPARK_ERRORS:
                # a scan names the file where the inference of its schema may not
                if on_error != "skip" or _reads(spark, [file["path"]], T.StructType([_PART_FIELD])):
                    raise
                found.unreadable.append(file["path"])
    return found


def schema_groups(spark: SparkSession, paths: Sequence[str], on_error: str = "abort") -> FileGroups:
    """Files of the given paths by their columns and types.

    All footers are read in one distributed pass, however the types alternate, and compared
    on the executors: the driver gets every schema once, and of a file its path and rows. A
    damaged footer raises, or with ``skip`` is reported.
    """
    with _footers_once(list_files(spark, paths)) as (files, schemas):
        return _grouped(spark, files.orderBy("path").collect(), schemas, on_error)


def list_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Parquet files below paths; only the listing is used, contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(path if isinstance(path, str) else list(path))
        .select("path")
    )


def landing_parts(spark: SparkSession, landing: str) -> DataFrame:
    """Part files of a landing folder: path, monthly file, part, and the unit they belong to."""
    return parts_of(list_files(spark, landing))


def parts_of(files: DataFrame) -> DataFrame:
    """The same of any files, by their ``path``."""
    path = F.col("path")
    folder = F.regexp_replace(path, "/[^/]*$", "")
    return files.select(
        "path",
        source_name(path).alias("source_file"),
        F.substring_index(path, "/", -1).alias("part"),
        F.when(folder.endswith(".parquet"), folder).otherwise(path).alias("unit"),
    )


def infer_trip_schema(spark: SparkSession, paths: Sequence[str]) -> T.StructType:
    """Union of the files' columns, each in the widest type any file uses.

    Only distinct schemas reach the driver, and files that pyarrow cannot open.
    """
    with _footers_once(list_files(spark, paths)) as (files, schemas):
        others = files.filter("schema_id IS NULL").orderBy("path").toLocalIterator()
        asked = _grouped(spark, others, schemas, "abort").groups
    return merged_schema([*schemas.values(), *[schema for _, schema in asked]])


def _read_group(
    spark: SparkSession, paths: Sequence[str], files: T.StructType, target: T.StructType
) -> DataFrame:
    read = with_lineage(spark.read.schema(files).parquet(*paths))
    part = _decoded(F.substring_index(F.col("_metadata.file_path"), "/", -1))
    return conform(read.select("*", part.alias(PART)), T.StructType([*target, _PART_FIELD]))


_PART_FIELD = T.StructField(PART, T.StringType())


def read_trips(
    spark: SparkSession,
    paths: str | Sequence[str],
    on_error: str = "abort",
    schema: T.StructType = RAW_TRIP_SCHEMA,
) -> DataFrame:
    """Trips of the given files, directories or globs in one schema, with lineage.

    With ``skip`` damaged files are left out whole. To find damaged pages all files are
    then read once in advance, however many are damaged.
    """
    listed = [paths] if isinstance(paths, str) else list(paths)
    found = schema_groups(spark, listed, on_error)
    frames = []
    for part, files in found.groups:
        if on_error == "skip":
            part, _ = _sound(spark, part, files, found.rows)
        if part:
            frames.append(_read_group(spark, part, files, schema).drop(PART))
    if not frames:
        raise ValueError("none of the files could be read")
    return reduce(DataFrame.unionByName, frames)


def _read_all(spark: SparkSession, files: T.StructType):
    def read(paths: Sequence[str]) -> None:
        spark.read.schema(files).parquet(*paths).write.format("noop").mode("overwrite").save()

    return read


def _plain(path: str) -> str:
    return re.sub(r"^file:/+", "/", path)


def damaged_path(error: Exception) -> str | None:
    """Path of the file that Spark names as unreadable, None for any other error."""
    cause = getattr(error, "java_exception", None) or getattr(error, "_origin", None)
    while cause is not None:
        if hasattr(cause, "getCondition") and "SparkThrowable" in _interfaces(cause):
            if cause.getCondition() in _DAMAGED:
                return _plain(unquote(dict(cause.getMessageParameters())["path"]))
        cause = cause.getCause()
    return None


def _interfaces(java_object) -> str:
    kind, names = java_object.getClass(), ""
    while kind is not None:
        names += " ".join(i.getSimpleName() for i in kind.getInterfaces())
        kind = kind.getSuperclass()
    return names


def _short(spark: SparkSession, paths: Sequence[str], files: T.StructType, rows: Mapping[str, int]) -> list[str]:
    """Paths that give fewer rows than their footers promise when damage ends a file and not the job."""
    read = spark.read.schema(files).option("ignoreCorruptFiles", "true").parquet(*paths)
    every = [F.count(F.col(f"`{f.name}`")) for f in files]  # decodes all columns
    path = F.col("_metadata.file_path").alias("path")
    counted = read.groupBy(path).agg(F.count("*").alias("rows"), F.array(*every).alias("known")).collect()
    found = {_plain(unquote(r["path"])): r["rows"] for r in counted}
    return [p for p in paths if found.get(_plain(p), 0) < rows[p]]


def _sound(
    spark: SparkSession, paths: Sequence[str], files: T.StructType, rows: Mapping[str, int]
) -> tuple[list[str], list[str]]:
    """Paths without damage, and damaged ones.

    One pass finds the files that break off; these are read once more, so that a passing
    fault of the store leaves no file out. Files whose footer only Spark can read are tried
    one failure at a time.
    """
    known = [p for p in paths if p in rows]
    bad = _short(spark, known, files, rows) if known else []
    bad = _short(spark, bad, files, rows) if bad else []
    good = [p for p in known if p not in set(bad)]
    others = [p for p in paths if p not in rows]
    if others:
        more, damaged = _without_damaged(spark, others, files, _read_all(spark, files))
        return good + more, bad + damaged
    return good, bad


def _without_damaged(
    spark: SparkSession, paths: Sequence[str], files: T.StructType, work
) -> tuple[list[str], list[str]]:
    """Do ``work`` on the paths, leaving out files that prove damaged: paths done, paths left out.

    Only the file an error names is left out, and only if reading it by itself fails in the
    same way. Every other error is raised.
    """
    good, bad = list(paths), []
    while good:
        try:
            work(good)
            return good, bad
        except _SPARK_ERRORS as error:
            named = damaged_path(error)
            suspects = [p for p in good if _plain(p) == named]
            if not suspects or _reads(spark, suspects, files):
                raise
            good = [p for p in good if p not in suspects]
            bad += suspects
    return good, bad


def _reads(spark: SparkSession, paths: Sequence[str], files: T.StructType) -> bool:
    try:
        _read_all(spark, files)(paths)
    except _SPARK_ERRORS as error:
        return damaged_path(error) is None
    return True


def _write_parts(rows: DataFrame, target: str) -> None:
    """Write rows into the folders of their parts; each task is to meet few of these, and then sorts nothing."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    with files_kept_open(rows.sparkSession):
        writer.partitionBy(SOURCE_FILE, PART).parquet(target)


def write_raw(df: DataFrame, path: str, mode: str = "append") -> None:
    """``append`` adds rows, ``overwrite`` reloads the whole table and forgets former loads.

    Rows are laid out like loaded files, as a part of their own. Columns the table does not
    have are added to it. A folder of another layout is refused. A reload is written and
    recorded beside the table before it takes its place, so one that fails leaves all former
    loads and their log as they were.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown write mode: {mode}")
    spark = df.sparkSession
    log = LoadLog(spark, path)
    log.begin()
    known = log.columns() if mode == "append" else None
    columns = evolved_schema(known, df.schema) if known else df.schema
    part = f"rows-{uuid4().hex}"
    # a month too large for one task is split; no task meets all months
    rows = conform(df, columns).withColumn(PART, F.lit(part)).hint("rebalance", SOURCE_FILE)
    if mode == "append":
        _write_parts(rows, log.target)
        log.record([(None, part, None)], columns)
        return
    table = Generations(spark, path)
    folder = table.fresh()
    _write_parts(rows, folder)
    LoadLog(spark, folder).record([(None, part, None)], columns)
    table.switch(folder)
    table.forget()


def read_raw(spark: SparkSession, target: str, files: Sequence[str] | None = None) -> DataFrame:
    """Rows of all recorded loads in the table's columns; older rows hold NULL in newer ones.

    With ``files`` only rows of these source files are read, and only their folders are listed;
    a file the table does not hold adds nothing.
    """
    log = LoadLog(spark, target)
    columns = log.columns()
    if columns is None:
        raise ValueError(f"{target} holds no load")
    if files is not None:
        parts = _parts_within(spark, log, files)
        if not parts:
            return spark.createDataFrame([], columns)
        return read_parts(spark, target, parts).select(*columns.names)
    rows = spark.read.schema(T.StructType([*columns, _PART_FIELD])).parquet(log.target)
    loaded = log.entries().select(F.col("source_file").alias("_file"), F.col("part").alias("_recorded")).distinct()
    of_load = (F.col(PART) == F.col("_recorded")) & (
        F.col("_file").isNull() | (F.col("_file") == F.col(SOURCE_FILE))
    )
    return rows.join(loaded, of_load, "left_semi").select(*columns.names)


def _parts_within(spark: SparkSession, log: LoadLog, files: Sequence[str]) -> list[tuple[str, str]]:
    """Recorded parts that lie in the folders of source files, rows written directly included."""
    folders, names = Folders(spark, log.target), spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    lead = f"{PART}="
    there = [
        (file, names.unescapePathName(name.removeprefix(lead)))
        for file in dict.fromkeys(files)
        for name in folders.names(f"{log.target}/{SOURCE_FILE}={names.escapePathName(file)}")
        if name.startswith(lead)
    ]
    listed = spark.createDataFrame(there, "_within string, _there string")
    recorded = (F.col("part") == F.col("_there")) & (
        F.col("source_file").isNull() | (F.col("source_file") == F.col("_within"))
    )
    held = listed.join(log.entries(), recorded, "left_semi").orderBy("_within", "_there")
    return [tuple(row) for row in held.collect()]


def read_parts(spark: SparkSession, target: str, parts: Sequence[tuple[str | None, str]]) -> DataFrame:
    """Rows of some recorded parts (source file or None for rows written directly, and part), with the part's name.

    Spark is handed their folders only, so nothing else of the table is listed or read.
    """
    log = LoadLog(spark, target)
    columns = log.columns()
    escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    paths = [
        f"{log.target}/{SOURCE_FILE}={'*' if file is None else escaped(file)}/{PART}={escaped(part)}"
        for file, part in parts
    ]
    schema = T.StructType([*columns, _PART_FIELD])
    return spark.read.schema(schema).option("basePath", log.target).parquet(*paths)


@dataclass(frozen=True)
class LoadReport:
    loaded: list[str]
    skipped: list[str]


def fresh_parts(spark: SparkSession, landing: str, log: LoadLog) -> DataFrame:
    """Landing parts the log does not record."""
    return _unrecorded(landing_parts(spark, landing), log)


def _unrecorded(parts: DataFrame, log: LoadLog) -> DataFrame:
    known = log.entries().filter("unit IS NOT NULL").select("source_file", "part").distinct()
    return parts.join(known, ["source_file", "part"], "left_anti")


def _refuse_shared_names(fresh: DataFrame, log: LoadLog) -> None:
    units = fresh.select("source_file", "unit").unionByName(
        log.entries().filter("unit IS NOT NULL").select("source_file", "unit")
    )
    shared = units.groupBy("source_file").agg(F.min("unit").alias("a"), F.max("unit").alias("z"))
    if not shared.filter("a <> z").isEmpty():
        raise ValueError("two landing files share a name, which must identify a file")


def _batches(files: Iterator[Row], size: int) -> Iterator[list[Row]]:
    """Whole monthly files together, at least ``size`` parts a batch but for the last."""
    batch: list[Row] = []
    for file in files:
        if len(batch) >= size and batch[-1]["source_file"] != file["source_file"]:
            yield batch
            batch = []
        batch.append(file)
    if batch:
        yield batch


def load_new_files(
    spark: SparkSession,
    landing: str,
    target: str,
    on_error: str = "abort",
    schema: T.StructType = RAW_TRIP_SCHEMA,
    batch_files: int = 1000,
) -> LoadReport:
    """Load the landing parts that raw does not hold yet; a rerun adds nothing.

    Files may differ in column types, case and presence; a column the table does not have
    is added to it as DOUBLE. Parts that arrive later in a folder already loaded are loaded
    too. Batches of months are written and recorded one after another, so neither the
    driver nor a failed run has more than a batch in hand. With ``skip`` a damaged file is
    left out whole and tried again on the next run; any other error is raised.
    """
    return load_parts(spark, landing_parts(spark, landing), target, on_error, schema, batch_files)


def load_parts(
    spark: SparkSession,
    parts: DataFrame,
    target: str,
    on_error: str = "abort",
    schema: T.StructType = RAW_TRIP_SCHEMA,
    batch_files: int = 1000,
) -> LoadReport:
    """The same for given parts (as of ``parts_of``), of which recorded ones are passed over."""
    log = LoadLog(spark, target)
    log.begin()
    fresh = _unrecorded(parts, log)
    _refuse_shared_names(fresh, log)
    columns = log.columns() or schema
    loaded: set[str] = set()
    skipped: list[str] = []
    with _footers_once(fresh) as (listed, schemas):
        ordered = listed.orderBy("source_file", "part").toLocalIterator()
        for batch in _batches(ordered, batch_files):
            found = _grouped(spark, batch, schemas, on_error)
            skipped += found.unreadable
            by_path = {file["path"]: file for file in batch}
            for paths, files in found.groups:
                columns = evolved_schema(columns, files)
                if on_error == "skip":
                    paths, bad = _sound(spark, paths, files, found.rows)
                    skipped += bad
                if not paths:
                    continue
                _write_parts(_read_group(spark, paths, files, columns), log.target)
                done = [by_path[p] for p in paths]
                log.record([(f["source_file"], f["part"], f["unit"]) for f in done], columns)
                loaded |= {f["unit"] for f in done}
    return LoadReport(sorted(loaded), sorted(skipped))
