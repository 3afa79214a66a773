"""Session and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


def local_session(cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """Local session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tripflow")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the one the cluster names in ``spark.checkpoint.dir``.

    A machine-local folder is only ever chosen when the setting is absent and
    the session itself is local, since executors elsewhere could not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tripflow-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def files_kept_open(spark: SparkSession, most: int = 32) -> Iterator[None]:
    """Within it a task of a partitioned write keeps up to ``most`` files open instead of sorting its rows.

    Only for writes whose tasks meet few files each: rows for more files are sorted as ever. A
    number that the session sets itself stays.
    """
    if int(spark.conf.get(_OPEN_FILES, "0")) > 0:
        yield
        return
    spark.conf.set(_OPEN_FILES, str(most))
    try:
        yield
    finally:
        spark.conf.unset(_OPEN_FILES)
