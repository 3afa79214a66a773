"""Tables that are replaced by writing anew, then switching.

Each build of a table has a folder of its own below ``_generations``. Once it is complete, a
small file in ``_current`` names it, and readers follow the file of the highest number. So
a build that breaks off anywhere leaves the former rows in place, on stores without atomic
renames too: pointers are only ever added, and one whose line is not complete does not
count. The generation before the current one stays for those who still read it and goes after
the next success, together with what broken builds left. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_GENERATIONS, _CURRENT = "_generations", "_current"


class Folders:
    """The few file operations that Spark itself has no words for."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm = spark._jvm
        self._files = self.place(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def place(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def names(self, path: str) -> list[str]:
        """Names in a folder; none if it does not exist."""
        place = self.place(path)
        if not self._files.exists(place):
            return []
        return sorted(s.getPath().getName() for s in self._files.listStatus(place))

    def exists(self, path: str) -> bool:
        return self._files.exists(self.place(path))

    def text(self, path: str) -> str:
        stream = self._files.open(self.place(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> None:
        """A new file; one that exists is not replaced."""
        stream = self._files.create(self.place(path), False)
        stream.write(bytearray(text, "utf-8"))
        stream.close()

    def delete(self, path: str) -> None:
        self._files.delete(self.place(path), True)


class Generations:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path = path.rstrip("/")
        self._folders = Folders(spark, path)

    def _complete(self) -> list[str]:
        """Names of the completed generations, oldest first."""
        pointers = f"{self.path}/{_CURRENT}"
        lines = [self._folders.text(f"{pointers}/{n}") for n in self._folders.names(pointers)]
        return [line.strip() for line in lines if line.endswith("\n")]

    def current(self) -> str | None:
        """Folder of the current generation; None if the table was never replaced."""
        found = self._complete()
        return f"{self.path}/{_GENERATIONS}/{found[-1]}" if found else None

    def fresh(self) -> str:
        """Folder for the next generation."""
        taken = [int(n) for n in self._folders.names(f"{self.path}/{_CURRENT}")]
        return f"{self.path}/{_GENERATIONS}/{max(taken, default=0) + 1:08d}-{uuid4().hex}"

    def switch(self, folder: str) -> None:
        """Make a complete generation the current one; fails if another took its number."""
        name = folder.rsplit("/", 1)[1]
        self._folders.create(f"{self.path}/{_CURRENT}/{name[:8]}", f"{name}\n")

    def forget(self) -> None:
        """Delete all but the current generation and the one before it."""
        found = self._complete()
        kept, below = found[-2:], f"{self.path}/{_GENERATIONS}"
        for name in self._folders.names(below):
            if name not in kept and name[:8] <= found[-1][:8]:  # higher numbers are being written
                self._folders.delete(f"{below}/{name}")
        for name in self._folders.names(f"{self.path}/{_CURRENT}"):
            if name < kept[0][:8]:
                self._folders.delete(f"{self.path}/{_CURRENT}/{name}")
        if len(found) > 1:  # rows beside the generations are older than any
            for name in self._folders.names(self.path):
                if name not in (_GENERATIONS, _CURRENT):
                    self._folders.delete(f"{self.path}/{name}")


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Store the rows as the table's next generation and read them back."""
    table = Generations(df.sparkSession, path)
    folder = table.fresh()
    df.write.partitionBy(*partition_by).parquet(folder)
    table.switch(folder)
    table.forget()
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The current rows of a replaced table."""
    folder = Generations(spark, path).current()
    if folder is None:
        raise ValueError(f"{path} holds no complete build")
    return spark.read.parquet(folder)
