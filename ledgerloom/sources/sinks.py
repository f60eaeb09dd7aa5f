"""Write a report's rows; page layout is left to the reader of the files.

A report is written beside its place and moved there when it is whole, so a run that fails leaves the last one as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.session import scratch


class Folder:
    """A folder in any file system that Spark reads."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self.path = path
        self._at = self._jvm.org.apache.hadoop.fs.Path(path)
        self._files = self._at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return self._files.exists(self._at)

    def make(self) -> None:
        self._files.mkdirs(self._at)

    def delete(self) -> None:
        self._files.delete(self._at, True)

    def move(self, target: Folder) -> None:
        """One rename; an error if the target is there or the file system refuses."""
        if target.exists() or not (self._files.mkdirs(target._at.getParent()) and self._files.rename(self._at, target._at)):
            raise OSError(f"cannot move {self.path} to {target.path}")


def _write(df: DataFrame, path: str, fmt: str, partition_by: Sequence[str]) -> None:
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.format(fmt).save(path)


def _beside(path: str, what: str) -> str:
    """A hidden name in the same folder: readers skip names that start with a dot."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/.{name}-{what}-{uuid.uuid4().hex}"


def write_report(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Replace the report at ``path``.

    Readers find the whole old or the whole new one; between the two renames, for a moment, none.  Where the second rename
    fails, the old report is put back.  Stores that copy on rename (object stores) lose this guarantee.
    """
    spark = df.sparkSession
    target, staged, old = Folder(spark, path), Folder(spark, _beside(path, "new")), Folder(spark, _beside(path, "old"))
    try:
        _write(df, staged.path, fmt, partition_by)
    except BaseException:
        staged.delete()
        raise
    there = target.exists()
    if there:
        target.move(old)
    try:
        staged.move(target)
    except BaseException:
        if there:
            old.move(target)
        staged.delete()
        raise
    old.delete()


def run_report(spark: SparkSession, build: Callable[[], DataFrame], path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Build a report, replace the one at ``path`` and drop all intermediates of the run."""
    with scratch(spark):
        write_report(build(), path, fmt, partition_by)


def write_once(df: DataFrame, path: str, fmt: str = "parquet") -> bool:
    """Write a folder that is never replaced; false, and nothing done, if it is there already."""
    spark = df.sparkSession
    target, staged = Folder(spark, path), Folder(spark, _beside(path, "new"))
    if target.exists():
        return False
    try:
        _write(df, staged.path, fmt, ())
        staged.move(target)
    except BaseException:
        staged.delete()
        raise
    return True
