"""Where report tables come from.  A source hands out one DataFrame per table name."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.session import cut, home
from ledgerloom.sources.schemas import check, exact_numbers
from ledgerloom.sources.standins import RAW_TABLES, STANDINS, references


class Source:
    """Base: subclasses implement ``table``."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def table(self, name: str) -> DataFrame:
        raise NotImplementedError

    def scan(self, name: str, columns: str | None = None, prefix: str = "") -> DataFrame:
        """Pick and check columns (blank-separated, ``col:alias`` renames); ``prefix`` starts all other names."""
        df = self.table(name)
        if columns is None:
            return df
        items = [item.partition(":") for item in columns.split()]
        check(name, df, [c for c, _, _ in items])
        return df.select(*(F.col(c).alias(alias or f"{prefix}{c}") for c, _, alias in items))


class FolderSource(Source):
    """Parquet tables below one folder, as ``name`` or ``name.parquet``."""

    def __init__(self, spark: SparkSession, root: str, suffix: str = ""):
        super().__init__(spark)
        self.root, self.suffix = root, suffix

    def table(self, name: str) -> DataFrame:
        return exact_numbers(self.spark.read.parquet(os.path.join(self.root, name + self.suffix)))


class DatabaseSource(Source):
    """Tables of the session catalog."""

    def __init__(self, spark: SparkSession, database: str):
        super().__init__(spark)
        self.database = database

    def table(self, name: str) -> DataFrame:
        return exact_numbers(self.spark.table(f"{self.database}.{name}"))


class FrameSource(Source):
    """Frames at hand, for tests and for mixing sources."""

    def __init__(self, spark: SparkSession, frames: Mapping[str, DataFrame]):
        super().__init__(spark)
        self.frames = dict(frames)

    def table(self, name: str) -> DataFrame:
        return self.frames[name]


class StandInSource(Source):
    """Report tables derived from the test tables in ``folder``.

    ``written`` names tables to build once and read back, for reports that derive many tables from them.
    """

    def __init__(self, spark: SparkSession, folder: str, written: tuple[str, ...] = ()):
        super().__init__(spark)
        self.folder, self.written = folder, written
        # its tables serve the whole report, not the step that asks for one first
        self._home = home(spark) if written else None
        self._made: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._made:
            if name in RAW_TABLES:
                made = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            else:
                sql = STANDINS[name]
                made = self.spark.sql(sql, **{ref: self.table(ref) for ref in references(sql)})
            self._made[name] = cut(made, self._home) if name in self.written else made
        return self._made[name]

    def query(self, sql: str) -> DataFrame:
        """Run a SELECT that names tables in braces."""
        return self.spark.sql(sql, **{ref: self.table(ref) for ref in references(sql)})


def literal_row(spark: SparkSession, **values: object) -> DataFrame:
    """One row of constants."""
    return spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items()))
