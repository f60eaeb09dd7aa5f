"""Registered queries: a Spark callable per name and, where SQL can say it, the oracle text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.session import tune
from ledgerloom.sources.catalog import Source, StandInSource
from ledgerloom.sources.standins import as_cte

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, run: Callable[[Source], DataFrame], oracle: str | None = None, written: tuple[str, ...] = ()) -> None:
    """``run`` gets the stand-in source; ``oracle`` names its tables in braces; ``written`` stand-ins are built once."""
    def call(spark: SparkSession, folder: str) -> DataFrame:
        return run(StandInSource(tune(spark), folder, written))

    call.__name__ = name
    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")
    QUERIES[name] = call
    if oracle is not None:
        ORACLES[name] = as_cte(oracle)


def narrowed(name: str, of: str, run: Callable[[Source], DataFrame], where: str, written: tuple[str, ...] = ()) -> None:
    """A second run of the report ``of`` with more parameters; its oracle filters that report's rows (its stand-ins are in it already)."""
    register(name, run, None, written)
    ORACLES[name] = f"SELECT * FROM ({ORACLES[of]}) WHERE {where}"
