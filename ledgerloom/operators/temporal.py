"""Rows valid at a date, in a window, or at a document version."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

START, END = "effective_start_date", "effective_end_date"
OPEN_VERSION = 9_999_999


def valid_at(at: Column, start: Column, end: Column, open_end: bool = False, allow_missing: bool = False) -> Column:
    """Closed interval test.  ``open_end``: no end means still valid.  ``allow_missing``: a row
    without a start or an end passes, as after an outer join."""
    hit = at.between(start, end)
    if open_end:
        hit = hit | ((start <= at) & end.isNull())
    if allow_missing:
        hit = hit | start.isNull() | end.isNull()
    return hit


def as_of(df: DataFrame, at: Column, start: str = START, end: str = END,
          open_end: bool = False, allow_missing: bool = False) -> DataFrame:
    return df.filter(valid_at(at, F.col(start), F.col(end), open_end, allow_missing))


def as_of_join(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str,
               start: str = START, end: str = END, how: str = "inner",
               cell_years: int | None = None, horizon: tuple[int, int] = (1900, 2100)) -> DataFrame:
    """Join each left row to the right rows valid at its own date.

    The plan is a hash or sort-merge join on the keys with the interval as residual test, which
    compares all rows of a key.  With ``cell_years`` (any ``how`` that keeps left rows or pairs: inner,
    left, left_semi, left_anti) the key is extended by a calendar cell, so that a key with very many dates and intervals is spread over tasks and only
    rows of the same stretch of time meet.  An interval is copied into each cell it touches inside
    ``horizon``; a date lies in one cell only, so no pair comes twice.  Dates outside the horizon
    are clamped to its first or last cell on both sides and keep the exact residual test.  A left row
    is never copied, so one without a partner (no key, no date, no interval) stays once.
    """
    interval = right.withColumnsRenamed({start: "_start", end: "_end"})
    test = F.col(at).between(F.col("_start"), F.col("_end"))
    on = list(keys)
    if cell_years:
        low, high = horizon

        def cell(c: Column) -> Column:
            return F.floor(F.least(F.greatest(F.year(c), F.lit(low)), F.lit(high)) / cell_years).cast("int")

        left = left.withColumn("_cell", cell(F.col(at)))
        interval = interval.filter(F.col("_start") <= F.col("_end")).withColumn(
            "_cell", F.explode(F.sequence(cell(F.col("_start")), cell(F.col("_end")))))
        on = [*on, "_cell"]
    renamed = interval.withColumnsRenamed({k: f"_r_{k}" for k in on})
    cond = test
    for k in on:
        cond = (F.col(k) == F.col(f"_r_{k}")) & cond
    joined = left.join(renamed, cond, how).drop(*(f"_r_{k}" for k in on))
    if how not in ("left_semi", "left_anti"):
        joined = joined.withColumnsRenamed({"_start": start, "_end": end})
    return joined.drop("_cell")


def overlaps(low: Column, high: Column | None, start: Column, end: Column, today: Column) -> Column:
    """The interval touches the window; a window without an end goes up to today."""
    until = today if high is None else F.coalesce(high, today)
    return (end >= low) & (start <= until)


def _blocks(low: Column, high: Column, levels: Column) -> Column:
    """The aligned blocks (level, number) of 2 ** level versions each that make up ``low <= v < high``: two a level at most."""
    low, high = low.cast("bigint"), high.cast("bigint")
    shift = lambda way, c, by: F.call_function(f"shift{way}", c, by)

    def level(i: Column) -> Column:
        first, end = shift("right", low + shift("left", F.lit(1).cast("bigint"), i) - 1, i), shift("right", high, i)
        odd = [F.when((first < end) & (c % 2 == 1), F.struct(i.alias("level"), n.alias("number"))) for c, n in ((first, first), (end, end - 1))]
        return F.filter(F.array(*odd), lambda b: b.isNotNull())

    return F.flatten(F.transform(F.sequence(F.lit(0), levels), level))


def version_as_of(archive: DataFrame, versions: DataFrame, keys: Sequence[str], version: str = "co_sequence",
                  low: str = "from_co_seq", high: str = "to_co_seq") -> DataFrame:
    """Every version of a document with the archive rows in force at it (``low <= v < high``; versions are not negative).

    A join by equality: a row's stretch of versions is cut into aligned blocks of 1, 2, 4 ... versions, of which each version
    has one a level, so that a pair meets in exactly one block.  Rows and versions are copied as often as the logarithm of
    the document's last version, and a document of very many rows and versions spreads over tasks.
    """
    last = versions.groupBy(*keys).agg(F.max(version).alias("_last"))
    named = {k: f"_v_{k}" for k in keys}
    match = lambda side: reduce(and_, (F.col(k) == F.col(f"{side}{k}") for k in keys))
    levels = F.floor(F.log2(F.col("_last") + F.lit(1))).cast("int")
    ends = last.withColumnsRenamed({k: f"_l_{k}" for k in keys})
    cut_rows = (archive.filter(F.col(low) < F.col(high)).join(ends, match("_l_")).drop(*(f"_l_{k}" for k in keys))
                .withColumn("_b", F.explode(_blocks(F.greatest(F.col(low), F.lit(0)), F.least(F.col(high), F.col("_last") + 1), levels)))
                .select("*", F.col("_b.level").alias("_level"), F.col("_b.number").alias("_number")).drop("_b", "_last"))
    dealt = (versions.join(ends, match("_l_")).drop(*(f"_l_{k}" for k in keys))
             .withColumn("_at", F.explode(F.sequence(F.lit(0), levels)))
             .withColumn("_block", F.call_function("shiftright", F.col(version).cast("bigint"), F.col("_at"))).drop("_last").withColumnsRenamed(named))
    cond = match("_v_") & (F.col("_level") == F.col("_at")) & (F.col("_number") == F.col("_block"))
    return cut_rows.join(dealt, cond).drop("_level", "_number", "_at", "_block", *named.values())


def changes_at(archive: DataFrame, versions: DataFrame, keys: Sequence[str], children: Sequence[DataFrame] = (), child_key: str | None = None,
               version: str = "co_sequence", low: str = "from_co_seq", high: str = "to_co_seq") -> DataFrame:
    """Archive rows with the versions that change them: those at which the row starts, or, if it is open, an open child row.

    ``children`` are archive frames linked to the rows by ``child_key``.  Only starts make a row appear, so versions are found
    by equality with them; what merely stays in force is never built.
    """
    named = {k: f"_v_{k}" for k in keys}
    at = versions.withColumnsRenamed(named)
    match = reduce(and_, (F.col(k) == F.col(f"_v_{k}") for k in keys))
    events = archive.filter(F.col(low) < F.col(high)).withColumn("_at", F.col(low))
    if children:
        starts = reduce(DataFrame.unionByName, (c.filter(F.col(high) == OPEN_VERSION).select(F.col(child_key).alias("_child"), F.col(low).alias("_at")) for c in children)).distinct()
        still_open = archive.filter(F.col(high) == OPEN_VERSION).join(starts, F.col(child_key) == F.col("_child")).filter(
            (F.col("_at") > F.col(low)) & (F.col("_at") < F.col(high))).drop("_child")
        events = events.unionByName(still_open)
    return events.join(at, match & (F.col("_at") == F.col(version))).drop("_at", *named.values())
