"""Numbering, slots and carry-forward, arranged so that no task holds a whole large group."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from ledgerloom.session import cut


def top_n(df: DataFrame, keys: Sequence[str], by: Sequence[Column], n: int, number: str = "row_num") -> DataFrame:
    """The first ``n`` rows of each group with their number.  Spark applies the limit before the
    shuffle too (window group limit), so at most ``n`` rows per group and task travel."""
    w = Window.partitionBy(*keys).orderBy(*by)
    return df.withColumn(number, F.row_number().over(w)).filter(F.col(number) <= n)


def slot_pivot(df: DataFrame, keys: Sequence[str], number: str,
               slots: Mapping[str, tuple[str, Sequence[int]]]) -> DataFrame:
    """Spread numbered rows over columns: output name -> (column, numbers).  With several numbers
    the maximum is taken per column, so the values of a slot may come from different rows."""
    return df.groupBy(*keys).agg(*(
        F.max(F.when(F.col(number).isin(*numbers), F.col(c))).alias(name) for name, (c, numbers) in slots.items()))


def numbered_slots(prefix: str, c: str, n: int) -> dict[str, tuple[str, Sequence[int]]]:
    return {f"{prefix}{i}": (c, [i]) for i in range(1, n + 1)}


def first_slots(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, groups: Sequence[str],
                slots: Mapping[str, tuple[str, Sequence[int]]]) -> DataFrame:
    """Number rows within ``keys``, spread the first ``n`` over columns, one row per ``groups`` value.

    ``groups`` may be finer than ``keys``: a value that owns none of the first rows still gets its
    row, with empty slots.
    """
    first = top_n(df, keys, [F.asc_nulls_last(o) for o in order], n, "_n")
    if list(groups) != list(keys):
        first = first.unionByName(df.select(*groups).distinct(), allowMissingColumns=True)
    return slot_pivot(first, groups, "_n", slots)


def halo_window(df: DataFrame, keys: Sequence[str], order: Sequence[str], depth: int,
                exprs: Mapping[str, Callable[[WindowSpec], Column]], reads: Sequence[str], chunk: Column | None = None) -> DataFrame:
    """Window expressions over the columns ``reads`` that look back at most ``depth`` rows within ``keys``.

    The expressions may use ``_at``, the row's number in its window.

    ``chunk`` must rise with the order.  It cuts a group into pieces that are windowed apart;
    each piece gets the last ``depth`` rows before it as a halo, so results are those of the
    uncut window.  Every non-empty piece has at least one row, so the halo lies in the ``depth``
    pieces before it.  Only groups that fall into several pieces take part in building the halos.
    """
    def spec(part: Sequence[str]) -> WindowSpec:
        return Window.partitionBy(*part).orderBy(*(F.asc_nulls_last(o) for o in order))

    def evaluated(rows: DataFrame, w: WindowSpec) -> DataFrame:
        numbered = rows.withColumn("_at", F.row_number().over(w))
        return numbered.withColumns({name: make(w) for name, make in exprs.items()}).drop("_at")

    if chunk is None:
        return evaluated(df, spec(keys))

    parts = [*keys, "_chunk"]
    whole = df.withColumn("_chunk", chunk)
    carried = list(dict.fromkeys([*keys, *order, *reads]))
    narrow = whole.select(*carried, "_chunk")
    several = (narrow.groupBy(*keys).agg(F.min("_chunk").alias("_low"), F.max("_chunk").alias("_high"))
               .filter(F.col("_low") < F.col("_high")).select(*keys))
    back = Window.partitionBy(*parts).orderBy(*(F.desc_nulls_first(o) for o in order))
    tails = (narrow.join(several, list(keys), "left_semi").repartition(*parts).withColumn("_back", F.row_number().over(back)).filter(F.col("_back") <= depth)
             .groupBy(*parts).agg(F.sort_array(F.collect_list(
                 F.struct((-F.col("_back")).alias("_at"), F.struct(*carried).alias("_row")))).alias("_tail")))
    before = Window.partitionBy(*keys).orderBy(F.asc_nulls_last("_chunk")).rowsBetween(-depth, -1)
    halo = (tails.withColumn("_halo", F.flatten(F.collect_list("_tail").over(before)))
            .filter(F.size("_halo") > 0)
            .select("_chunk", F.explode(F.slice("_halo", F.greatest(F.lit(1), F.size("_halo") - (depth - 1)), depth)).alias("_h"))
            .select("_h._row.*", "_chunk", F.lit(True).alias("_is_halo")))
    # partitioned by piece even where the input already lies partitioned by key
    fed = whole.withColumn("_is_halo", F.lit(False)).unionByName(halo, allowMissingColumns=True).repartition(*parts)
    return evaluated(fed, spec(parts)).filter(~F.col("_is_halo")).drop("_chunk", "_is_halo")


def fill_previous(df: DataFrame, cols: Mapping[str, str], keys: Sequence[str], order: Sequence[str],
                  within: int = 7, chunk: Column | None = None) -> DataFrame:
    """New column -> source column: the nearest known value of this row or the ``within`` rows before."""
    # A running "last known value with its row number" costs one step per row; a sliding frame would
    # go through the whole frame again for every row.
    def filler(c: str) -> Callable[[WindowSpec], Column]:
        known = F.when(F.col(c).isNotNull(), F.struct(F.col("_at").alias("at"), F.col(c).alias("value")))

        def make(w: WindowSpec) -> Column:
            last = F.last(known, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
            return F.when(F.col("_at") - last["at"] <= within, last["value"])
        return make

    return halo_window(df, keys, order, within, {name: filler(c) for name, c in cols.items()}, list(cols.values()), chunk)


def lag_steps(df: DataFrame, c: str, keys: Sequence[str], order: Sequence[str], steps: int,
              prefix: str = "lag_", chunk: Column | None = None) -> DataFrame:
    def step(i: int) -> Callable[[WindowSpec], Column]:
        return lambda w: F.lag(c, i).over(w)

    return halo_window(df, keys, order, steps, {f"{prefix}{i}": step(i) for i in range(1, steps + 1)}, [c], chunk)


def _with_places(df: DataFrame, order: Sequence[Column]) -> tuple[DataFrame, DataFrame]:
    """The rows with ``_rank_part`` and ``_rank_place`` in it, and per part the rows before it; parts follow the order.

    Written once, because both depend on the layout.  The counts are one row per partition.
    """
    laid = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())).withColumns({
        "_rank_part": F.shiftright("_id", 33), "_rank_place": F.col("_id").bitwiseAND((1 << 33) - 1)}).drop("_id")
    counts = laid.groupBy("_rank_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_rank_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return laid, cut(counts.select("_rank_part", before.alias("_rank_before")))


def global_row_number(df: DataFrame, order: Sequence[str], name: str = "row_num", start: int = 0) -> DataFrame:
    """Number all rows in order without gathering them.

    Rows are range-partitioned, sorted and written once; a row's number is its place in its partition plus the rows of the
    partitions before, of which there is one count per partition.  No further shuffle: the counts are a broadcast of one
    row per partition.
    """
    laid, offsets = _with_places(df, [F.asc_nulls_last(o) for o in order])
    return (laid.join(F.broadcast(offsets), "_rank_part")
            .withColumn(name, (F.col("_rank_before") + F.col("_rank_place") + 1 + start).cast("bigint")).drop("_rank_part", "_rank_place", "_rank_before"))


def dense_rank_global(df: DataFrame, c: str, name: str, descending: bool = True) -> DataFrame:
    """Dense rank over all rows: number the distinct values over range partitions and join the number back.

    The values may be as many as the rows: no task sees more of them than a partition holds, and their numbers meet the rows
    in a join that Spark broadcasts or shuffles by their size.
    """
    key = F.desc_nulls_first("_value") if descending else F.asc_nulls_last("_value")
    values, offsets = _with_places(df.select(F.col(c).alias("_value")).distinct(), [key])
    ranks = values.join(F.broadcast(offsets), "_rank_part").select("_value", (F.col("_rank_before") + F.col("_rank_place") + 1).cast("bigint").alias(name))
    return df.join(ranks, F.col(c).eqNullSafe(F.col("_value")), "left").drop("_value")
