"""Mixing sources to target weights by subset sums over exact document lengths.

Documents are counted by exact length.  Per source a bounded-knapsack dynamic programme over these counts decides how many
documents of each length are taken, and the documents of a length are then chosen by seeded order.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ledgerloom.llm.common import WORD
from ledgerloom.operators.windows import global_row_number
from ledgerloom.session import cut

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEATS = 3
#: Sums around the remaining budget that the dynamic programme looks at, in words.
DP_WINDOW = 1 << 16
#: Expected rows of the one bucket per source and length in which documents are ranked.
BUCKET_ROWS = 200


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int, window: int = DP_WINDOW) -> np.ndarray:
    """How many documents of each length to take so that the sum comes nearest to ``budget`` (a tie goes to the lower sum).

    A budget within half a ``window`` is the bounded-knapsack programme's alone, over all documents: the result is the nearest
    sum there is.  Of a larger one lengths take their proportional share of all but half a window first, then whole documents
    from the longest down until what is left lies within it; the programme finds the nearest sum for that rest over all
    documents left.  Its memory is ``2 * window`` however many documents there are.
    """
    order = np.argsort(-lengths, kind="stable")
    size, have = lengths[order].astype(np.int64), counts[order].astype(np.int64)
    have = np.where(size > 0, have, 0)
    total = int((size * have).sum())
    budget = max(0, min(int(budget), total))
    # the share is that of a smaller budget, so that the programme has room on both sides
    early = max(0, budget - window // 2)
    taken = np.array([int(c) * early // total for c in have], np.int64) if total else np.zeros_like(have)
    rest = budget - int((taken * size).sum())
    for i in range(len(size)):
        if rest <= window // 2:
            break
        if size[i] and have[i] > taken[i] and size[i] <= rest:
            n = min(int(have[i] - taken[i]), max(1, int((rest - window // 2) // size[i])))
            taken[i] += n
            rest -= n * int(size[i])
    if rest > 0:
        # first[s]: the item (length, number of documents) that first reached the sum s
        top = min(2 * rest, rest + window)
        first = np.full(top + 1, -1, np.int32)
        reached = np.zeros(top + 1, bool)
        reached[0] = True
        items: list[tuple[int, int]] = []
        for i in range(len(size) - 1, -1, -1):
            left, power = int(have[i] - taken[i]), 1
            while left > 0 and size[i] * min(power, left) <= top and not reached[rest]:
                n = min(power, left)
                w = int(size[i]) * n
                new = np.zeros(top + 1, bool)
                new[w:] = reached[:top + 1 - w]
                new &= ~reached
                first[new] = len(items)
                reached |= new
                items.append((i, n))
                left, power = left - n, power * 2
            if reached[rest]:
                break
        sums = np.flatnonzero(reached)
        at = int(sums[np.argmin(np.abs(sums - rest), axis=0)])
        while at:
            i, n = items[first[at]]
            taken[i] += n
            at -= n * int(size[i])
    out = np.zeros_like(taken)
    out[order] = taken
    return out


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.0, most: float = MAX_REPEATS) -> DataFrame:
    """Add ``target`` to (source, source_size) rows: the budget by weight, at most ``most`` times a source's size.

    Sources get the weights in turn, by code point order with null last.  What lies above a source's most is shared anew by
    weight among the others until none is above.  Each round is one sum over the sources; only scalars reach the driver.
    """
    placed = global_row_number(sizes, ["source"], "_place")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.pmod(F.col("_place") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = cut(placed.withColumn("_weight", weight).withColumn("_most", F.col("source_size") * F.lit(float(most))))
    whole = float(ranked.agg(F.sum("source_size")).first()[0] or 0) * share
    level = None
    while True:
        above = F.lit(False) if level is None else F.col("_most") < F.col("_weight") * F.lit(level)
        full, open_weight = ranked.agg(F.sum(F.when(above, F.col("_most")).otherwise(0.0)), F.sum(F.when(above, 0.0).otherwise(F.col("_weight")))).first()
        new = (whole - (full or 0.0)) / open_weight if open_weight else float("inf")
        if level is not None and new <= level:
            break
        level = new
    target = F.least(F.col("_most"), F.col("_weight") * F.lit(level)) if level != float("inf") else F.col("_most")
    return ranked.withColumn("target", target).drop("_place", "_weight", "_most")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[float] = WEIGHTS,
        share: float = 1.0, most: int = MAX_REPEATS, seed: int = 7) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, repeats, taken (= size * repeats).

    A source below its target repeats all its documents as often as they fit whole; the rest of the target is a subset sum.
    Null and wordless texts have size 0 and are not taken.  Null sources form one source.  A repeated row is a document of
    its own; rows alike in id and size are interchangeable.  An empty table gives no rows.

    The length table has at most sqrt(2 * words) rows per source, as its distinct lengths sum to no more than the words;
    it is the only thing that one task sees whole.
    """
    sized = cut(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                            F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
                .withColumn("_draw", F.xxhash64("doc_id", "size", F.lit(seed))))
    lengths = cut(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    targets = cut(source_targets(lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, share, most))

    def plan(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        size, n = rows["size"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
        whole, target = int(rows["source_size"].iloc[0]), float(rows["target"].iloc[0])
        rounds = min(most, int(target // whole)) if whole else 0
        extra = fit_budget(size, n, int(round(target - rounds * whole))) if whole and rounds < most else np.zeros_like(n)
        return rows.assign(rounds=rounds, extra=extra, buckets=np.maximum(1, n // BUCKET_ROWS))

    planned = cut(lengths.join(targets, lengths["source"].eqNullSafe(targets["source"])).select(lengths["source"], "size", "n", "source_size", "target")
                  .groupBy("source").applyInPandas(plan, "source string, size long, n long, source_size long, target double, rounds long, extra long, buckets long"))
    # The documents of a length are taken in the order of their draw.  Draws fall into ordered buckets: all documents of the
    # buckets before the limit are taken, and only those of the bucket that holds the limit need ranks.
    p = planned.withColumnsRenamed({"source": "_source", "size": "_size"})
    spread = cut(sized.join(p, sized["source"].eqNullSafe(p["_source"]) & (sized["size"] == p["_size"])).drop("_source", "_size")
                 .withColumn("_bucket", F.floor((F.shiftright("_draw", 16) / F.lit(float(1 << 48)) + 0.5) * F.col("buckets"))))
    key = ["source", "size", "_bucket"]
    filled = spread.filter("extra > 0 and extra < n").groupBy(*key).agg(F.count(F.lit(1)).alias("_in"), F.first("extra").alias("_extra"))
    before = Window.partitionBy("source", "size").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    edge = (filled.withColumn("_open", F.col("_extra") - F.coalesce(F.sum("_in").over(before), F.lit(0)))
            .withColumn("_limit", F.greatest(F.lit(0), F.least("_open", "_in")))
            .select(F.col("source").alias("_s"), F.col("size").alias("_z"), F.col("_bucket").alias("_b"), "_in", "_limit"))
    joined = spread.join(edge, spread["source"].eqNullSafe(edge["_s"]) & (spread["size"] == edge["_z"]) & (spread["_bucket"] == edge["_b"]), "left")
    ranked = (joined.filter("_limit > 0 and _limit < _in")
              .withColumn("_rank", F.row_number().over(Window.partitionBy("source", "size", "_bucket").orderBy("_draw", "doc_id")))
              .withColumn("_more", (F.col("_rank") <= F.col("_limit")).cast("long")).drop("_rank"))
    plain = (joined.filter("_limit is null or _limit = 0 or _limit = _in")
             .withColumn("_more", F.when(F.col("_limit").isNull(), (F.col("extra") >= F.col("n")) & (F.col("size") > 0)).otherwise(F.col("_limit") > 0).cast("long")))
    return (plain.unionByName(ranked).withColumn("repeats", F.when(F.col("size") > 0, F.col("rounds") + F.col("_more")).otherwise(F.lit(0)))
            .select("doc_id", "source", "size", "source_size", "target", "repeats", (F.col("size") * F.col("repeats")).alias("taken")))


def apply_mix(docs: DataFrame, **options: object) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them.  Rows that share doc_id and source share their repeats evenly."""
    plan = (mix(docs, **options).groupBy(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"))
            .agg(F.sum("repeats").alias("_repeats"), F.count(F.lit(1)).alias("_rows")).filter("_repeats > 0"))
    sized = docs.withColumn("_words", F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long"))
    joined = sized.join(plan, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_source")) & (F.col("_words") == F.col("_size")))
    # a row alone takes its repeats; of rows alike in identifier, source and size each takes its part, by order of text
    alone = joined.filter("_rows = 1").withColumn("_times", F.col("_repeats"))
    place = F.row_number().over(Window.partitionBy("_id", "_source", "_size").orderBy("text"))
    shared = (joined.filter("_rows > 1").withColumn("_place", place)
              .withColumn("_times", F.floor(F.col("_repeats") / F.col("_rows")) + (F.col("_place") <= F.col("_repeats") % F.col("_rows")).cast("long")).drop("_place"))
    return (alone.unionByName(shared).filter("_times > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))))
            .select(*docs.columns))
