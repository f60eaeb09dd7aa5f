"""Shared helpers: word and shingle fingerprints over Arrow text buffers, streamed groups, connected components.

Text columns are handled as Arrow batches: the UTF-8 bytes of a batch lie in one buffer, so words, rolling hashes and
shingles are a few numpy passes over slices of some MB.  Null text counts as empty everywhere here.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.session import cut, ensure_checkpoint_dir

#: Words are runs of other characters than space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SHINGLE_WORDS = 5
SLICE_BYTES = 2 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row offsets) of consecutive rows; a slice exceeds ``limit`` only for one longer text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    if not len(column):
        return
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset:column.offset + len(column) + 1]
    content = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        high = min(high, len(column))
        yield low, high, content[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low]
        low = high


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        size = 1 << int(n - 1).bit_length()
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _powers[i] = np.cumprod(factors)
    return _powers[0][:n], _powers[1][:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums, from which the hash of any range follows; see ``range_hash``."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data) + 1)[0][:-1], out=sums[1:])
    return sums


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return (sums[end] - sums[start]) * powers(len(sums))[1][start]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and per row where its words begin (one entry more than rows)."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = ~_SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    begins = inside[:-1].copy()
    begins[1:] &= ~inside[:-2] | first[1:-1]
    ends = inside[:-1] & (~inside[1:] | first[1:])
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash per word, and per row where its words begin."""
    starts, ends, rows = word_bounds(data, offsets)
    return mix(range_hash(prefix_sums(data), starts, ends)), rows


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` successive items, also of those that reach beyond a row."""
    if len(hashes) < k:
        return np.zeros(0, np.uint64)
    n = len(hashes) - k + 1
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total = (total * np.uint64(0xD1342543DE82EF95)) + hashes[j:j + n]
    return mix(total)


def shingles(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word k-grams of all rows, row after row, and where each row's begin.

    A row of fewer than ``k`` words, but at least one, has a single shingle: all its words.  A row without words has none.
    """
    hashes, rows = word_hashes(data, offsets)
    count = np.diff(rows)
    whole = windows(hashes, k)
    size = np.where(count >= k, count - k + 1, (count > 0).astype(count.dtype))
    at = np.concatenate([[0], np.cumsum(size)])
    take = np.repeat(rows[:-1] - at[:-1], size) + np.arange(at[-1])
    out = whole[np.minimum(take, len(whole) - 1)] if len(whole) else np.zeros(at[-1], np.uint64)
    for row in np.flatnonzero((count > 0) & (count < k)):
        out[at[row]] = windows(hashes[rows[row]:rows[row + 1]], int(count[row]))[0] ^ np.uint64(count[row])
    return out, at


def streamed_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Successive groups of a partition that is sorted by ``keys``; a group may span batches.

    Keys must not be null.
    """
    held: list[pa.Table] = []
    last: tuple | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not table.num_rows:
            continue
        change = np.zeros(table.num_rows, bool)
        change[0] = True
        for k in keys:
            values = table.column(k).combine_chunks()
            change[1:] |= np.asarray(pc.not_equal(values[1:], values[:-1]).to_numpy(zero_copy_only=False), bool)
        starts = np.flatnonzero(change)
        for low, high in zip(starts, [*starts[1:], table.num_rows], strict=True):
            this = tuple(table.column(k)[int(low)].as_py() for k in keys)
            if held and this != last:
                yield pa.concat_tables(held)
                held = []
            held.append(table.slice(low, high - low))
            last = this
    if held:
        yield pa.concat_tables(held)


def arrow_groups(df: DataFrame, keys: list[str], work: Callable[[Iterator[pa.Table]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Bring equal keys together, sort, and hand the groups of each partition to ``work`` one after the other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return work(streamed_groups(batches, keys))

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def cut_by(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """``cut`` into buckets of ``key``: a later grouping by it, or a join on it, reads the files without a shuffle."""
    spark, name = df.sparkSession, f"cut_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, key).option("path", os.path.join(ensure_checkpoint_dir(spark), name)).saveAsTable(name, format="parquet")
    return spark.table(name)


def with_block_pairs(df: DataFrame, size: Column, member: Column, block_rows: int) -> DataFrame:
    """Copy each row of a group to the block pairs that it takes part in: columns ``block``, ``left_block``, ``right_block``.

    A group of ``size`` rows falls into ceil(size / block_rows) blocks by hash, so that each pair of rows meets in one block
    pair and no task needs the whole group.  A small group is one block and is not copied.
    """
    n = F.ceil(size / F.lit(block_rows)).cast("int")
    return (df.withColumn("_blocks", n).withColumn("block", F.pmod(F.xxhash64(member, F.lit(17)), F.col("_blocks")).cast("int"))
            .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
            .withColumn("left_block", F.least("block", "_other")).withColumn("right_block", F.greatest("block", "_other"))
            .drop("_blocks", "_other"))


def spanning(adjacent: np.ndarray) -> np.ndarray:
    """Smallest index reachable in a symmetric boolean matrix, per row."""
    label = np.arange(len(adjacent))
    reach = adjacent | np.eye(len(adjacent), dtype=bool)
    while True:
        new = np.where(reach, label[None, :], len(label)).min(axis=1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for all nodes of undirected edges; the component is its smallest node.

    Alternates the two star steps of distributed connected components: every node's larger neighbours, then its smaller
    ones, are tied to the smallest node around.  A step is one pre-aggregated minimum per node and one join, so a hub
    never has to fit one task.  Each round is written to the shared folder, the minima too: a join of two
    written tables is one that adaptive execution can split at a hub.  The loop ends when the edges stay as they are.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v and u is not null and v is not null")
    state = cut(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    while True:
        now = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen or not now[0]:
            return state.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                state.select(F.col("v"), F.col("v"))).distinct()
        seen = now
        both = state.union(state.select("v", "u"))
        low = cut(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = cut(large)
        low = cut(large.groupBy("u").agg(F.min("v").alias("m")))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m"))))
        state = cut(small.filter("u <> v").distinct())


def binary_key(text: Column) -> Column:
    """128-bit key of a text; null for null."""
    return F.unhex(F.md5(text))
