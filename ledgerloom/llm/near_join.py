"""N-gram Jaccard self-join by a MinHash LSH forest with exact verification.

1. Each text gets a MinHash signature of its word shingles; equal texts are one class from here on.
2. The signature is read as the labels of ``trees`` prefix tries.  Matched prefixes are shortened from ``max_depth`` until the
   modelled recall at the threshold reaches the target; texts that share such a prefix in any trie are candidates.
3. Candidates whose signatures agree in fewer than half as many places as the threshold asks for are dropped, and the rest is
   tied to families by spanning edges, not by all pairs.
4. Within a family all pairs are verified exactly on whole shingle sets, in blocks, and only counts and spanning edges leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import SHINGLE_WORDS, arrow_groups, binary_key, components, shingles, spanning, text_slices, with_block_pairs
from ledgerloom.session import cut

SIMILARITY = 0.8
TREES = 16
MAX_DEPTH = 8
RECALL = 0.9999
BLOCK_ROWS = 256
SCREEN = 0.5


def trie_depth(similarity: float, trees: int, max_depth: int, recall: float) -> int:
    """The longest prefix at which the forest still finds a pair at the threshold with the target recall."""
    depth = max_depth
    while depth > 1 and 1 - (1 - similarity ** depth) ** trees < recall:
        depth -= 1
    return depth


def signatures(docs: DataFrame, k: int, values: int) -> DataFrame:
    """doc_id, key (of the text), n_shingles, signature (``values`` 32-bit minima; empty for a text without words)."""
    rng = np.random.default_rng(2024)
    factor = rng.integers(1, 1 << 63, values, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shift = rng.integers(0, 1 << 63, values, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column("text")):
                grams, at = shingles(data, offsets, k)
                size = np.diff(at)
                full = np.flatnonzero(size)
                minima = np.zeros((len(full), values), np.uint32)
                for j in range(values if len(full) else 0):
                    minima[:, j] = np.minimum.reduceat(grams * factor[j] + shift[j], at[full]) >> np.uint64(32)
                ends = np.concatenate([[0], np.cumsum(np.where(size > 0, values, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[low:high], batch.column("key")[low:high], pa.array(size, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(minima.reshape(-1).view(np.int32)))],
                    names=["doc_id", "key", "n_shingles", "signature"])

    return docs.mapInArrow(run, "doc_id long, key binary, n_shingles long, signature array<int>")


def _screened(least: int, trees: int, depth: int):
    """Spanning edges among the rows of a block pair whose signatures agree in ``least`` places.

    A pair that shares prefixes in several tries counts in the first of them only.
    """
    values = trees * depth

    def work(groups: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
        left: list = []
        right: list = []
        for group in groups:
            n = group.num_rows
            if n > 1:
                keys = group.column("key").to_pylist()
                sign = group.column("signature").combine_chunks().flatten().to_numpy().reshape(n, values)
                tree = group.column("tree")[0].as_py()
                same, earlier = np.zeros((n, n), np.int16), np.zeros((n, n), bool)
                for t in range(trees):
                    met = np.ones((n, n), bool)
                    for j in range(t * depth, (t + 1) * depth):
                        equal = sign[:, j, None] == sign[None, :, j]
                        same += equal
                        met &= equal
                    if t < tree:
                        earlier |= met
                label = spanning((same >= least) & ~earlier)
                for i in np.flatnonzero(label != np.arange(n)):
                    left.append(keys[i])
                    right.append(keys[label[i]])
            if len(left) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["a", "b"])
                left, right = [], []
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["a", "b"])
    return work


def common_counts(grams: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of all pairwise intersections of sets of hashes."""
    n = len(grams)
    values, place = np.unique(np.concatenate(grams), return_inverse=True)
    row = np.repeat(np.arange(n), [len(g) for g in grams])
    shared = np.flatnonzero(np.bincount(place, minlength=len(values)) > 1)
    number = np.full(len(values), -1)
    number[shared] = np.arange(len(shared))
    at = number[place]
    row, at = row[at >= 0], at[at >= 0]
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    total = np.zeros((n, n), np.float64)
    for low in range(0, len(shared), columns):
        a, b = np.searchsorted(at, [low, low + columns])
        has = np.zeros((n, columns), np.float32)
        has[row[a:b], at[a:b] - low] = 1
        total += has @ has.T
    return total


def _verified(k: int, similarity: float):
    """Links of each row with the rows of the other side of its block pair (weighted by copies), and spanning edges."""
    def emit(out: list[tuple]) -> pa.RecordBatch:
        keys, links, ties = zip(*out) if out else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(links, pa.int64()), pa.array(ties, pa.binary())], names=["key", "links", "tie"])

    def work(groups: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for group in groups:
            keys = group.column("key").to_pylist()
            # a text that stands under its identifier more than once arrives more than once
            rows = list({key: i for i, key in enumerate(keys)}.values())
            if len(rows) < 2:
                continue
            keys = [keys[i] for i in rows]
            block, copies = (group.column(c).to_numpy()[rows] for c in ("block", "copies"))
            grams: list[np.ndarray] = []
            for _, _, data, offsets in text_slices(group.column("text").combine_chunks().take(pa.array(rows))):
                found, at = shingles(data, offsets, k)
                grams += [np.unique(found[x:y]) for x, y in zip(at[:-1], at[1:], strict=True)]
            size = np.array([len(g) for g in grams], np.float64)
            both = common_counts(grams)
            # |A and B| / |A or B| >= similarity, in whole numbers as far as the threshold allows
            linked = (both > 0) & (both + 1e-9 >= similarity * (size[:, None] + size[None, :] - both))
            np.fill_diagonal(linked, False)
            one_block = group.column("left_block")[0].as_py() == group.column("right_block")[0].as_py()
            counted = linked if one_block else linked & (block[:, None] != block[None, :])
            links = counted.astype(np.float64) @ copies.astype(np.float64)
            label = spanning(linked)
            out += [(key, int(n), keys[x]) for key, n, x in zip(keys, links, label, strict=True) if n or key != keys[x]]
            if len(out) >= 10_000:
                yield emit(out)
                out = []
        yield emit(out)
    return work


def near_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE_WORDS, similarity: float = SIMILARITY,
              trees: int = TREES, max_depth: int = MAX_DEPTH, recall: float = RECALL, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per document: doc_id, key, class_id, n_links, n_copies, class_key.

    Two documents are linked if the Jaccard similarity of their sets of word ``k``-grams is at least ``similarity``; equal
    texts with a word are linked.  ``class_id`` is the smallest doc_id that links lead to, ``n_links`` the number of other
    documents linked directly and ``n_copies`` those of them with the very same text.  ``key`` is the MD5 of the text,
    ``class_key`` the smallest key that links lead to (null for texts without words): other than ``class_id`` it tells classes
    apart also where unrelated texts share an identifier.
    Texts of fewer than ``k`` words have all their words as one gram.  Null and wordless texts link with nothing and are
    classes of their own.  A null doc_id is never a class while another one is there.  An empty table gives no rows.
    """
    depth = trie_depth(similarity, trees, max_depth, recall)
    values = trees * depth
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumn("key", binary_key(F.col("text")))
    signed = cut(signatures(texts, k, values))
    classes = cut(signed.filter("n_shingles > 0").groupBy("key").agg(
        F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("signature").alias("signature")))

    prefix = F.array(*(F.xxhash64(F.lit(t), *(F.col("signature")[t * depth + j] for j in range(depth))) for t in range(trees)))
    nodes = classes.select("key", F.posexplode(prefix).alias("tree", "node"))
    met = cut(nodes.groupBy("node").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1"))
    members = with_block_pairs(nodes.join(met, "node"), F.col("_n"), F.col("key"), block_rows).select("node", "tree", "left_block", "right_block", "key")
    labelled = members.join(classes.select("key", "signature"), "key")
    candidate = arrow_groups(labelled, ["node", "left_block", "right_block"], _screened(int(values * SCREEN * similarity / SIMILARITY), trees, depth), "a binary, b binary")
    families = components(candidate)

    sized = families.join(families.groupBy("component").agg(F.count(F.lit(1)).alias("_n")), "component")
    wanted = sized.join(classes.select(F.col("key").alias("node"), "id", "copies"), "node")
    rows = (texts.join(wanted, (texts["key"] == wanted["node"]) & texts["doc_id"].eqNullSafe(wanted["id"]))
            .select("key", "text", "copies", "component", "_n"))
    blocks = with_block_pairs(rows, F.col("_n"), F.col("key"), block_rows).drop("_n")
    checked = cut(arrow_groups(blocks, ["component", "left_block", "right_block"], _verified(k, similarity), "key binary, links long, tie binary"))
    links = checked.groupBy("key").agg(F.sum("links").alias("links"))
    joined = components(checked.select(F.col("key").alias("a"), F.col("tie").alias("b")))

    ids = joined.join(classes.select(F.col("key").alias("node"), "id"), "node")
    tied = ids.join(ids.groupBy("component").agg(F.min("id").alias("class_id")), "component").select(F.col("node").alias("key"), "class_id", "component")
    per_text = cut(classes.select("key", "id", "copies").join(tied, "key", "left").join(links, "key", "left")
                .select("key", F.coalesce("class_id", "id").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                        (F.col("copies") - 1).alias("n_copies"), F.coalesce("component", "key").alias("class_key")))
    return (signed.select("doc_id", "key").join(per_text, "key", "left")
            .select("doc_id", "key", F.when(F.col("n_links").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                    F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("n_copies", F.lit(0)).alias("n_copies"), "class_key"))


def keep_first(docs: DataFrame, **options: object) -> DataFrame:
    """The documents with one row of each class kept: the one whose doc_id is the class.  Columns stay as they are.

    Of rows of a class that share this doc_id the one with the smallest text key is kept, so unrelated texts under one
    identifier both stay.  Texts without words are classes of their own, one row per identifier and text.
    """
    near = near_join(docs, **options).select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), F.col("class_id").alias("_class"), F.col("class_key").alias("_group"))
    first = near.filter(F.col("_id").eqNullSafe(F.col("_class")))
    chosen = cut(first.filter("_group is not null").groupBy("_group").agg(F.min(F.struct("_key", "_id")).alias("_one")).select("_one._id", "_one._key")
                 .union(first.filter("_group is null").select("_id", "_key").distinct()))
    keyed = docs.withColumn("_row_key", binary_key(F.col("text")))
    kept = keyed.join(chosen, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("_row_key").eqNullSafe(F.col("_key")))
    return kept.dropDuplicates(["doc_id", "_row_key"]).select(*docs.columns)
