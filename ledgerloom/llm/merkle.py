"""Merkle manifest of a table of documents: leaves, roots per source and of all, inclusion proofs and their check.

A document is a leaf, a source a tree of 16 children a node, and the sources' roots are the leaves of the tree above.

1. Digests of rows are built-in expressions.  Only digests, keys and positions go on; texts are not shuffled.
2. A leaf's position in its source comes from a range partitioning by source, identifier and digest, with one row count per
   source and partition, so a source that holds most rows is spread over all partitions.
3. 4096 successive leaves (three levels) are a superblock.  One grouped reduction turns superblocks into nodes of the next
   tree, and so on until each source has one node: a handful of rounds whatever the size.
4. On the way down each round cogroups the nodes of a superblock with the one row of outer nodes that its own node needs
   (siblings up to the root).  The last cogroup, that of the leaves, finishes the subtree, joins the proofs and folds them.

No group holds more than a superblock and one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.session import cut

FAN = 16
#: Leaves of a superblock: a power of ``FAN``, and the most rows that a group holds.
BLOCK = FAN ** 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NODE = "tree string, pos long, count long, digest string"
_STEP = "array<struct<left:string,right:string>>"
_PATH = f"tree string, pos long, path {_STEP}, top string"


def digest(*parts: str) -> str:
    """Lower-case hexadecimal sha256 of the parts, concatenated."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _field(c: Column) -> Column:
    return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))


def _leaf(**changed: Column) -> Column:
    return F.sha2(F.concat(*(_field(changed.get(c, F.col(c)).cast("string")) for c in FIELDS)), 256)


def is_tampered(doc_id: Column) -> Column:
    """Whether the drill tampers with this document: 5 divides the crc32 of its decimal identifier; never for null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """tree, doc_id, digest, changed: the digest of each row, and that of the tampered row where it is another.

    ``tree`` is a key that sorts like the source, null first, and is never null.
    """
    tampered = F.when(is_tampered(F.col("doc_id")), _leaf(text=F.translate(F.col("text"), _UPPER, _LOWER)))
    return (docs.select(*FIELDS).select(F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("tree"), F.col("doc_id").cast("long"), _leaf().alias("digest"), tampered.alias("changed"))
            .withColumn("changed", F.when(F.col("changed") != F.col("digest"), F.col("changed"))))


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the partition and the place among the rows of the same tree in this partition; rows of a tree follow each other."""
    part, last, done = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        trees = batch.column("tree")
        fresh = np.ones(batch.num_rows, bool)
        fresh[1:] = pc.not_equal(trees[1:], trees[:-1]).to_numpy(zero_copy_only=False)
        fresh[0] = trees[0].as_py() != last
        at = np.arange(batch.num_rows)
        begin = np.maximum.accumulate(np.where(fresh, at, -1))
        place = np.where(begin < 0, at + done, at - begin)
        last, done = trees[-1].as_py(), int(place[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(place)], names=[*batch.schema.names, "part", "place"])


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``pos``, the place of a row in its ``tree`` by ``order`` (nulls first, from 0), and ``count``, the rows of the tree.

    Rows that are equal in all of ``order`` are told apart by their place in the written input, so that copies without
    number spread over partitions as well.
    """
    laid = cut(rows.withColumn("tie", F.monotonically_increasing_id()))
    by = [F.asc_nulls_first(c) for c in ("tree", *order, "tie")]
    kinds = ", ".join(f"`{c}` {t}" for c, t in laid.dtypes)
    placed = cut(laid.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(_places, f"{kinds}, part int, place long")).drop("tie")
    parts = placed.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = parts.select("tree", "part", F.coalesce(before, F.lit(0)).alias("before"), F.sum("n").over(Window.partitionBy("tree")).alias("count"))
    return cut(placed.join(offsets, ["tree", "part"]).withColumn("pos", F.col("place") + F.col("before")).drop("part", "place", "before"))


def _levels(digests: list[str], count: int, size: int) -> list[list[str]]:
    """The nodes of a superblock level by level, as far up as its tree has several nodes, to one node at last."""
    out = [digests]
    while count > 1 and size > 1:
        out.append([digest(*out[-1][i:i + FAN]) for i in range(0, len(out[-1]), FAN)])
        count, size = -(-count // FAN), size // FAN
    return out


def _reduce(key: tuple, group: pd.DataFrame, block: int) -> pd.DataFrame:
    """The one node of a superblock, as a node of the tree above."""
    group = group.sort_values("pos")
    count = int(group["count"].iloc[0])
    return pd.DataFrame({"tree": [key[0]], "pos": [key[1]], "count": [-(-count // block)], "digest": [_levels(group["digest"].tolist(), count, block)[-1][0]]})


def _paths_below(levels: list[list[str]], above: list[tuple[str, str]]) -> list[list[tuple[str, str]]]:
    """Per node of the lowest level its siblings to the left and right, level by level, those of the outer nodes included."""
    paths = [above]
    for nodes in reversed(levels[:-1]):
        lower = []
        for i in range(len(nodes)):
            run = i - i % FAN
            lower.append([("".join(nodes[run:i]), "".join(nodes[i + 1:run + FAN])), *paths[i // FAN]])
        paths = lower
    return paths


def _steps(value: object) -> list[tuple[str, str]]:
    return [(s["left"], s["right"]) for s in value]


def _descend(group: pd.DataFrame, outer: pd.DataFrame, block: int) -> pd.DataFrame:
    group = group.sort_values("pos")
    paths = _paths_below(_levels(group["digest"].tolist(), int(group["count"].iloc[0]), block), _steps(outer["path"].iloc[0]))
    steps = [[{"left": a, "right": b} for a, b in p] for p in paths]
    return pd.DataFrame({"tree": group["tree"].tolist(), "pos": group["pos"].tolist(), "path": steps, "top": outer["top"].iloc[0]})


def fold(leaf: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and the siblings on its way lead to."""
    for left, right in path:
        leaf = digest(left, leaf, right)
    return leaf


def _prove(group: pd.DataFrame, outer: pd.DataFrame, block: int) -> pd.DataFrame:
    group = group.sort_values("pos")
    found, top = group["digest"].tolist(), outer.iloc[0]
    paths = _paths_below(_levels(found, int(group["count"].iloc[0]), block), _steps(top["path"]))
    folded = [fold(leaf if changed is None else changed, path) for leaf, changed, path in zip(found, group["changed"].tolist(), paths, strict=True)]
    return pd.DataFrame({
        "doc_id": group["doc_id"].tolist(), "leaf": found, "subroot": top["top"], "root": top["root"],
        "proof_sha256": [digest(*(s for step in path for s in step)) for path in paths], "folded_root": folded,
        "verified": [f == top["root"] for f in folded]})


def _by_block(nodes: DataFrame, block: int):
    return nodes.withColumn("block", F.floor(F.col("pos") / block)).groupBy("tree", "block")


def _reduced(nodes: DataFrame, block: int) -> DataFrame:
    return cut(_by_block(nodes.select("tree", "pos", "count", "digest"), block).applyInPandas(lambda key, group: _reduce(key, group, block), _NODE))


def paths(nodes: DataFrame, block: int = BLOCK) -> DataFrame:
    """tree, pos, path (siblings per level up to the tree's root), top (that root), for nodes tree, pos, count, digest."""
    if nodes.filter("count > 1").isEmpty():
        return nodes.select("tree", "pos", F.expr(f"cast(array() as {_STEP})").alias("path"), F.col("digest").alias("top"))
    outer = paths(_reduced(nodes, block), block)
    held = _by_block(nodes, block).cogroup(outer.withColumnRenamed("pos", "block").groupBy("tree", "block"))
    return cut(held.applyInPandas(lambda group, above: _descend(group, above, block), _PATH))


def manifest(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``folded_root`` is recomputed from the tampered leaf (``is_tampered``), else the original one, with the original
    siblings; ``verified`` tells whether it is the root.  Within a source leaves ascend by doc_id (null first), then by
    digest; repeated rows are leaves of their own.  A null source is a source.  Any other column is ignored.  Texts may be null,
    empty or of any length.  An empty table has no rows.
    """
    rows = numbered(leaves(docs), ["doc_id", "digest"])
    inner = paths(_reduced(rows, block), block)
    subroots = numbered(inner.filter("pos = 0").select(F.lit("").alias("tree"), F.col("tree").alias("source"), F.col("top").alias("digest")), ["source"])
    over = subroots.join(paths(subroots.select("tree", "pos", "count", "digest"), block).select("pos", F.col("path").alias("over"), F.col("top").alias("root")), "pos")
    outer = inner.join(over.select(F.col("source").alias("tree"), "over", "root"), "tree").select(
        "tree", F.col("pos").alias("block"), F.concat("path", "over").alias("path"), "top", "root")
    # identifiers travel as text: pandas would turn whole numbers with a null into floats
    proved = _by_block(rows.withColumn("doc_id", F.col("doc_id").cast("string")), block).cogroup(outer.groupBy("tree", "block")).applyInPandas(
        lambda group, above: _prove(group, above, block), "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    return proved.withColumn("doc_id", F.col("doc_id").cast("long"))
