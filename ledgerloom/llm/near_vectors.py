"""Exact embedding near-duplicates by a dual traversal of cover trees.

Per label a cover tree of nested levels with halving radii is fitted on a bounded sample; all vectors are then assigned to
its leaves, and each node's covering radius is taken over all of them.  A dual traversal drops node pairs that lie further
apart than their radii allow.  The leaf pairs left are compared exactly, in blocks, in double precision.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import arrow_groups, components, spanning
from ledgerloom.session import cut

COSINE = 0.98
#: Vectors per leaf aimed at, most leaves of a label, sampled vectors per leaf, most labels that get a tree of their own.
#: Further labels are one leaf each.  None of these changes the result.
LEAF_ROWS = 1024
MAX_LEAVES = 64
SAMPLE_PER_LEAF = 8
MAX_TREES = 2000
BLOCK_ROWS = 1024


class CoverTree:
    """Nested nets over sample points on the unit sphere: a centre at depth l covers its children within 2 / 2**l."""

    def __init__(self, sample: np.ndarray, leaves: int):
        order, far = [0], np.linalg.norm(sample - sample[0], axis=1)
        reach = [4.0]
        while len(order) < min(leaves, len(sample)) and far.max() > 1e-9:
            at = int(far.argmax())
            reach.append(float(far[at]))
            order.append(at)
            far = np.minimum(far, np.linalg.norm(sample - sample[at], axis=1))
        self.centres = sample[order]
        self.between = np.linalg.norm(self.centres[:, None] - self.centres[None], axis=2)
        # levels[l]: number of centres with insertion distance of at least 2 / 2**l; centres are in order of insertion
        self.levels, radius = [1], 2.0
        while self.levels[-1] < len(order):
            radius /= 2
            self.levels.append(max(self.levels[-1], int(np.sum(np.array(reach) >= radius))))

    def children(self, level: int) -> list[np.ndarray]:
        nearest = self.between[:self.levels[level + 1], :self.levels[level]].argmin(axis=1)
        return [np.flatnonzero(nearest == i) for i in range(self.levels[level])]

    def pairs(self, radii: np.ndarray, slack: float) -> list[tuple[int, int]]:
        """Leaf pairs (i <= j) that may hold vectors within ``slack`` of each other, given the leaves' covering radii."""
        depth = len(self.levels) - 1
        below = [self.children(level) for level in range(depth)]
        cover = [radii]
        for level in range(depth - 1, -1, -1):
            cover.insert(0, np.array([max((self.between[i, j] + cover[0][j] for j in kids), default=0.0) for i, kids in enumerate(below[level])]))
        out, todo = [], [(0, 0, 0)]
        while todo:
            i, j, level = todo.pop()
            if i != j and self.between[i, j] > cover[level][i] + cover[level][j] + slack + 1e-9:
                continue
            if level == depth:
                out.append((i, j))
                continue
            for a in below[level][i]:
                todo += [(min(a, b), max(a, b), level + 1) for b in below[level][j] if i != j or a <= b]
        return sorted(out)


def _prepared(vectors: DataFrame) -> DataFrame:
    """vec_id, label, key (of label and components), vector (doubles as bytes); key and vector are null where nothing can link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, data = [], []
            for label, vector in zip(batch.column("label").to_pylist(), batch.column("vector"), strict=True):
                x = None
                if label is not None and vector.is_valid and len(vector.values) and not vector.values.null_count:
                    x = vector.values.to_numpy().astype(np.float64) + 0.0
                    x = x if np.isfinite(x).all() and x.any() else None
                raw = None if x is None else x.tobytes()
                data.append(raw)
                keys.append(None if raw is None else hashlib.md5(f"{label}:".encode() + raw).digest())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(keys, pa.binary()), pa.array(data, pa.binary())], names=["vec_id", "label", "key", "vector"])

    return vectors.mapInArrow(run, "vec_id long, label long, key binary, vector binary")


def _unit(raw: list[bytes]) -> np.ndarray:
    x = np.stack([np.frombuffer(r, np.float64) for r in raw])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _assigned(reps: DataFrame, trees: dict[tuple[int, int], CoverTree]) -> DataFrame:
    """Adds leaf and distance to the leaf's centre."""
    shared = reps.sparkSession.sparkContext.broadcast({k: t.centres for k, t in trees.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf, distance = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
            label, size = batch.column("label").to_numpy(), batch.column("size").to_numpy()
            raw = batch.column("vector").to_pylist()
            for group in set(zip(label.tolist(), size.tolist(), strict=True)) & shared.value.keys():
                at = np.flatnonzero((label == group[0]) & (size == group[1]))
                x, centres = _unit([raw[i] for i in at]), shared.value[group]
                dots = x @ centres.T
                leaf[at] = dots.argmax(axis=1)
                distance[at] = np.linalg.norm(x - centres[leaf[at]], axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf), pa.array(distance)], names=[*batch.schema.names, "leaf", "distance"])

    return reps.mapInArrow(run, "key binary, label long, size int, copies long, vector binary, leaf int, distance double")


def _linked(cosine: float):
    def work(groups: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
        for group in groups:
            keys = group.column("key").to_pylist()
            raw = group.column("vector").to_pylist()
            side = list(zip(group.column("leaf").to_pylist(), group.column("block").to_pylist(), strict=True))
            one = group.column("first")[0].as_py() == group.column("second")[0].as_py()
            x = _unit(raw)
            linked = x @ x.T >= cosine
            np.fill_diagonal(linked, False)
            number = {s: i for i, s in enumerate(dict.fromkeys(side))}
            part = np.array([number[s] for s in side])
            counted = linked if one else linked & (part[:, None] != part[None, :])
            links = counted.astype(np.float64) @ group.column("copies").to_numpy().astype(np.float64)
            label = spanning(linked)
            keep = np.flatnonzero((links > 0) | (label != np.arange(len(keys))))
            yield pa.RecordBatch.from_arrays([pa.array([keys[i] for i in keep], pa.binary()), pa.array(links[keep].astype(np.int64)), pa.array([keys[label[i]] for i in keep], pa.binary())],
                                             names=["key", "links", "tie"])
    return work


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = COSINE,
                 leaf_rows: int = LEAF_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors of one label link if their cosine is at least ``cosine`` (above 0), in double precision.  Null labels, null, empty
    and zero vectors and such with null or non-finite components link with nothing, nor do vectors of different length.
    Equal vectors are compared once and counted as often as they stand there; repeated rows count as vectors of their own.
    """
    prepared = cut(_prepared(vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))))
    classes = cut(prepared.filter("key is not null").groupBy("key").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"),
                                                                        F.first("vector").alias("vector")).withColumn("size", F.octet_length("vector").cast("int")))
    large = (classes.groupBy("label", "size").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > leaf_rows)
             .orderBy(F.desc("n"), "label", "size").limit(MAX_TREES))
    per = F.greatest(F.lit(1), F.floor(F.col("n") / (F.least(F.lit(MAX_LEAVES), F.ceil(F.col("n") / leaf_rows)) * SAMPLE_PER_LEAF)))
    sample: dict[tuple[int, int], list[bytes]] = {}
    leaves: dict[tuple[int, int], int] = {}
    for r in classes.join(F.broadcast(large), ["label", "size"]).filter(F.pmod(F.xxhash64("key"), per) == 0).select("label", "size", "n", "vector").collect():
        sample.setdefault((r.label, r.size), []).append(bytes(r.vector))
        leaves[r.label, r.size] = min(MAX_LEAVES, -(-r.n // leaf_rows))
    trees = {k: CoverTree(_unit(sorted(v)), leaves[k]) for k, v in sample.items()}

    placed = cut(_assigned(classes.select("key", "label", "size", "copies", "vector"), trees))
    stats = placed.groupBy("label", "size", "leaf").agg(F.count(F.lit(1)).alias("rows"), F.max("distance").alias("radius"))
    slack = float(np.sqrt(2 - 2 * cosine))
    # leaves of trees are bounded by MAX_TREES * MAX_LEAVES; the other labels pair with themselves only
    known: dict[tuple[int, int], dict[int, float]] = {}
    for r in stats.join(F.broadcast(large), ["label", "size"]).collect() if trees else ():
        known.setdefault((r.label, r.size), {})[r.leaf] = r.radius
    met = []
    for k, tree in trees.items():
        radii = np.array([known.get(k, {}).get(i, 0.0) for i in range(len(tree.centres))])
        met += [(*k, int(i), int(j)) for i, j in tree.pairs(radii, slack)]
    spark = vectors.sparkSession
    partners = spark.createDataFrame([*((a, b, i, j) for a, b, i, j in met), *((a, b, j, i) for a, b, i, j in met if i != j)], "label long, size int, leaf int, other int")
    sized = placed.join(stats.select("label", "size", "leaf", "rows"), ["label", "size", "leaf"]).withColumn("blocks", F.ceil(F.col("rows") / block_rows).cast("int"))
    paired = sized.join(F.broadcast(partners), ["label", "size", "leaf"], "left").withColumn("other", F.coalesce("other", "leaf"))
    others = stats.select("label", "size", F.col("leaf").alias("other"), F.ceil(F.col("rows") / block_rows).cast("int").alias("_others"))
    spread = (paired.join(others, ["label", "size", "other"])
              .withColumn("block", F.pmod(F.xxhash64("key", F.lit(5)), F.col("blocks")).cast("int"))
              .withColumn("_block", F.explode(F.sequence(F.lit(0), F.col("_others") - 1))))
    mine, theirs = F.struct(F.col("leaf").alias("leaf"), F.col("block").alias("block")), F.struct(F.col("other").alias("leaf"), F.col("_block").alias("block"))
    write = lambda s: F.concat_ws(":", s["leaf"], s["block"])
    pairs = (spread.withColumn("first", write(F.least(mine, theirs))).withColumn("second", write(F.greatest(mine, theirs)))
             .select("label", "size", "first", "second", "key", "copies", "vector", "leaf", "block"))
    checked = cut(arrow_groups(pairs, ["label", "size", "first", "second"], _linked(cosine), "key binary, links long, tie binary"))
    links = checked.groupBy("key").agg(F.sum("links").alias("links"))
    joined = components(checked.select(F.col("key").alias("a"), F.col("tie").alias("b")))
    ids = joined.join(classes.select(F.col("key").alias("node"), "id"), "node")
    tied = ids.join(ids.groupBy("component").agg(F.min("id").alias("smallest")), "component").select(F.col("node").alias("key"), "smallest")
    per_key = cut(classes.select("key", "id", "copies").join(tied, "key", "left").join(links, "key", "left")
               .select("key", F.coalesce("smallest", "id").alias("smallest"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("found")))
    return (prepared.select("vec_id", "key").join(per_key, "key", "left")
            .select("vec_id", F.coalesce("found", F.lit(0)).alias("n_links"), F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("smallest")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))
