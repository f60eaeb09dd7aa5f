"""Removal of repeated byte strings by prefix-free parsing.

Rolling-hash triggers cut the texts into phrases, which depend on content only, so repeated text has equal phrases.  The
dictionary of distinct phrases (each with the bytes of the windows that start in it) is small for repetitive text, and all
later work is on the dictionary and on the parse, the list of phrase occurrences:

1. Every window of ``length`` bytes has an anchor, its smallest gram.  Only windows whose anchor stands in two places at
   least can be repeated; stretches of such windows are parsed into phrases.
2. A phrase that occurs twice is repeated whole.
3. The windows of the dictionary are put in one order, that of their fingerprints, in which equal windows are neighbours.
   The order is dealt over buckets, so no task holds a suffix array of the whole dictionary or parse.
4. The parse carries repeated windows back to the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import arrow_groups, binary_key, mix, prefix_sums, range_hash, text_slices
from ledgerloom.session import cut

LENGTH = 400
ANCHOR_BYTES = 128
TRIGGER_BYTES = 16
TRIGGER_MOD = 1024
SHARD_BYTES = 6 << 20


def _grams(sums: np.ndarray, size: int) -> np.ndarray:
    n = len(sums) - size
    at = np.arange(max(0, n))
    return mix(range_hash(sums, at, at + size))


def _sliding(x: np.ndarray, width: int, best: np.ufunc, empty: int) -> np.ndarray:
    """Minimum or maximum of each ``width`` successive values."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    padded = np.full(-(-len(x) // width) * width, empty, x.dtype)
    padded[:len(x)] = x
    table = padded.reshape(-1, width)
    forward = best.accumulate(table, axis=1).reshape(-1)
    backward = best.accumulate(table[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return best(backward[:n], forward[width - 1:width - 1 + n])


def _window_anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Gram hashes, the smallest gram of the window at each byte, whether this window lies within its text, and prefix sums."""
    sums = prefix_sums(data)
    grams = _grams(sums, gram)
    smallest = _sliding(grams, length - gram + 1, np.minimum, np.iinfo(np.uint64).max)
    inside = np.zeros(len(data) + 1, np.int64)
    long = offsets[1:] - offsets[:-1] >= length
    np.add.at(inside, offsets[:-1][long], 1)
    np.add.at(inside, (offsets[1:] - length + 1)[long], -1)
    return grams, smallest, np.cumsum(inside)[:len(smallest)] > 0, sums


def _anchors(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column("text")):
                grams, smallest, inside, _ = _window_anchors(data, offsets, length, gram)
                width = length - gram + 1
                if len(smallest):
                    # a gram is an anchor if it is the smallest of some window around it
                    held = np.concatenate([np.zeros(width - 1, np.uint64), np.where(inside, smallest, np.uint64(0)), np.zeros(width - 1, np.uint64)])
                    at = np.flatnonzero(_sliding(held, width, np.maximum, 0) == grams)
                else:
                    at = np.zeros(0, np.int64)
                ends = np.searchsorted(at, offsets).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column("key")[low:high], pa.ListArray.from_arrays(pa.array(ends), pa.array(grams[at].view(np.int64)))], names=["key", "anchors"])
    return run


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _phrases(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, starts, stops, contents = [], [], [], [], []
            names = batch.column("key").to_pylist()
            for low, high, data, offsets in text_slices(batch.column("text")):
                _, smallest, inside, sums = _window_anchors(data, offsets, length, gram)
                suspect = np.zeros(len(smallest), bool)
                for i in range(low, high):
                    a, b = offsets[i - low], max(offsets[i - low], offsets[i - low + 1] - length + 1)
                    if b > a:
                        known = np.sort(batch.column("bad")[i].values.to_numpy().view(np.uint64))
                        place = np.minimum(np.searchsorted(known, smallest[a:b]), len(known) - 1)
                        suspect[a:b] = known[place] == smallest[a:b]
                suspect &= inside
                trigger = np.flatnonzero(_grams(sums, TRIGGER_BYTES)[:len(suspect)] % np.uint64(TRIGGER_MOD) == 0)
                content = data.tobytes()
                first, last = _runs(suspect)
                # a stretch ends where its text ends: the windows that would reach over are not inside
                cuts = np.unique(np.concatenate([first, trigger[suspect[trigger]]])) if len(first) else first
                ends = np.minimum(np.append(cuts[1:], len(suspect)), last[np.searchsorted(last, cuts, "right")]) if len(cuts) else cuts
                row = np.searchsorted(offsets, cuts, "right") - 1
                for s, e, r in zip(cuts.tolist(), ends.tolist(), row.tolist(), strict=True):
                    piece = content[s:e + length - 1]
                    ids.append(hashlib.md5(piece).digest())
                    keys.append(names[low + r])
                    starts.append(s - int(offsets[r]))
                    stops.append(e - int(offsets[r]))
                    contents.append(piece)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(keys, pa.binary()), pa.array(starts, pa.int32()), pa.array(stops, pa.int32()), pa.array(contents, pa.binary())],
                                             names=["phrase", "key", "start", "stop", "content"])
    return run


def _fingerprints(content: bytes, length: int) -> np.ndarray:
    sums = prefix_sums(np.frombuffer(content, np.uint8))
    return _grams(sums, length)


_DEALT = "shard int, bucket int, phrase binary, twice boolean, content binary, prints binary"


def _rows(**columns: list) -> pa.RecordBatch:
    types = {"shard": pa.int32(), "bucket": pa.int32(), "phrase": pa.binary(), "twice": pa.bool_(), "content": pa.binary(), "prints": pa.binary()}
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in types.items()], names=list(types))


def _local(group: pa.Table, length: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Window fingerprints per phrase of a shard, and all of them that occur once or more often here."""
    prints = [_fingerprints(c, length) for c in group.column("content").to_pylist()]
    weight = np.repeat([2 if t else 1 for t in group.column("twice").to_pylist()], [len(p) for p in prints])
    values, place = np.unique(np.concatenate([np.zeros(0, np.uint64), *prints]), return_inverse=True)
    times = np.bincount(place, weights=weight, minlength=len(values))
    return prints, values[times < 2], values[times > 1]


def _dealt(length: int, buckets: int):
    def work(groups: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
        for group in groups:
            _, once, often = _local(group, length)
            shard = group.column("shard")[0].as_py()
            for twice, values in ((False, once), (True, often)):
                bucket = (values >> np.uint64(40)) % np.uint64(buckets)
                order = np.argsort(bucket, kind="stable")
                found, at = np.unique(bucket[order], return_index=True)
                parts = np.split(values[order], at[1:])
                if len(found):
                    yield _rows(shard=[shard] * len(found), bucket=found.astype(np.int64).tolist(), twice=[twice] * len(found), prints=[p.tobytes() for p in parts])
    return work


def _matched(groups: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
    """Per shard the fingerprints that are single there and stand in another shard too."""
    for group in groups:
        parts = [np.frombuffer(p, np.uint64) for p in group.column("prints").to_pylist()]
        values, place = np.unique(np.concatenate(parts), return_inverse=True)
        times = np.bincount(place, minlength=len(values))
        low = 0
        shards, out = [], []
        for part, shard, twice in zip(parts, group.column("shard").to_pylist(), group.column("twice").to_pylist(), strict=True):
            again = part[times[place[low:low + len(part)]] > 1]
            low += len(part)
            if not twice and len(again):
                shards.append(shard)
                out.append(again.tobytes())
        yield _rows(shard=shards, prints=out)


def _repeated(length: int):
    def work(groups: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
        for group in groups:
            is_phrase = group.column("phrase").is_valid()
            phrases = group.filter(is_phrase)
            answers = [np.frombuffer(p, np.uint64) for p in group.filter(pc.invert(is_phrase)).column("prints").to_pylist()]
            prints, _, often = _local(phrases, length)
            known = np.sort(np.concatenate([often, *answers]))
            names, firsts, lasts = [], [], []
            for name, values in zip(phrases.column("phrase").to_pylist(), prints, strict=True):
                place = np.minimum(np.searchsorted(known, values), len(known) - 1) if len(known) else None
                a, b = _runs(known[place] == values) if place is not None else ([], [])
                names += [name] * len(a)
                firsts += list(map(int, a))
                lasts += list(map(int, b))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(firsts, pa.int32()), pa.array(lasts, pa.int32())], names=["phrase", "first", "last"])
    return work


def _removed(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, gone, spans, hashes, cuts = [], [], [], [], []
            for text, whole, runs in zip(batch.column("text"), batch.column("whole").to_pylist(), batch.column("runs"), strict=True):
                data = text.as_buffer().to_pybytes() if text.is_valid else b""
                covered: list[tuple[int, int]] = [(0, len(data))] if whole and len(data) >= length else []
                if not covered and runs.is_valid:
                    flat = runs.values.flatten()
                    a, b = flat[0].to_numpy(), flat[1].to_numpy()
                    edge = np.zeros(len(data) + 1, np.int64)
                    np.add.at(edge, a, 1)
                    np.add.at(edge, b + length - 1, -1)
                    covered = [(int(s), int(e)) for s, e in zip(*_runs(np.cumsum(edge)[:-1] > 0), strict=True)]
                kept, done = hashlib.sha256(), 0
                for s, e in covered:
                    kept.update(data[done:s])
                    done = e
                kept.update(data[done:])
                sizes.append(len(data))
                gone.append(sum(e - s for s, e in covered))
                spans.append(len(covered))
                hashes.append(kept.hexdigest())
                cuts.append([{"start": s, "end": e} for s, e in covered])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (sizes, gone, spans)), pa.array(hashes, pa.string()),
                                              pa.array(cuts, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])
    return run


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = ANCHOR_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed (byte ranges).

    Removed are all bytes covered by a string of ``length`` bytes that also starts anywhere else in any text.  Null text is
    empty; texts shorter than ``length`` lose nothing; a text that stands there twice, repeated rows included, loses all.
    Equality is by 64-bit fingerprints of windows and 128-bit ones of phrases.  An empty table gives no rows.
    """
    if not TRIGGER_BYTES <= gram < length:
        raise ValueError("anchors must be shorter than the repeated string and not shorter than triggers")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumn("key", binary_key(F.coalesce("text", F.lit(""))))
    parsed = cut(texts.select("key", "text").mapInArrow(_anchors(length, gram), "key binary, anchors array<long>")
                 .groupBy("key").agg(F.first("anchors").alias("anchors"), F.count(F.lit(1)).alias("copies")))
    stands = parsed.select("key", F.explode("anchors").alias("anchor"))
    shared = cut(stands.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor"))
    bad = stands.join(shared, "anchor").groupBy("key").agg(F.collect_set("anchor").alias("bad"))
    # a text that stands there several times is parsed as often; equal places of it count once below
    phrases = cut(texts.select("key", "text").join(bad, "key").select("key", "text", "bad")
                  .mapInArrow(_phrases(length, gram), "phrase binary, key binary, start int, stop int, content binary"))
    place = F.struct("key", "start")
    dictionary = cut(phrases.groupBy("phrase").agg(F.first("content").alias("content"), (F.min(place) != F.max(place)).alias("twice")))
    held = dictionary.agg(F.sum(F.octet_length("content"))).first()[0] or 0
    shards = max(1, int(held // shard_bytes))
    entries = dictionary.select(F.pmod(F.xxhash64("phrase"), F.lit(shards)).cast("int").alias("shard"), F.lit(None).cast("int").alias("bucket"), "phrase", "twice", "content",
                                F.lit(None).cast("binary").alias("prints"))
    dealt = arrow_groups(entries, ["shard"], _dealt(length, shards), _DEALT)
    answers = arrow_groups(dealt, ["bucket"], _matched, _DEALT)
    runs = arrow_groups(entries.unionByName(answers), ["shard"], _repeated(length), "phrase binary, first int, last int")
    found = (phrases.select("phrase", "key", "start").join(runs, "phrase")
             .groupBy("key").agg(F.collect_set(F.struct((F.col("start") + F.col("first")).alias("a"), (F.col("start") + F.col("last")).alias("b"))).alias("runs")))
    marks = cut(parsed.select("key", (F.col("copies") > 1).alias("whole")).join(found, "key", "left").filter(F.col("whole") | F.col("runs").isNotNull()))
    return (texts.join(marks, "key", "left").select("doc_id", "text", F.coalesce("whole", F.lit(False)).alias("whole"), "runs")
            .mapInArrow(_removed(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<start:long,end:long>>"))
