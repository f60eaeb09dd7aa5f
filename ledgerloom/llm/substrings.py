"""Removal of repeated word strings by prefix-partitioned suffix trees.

Every window of ``length`` words holds an anchor, the smallest of its word grams, which depends on the window's words only.
Of all suffixes of the corpus only those that start at an anchor are needed (a sparse suffix tree), each with the words to
its left that windows around the anchor reach.

1. Anchors are counted.  A suffix whose gram stands in one place cannot be repeated and is dropped before any text moves.
2. A gram is the prefix by which suffixes are split.  Grams are dealt into groups of a bounded number of suffixes.
3. In a group the suffixes are sorted by their words; neighbours' common lengths give the nodes of the subtrees.  A window that
   starts ``o`` words before the anchor is repeated if another leaf of its node of depth ``length - o`` has the same ``o``
   words to the left.  Words are compared as they are, not by hashes.
4. A prefix that too many suffixes share is lengthened to all words of the window: its windows are told apart by 128-bit
   digests, counted before the shuffle, so that no group grows with the corpus.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import arrow_groups, binary_key, text_slices, windows, word_bounds, word_hashes
from ledgerloom.session import cut

LENGTH = 35
GRAM = 14
#: Suffixes of a group, about; a prefix that a quarter as many share is lengthened.
GROUP = 16_000

#: Suffixes at frequent prefixes that follow each other and are looked up together, about.
STRETCH = 4
#: Suffixes at one frequent prefix that ask for their windows in one row, at most.
PACK = 64
#: Places of one window that are held together in one row, at most.
PLACES = 1024

_FREQUENT = "array<struct<anchor:bigint,start:int,digests:array<binary>>>"
_SUFFIXES = f"num long, anchor long, start int, at int, n int, content binary, stretch binary, frequent {_FREQUENT}"


def _window_anchors(hashes: np.ndarray, rows: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words of the windows that lie within their text, their anchors' places, and the hashes of all grams."""
    grams = windows(hashes, gram)
    width = length - gram + 1
    if len(grams) < width:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), grams
    low = np.uint64(0xFFFFFFFF)
    # the leftmost of the smallest, by the upper half of the hash
    ranked = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    place = (np.lib.stride_tricks.sliding_window_view(ranked, width).min(axis=1) & low).astype(np.int64)
    ends = np.repeat(rows[1:], np.diff(rows))[:len(place)]
    first = np.flatnonzero(np.arange(len(place)) + length <= ends)
    return first, place[first], grams


def _anchors(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column("text")):
                hashes, rows = word_hashes(data, offsets)
                _, place, grams = _window_anchors(hashes, rows, length, gram)
                at = np.unique(place)
                ends = np.searchsorted(at, rows).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(grams[at].view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("key")[low:high], batch.column("doc_id")[low:high], lists], names=["key", "doc_id", "anchors"])
    return run


def _suffixes(length: int, gram: int):
    """The suffixes at shared anchors, one row each, with the words of their windows; of those at frequent anchors a few that follow each
    other make a row, with a digest of all and one per window."""
    def of_text(num: int, known: np.ndarray, often: np.ndarray, hashes: np.ndarray, rows: np.ndarray, words: list[bytes]) -> Iterator[tuple]:
        first, place, grams = _window_anchors(hashes, rows, length, gram)
        mine = grams[place].view(np.int64)
        slot = np.minimum(np.searchsorted(known, mine), len(known) - 1)
        held = np.flatnonzero(known[slot] == mine)
        if not len(held):
            return
        first, place, mine, hot = first[held], place[held], mine[held], often[slot[held]]
        begin = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        stretch: list[dict] = []
        for i, j in zip(begin.tolist(), [*begin[1:].tolist(), len(place)], strict=True):
            start, n, anchor = int(first[i]), j - i, int(mine[i])
            if stretch and (not hot[i] or start != stretch[-1]["start"] + len(stretch[-1]["digests"]) or anchor % STRETCH == 0):
                yield frequent(num, stretch, words)
                stretch = []
            if hot[i]:
                digests = [hashlib.blake2b(b" ".join(words[s:s + length]), digest_size=16).digest() for s in range(start, start + n)]
                stretch.append({"anchor": anchor, "start": start, "digests": digests})
            else:
                yield num, anchor, start, int(place[i]) - start, n, b" ".join(words[start:start + n + length - 1]), None, None
        if stretch:
            yield frequent(num, stretch, words)

    def frequent(num: int, stretch: list[dict], words: list[bytes]) -> tuple:
        low, last = stretch[0]["start"], stretch[-1]
        whole = b" ".join(words[low:last["start"] + len(last["digests"]) + length - 1])
        return num, None, low, None, last["start"] + len(last["digests"]) - low, None, hashlib.blake2b(whole, digest_size=16).digest(), stretch

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("num", pa.int64()), ("anchor", pa.int64()), ("start", pa.int32()), ("at", pa.int32()), ("n", pa.int32()), ("content", pa.binary()),
                            ("stretch", pa.binary()), ("frequent", pa.list_(pa.struct([("anchor", pa.int64()), ("start", pa.int32()), ("digests", pa.list_(pa.binary()))])))])
        for batch in batches:
            numbers, shared = batch.column("num").to_pylist(), batch.column("shared")
            for low, high, data, offsets in text_slices(batch.column("text")):
                hashes, rows = word_hashes(data, offsets)
                starts, ends, _ = word_bounds(data, offsets)
                content, out = data.tobytes(), []
                for i in range(low, high):
                    a, b = rows[i - low], rows[i - low + 1]
                    known = shared[i].values
                    order = np.argsort(anchors := known.field("anchor").to_numpy())
                    often = known.field("often").to_numpy(zero_copy_only=False)
                    words = [content[s:e] for s, e in zip(starts[a:b].tolist(), ends[a:b].tolist(), strict=True)]
                    out += of_text(numbers[i], anchors[order], often[order], hashes[a:b], np.array([0, b - a]), words)
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
    return run


def _order(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lexicographic order of the rows, and the number of words that each of it has in common with the one before."""
    order = np.lexsort(words.T[::-1])
    same = words[order][1:] == words[order][:-1]
    return order, np.where(same.all(axis=1), words.shape[1], same.argmin(axis=1))


def _classes(order: np.ndarray, common: np.ndarray, depth: int) -> np.ndarray:
    """Per row its node of that depth: rows that agree in so many words."""
    out = np.zeros(len(order), np.int64)
    out[order[1:]] = np.cumsum(common < depth)
    return out


def repeated_windows(contents: list[bytes], at: np.ndarray, n: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Which windows of which suffix stand at several suffixes: a matrix, a column per window from the suffix's first.

    Row ``i`` has ``n[i]`` windows in ``contents[i]``, whose anchor is the word ``at[i]``.
    """
    count, width = len(contents), length - gram + 1
    right, left = np.zeros((count, length), np.uint32), np.zeros((count, width - 1), np.uint32)
    ids: dict[bytes, int] = {}
    for i, (content, k) in enumerate(zip(contents, at.tolist(), strict=True)):
        words = [ids.setdefault(w, len(ids) + 1) for w in content.split(b" ")]
        after, before = words[k:k + length], words[:k][::-1]
        right[i, :len(after)] = after
        left[i, :len(before)] = before
    suffixes, contexts = _order(right), _order(left)
    out = np.zeros((count, width), bool)
    for o in range(width):
        column = at - o
        rows = np.flatnonzero((column >= 0) & (column < n))
        if len(rows) > 1:
            node = _classes(*suffixes, length - o)[rows] * count + _classes(*contexts, o)[rows]
            _, place, times = np.unique(node, return_inverse=True, return_counts=True)
            rows = rows[times[place] > 1]
            out[rows, column[rows]] = True
    return out


def _trees(length: int, gram: int):
    def work(groups: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
        for group in groups:
            num, start, at, n = (group.column(c).to_numpy() for c in ("num", "start", "at", "n"))
            order = np.lexsort((start, num))
            # a text may have been read twice (repeated rows); a place counts once
            fresh = np.ones(len(order), bool)
            fresh[1:] = (num[order][1:] != num[order][:-1]) | (start[order][1:] != start[order][:-1])
            keep = np.sort(order[fresh])
            contents = group.column("content").take(pa.array(keep)).to_pylist()
            found = repeated_windows(contents, at[keep].astype(np.int64), n[keep].astype(np.int64), length, gram)
            edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
            row, first = np.nonzero(edge == 1)
            last = np.nonzero(edge == -1)[1]
            begin = start[keep][row].astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(num[keep][row]), pa.array((begin + first).astype(np.int32)), pa.array((begin + last).astype(np.int32))], names=["num", "first", "last"])
    return work


def _removed(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, gone, hashes, cuts = [], [], [], []
            for text, whole, runs in zip(batch.column("text"), batch.column("whole").to_pylist(), batch.column("runs"), strict=True):
                words = text.as_buffer().to_pybytes().split() if text.is_valid else []
                edge = np.zeros(len(words) + 1, np.int64)
                if whole and len(words) >= length:
                    edge[0] = 1
                elif runs.is_valid:
                    np.add.at(edge, runs.values.field("first").to_numpy(), 1)
                    np.add.at(edge, runs.values.field("last").to_numpy() + length - 1, -1)
                step = np.diff(np.concatenate([[0], np.cumsum(edge)[:-1] > 0, [0]]).astype(np.int8))
                spans = list(zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist(), strict=True))
                kept, done = [], 0
                for s, e in spans:
                    kept += words[done:s]
                    done = e
                kept += words[done:]
                sizes.append(len(words))
                gone.append(len(words) - len(kept))
                hashes.append(hashlib.sha256(b" ".join(kept)).hexdigest())
                cuts.append([{"start": s, "end": e} for s, e in spans])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(hashes, pa.string()),
                                              pa.array(cuts, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                                             names=["doc_id", "n_words", "n_removed", "kept_sha256", "removed"])
    return run


def _packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The suffixes of a batch's stretches by anchor, at most ``PACK`` in a row."""
    for batch in batches:
        stretches = batch.column("frequent")
        flat, num = pc.list_flatten(stretches), batch.column("num").take(pc.list_parent_indices(stretches))
        anchor = flat.field("anchor").to_numpy()
        order = np.argsort(anchor, kind="stable")
        anchor = anchor[order]
        begin = np.flatnonzero(np.concatenate([np.ones(min(1, len(anchor)), bool), anchor[1:] != anchor[:-1]]))
        at = np.arange(len(anchor)) - np.repeat(begin, np.diff(np.append(begin, len(anchor))))
        first = np.flatnonzero(at % PACK == 0)
        take = pa.array(order)
        asks = pa.StructArray.from_arrays([num.take(take), flat.field("start").take(take), flat.field("digests").take(take)], names=["num", "start", "digests"])
        yield pa.RecordBatch.from_arrays([pa.array(anchor[first], pa.int64()), pa.ListArray.from_arrays(pa.array(np.append(first, len(anchor)), pa.int32()), asks)], names=["anchor", "asks"])


_PLACES = "anchor long, digest binary, places array<struct<num:bigint,start:int>>"


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different windows of a batch's packs, each with the places where it stands, at most ``PLACES`` in a row."""
    for batch in batches:
        asks = batch.column("asks")
        flat, anchor = pc.list_flatten(asks), batch.column("anchor").take(pc.list_parent_indices(asks)).to_numpy()
        suffix, digests = pc.list_parent_indices(flat.field("digests")).to_numpy(), pc.list_flatten(flat.field("digests"))
        halves = np.frombuffer(b"".join(digests.to_pylist()), np.uint64).reshape(-1, 2)
        start = flat.field("start").to_numpy()[suffix] + np.arange(len(suffix)) - np.searchsorted(suffix, suffix)
        keys = (halves[:, 0], halves[:, 1], anchor[suffix])
        order = np.lexsort(keys)
        fresh = np.ones(len(order), bool)
        fresh[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
        begin = np.flatnonzero(fresh)
        at = np.arange(len(order)) - np.repeat(begin, np.diff(np.append(begin, len(order))))
        first = np.flatnonzero(at % PLACES == 0)
        places = pa.StructArray.from_arrays([flat.field("num").take(pa.array(suffix[order])), pa.array(start[order], pa.int32())], names=["num", "start"])
        yield pa.RecordBatch.from_arrays([pa.array(anchor[suffix][order[first]], pa.int64()), digests.take(pa.array(order[first])),
                                          pa.ListArray.from_arrays(pa.array(np.append(first, len(order)), pa.int32()), places)], names=["anchor", "digest", "places"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The places of a batch as runs of windows that follow each other, one row per text."""
    for batch in batches:
        flat = pc.list_flatten(batch.column("places"))
        num, start = flat.field("num").to_numpy(), flat.field("start").to_numpy()
        order = np.lexsort((start, num))
        num, start = num[order], start[order]
        other = np.ones(len(num), bool)
        other[1:] = num[1:] != num[:-1]
        gap = other.copy()
        gap[1:] |= start[1:] != start[:-1] + 1
        begin = np.flatnonzero(gap)
        runs = pa.StructArray.from_arrays([pa.array(start[begin], pa.int32()), pa.array(start[np.append(begin[1:], len(num)) - 1] + 1, pa.int32())] if len(num) else
                                          [pa.array([], pa.int32())] * 2, names=["first", "last"])
        ends = np.append(np.flatnonzero(other[begin]), len(begin))
        yield pa.RecordBatch.from_arrays([pa.array(num[other], pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), runs)], names=["num", "runs"])


def _of_frequent(stretches: DataFrame) -> DataFrame:
    """num, runs: the repeated windows at frequent anchors, told apart by digests.

    A stretch that stands in several places is repeated as a whole.  The others are looked up by window: each batch has one row
    for a window, however often it stands there, with its places; their numbers are added up, and the places of the windows that
    stand in several come back as runs, one row per text and batch.  So the rows are at most the different windows of the batches.
    """
    place = F.struct("num", "start")
    different = cut(stretches.groupBy("stretch").agg(F.first("frequent").alias("frequent"), F.min(place).alias("place"), (F.min(place) != F.max(place)).alias("several")))
    # one function and so one Python worker a task; the places lie written before others read them
    windows = lambda df: df.select("place.num", "frequent").mapInArrow(lambda batches: _places(_packs(batches)), _PLACES)
    mine = windows(different.filter("not several"))
    times = mine.select("anchor", "digest", F.size("places").alias("n")).unionByName(windows(different.filter("several")).select("anchor", "digest", F.lit(2).alias("n")))
    again = cut(times.groupBy("anchor", "digest").agg(F.sum("n").alias("n")).filter("n > 1").select("anchor", "digest"))
    single = cut(mine.join(again, ["anchor", "digest"]).select("places")).mapInArrow(_runs, "num long, runs array<struct<first:int,last:int>>")
    whole = stretches.join(different.filter("several").select("stretch"), "stretch").select(
        "num", F.array(F.struct(F.col("start").alias("first"), (F.col("start") + F.col("n")).alias("last"))).alias("runs"))
    return whole.unionByName(single)


def repeated_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256, removed (ranges of words).

    Removed is each word covered by a window of ``length`` words whose sequence also starts anywhere else in any text.  Words
    are what spaces, tabs, line feeds, vertical tabs, form feeds and carriage returns separate; kept words are joined by one
    space.  Null text has no words; texts of fewer than ``length`` words lose nothing; a longer text that stands there twice,
    repeated rows included, loses all (texts are the same by 128-bit key).  Texts may have any length.  An empty table gives no rows.
    """
    if not 1 <= gram < length:
        raise ValueError("an anchor must be shorter than the repeated string")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("key", binary_key(F.coalesce("text", F.lit(""))))
    parsed = cut(texts.mapInArrow(_anchors(length, gram), "key binary, doc_id long, anchors array<long>").groupBy("key").agg(
        F.first("anchors").alias("anchors"), F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("read")).withColumn("num", F.monotonically_increasing_id()))
    stands = parsed.select("num", F.explode("anchors").alias("anchor"))
    shared = cut(stands.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor", "n", (F.col("n") > group // 4).alias("often")))
    groups = max(1, -(-(shared.filter("not often").agg(F.sum("n")).first()[0] or 0) // group))
    wanted = (stands.join(shared, "anchor").groupBy("num").agg(F.collect_set(F.struct("anchor", "often")).alias("shared"))
              .join(parsed.select("num", "key", "read"), "num").select("num", "key", "read", "shared"))
    # of the copies of a text one is read; the others lose all their words
    found = cut(texts.join(wanted, (texts["key"] == wanted["key"]) & texts["doc_id"].eqNullSafe(wanted["read"])).select("num", "text", "shared")
                .mapInArrow(_suffixes(length, gram), _SUFFIXES))
    suffixes = found.filter("stretch is null").select(F.pmod(F.xxhash64("anchor"), F.lit(groups)).cast("int").alias("group"), "num", "start", "at", "n", "content")
    trees = arrow_groups(suffixes, ["group"], _trees(length, gram), "num long, first int, last int").select("num", F.array(F.struct("first", "last")).alias("runs"))
    often = _of_frequent(found.filter("stretch is not null").select("num", "start", "n", "stretch", "frequent"))
    runs = trees.unionByName(often).groupBy("num").agg(F.flatten(F.collect_list("runs")).alias("runs"))
    marks = cut(parsed.select("num", "key", (F.col("copies") > 1).alias("whole")).join(runs, "num", "left").filter(F.col("whole") | F.col("runs").isNotNull()).drop("num"))
    return (texts.join(marks, "key", "left").select("doc_id", "text", F.coalesce("whole", F.lit(False)).alias("whole"), "runs")
            .mapInArrow(_removed(length), "doc_id long, n_words long, n_removed long, kept_sha256 string, removed array<struct<start:long,end:long>>"))
