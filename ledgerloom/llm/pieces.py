"""SentencePiece encoding and decoding by a relational lattice over distinct words.

Documents are packed in batches.  A batch keeps, per document, the numbers of its words, and its distinct words once.  A word
is a stretch without a place that no piece of the vocabulary crosses, so its pieces do not depend on what stands around it.  The
distinct words of all batches are exploded into their substrings, these are equi-joined to the piece table, the matching
edges are grouped by word again, and a Spark higher-order ``aggregate`` (or, for merges, an Arrow function) folds them into the word's pieces.  The pieces go
back to the batches, where the documents are put together.

The fold follows the kind of the vocabulary: for ``unigram`` it is Viterbi (the path with the largest sum of scores), for
``bpe`` the best-ranked adjacent pair is merged until none is left.  A sum of scores does not give the pieces that a BPE
vocabulary defines, so Viterbi alone would give other results than the published tokenizer.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.llm.common import binary_key, cut_by

MODEL = os.environ.get("LEDGERLOOM_PIECES", "/opt/tokenizers/piece_bpe_32k.model")
BATCH_BYTES = 16 << 20
SHARD_BYTES = 32 << 20
#: Buckets of a written table; Spark allows 100,000.
MAX_BUCKETS = 50_000
SPACE = "▁"
SLICE = 1 << 18
STRETCH = 256


@dataclass(frozen=True)
class Pieces:
    """A vocabulary: (piece, id, score) of ordinary pieces, ids of the 256 byte pieces (or the id of <unk> alone)."""
    rows: tuple[tuple[str, int, float], ...]
    byte_ids: tuple[int, ...]
    unknown: int
    texts: tuple[str, ...]
    kind: str

    @classmethod
    def load(cls, path: str, kind: str = "bpe") -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        byte = {model.id_to_piece(i): i for i in range(n) if model.is_byte(i)}
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        texts = {i: model.id_to_piece(i).encode().hex() for i in plain} | {i: p[3:5].lower() for p, i in byte.items()}
        return cls(tuple((model.id_to_piece(i), i, model.get_score(i)) for i in plain),
                   tuple(byte[f"<0x{b:02X}>"] for b in range(256)) if byte else (), model.unk_id(), tuple(texts.get(i, "") for i in range(n)), kind)

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(pa.table({"piece": pa.array([r[0] for r in self.rows]), "id": pa.array([r[1] for r in self.rows], pa.int32()),
                                               "score": pa.array([r[2] for r in self.rows], pa.float64())}))

    @property
    def joints(self) -> tuple[np.ndarray, np.ndarray]:
        """The place of each code point among those of longer pieces (the last place: all others), and which pairs of them
        stand side by side in a piece: a table of the square of the vocabulary's alphabet."""
        pairs = {r[0][i:i + 2] for r in self.rows for i in range(len(r[0]) - 1)}
        alphabet = sorted({ord(c) for pair in pairs for c in pair})
        lookup = np.full(0x110000, len(alphabet), np.int32)
        lookup[alphabet] = np.arange(len(alphabet))
        joined = np.zeros((len(alphabet) + 1, len(alphabet) + 1), bool)
        for a, b in pairs:
            joined[lookup[ord(a)], lookup[ord(b)]] = True
        return lookup, joined

    @property
    def longest(self) -> int:
        return max((len(r[0]) for r in self.rows), default=1)

    @property
    def bits(self) -> tuple[int, int]:
        """Bits for the length of a piece and for id + 1; beside them a long has room for any start in a string."""
        return self.longest.bit_length(), (max((r[1] for r in self.rows), default=0) + 1).bit_length()


def _packed(values: pa.Array) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([values], names=["v"])
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pa.Array:
    return pa.ipc.open_stream(data).read_next_batch().column(0)


def _units(text: str, joints: tuple[np.ndarray, np.ndarray]) -> pa.StringArray:
    """The text cut between characters that no piece holds side by side: no path of the lattice crosses such a place."""
    lookup, joined = joints
    starts, at, before = [], 0, len(joined) - 1
    for low in range(0, len(text), SLICE):
        code = np.frombuffer(text[low:low + SLICE].encode("utf-32-le"), np.uint32)
        index = lookup[code]
        opens = ~joined[np.concatenate([[before], index[:-1]]), index]
        width = 1 + (code > 0x7F) + (code > 0x7FF).astype(np.int64) + (code > 0xFFFF)
        place = at + np.cumsum(width) - width
        starts.append(place[opens])
        at, before = at + int(width.sum()), index[-1]
    offsets = np.concatenate([*starts, [at]]).astype(np.int32)
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(text.encode()))


def _pressed(numbers: np.ndarray) -> bytes:
    """Count and numbers, byte by byte in planes, as the high bytes of frequent words are zero."""
    return len(numbers).to_bytes(4, "little") + bytes(pa.compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), "zstd", asbytes=True))


def _unpressed(data: bytes | pa.Buffer) -> np.ndarray:
    data = memoryview(data)
    n = int.from_bytes(data[:4], "little")
    if not n:
        return np.zeros(0, np.uint32)
    planes = np.frombuffer(pa.decompress(pa.py_buffer(data[4:]), n * 4, "zstd", asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


_BATCHED = "batch string, shard int, doc_id long, text_md5 binary, payload binary"


#: In place of a shard: the row of a batch that tells the shard of each of its words.
DEALT = -1


def _batches(docs: DataFrame, shards: int, batch_bytes: int, joints: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Rows of three kinds: a document with its word numbers (shard null), the words of a batch that fall into a shard, and
    the shard of each word of a batch (shard ``DEALT``).  The words of a batch are numbered from the most frequent down."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId(), 0
        ids: list = []
        marks: list = []
        units: list = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            name = f"{part}-{count}"
            told = pa.chunked_array([u for u in units if u is not None], pa.string()).combine_chunks().dictionary_encode()
            found, words = told.indices.to_numpy(), told.dictionary
            order = np.argsort(-np.bincount(found, minlength=len(words)), kind="stable")
            place = np.empty(len(words), np.uint32)
            place[order] = np.arange(len(words), dtype=np.uint32)
            words, numbers = words.take(pa.array(order)), place[found]
            payload, at = [], 0
            for u in units:
                payload.append(None if u is None else _pressed(numbers[at:at + len(u)]))
                at += 0 if u is None else len(u)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(ids)), pa.nulls(len(ids), pa.int32()), pa.array(ids, pa.int64()), pa.array(marks, pa.binary()),
                                              pa.array(payload, pa.binary())], names=["batch", "shard", "doc_id", "text_md5", "payload"])
            shard = np.fromiter(map(crc32, words.cast(pa.binary()).to_pylist()), np.int64, len(words)) % shards
            order = np.argsort(shard, kind="stable")
            cuts, words = np.flatnonzero(np.diff(shard[order], prepend=-1)), words.take(pa.array(order))
            rows = [(DEALT, _pressed(shard))] + [(int(shard[order[a]]), _packed(words.slice(a, b - a))) for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(words)], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(rows)), pa.array([r[0] for r in rows], pa.int32()), pa.nulls(len(rows), pa.int64()),
                                              pa.nulls(len(rows), pa.binary()), pa.array([r[1] for r in rows], pa.binary())], names=["batch", "shard", "doc_id", "text_md5", "payload"])
            pa.default_memory_pool().release_unused()

        for batch in batches:
            for doc, mark, text in zip(batch.column("doc_id").to_pylist(), batch.column("text_md5").to_pylist(), batch.column("text"), strict=True):
                text = text.as_py()
                ids.append(doc)
                marks.append(mark)
                if text is None:
                    units.append(None)
                else:
                    units.append(_units(SPACE + text.replace(" ", SPACE), joints) if text else pa.array([], pa.string()))
                    held += len(text)
                if held >= batch_bytes:
                    yield from flush()
                    ids, marks, units, held, count = [], [], [], 0, count + 1
        if ids:
            yield from flush()

    return docs.mapInArrow(run, _BATCHED)


def _distinct(group: pa.Table) -> pa.Table:
    words = pc.unique(pa.chunked_array([_unpacked(payload.as_buffer()) for payload in group.column("payload")], pa.string()))
    return pa.table({"place": pa.array([group.column("place")[0].as_py()] * len(words), pa.string()), "word": words})


def _merged(n: int, found: memoryview, first: int, longest: int, rank: list[float | None]) -> list[int]:
    """Ends of the pieces of a word after merging the best-ranked adjacent pair again and again (the leftmost of equals).
    From ``first`` on, ``found`` holds ``longest`` numbers per start: id + 1 of the piece of each length, 0 where there is none."""
    def worth(start: int, end: int) -> float | None:
        return rank[found[first + start * longest + end - start - 1]] if end - start <= longest else None

    after, before, alive = list(range(1, n + 1)), list(range(-1, n)), [True] * n
    heap = [(r, i) for i in range(n - 1) if (r := worth(i, i + 2)) is not None]
    heapify(heap)
    while heap:
        r, i = heappop(heap)
        j = after[i] if alive[i] else n
        if j >= n or worth(i, after[j]) != r:
            continue
        alive[j] = False
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for k in (before[i], i):
            if k >= 0 and after[k] < n and (r := worth(k, after[after[k]])) is not None:
                heappush(heap, (r, k))
    out, i = [], 0
    while i < n:
        i = after[i]
        out.append(i)
    return out


def _merge_words(by: tuple[str, ...], vocabulary: Pieces):
    rank: list[float | None] = [None] * (max((r[1] for r in vocabulary.rows), default=0) + 2)
    for _, i, score in vocabulary.rows:
        rank[i + 1] = -score
    other, longest = vocabulary.byte_ids, vocabulary.longest
    size_bits, id_bits = vocabulary.bits

    def spell(words: list[str], edge: np.ndarray, counts: np.ndarray) -> pa.Array:
        values: list[int] = []
        ends = [0]
        n = np.fromiter(map(len, words), np.int64, len(words))
        firsts = (np.cumsum(n) - n) * longest
        table = np.zeros(int(n.sum()) * longest, np.int32)
        table[np.repeat(firsts, counts) + (edge >> size_bits + id_bits) * longest + (edge >> id_bits & (1 << size_bits) - 1) - 1] = edge & (1 << id_bits) - 1
        found = memoryview(table)
        for word, first in zip(words, firsts.tolist(), strict=True):
            start = 0
            for end in _merged(len(word), found, first, longest, rank):
                i = found[first + start * longest + end - start - 1] - 1
                values += [i] if i >= 0 else [other[b] for b in word[start:end].encode()] if other else [vocabulary.unknown]
                start = end
            ends.append(len(values))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the edges of a word arrive one after the other; the last word of a batch may go on in the next ones
        held: list[pa.RecordBatch] = []
        for batch in chain(batches, [None]):
            if batch is not None:
                held.append(batch)
                if not batch.num_rows or held[0].num_rows and held[0].column("number")[0] == batch.column("number")[-1]:
                    continue
            if not any(b.num_rows for b in held):
                continue
            table = pa.Table.from_batches(held)
            number, edge = table.column("number").to_numpy(), table.column("edge").to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))
            held = []
            if batch is not None:
                held, table = table.slice(int(starts[-1])).to_batches(), table.slice(0, int(starts[-1]))
                edge, starts = edge[:starts[-1]], starts[:-1]
            if len(starts):
                first = table.take(pa.array(starts)).combine_chunks()
                counts = np.diff(np.append(starts, len(edge)))
                yield pa.RecordBatch.from_arrays([*(first.column(c).combine_chunks() for c in by), spell(first.column("word").to_pylist(), edge, counts)], names=[*by, "ids"])
    return run


def _viterbi_fold(edges: Column, n: Column) -> Column:
    """Boundaries of the path with the largest sum of scores; of equal paths the one whose last piece is longest."""
    start = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("back")))

    def step(best: Column, p: Column) -> Column:
        ending = F.filter(edges, lambda e: e["end"] == p)
        return F.concat(best, F.array(F.array_max(F.transform(ending, lambda e: F.struct(
            (best[e["start"]]["score"] - e["rank"]).alias("score"), (-e["start"]).alias("back"))))))
    table = F.aggregate(F.sequence(F.lit(1), n), start, step)
    return F.aggregate(F.sequence(F.lit(1), n), F.array(n), lambda path, _: F.when(path[0] > 0, F.concat(F.array(-table[path[0]]["back"]), path)).otherwise(path))


def encode_words(words: DataFrame, vocabulary: Pieces, by: tuple[str, ...] = ("word",)) -> DataFrame:
    """Add ``ids`` to distinct non-empty words.  ``by`` names the grouping columns; they must hold ``word``.

    Substrings are as long as the longest piece at most; the piece table is a vocabulary (some 10,000 rows), so it is
    broadcast.  A character without a piece takes its byte pieces, or <unk> where the vocabulary has none.
    """
    spark, longest = words.sparkSession, vocabulary.longest
    numbered = words.select(*by, F.monotonically_increasing_id().alias("number"))
    # a substring is found by counting from the start, so long words are read by stretches, with as much as a piece may reach beyond
    reading = F.lit(f"(?s)(?=(.{{1,{STRETCH + longest - 1}}})).{{1,{STRETCH}}}")
    stretches = numbered.select(*by, "number", F.posexplode(F.when(F.length("word") <= STRETCH, F.array("word")).otherwise(F.regexp_extract_all("word", reading, F.lit(1)))).alias("nth", "part"))
    starts = stretches.select(*by, "number", "nth", "part", F.explode(F.sequence(F.lit(0), F.least(F.lit(STRETCH), F.length("part")) - 1)).alias("at"))
    cells = (starts.select(*by, "number", "nth", "part", "at", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.length("part") - F.col("at")))).alias("size"))
             .select(*by, "number", (F.col("nth") * STRETCH + F.col("at")).alias("start"), (F.col("nth") * STRETCH + F.col("at") + F.col("size")).alias("end"),
                     F.substring(F.col("part"), F.col("at") + 1, F.col("size")).alias("piece")))
    table = F.broadcast(vocabulary.table(spark))
    # single characters stay in the lattice with or without a piece
    edges = cells.join(table, "piece", "left").filter("id is not null or end = start + 1")
    if vocabulary.kind == "bpe":
        # one long per edge: start, length, id + 1 (0 where there is no piece); a word's edges stay together, as nothing was shuffled
        size_bits, id_bits = vocabulary.bits
        packed = (F.shiftleft(F.col("start").cast("long"), size_bits + id_bits) + F.shiftleft((F.col("end") - F.col("start")).cast("long"), id_bits)
                  + F.coalesce(F.col("id") + 1, F.lit(0))).alias("edge")
        types = dict(words.dtypes)
        # the first edge of a word carries it, the others need not
        led = [F.when((F.col("start") == 0) & (F.col("end") == 1), F.col(c)).alias(c) for c in by]
        return edges.select(*led, "number", packed).mapInArrow(_merge_words(by, vocabulary), ", ".join(f"{c} {types[c]}" for c in by) + ", ids array<int>")
    lattice = edges.groupBy(*by).agg(F.collect_list(F.struct((-F.coalesce("score", F.lit(-1e9))).alias("rank"), "start", "end", "id")).alias("edges"))
    n = F.length("word")
    bounds = _viterbi_fold(F.col("edges"), n)
    folded = lattice.select(*by, "edges", bounds.alias("bounds"))

    def spell(i: Column) -> Column:
        low, high = F.col("bounds")[i], F.col("bounds")[i + 1]
        edge = F.filter("edges", lambda e: (e["start"] == low) & (e["end"] == high))[0]
        raw = F.hex(F.encode(F.substring(F.col("word"), low + 1, high - low), "UTF-8"))
        if vocabulary.byte_ids:
            bytes_ = F.array(*(F.lit(b) for b in vocabulary.byte_ids))
            other = F.transform(F.sequence(F.lit(0), (F.length(raw) / 2 - 1).cast("int")),
                                lambda j: bytes_[F.conv(F.substring(raw, j * 2 + 1, F.lit(2)), 16, 10).cast("int")])
        else:
            other = F.array(F.lit(vocabulary.unknown))
        return F.when(edge["id"].isNull(), other).otherwise(F.array(edge["id"]))
    return folded.select(*by, F.flatten(F.transform(F.sequence(F.lit(0), F.size("bounds") - 2), spell)).alias("ids"))


def _answered(asked: pa.Table, known: pa.Table) -> pa.Table:
    """For each batch of a shard the pieces of its words, in its own order."""
    words, ids = known.column("word").combine_chunks(), known.column("ids").combine_chunks()
    told = [_packed(ids.take(pc.index_in(_unpacked(payload.as_buffer()), value_set=words))) for payload in asked.column("payload")]
    return pa.table({"batch": asked.column("batch"), "shard": asked.column("shard"), "payload": pa.array(told, pa.binary())})


def _assembled(packed: pa.Table, answers: pa.Table) -> pa.Table:
    """The documents of a batch from their word numbers and the pieces of its words."""
    is_doc = pc.is_null(packed.column("shard"))
    docs, dealt = packed.filter(is_doc), packed.filter(pc.invert(is_doc)).column("payload")
    spelled = [_unpacked(p.as_buffer()) for p in answers.sort_by("shard").column("payload")]
    values = np.concatenate([np.zeros(0, np.int32), *(s.flatten().to_numpy() for s in spelled)])
    lengths = np.concatenate([np.zeros(0, np.int64), *(np.diff(s.offsets.to_numpy()) for s in spelled)]).astype(np.int64)
    # answers lie by shard and, within it, by number
    order = np.argsort(_unpressed(dealt[0].as_py()), kind="stable")
    length, begin = np.empty_like(lengths), np.empty_like(lengths)
    length[order], begin[order] = lengths, np.cumsum(lengths) - lengths
    out = []
    for payload in docs.column("payload"):
        if not payload.is_valid:
            out.append(pa.nulls(1, pa.list_(pa.int32())))
            continue
        at = _unpressed(payload.as_buffer())
        size = length[at]
        ends = np.cumsum(size)
        ids = values[np.repeat(begin[at] - (ends - size), size) + np.arange(int(size.sum()))]
        out.append(pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(ids)))
    return pa.table({"doc_id": docs.column("doc_id"), "text_md5": docs.column("text_md5"), "ids": pa.chunked_array(out, pa.list_(pa.int32()))})


def encode(docs: DataFrame, vocabulary: Pieces, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = BATCH_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per document: doc_id, text_md5, ids (the pieces of the whole text).

    Null text gives null, empty text an empty array.  Spaces are written as U+2581 and one is put in front, other white
    space is kept; every repeated row is encoded.  An empty table gives no rows.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), binary_key(F.col(text_col)).alias("text_md5"))
    held = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, int(held // shard_bytes))
    buckets = max(1, min(MAX_BUCKETS, int(held // (4 * batch_bytes))))
    # one table holds both: documents by their batch, words by their shard; each is grouped where it lies
    place = F.when(F.col("shard") > DEALT, F.concat(F.lit("s"), "shard")).otherwise(F.col("batch"))
    packed = cut_by(_batches(texts, shards, batch_bytes, vocabulary.joints).withColumn("place", place), "place", buckets)
    asked = packed.filter(F.col("shard") > DEALT)
    words = asked.select("place", "payload").groupBy("place").applyInArrow(_distinct, "place string, word string").repartition(min(shards, MAX_BUCKETS), "place")
    known = cut_by(encode_words(words, vocabulary, ("place", "word")), "place", buckets)
    answers = asked.select("place", "batch", "shard", "payload").groupBy("place").cogroup(known.groupBy("place")).applyInArrow(
        _answered, "batch string, shard int, payload binary")
    mine = packed.filter(F.col("shard").isNull() | (F.col("shard") == DEALT))
    return mine.groupBy("place").cogroup(answers.groupBy(F.col("batch").alias("place"))).applyInArrow(_assembled, "doc_id long, text_md5 binary, ids array<int>")


def decode(ids: Column, vocabulary: Pieces) -> Column:
    """The text of an array of ids, as one expression; null for null.  Byte pieces are put together as UTF-8."""
    table = F.array(*(F.lit(t) for t in vocabulary.texts)) if len(vocabulary.texts) < 64 else F.split(F.lit(",".join(vocabulary.texts)), ",")
    text = F.decode(F.unhex(F.array_join(F.transform(ids, lambda i: table[i]), "")), "UTF-8")
    spaced = F.replace(text, F.lit(SPACE), F.lit(" "))
    return F.when(F.startswith(spaced, F.lit(" ")), F.substring(spaced, 2, 2_147_483_647)).otherwise(spaced)
