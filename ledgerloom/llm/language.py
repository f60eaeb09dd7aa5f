"""Language identification: script ranges narrow the candidates, then Viterbi over per-word scores labels spans.

A language is a multinomial over hashed letter trigrams (word ends are marked), counted over all training documents.  A word
is a run of letters of one script; its candidates are the languages that use this script.  Viterbi with a penalty for each
switch labels the words of a text, so that a text of several languages falls into spans.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

BITS = 17
SMOOTHING = 0.5
SWITCH = 12.0
#: A script counts for a language if it holds this share of the language's letters.
SCRIPT_SHARE = 0.01
#: Letters are held for slices of this many bytes, scores of words for rounds of this many (or for one longer text).
SLICE_BYTES = 1 << 18
ROUND_BYTES = 4 << 20
UNKNOWN = "und"

#: First code point of ranges of scripts; letters outside belong to script 1 (Latin and others).
SCRIPT_RANGES = (
    (0x0370, 0x03FF, 2), (0x1F00, 0x1FFF, 2),  # Greek
    (0x0400, 0x052F, 3), (0x1C80, 0x1C8F, 3), (0x2DE0, 0x2DFF, 3), (0xA640, 0xA69F, 3),  # Cyrillic
    (0x0530, 0x058F, 4),  # Armenian
    (0x0590, 0x05FF, 5), (0xFB1D, 0xFB4F, 5),  # Hebrew
    (0x0600, 0x06FF, 6), (0x0750, 0x077F, 6), (0x08A0, 0x08FF, 6), (0xFB50, 0xFDFF, 6), (0xFE70, 0xFEFF, 6),  # Arabic
    (0x0900, 0x097F, 7),  # Devanagari
    (0x0980, 0x09FF, 8),  # Bengali
    (0x0A00, 0x0A7F, 9),  # Gurmukhi
    (0x0A80, 0x0AFF, 10),  # Gujarati
    (0x0B80, 0x0BFF, 11),  # Tamil
    (0x0C00, 0x0C7F, 12),  # Telugu
    (0x0C80, 0x0CFF, 13),  # Kannada
    (0x0D00, 0x0D7F, 14),  # Malayalam
    (0x0E00, 0x0E7F, 15),  # Thai
    (0x10A0, 0x10FF, 16),  # Georgian
    (0x1100, 0x11FF, 17), (0x3130, 0x318F, 17), (0xAC00, 0xD7AF, 17),  # Hangul
    (0x3040, 0x30FF, 18),  # Hiragana, Katakana
    (0x3400, 0x4DBF, 19), (0x4E00, 0x9FFF, 19), (0xF900, 0xFAFF, 19), (0x20000, 0x3134F, 19),  # Han
)
SCRIPTS = 20


@cache
def script_table() -> np.ndarray:
    """Script of every code point; 0 where it is no letter."""
    table = np.fromiter((chr(c).isalpha() for c in range(0x110000)), np.uint8, 0x110000)
    for low, high, script in SCRIPT_RANGES:
        table[low:high + 1] *= script
    return table


@dataclass(frozen=True)
class LanguageModel:
    """Learned languages in order, log probabilities (language, bucket), and which language uses which script."""
    names: tuple[str, ...]
    scores: np.ndarray
    uses: np.ndarray
    prior: np.ndarray


def _slices(column: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """First and end row of consecutive slices; one exceeds ``limit`` bytes only for one longer text."""
    ends = np.cumsum(pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + limit, "right")))
        yield low, high
        low = high


def _letters(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per slice of rows: first row, end row, trigram bucket and script of every letter, first letter of each word, words
    before each row (one more than rows), and place of each letter in its row."""
    for low, high in _slices(column, SLICE_BYTES):
        part = pc.utf8_lower(column[low:high].fill_null(""))
        at = np.concatenate([[0], np.cumsum(pc.utf8_length(part).to_numpy(zero_copy_only=False).astype(np.int64))])
        code = np.frombuffer("".join(part.to_pylist()).encode("utf-32-le"), np.uint32)
        script = script_table()[code]
        letter = np.flatnonzero(script)
        kind, code = script[letter], code[letter].astype(np.uint64)
        row = np.searchsorted(at, letter, "right") - 1
        new = np.ones(len(letter) + 1, bool)
        if len(letter) > 1:
            new[1:-1] = (np.diff(letter) != 1) | (kind[1:] != kind[:-1]) | (row[1:] != row[:-1])
        before = np.where(new[:-1], np.uint64(0), np.concatenate([[np.uint64(0)], code[:-1]])) if len(letter) else code
        after = np.where(new[1:], np.uint64(0), np.concatenate([code[1:], [np.uint64(0)]])) if len(letter) else code
        mixed = (before * np.uint64(0x9E3779B97F4A7C15) + code * np.uint64(0xC2B2AE3D27D4EB4F) + after * np.uint64(0x165667B19E3779F9)) * np.uint64(0xD6E8FEB86659FD93)
        starts = np.flatnonzero(new[:-1])
        yield low, high, (mixed >> np.uint64(64 - BITS)).astype(np.int64), kind, starts, np.searchsorted(row[starts], np.arange(high - low + 1)), letter - at[row]


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Counts over all labelled documents that are not held out.

    A task sends one count per language and bucket, so what reaches the driver is at most (languages * 2**BITS) rows whatever
    the number of documents.  Null labels and null identifiers do not take part.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            for low, high, bucket, script, starts, words, _ in _letters(batch.column("text")):
                ends = np.concatenate([starts, [len(bucket)]])[words]
                for lang in set(langs[low:high]):
                    rows = np.flatnonzero(langs[low:high] == lang)
                    take = np.concatenate([np.arange(ends[r], ends[r + 1]) for r in rows])
                    held = found.setdefault(lang, np.zeros((1 << BITS) + SCRIPTS + 1, np.int64))
                    held[:1 << BITS] += np.bincount(bucket[take], minlength=1 << BITS)
                    held[1 << BITS:-1] += np.bincount(script[take], minlength=SCRIPTS)
                    held[-1] += len(rows)
        for lang, counts in found.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(counts[at])], names=["lang", "bucket", "n"])

    taught = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
              .filter(F.col("lang").isNotNull() & F.col("_id").isNotNull() & ~is_held_out(F.col("_id"))).select("text", "lang"))
    sums = taught.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    names = tuple(sorted(sums["lang"].unique()))
    table = np.zeros((len(names), (1 << BITS) + SCRIPTS + 1))
    table[np.searchsorted(names, sums["lang"]) if names else [], sums["bucket"].to_numpy(np.int64)] = sums["n"]
    grams, scripts = table[:, :1 << BITS], table[:, 1 << BITS:-1]
    total = grams.sum(axis=1, keepdims=True)
    scores = np.log((grams + SMOOTHING) / (total + SMOOTHING * (1 << BITS))).astype(np.float32)
    return LanguageModel(names, scores, scripts >= SCRIPT_SHARE * np.maximum(1, scripts.sum(axis=1, keepdims=True)), table[:, -1])


def viterbi(emission: np.ndarray, rows: np.ndarray, switch: float) -> np.ndarray:
    """Label of every word; ``rows`` are the words before each text.  All texts go forward together, word by word."""
    n_words = np.diff(rows)
    order = np.argsort(-n_words, kind="stable")
    starts, length = rows[:-1][order], n_words[order]
    steps = int(length[0]) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(1, steps + 1), "right")
    back = np.zeros(emission.shape, np.uint8 if emission.shape[1] < 256 else np.uint16)
    own = np.arange(emission.shape[1], dtype=back.dtype)
    value = np.zeros((len(order), emission.shape[1]))
    for t in range(steps):
        a = active[t]
        v, at = value[:a], starts[:a] + t
        if t:
            jump = v.max(axis=1, keepdims=True) - switch
            back[at] = np.where(v >= jump, own, v.argmax(axis=1)[:, None].astype(back.dtype))
            np.maximum(v, jump, out=v)
        v += emission[at]
    label = np.zeros(len(emission), np.int64)
    state = value.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        a = active[t]
        at = starts[:a] + t
        label[at] = state[:a]
        if t:
            state[:a] = back[at, state[:a]]
    return label


def _scored(m: LanguageModel, low: int, high: int, bucket: np.ndarray, script: np.ndarray, starts: np.ndarray, words: np.ndarray,
            place: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each word of a slice: scores, script, letters, place of its start and end; of each row: its words."""
    emission = np.empty((len(starts), len(m.names)), np.float32)
    if len(starts):
        for i in range(len(m.names)):
            emission[:, i] = np.add.reduceat(m.scores[i][bucket], starts)
    last = np.append(starts[1:], len(bucket))[:len(starts)] - 1
    return emission, script[starts], last - starts + 1, place[starts], place[last] + 1, np.diff(words)


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text", prefix: str = "", spans: bool = False, switch: float = SWITCH) -> DataFrame:
    """All columns of ``docs`` and ``lang_pred``, ``score``, with ``spans`` also the labelled spans (start, end, lang).

    ``lang_pred`` holds most letters of the text, ``score`` is the share of letters labelled with it.  A text that is null or
    has no letter is ``und`` with score 0, and so is every text if no language was learned.  Letters of a script that no
    language uses speak for none.  ``prefix`` goes before the new names, for inputs that have such columns already.
    """
    new = [f"{prefix}lang_pred", f"{prefix}score"] + [f"{prefix}spans"] * spans
    kinds = ["string", "double", "array<struct<start:int,end:int,lang:string>>"][:len(new)]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        n = len(m.names)
        for batch in batches:
            text = batch.column(batch.schema.get_field_index(text_col)).cast(pa.string())
            for low, high in _slices(text, max(1 << 16, ROUND_BYTES * 4 // max(4, n))):
                pred, score, found = [UNKNOWN] * (high - low), np.zeros(high - low), [[] for _ in range(high - low)]
                emission, script, letters, first, end, counts = (np.concatenate(x) for x in zip(*(_scored(m, *piece) for piece in _letters(text[low:high])), strict=True))
                words = np.concatenate([[0], np.cumsum(counts)])
                if n and len(emission):
                    allowed = m.uses[:, script].T
                    known = allowed.any(axis=1)
                    emission[~known] = 0
                    emission[known] = np.where(allowed[known], emission[known], emission[known].min(axis=1, keepdims=True) - 100)
                    if not known.all():
                        emission[~known] += (1e-6 * m.prior / max(1.0, m.prior.max())).astype(np.float32)
                    label = viterbi(emission, words, switch)
                    row = np.repeat(np.arange(high - low), np.diff(words))
                    share = np.bincount(row * n + label, weights=letters, minlength=(high - low) * n).reshape(-1, n)
                    whole = share.sum(axis=1)
                    has = whole > 0
                    top = share.argmax(axis=1)
                    score = np.where(has, share.max(axis=1) / np.maximum(whole, 1), 0.0)
                    pred = [m.names[t] if h else UNKNOWN for t, h in zip(top, has, strict=True)]
                    if spans:
                        new_span = np.flatnonzero(np.concatenate([[True], (label[1:] != label[:-1]) | (row[1:] != row[:-1])]))
                        for a, b in zip(new_span, np.append(new_span[1:], len(label)) - 1, strict=True):
                            found[row[a]].append({"start": int(first[a]), "end": int(end[b]), "lang": m.names[label[a]]})
                out = [batch.column(i)[low:high] for i in range(batch.num_columns)] + [pa.array(pred, pa.string()), pa.array(score, pa.float64())]
                if spans:
                    out.append(pa.array(found, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))))
                yield pa.RecordBatch.from_arrays(out, names=[*batch.schema.names, *new])

    schema = ", ".join(f"`{c}` {t}" for c, t in [*docs.dtypes, *zip(new, kinds, strict=True)])
    return docs.mapInArrow(run, schema)
