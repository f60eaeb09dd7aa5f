"""Quality rules: base counts and a hashed n-gram log-likelihood ratio between trusted and raw text.

Words and word pairs are hashed into buckets.  Two multinomials over the buckets are counted: the trusted documents (labelled
of good quality) and all documents.  A document's score is the mean log ratio of its n-grams, and the threshold is fixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import mix, text_slices, windows, word_bounds, prefix_sums, range_hash

BUCKETS = 1 << 16
SMOOTHING = 1.0
THRESHOLD = -0.1
#: Most trusted documents that are used, the first by hash of doc_id; the raw counts take all documents.
MAX_TRUSTED = 500_000
MIN_WORDS = 50
REPEAT_WINDOW = 3

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _ngrams(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of all words and of all word pairs within a row."""
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    pairs = windows(hashes, 2)
    inside = row[1:] == row[:-1] if len(row) > 1 else np.zeros(0, bool)
    shift = np.uint64(48)
    return np.concatenate([hashes >> shift, pairs[inside] >> shift]).astype(np.int64), np.concatenate([row, row[1:][inside] if len(row) > 1 else row[:0]])


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, rows = word_bounds(data, offsets)
    return mix(range_hash(prefix_sums(data), starts, ends)), rows


def log_ratios(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", quality_col: str = "quality", max_trusted: int = MAX_TRUSTED) -> np.ndarray:
    """log(p_trusted / p_raw) per bucket.  Without trusted documents all ratios are 0.

    The trusted identifiers are a documented, bounded sample (``max_trusted``), so they are broadcast.  Every task sends one
    count per bucket that it met; the driver gets one row per bucket.
    """
    good = labels.filter(F.col(quality_col) == 1).select(F.col("doc_id").cast("long").alias("_id")).filter("_id is not null").distinct()
    picked = [r[0] for r in good.orderBy(F.xxhash64("_id"), "_id").limit(max_trusted).collect()]
    trusted = docs.sparkSession.sparkContext.broadcast(np.sort(np.array(picked, np.int64)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            ids = batch.column("doc_id").fill_null(-1).to_numpy()
            is_good = np.isin(ids, trusted.value) & batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            for low, high, data, offsets in text_slices(batch.column("text")):
                bucket, row = _ngrams(*_words(data, offsets))
                raw += np.bincount(bucket, minlength=BUCKETS)
                target += np.bincount(bucket[is_good[low:high][row]], minlength=BUCKETS)
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(target[at])], names=["bucket", "raw", "target"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sums = texts.mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[sums.column("bucket").to_numpy()] = sums.column("raw").to_numpy()
    target[sums.column("bucket").to_numpy()] = sums.column("target").to_numpy()
    if not target.sum():
        return np.zeros(BUCKETS)
    # the raw shares serve as prior of the trusted ones, so that a bucket seen nowhere has ratio 0
    prior = (raw + SMOOTHING) / (raw.sum() + SMOOTHING * BUCKETS)
    weight = SMOOTHING * BUCKETS / 16
    return np.log((target + weight * prior) / (target.sum() + weight) / prior)


def judge(docs: DataFrame, ratios: np.ndarray, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document with the base counts, base_failed, score and kept.

    Words are runs of other characters than ASCII white space.  Null and empty texts have no words and fail the base rule;
    their score is 0.  Repeated rows are judged each; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ratios)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column("text")):
                n = high - low
                sums = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets])  # noqa: B023, E731
                hashes, rows = _words(data, offsets)
                n_words = np.diff(rows)
                chars, symbols = sums(~_SPACE[data] & ((data & 0xC0) != 0x80)), sums(_SYMBOL[data])
                content = data.tobytes()
                dup = np.zeros(n, np.int64)
                for i in np.flatnonzero(sums(data == 10)):
                    lines = [x for x in content[offsets[i]:offsets[i + 1]].split(b"\n") if x.strip()]
                    dup[i] = len(lines) - len(set(lines))
                row = np.repeat(np.arange(n), n_words)
                grams = windows(hashes, REPEAT_WINDOW)
                at = np.flatnonzero(row[:len(grams)] == row[REPEAT_WINDOW - 1:]) if len(grams) else np.zeros(0, np.int64)
                _, which, times = np.unique(mix(grams[at] ^ mix(row[at].astype(np.uint64) + np.uint64(1))), return_inverse=True, return_counts=True)
                again = at[times[which] > 1] if len(at) else at
                marked = np.zeros(len(hashes), bool)
                for j in range(REPEAT_WINDOW):
                    marked[again + j] = True
                repeat = np.bincount(row[marked], minlength=n)
                bucket, owner = _ngrams(hashes, rows)
                total = np.bincount(owner, weights=shared.value[bucket], minlength=n)
                score = total / np.maximum(1, np.bincount(owner, minlength=n))
                failed = (n_words < MIN_WORDS) | (100 * repeat > 50 * n_words)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[low:high], *(pa.array(np.asarray(x, np.int64)) for x in (n_words, chars, symbols, dup, repeat)),
                     pa.array(failed), pa.array(score), pa.array(~failed & (score >= threshold))], names=names)

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, score double, kept boolean"))
