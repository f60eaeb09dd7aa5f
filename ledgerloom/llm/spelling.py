"""Grouping of spelling variants: words one edit apart, joined on asymmetric q-chunks.

Of two words that differ by one code point, the shorter (of equal length: the smaller) contributes two disjoint chunks of
half its length, its first and its last code points.  The other contributes the positional grams of that length.  One edit
spoils one chunk at most, and moves the other by one place at most, so the pair meets in an equi-join of chunks with the
grams that stand within one place of them.  What meets is verified by edit distance.

A chunk that many words share (a common prefix or ending) is made more selective by the same rule: what is left of the word
beside the preserved chunk differs by the one edit too, so of its two disjoint chunks one is preserved as well.  Words that
meet in such a hot chunk are joined on both chunks instead, and so on; no pair is lost and no group is capped.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.session import cut

MIN_LENGTH = 6
MIN_COUNT = 5
#: A word belongs to a near word that is this many times as frequent.
RATIO = 5
#: Every run whose crc32 this number divides loses one code point.
SLIP = 199
#: Chunks shared by more words than this are joined together with a further one.
HOT_CHUNK = 200
#: Distinct words a task counts before it hands its counts on.
HELD_WORDS = 200_000

_RUN = re.compile(f"[a-zÀ-ÿ]{{{MIN_LENGTH},}}")


def slipped(doc_id: object, run: str) -> str:
    """The run as the corpus is taken to hold it: without one code point where ``SLIP`` divides its crc32 in this document."""
    h = zlib.crc32(run.encode(), zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()))
    if h % SLIP:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def handed() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
        held.clear()
        return out

    held: Counter[str] = Counter()
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            if not text.is_valid:
                continue
            start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
            # bytes are lowered in A-Z only
            for run, n in Counter(_RUN.findall(text.as_buffer().to_pybytes().lower().decode())).items():
                if zlib.crc32(run.encode(), start) % SLIP == 0:
                    run = slipped(doc_id, run)
                    if len(run) < MIN_LENGTH:
                        continue
                held[run] += n
            if len(held) > HELD_WORDS:
                yield handed()
    if held:
        yield handed()


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n: the words of at least ``MIN_LENGTH`` code points that occur at least ``MIN_COUNT`` times in all texts.

    Runs of letters (A-Z, a-z, U+00C0 to U+00FF), A-Z lower-cased, one code point less where ``slipped`` says so.  Tasks
    count before the shuffle, so a frequent word is one row per task.
    """
    read = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return read.mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)


def _split(df: DataFrame) -> DataFrame:
    """Each row twice: its first and its last ``left // 2`` code points join the key, the others stay as ``rest``.

    ``left`` is what the chunk word has left; the gram word has as much, or one code point more, so its beginning and its end
    are the grams that stand within one place of the chunk.
    """
    q = F.floor(F.col("left") / 2).cast("int")
    n = F.char_length("rest")
    split = F.array(F.struct(F.concat_ws("|", "key", F.lit("first"), F.substring("rest", F.lit(1), q)).alias("key"), F.substring("rest", q + 1, n).alias("rest")),
                    F.struct(F.concat_ws("|", "key", F.lit("last"), F.substring("rest", n - q + 1, q)).alias("key"), F.substring("rest", F.lit(1), n - q).alias("rest")))
    return df.select("word", (F.col("left") - q).alias("left"), F.explode(split).alias("s")).select("word", "left", "s.*")


def near_pairs(words: DataFrame, hot_chunk: int = HOT_CHUNK) -> DataFrame:
    """a, b: all pairs of words that differ by exactly one inserted, deleted or replaced code point, each pair once.

    ``words`` holds distinct non-null words in column ``word``.
    """
    n = F.char_length("word")
    whole = words.filter(n > 1).select("word", n.alias("n"))
    chunks = whole.select("word", F.col("n").alias("left"), F.col("n").cast("string").alias("key"), F.col("word").alias("rest"))
    grams = whole.select("word", "n", F.explode(F.array("n", F.col("n") - 1)).alias("left")).select(
        "word", "left", F.col("left").cast("string").alias("key"), F.col("word").alias("rest"))
    met: list[DataFrame] = []
    while True:
        chunks, grams = cut(_split(chunks)), cut(_split(grams))
        hot = cut(chunks.filter("left > 1").groupBy("key").count().filter(F.col("count") > hot_chunk).select("key"))
        met.append(chunks.join(hot, "key", "left_anti").select("key", F.col("word").alias("a")).join(grams.select("key", F.col("word").alias("b")), "key").select("a", "b"))
        if hot.isEmpty():
            break
        chunks, grams = chunks.join(hot, "key", "left_semi"), grams.join(hot, "key", "left_semi")
    ordered = (F.char_length("a") < F.char_length("b")) | ((F.char_length("a") == F.char_length("b")) & (F.col("a") < F.col("b")))
    near = [m.filter(ordered & (F.levenshtein("a", "b", 1) == 1)) for m in met]
    return reduce(DataFrame.unionByName, near).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """word, root: ``form`` followed to its end by pointer doubling; a form is ``RATIO`` times as frequent, so chains are short."""
    state = cut(forms.filter("form is not null").select("word", F.col("form").alias("root")))
    while True:
        nexts = state.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = cut(state.join(nexts, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        state = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return state


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    ``form`` is the most frequent near word (ties: the smallest in code-point order) if it is at least ``RATIO`` times as
    frequent, else null; ``root`` is where forms lead, the word itself if it has none.  Null texts and texts without
    letters give no words, repeated rows count as often as they stand there, a null identifier counts as an empty one, an
    empty table gives no rows.  Texts may have any length and are read whole.
    """
    words = cut(word_counts(docs, id_col, text_col))
    pairs = cut(near_pairs(words.select("word")))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near")).unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("near")))
    best = (both.join(words.select(F.col("word").alias("near"), F.col("n").alias("m")), "near")
            .groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("low"), "near")).alias("best")))
    is_form = -F.col("best.low") >= RATIO * F.col("n")
    formed = cut(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.low")).alias("form_n")))
    return formed.join(_roots(formed), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
