"""Personal data: pattern rules give seed entities, whose contexts induce patterns that discover further identifiers.

Seeds are what the base rules match.  The words around each mention are lexical patterns.  Spark scores the graph of
(pattern, instance) pairs in rounds: a pattern is as good as the share of its instances that are believed, an instance is
believed by the patterns that are good.  High-confidence patterns then mark identifier-like tokens that no rule matches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.common import binary_key
from ledgerloom.session import cut

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
MIN_INSTANCES = 5
CONFIDENCE = 0.9
#: Five seeds beside three unseen instances are just enough for the confidence.
SMOOTHING = 0.25
#: An unseen instance is no evidence against a pattern, but where they are the larger part (above 0.52), it is not trusted.
UNSEEN = 0.1

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
#: Tokens that may be identifiers: they hold a digit or an @ and five characters at least.
_TOKEN = re.compile(r"(?<![^\x20\x09-\x0D])(?=[^\x20\x09-\x0D0-9@]*[0-9@])[^\x20\x09-\x0D]{5,}")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_WORD_AFTER = re.compile(r"[\x20\x09-\x0D]*([^\x20\x09-\x0D]+)")
#: Context is looked for within so many characters of a mention.
CONTEXT_CHARS = 120


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base rules: leftmost non-overlapping matches per kind; failing ones are dropped."""
    out: list[tuple[int, int, int]] = []
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            out.append((0, start, found.end()))
            done = found.end()
        at = text.find("@", max(done, at + 1))
    if _DIGIT.search(text):
        out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = re.sub(r"[\x20-]", "", m.group())
                if 16 <= len(digits) <= 19 and luhn(digits):
                    out.append((2, m.start(), m.end()))
        if "+" in text:
            out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_DIGIT.findall(m.group())) <= 15]
    return out


def contexts(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns of a mention: one and two words before it (the start of the text counts as an empty word), one word
    after it, and the words on both sides."""
    low = max(0, start - CONTEXT_CHARS)
    shape = lambda w: _DIGIT.sub("9", w.lower())
    before = [shape(w) for w in _WORD.findall(text, low, start)[-2:]]
    after = _WORD_AFTER.match(text, end, min(len(text), end + CONTEXT_CHARS))
    out = []
    if before:
        out.append(f"{before[-1]} _")
        if len(before) > 1 or low == 0:
            out.append(f"{before[0] if len(before) > 1 else ''} {before[-1]} _")
    if after:
        out.append(f"_ {shape(after[1])}")
        if before:
            out.append(f"{before[-1]} _ {shape(after[1])}")
    return out


_SPAN = "struct<kind:int,start:int,end:int>"
_MENTION = "struct<kind:int,start:int,end:int,value:string,patterns:array<string>>"


def _mentions(docs: DataFrame) -> DataFrame:
    span = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
    mention = pa.struct([*span, ("value", pa.string()), ("patterns", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, found = [], []
            for text in batch.column("text"):
                text = text.as_py() or ""
                spans = base_spans(text)
                base.append([{"kind": k, "start": s, "end": e} for k, s, e in spans])
                here = [(k, s, e) for k, s, e in spans]
                taken = sorted((s, e) for _, s, e in spans)
                if "@" in text or _DIGIT.search(text):
                    i = 0
                    for m in _TOKEN.finditer(text):
                        while i < len(taken) and taken[i][1] <= m.start():
                            i += 1
                        if i == len(taken) or taken[i][0] >= m.end():
                            here.append((-1, m.start(), m.end()))
                found.append([{"kind": k, "start": s, "end": e, "value": text[s:e].lower(), "patterns": contexts(text, s, e)} for k, s, e in here])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(base, pa.list_(span)), pa.array(found, pa.list_(mention))],
                                             names=["doc_id", "key", "base", "mentions"])

    return docs.mapInArrow(run, f"doc_id long, key binary, base array<{_SPAN}>, mentions array<{_MENTION}>")


def good_patterns(edges: DataFrame, rounds: int = ROUNDS, min_instances: int = MIN_INSTANCES, confidence: float = CONFIDENCE) -> DataFrame:
    """(pattern, kind, score) of high-confidence patterns from distinct (pattern, value, kind) pairs; kind -1 is unknown.

    A pattern's score for a kind is the belief in its instances of that kind over the belief in those of all kinds
    (smoothed, so that support counts); instances without belief weigh ``UNSEEN``.  An unknown instance takes the belief of
    its best pattern.  Sums are pre-aggregated, so a pattern or value of very many mentions is no single task's load.
    """
    size = edges.groupBy("pattern").agg(F.countDistinct("value").alias("size")).filter(F.col("size") >= min_instances)
    graph = cut(edges.join(size, "pattern"))
    beliefs = graph.filter("kind >= 0").select("value", "kind").distinct().withColumn("belief", F.lit(1.0))
    seeds = beliefs
    scored = None
    for _ in range(rounds):
        sums = (graph.select("pattern", "value", "size").distinct().join(beliefs, "value").groupBy("pattern")
                .agg(F.first("size").alias("size"), F.sum("belief").alias("decided"),
                     F.array(*(F.struct(F.lit(k).alias("kind"), F.sum(F.when(F.col("kind") == k, F.col("belief"))).alias("mass")) for k in range(len(KINDS)))).alias("kinds")))
        weight = F.col("decided") + F.lit(UNSEEN) * F.greatest(F.col("size") - F.col("decided"), F.lit(0.0)) + F.lit(SMOOTHING)
        scored = cut(sums.select("pattern", weight.alias("weight"), F.inline("kinds")).filter(F.col("mass") >= min_instances)
                     .select("pattern", "kind", "mass", (F.col("mass") / F.col("weight")).alias("score")))
        lifted = (graph.filter("kind < 0").select("pattern", "value").distinct().join(scored.filter(F.col("score") >= confidence), "pattern")
                  .groupBy("value", "kind").agg(F.max("score").alias("belief")))
        beliefs = seeds.unionByName(lifted).groupBy("value", "kind").agg(F.max("belief").alias("belief"))
    return scored.filter(F.col("score") >= confidence).select("pattern", "kind", "score")


def _written(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")


def find_private(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: float) -> DataFrame:
    """One row per document: doc_id, key (MD5 of the text), base and spans (arrays of kind, start, end; code points).

    ``spans`` holds the base spans and those that patterns add, ordered by kind, then start.  An added span touches no base
    span.  Null text has none.  Repeated rows are documents of their own; contexts count once per distinct pair of pattern
    and value, so copies of a text add no weight.  An empty table gives no rows.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), binary_key(F.col(text_col)).alias("key"), F.col(text_col).alias("text"))
    read = cut(_mentions(texts))
    single = read.filter(F.size("mentions") > 0).select("key", F.explode("mentions").alias("m")).select("key", "m.*")
    edges = cut(single.select("value", "kind", F.explode("patterns").alias("pattern")).distinct())
    good = good_patterns(edges, **options)
    hits = (single.filter("kind < 0").select("key", "start", "end", F.explode("patterns").alias("pattern")).join(good, "pattern")
            .groupBy("key", "start", "end").agg(F.max_by("kind", F.struct("score", -F.col("kind"))).alias("kind")))
    added = cut(hits.groupBy(F.col("key").alias("_key")).agg(F.collect_list(F.struct("kind", "start", "end")).alias("added")))
    joined = read.join(added, F.col("key") == F.col("_key"), "left")
    order = lambda c: F.array_sort(F.coalesce(c, F.array().cast(f"array<{_SPAN}>")))
    return joined.select("doc_id", "key", order(F.col("base")).alias("base"),
                         order(F.when(F.col("added").isNull(), F.col("base")).otherwise(F.concat("base", "added"))).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts per kind, the SHA-256 of the base spans and all spans as text."""
    count = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")
    return found.select("doc_id", *(count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)),
                        F.sha2(_written(F.col("base")), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, **options: float) -> DataFrame:
    """The documents with every span replaced by its kind in brackets; n_chars follows the text.  Columns stay as they are."""
    found = find_private(docs, **options).filter(F.size("spans") > 0).dropDuplicates(["key"]).select(F.col("key").alias("_span_key"), F.col("spans").alias("_spans"))
    joined = docs.withColumn("_text_key", binary_key(F.col("text"))).join(found, F.col("_text_key") == F.col("_span_key"), "left")
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(at).to_pylist(), batch.column("_spans").to_pylist(), strict=True):
                if spans:
                    parts, done = [], 0
                    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
                        if s["end"] > done:
                            parts += [text[done:max(done, s["start"])], f"[{KINDS[s['kind']].upper()}]"] if s["start"] >= done else []
                            done = s["end"]
                    text = "".join(parts) + text[done:]
                out.append(text)
            columns = [pa.array(out, pa.string()) if i == at else batch.column(i) for i in range(len(docs_columns))]
            yield pa.RecordBatch.from_arrays(columns, names=docs_columns)

    docs_columns = docs.columns
    schema = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    masked = joined.select(*docs_columns, "_spans").mapInArrow(run, schema)
    return masked.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs_columns else masked
