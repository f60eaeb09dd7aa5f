import random
import re
import zlib
from collections import Counter

from ledgerloom.llm import spelling

SCHEMA = "doc_id long, text string"


def counts(rows):
    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            code = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if code % 199 == 0:
                run = run[:code % len(run)] + run[code % len(run) + 1:]
            out[run] += len(run) >= 6
    return {w: n for w, n in out.items() if n >= 5}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i:] == b[i + 1:] if len(a) < len(b) else a[i + 1:] == b[i + 1:]


def brute(rows):
    words = counts(rows)
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    best = {w: min(near[w], key=lambda v: (-words[v], v), default=None) for w in words}
    form = {w: b if b and words[b] >= 5 * words[w] else None for w, b in best.items()}
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


def found(df):
    rows = [tuple(r) for r in spelling.variants(df).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_given_documents(spark, small):
    df = spark.read.parquet(f"{small}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])
    assert found(df) == want and any(w[1] for w in want)


def test_odd_rows(spark):
    """Ties, accents outside A-Z, astral neighbours, nulls, repeated rows, a chain of forms, one very long run."""
    rows = [(1, "Straße straße Àbcdef àbcdef " * 40), (2, None), (3, ""), (None, "letters Letter5 letterss " * 5), (4, "12 :: \U0001F600abcdefg\U0001F600 " * 6)]
    rows += [(5, "mmmmmm " * 200 + "mmmmmn " * 30 + "mmmmnn " * 6 + "mmmmmo " * 30)] + [(6, "repeat repeats " * 3)] * 4 + [(7, "x" * 50_000 + " " + ("y" * 3000 + " ") * 5)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as word", "2 as n", "3 as key").repartition(3)
    want = brute(rows)
    assert found(df) == want and any(w[1] and w[2] != w[1] for w in want)
    assert found(df.limit(0)) == set()


def test_hot_chunks(spark):
    """Words that share a beginning or an ending meet on two and more chunks; none is lost."""
    random.seed(5)
    words = {"prefix" + "".join(random.choices("abcd", k=random.randrange(2, 7))) for _ in range(500)}
    words |= {"".join(random.choices("abé", k=random.randrange(1, 5))) + "ending" for _ in range(200)} | {"ab", "a", "b", "ba"}
    df = spark.createDataFrame([(w,) for w in words], "word string")
    want = {tuple(sorted((a, b), key=lambda w: (len(w), w))) for a in words for b in words if one_edit(a, b) and min(len(a), len(b)) > 1}
    for hot in (3, 40, 10_000):
        assert {tuple(r) for r in spelling.near_pairs(df, hot).collect()} == want
