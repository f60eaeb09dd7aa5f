import hashlib
import random
from collections import Counter

from ledgerloom.llm.repeats import repeated_spans

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute(rows, length):
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(d[s:s + length] for _, d in data for s in range(len(d) - length + 1))
    out = []
    for i, d in data:
        covered = bytearray(len(d))
        for s in range(len(d) - length + 1):
            if seen[d[s:s + length]] > 1:
                covered[s:s + length] = b"\1" * length
        kept = bytes(c for c, x in zip(d, covered) if not x)
        spans = sum(x and (not k or not covered[k - 1]) for k, x in enumerate(covered))
        out.append((i, len(d), sum(covered), int(spans), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is None, r))


def found(df, **options):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeated_spans(df, **options).collect()), key=lambda r: (r[0] is None, r))


def test_small_windows(spark):
    random.seed(4)
    passages = ["".join(random.choices("abcdé ", k=random.randrange(20, 200))) for _ in range(8)]
    rows = []
    for i in range(80):
        parts = ["".join(random.choices("xyz ", k=random.randrange(0, 60)))]
        for _ in range(random.randrange(3)):
            p = random.choice(passages)
            a = random.randrange(len(p) // 2)
            parts += [p[a:a + random.randrange(len(p))], "".join(random.choices("uvw", k=random.randrange(0, 30)))]
        rows.append((i, "".join(parts)))
    rows += [(100, None), (101, ""), (102, rows[3][1]), (103, "q" * 120), (None, "r" * 10), (104, "ab" * 70)]
    df = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], SCHEMA).selectExpr("*", "1 as key", "2 as phrase").repartition(6)
    want = brute(rows, 40)
    assert sum(r[2] for r in want) > 1000
    for shard in (1 << 20, 500):
        assert found(df, length=40, gram=20, shard_bytes=shard) == want
    assert found(df.limit(0)) == []


def test_given_documents(spark, small):
    df = spark.read.parquet(f"{small}/documents.parquet").limit(120).cache()
    rows = [(r.doc_id, r.text[:6000]) for r in df.collect()]
    cut = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], SCHEMA)
    assert found(cut) == brute(rows, 400)
