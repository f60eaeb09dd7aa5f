import hashlib
import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from ledgerloom.llm import substrings
from ledgerloom.llm.substrings import repeated_words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute(rows, length):
    data = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    seen = Counter(tuple(w[s:s + length]) for _, w in data for s in range(len(w) - length + 1))
    out = []
    for i, w in data:
        covered = [False] * len(w)
        for s in range(len(w) - length + 1):
            if seen[tuple(w[s:s + length])] > 1:
                covered[s:s + length] = [True] * length
        kept = [x for x, c in zip(w, covered, strict=True) if not c]
        out.append((i, len(w), sum(covered), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is None, r))


def found(df, **options):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in repeated_words(df, **options).collect()), key=lambda r: (r[0] is None, r))


def odd_rows():
    random.seed(6)
    space = lambda: random.choice([" ", "\n", "\t ", "\x0b", "\x0c\r", "  "])
    words = lambda pool, k: "".join(w + space() for w in random.choices(pool, k=k))
    passages = [random.choices(["ä", "bb", "c d", "e", "\U0001F600"], k=random.randrange(4, 30)) for _ in range(8)]
    rows = []
    for i in range(120):
        text = words("pqrstuvw", random.randrange(0, 12))
        for _ in range(random.randrange(3)):
            p = random.choice(passages)
            a = random.randrange(len(p) // 2)
            text += "".join(w + space() for w in p[a:a + random.randrange(len(p))]) + words("klmn", random.randrange(0, 6))
        rows.append((i, text))
    rows += [(200, None), (201, ""), (202, rows[3][1]), (203, "same " * 40), (None, "z y " * 9), (None, None), (204, " \n "), (205, "one two"), (206, "one two")]
    return rows + [(7, rows[7][1])] * 3 + [(8, "another text of eight " * 3)]


@pytest.mark.parametrize("gram, group", [(3, 16_000), (1, 60), (5, 200), (7, 4)])
def test_small_windows(spark, gram, group):
    """Small groups split the anchors over many tasks and lengthen the frequent ones."""
    rows = odd_rows()
    df = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], SCHEMA).selectExpr("*", "1 as key", "2 as num", "3 as anchor").repartition(6)
    want = brute(rows, 8)
    assert sum(r[2] for r in want) > 500 and sum(r[1] - r[2] for r in want) > 500
    assert found(df, length=8, gram=gram, group=group) == want


def test_empty_table(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []


def test_given_documents(spark, small):
    df = spark.read.parquet(f"{small}/documents.parquet").repartition(4)
    want = brute([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()], 35)
    assert found(df) == want and sum(r[2] for r in want) > 0


def test_long_text_and_hot_passage(spark):
    """One passage in every document, longer prefixes, and a text larger than a slice."""
    random.seed(7)
    passage = " ".join(f"w{k}" for k in range(50))
    rows = [(i, " ".join([*(f"a{random.randrange(10**9)}" for _ in range(30)), passage, *(f"b{random.randrange(10**9)}" for _ in range(30))])) for i in range(150)]
    rows.append((1000, " ".join(f"x{k}" for k in range(400_000)) + " " + passage + " end"))
    df = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], SCHEMA).repartition(3)
    got = found(df, group=40)
    assert got == found(df) and [r[2] for r in got] == [50] * 151 and got[-1][:3] == (1000, 400_051, 50)


def test_frequent_suffixes_ask_in_packs():
    """Suffixes at one anchor share rows of bounded size; none is lost, and what stood in one batch row may part."""
    kind = pa.list_(pa.struct([("anchor", pa.int64()), ("start", pa.int32()), ("digests", pa.list_(pa.binary()))]))
    rows = [[{"anchor": 7, "start": i, "digests": [b"a%d" % i, b"b"]}, {"anchor": i % 3, "start": i + 1, "digests": [b"c"]}] for i in range(150)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(150), pa.int64()), pa.array(rows, kind)], names=["num", "frequent"])
    got = [r for b in substrings._packs(iter([batch.slice(10), batch.slice(0, 0)])) for r in b.to_pylist()]
    asked = Counter((r["anchor"], a["num"], a["start"], tuple(a["digests"])) for r in got for a in r["asks"])
    assert asked == Counter((s["anchor"], i, s["start"], tuple(s["digests"])) for i in range(10, 150) for s in rows[i])
    assert max(len(r["asks"]) for r in got) <= substrings.PACK and len(got) == 3 + 3


def test_windows_of_packs_stand_once():
    """A window that many suffixes share is one row with all its places, cut where they are too many; places come back as runs."""
    kind = pa.list_(pa.struct([("num", pa.int64()), ("start", pa.int32()), ("digests", pa.list_(pa.binary()))]))
    same, rest = b"s" * 16, [b"%016d" % i for i in range(300)]
    rows = [[{"num": i, "start": 10 * k, "digests": [same, rest[i], same]} for k in range(5)] for i in range(300)] + [[]]
    batch = pa.RecordBatch.from_arrays([pa.array([i % 2 for i in range(301)], pa.int64()), pa.array(rows, kind)], names=["anchor", "asks"])
    made = list(substrings._places(iter([batch.slice(100), batch.slice(0, 0)])))
    got = [r for b in made for r in b.to_pylist()]
    stand = Counter((r["anchor"], r["digest"], p["num"], p["start"]) for r in got for p in r["places"])
    assert stand == Counter((i % 2, d, i, 10 * k + o) for i in range(100, 300) for k in range(5) for o, d in enumerate((same, rest[i], same)))
    assert max(len(r["places"]) for r in got) <= substrings.PLACES and len(got) == 200 + 2
    runs = [(r["num"], tuple((x["first"], x["last"]) for x in r["runs"])) for b in substrings._runs(iter(made)) for r in b.to_pylist()]
    assert sorted(runs) == [(i, tuple((10 * k, 10 * k + 3) for k in range(5))) for i in range(100, 300)]


def test_line_that_fills_many_texts(spark):
    """A line that stands hundreds of times in each of many different texts, and once in others, at frequent prefixes."""
    random.seed(8)
    line = ["never", "the", "less"]
    rows = []
    for i in range(60):
        text = [f"a{i}", f"b{i}", *line * random.randrange(1, 90), f"c{i}", *line * random.randrange(4), random.choice(["end", f"e{i}"])]
        rows.append((i, " ".join(text)))
    df = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows + rows[:3]], SCHEMA).repartition(5)
    assert found(df, length=8, gram=3, group=40) == brute(rows + rows[:3], 8)
