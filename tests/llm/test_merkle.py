import hashlib
import zlib

import pytest

from ledgerloom.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(digests):
    """Root, and per leaf its siblings per level."""
    paths, nodes, place = [[] for _ in digests], list(digests), list(range(len(digests)))
    while len(nodes) > 1:
        for i, p in enumerate(place):
            run = p - p % 16
            paths[i].append(("".join(nodes[run:p]), "".join(nodes[p + 1:run + 16])))
        nodes = [h(*nodes[i:i + 16]) for i in range(0, len(nodes), 16)]
        place = [p // 16 for p in place]
    return nodes[0], paths


def brute(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append(r)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    subs = {s: tree([leaf(r) for r in sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))]) for s in order}
    root, over = tree([subs[s][0] for s in order])
    out = []
    for i, s in enumerate(order):
        for r, path in zip(sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))), subs[s][1], strict=True):
            steps = path + over[i]
            changed = r if r[0] is None or r[4] is None or zlib.crc32(str(r[0]).encode()) % 5 else (*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]))
            node = leaf(changed)
            for a, b in steps:
                node = h(a, node, b)
            out.append((r[0], leaf(r), subs[s][0], root, h(*(x for step in steps for x in step)), node, node == root))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in merkle.manifest(df).collect()), key=str)


def odd_rows():
    rows = [(i, f"src{i % 3}", "en", i, f"Text {i} ÀB") for i in range(70)]
    rows += [(900 + i, None, None, None, None) for i in range(17)] + [(None, "src0", "en", 3, "No number"), (None, "src0", "en", 3, "No other")]
    rows += [(5000, "é", "", 0, ""), (5001, "lone", "en", 1, "UPPER"), (5002, "long", "en", 1, "Wörter " * 60_000)]
    return rows + [(7, "src1", "en", 7, "Text 7 ÀB")] * 3 + [(8, "src2", "en", 9, "Another text of 8")]


def test_nulls_ties_and_long_texts(spark):
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as tree", "2 as pos", "3 as block", "'x' as digest").repartition(5)
    got = found(df)
    assert got == brute(rows) and not all(r[-1] for r in got) and any(r[-1] for r in got)
    assert found(df.limit(0)) == []


@pytest.mark.parametrize("n", [16, 17, 257, 4097])
def test_heights(spark, n):
    """Sources below, at and above a full superblock, beside a source of one leaf."""
    rows = [(i, "many", None, 1, f"T{i}") for i in range(n)] + [(n, "one", None, 1, "t")]
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(4)) == brute(rows)


@pytest.mark.parametrize("block", [16, 256])
def test_many_superblocks_and_sources(spark, block):
    """Small superblocks: several rounds up and down, for the tree of the sources too."""
    rows = [(i, "hot" if i % 3 else f"s{i}", None, i, f"T{i}") for i in range(700)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert sorted((tuple(r) for r in merkle.manifest(df, block).collect()), key=str) == brute(rows)
