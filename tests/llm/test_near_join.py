import random
from collections import defaultdict

from ledgerloom.llm.near_join import keep_first, near_join, trie_depth

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def grams(text, k=5):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute(rows, similarity=0.8):
    sets = [(i, grams(t)) for i, t in rows]
    owners = defaultdict(list)
    for n, (_, g) in enumerate(sets):
        for x in g:
            owners[x].append(n)
    both = defaultdict(int)
    for members in owners.values():
        for x in range(len(members)):
            for y in range(x + 1, len(members)):
                both[members[x], members[y]] += 1
    links, parent = [0] * len(sets), list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for (a, b), n in both.items():
        if n >= similarity * (len(sets[a][1]) + len(sets[b][1]) - n) - 1e-9:
            links[a] += 1
            links[b] += 1
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    least = {}
    for n, (i, _) in enumerate(sets):
        least[root(n)] = min(least.get(root(n), i), i)
    return sorted((i, least[root(n)], links[n]) for n, (i, _) in enumerate(sets))


def test_depth():
    assert trie_depth(0.8, 16, 8, 0.9999) == 3
    assert trie_depth(0.99, 4, 8, 0.5) == 8


def test_against_brute_force(spark):
    random.seed(3)
    vocab = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for _ in range(25):
        base = random.choices(vocab, k=random.choice([4, 30, 120, 400]))
        for _ in range(random.choice([1, 2, 6, 40])):
            words = list(base)
            for _ in range(random.choice([0, 0, 1, 2, 5])):
                words[random.randrange(len(words))] = random.choice(vocab)
            rows.append((n, " ".join(words)))
            n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, "  \n"), (n + 3, "one"), (n + 4, "one")]
    df = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], SCHEMA).repartition(6)
    for block in (128, 7):
        got = sorted((r.doc_id, r.class_id, r.n_links) for r in near_join(df, block_rows=block).collect())
        assert got == brute(rows)
    classes = {c for _, c, _ in brute(rows)}
    assert sorted(r.doc_id for r in keep_first(df).collect()) == sorted(classes)


def test_given_documents(spark, small):
    df = spark.read.parquet(f"{small}/documents.parquet")
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in near_join(df).collect())
    assert got == brute([(r.doc_id, r.text) for r in df.collect()])


def test_odd_rows(spark):
    data = [(None, "a b c d e f", None, None, None), (1, "a b c d e f", None, None, None), (1, "a b c d e f", None, None, None),
            (2, None, None, None, None), (2, None, None, None, None), (None, None, None, None, None), (None, "only here", None, None, None)]
    df = spark.createDataFrame(data, SCHEMA).selectExpr("*", "1 as component", "2 as key", "3 as node")
    assert sorted((r.doc_id or -1, r.class_id or -1, r.n_links) for r in near_join(df).collect()) == [
        (-1, -1, 0), (-1, -1, 0), (-1, 1, 2), (1, 1, 2), (1, 1, 2), (2, 2, 0), (2, 2, 0)]
    kept = keep_first(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or -1, r.text or "") for r in kept.collect()) == [(-1, ""), (-1, "only here"), (1, "a b c d e f"), (2, "")]
    assert near_join(df.limit(0)).count() == 0 and keep_first(df.limit(0)).count() == 0


def test_unrelated_texts_under_one_identifier(spark):
    """Both classes keep a row, and what is near to one of them goes with it."""
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(7, a), (7, b), (9, b + " end"), (8, a), (7, ""), (7, " ")]
    df = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], SCHEMA)
    assert sorted((r.doc_id, r.text) for r in keep_first(df).collect()) == sorted([(7, a), (7, b), (7, ""), (7, " ")])
