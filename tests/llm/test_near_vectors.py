import numpy as np

from ledgerloom.llm.near_vectors import CoverTree, near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=0.98):
    def usable(v, label):
        return label is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    n = len(rows)
    links, parent = [0] * n, list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    good = [(i, np.array(v, np.float32).astype(float), label) for i, (_, v, label) in enumerate(rows) if usable(v, label)]
    for x in range(len(good)):
        for y in range(x + 1, len(good)):
            (i, a, la), (j, b, lb) = good[x], good[y]
            if la == lb and len(a) == len(b) and a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= cosine:
                links[i] += 1
                links[j] += 1
                parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (v, _, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), v), v)
    return sorted((v, links[i], least[root(i)], v == least[root(i)]) for i, (v, _, _) in enumerate(rows))


def test_tree_pairs_lose_nothing():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 3))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    tree = CoverTree(x[:60], 20)
    leaf = (x @ tree.centres.T).argmax(axis=1)
    radii = np.array([max(np.linalg.norm(x[leaf == i] - c, axis=1), default=0) for i, c in enumerate(tree.centres)])
    pairs = set(tree.pairs(radii, 0.2))
    near = np.argwhere(np.linalg.norm(x[:, None] - x[None], axis=2) <= 0.2)
    assert {(min(leaf[a], leaf[b]), max(leaf[a], leaf[b])) for a, b in near} <= pairs
    assert len(pairs) < 20 * 21 / 2


def test_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = []
    for c in range(40):
        base = rng.normal(size=6)
        for _ in range(int(rng.integers(1, 9))):
            rows.append((len(rows), (base + rng.normal(size=6) * 0.1).tolist(), int(c % 3)))
    rows += [(len(rows) + i, rows[0][1], 0) for i in range(12)]
    n = len(rows)
    rows += [(n, None, 0), (n + 1, [0.0] * 6, 0), (n + 2, [float("nan")] * 6, 0), (n + 3, rows[0][1], None), (n + 4, [1.0, None], 1), (n + 5, [], 1), (n + 6, [1e30] * 6, 2), (n + 7, [1e30] * 6, 2), (n + 8, [1.0, 2.0], 2)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as key", "2 as leaf").repartition(5)
    for leaf, block in ((1024, 1024), (16, 7)):
        got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in near_vectors(df, leaf_rows=leaf, block_rows=block).collect())
        assert got == brute(rows)
    assert near_vectors(df.limit(0)).count() == 0
    twice = near_vectors(spark.createDataFrame([(None, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (5, [1.0, 0.0], 1)], SCHEMA)).collect()
    assert sorted((r.vec_id or -1, r.n_links, r.component_id, r.kept) for r in twice) == [(-1, 2, 5, False), (5, 2, 5, True), (5, 2, 5, True)]
