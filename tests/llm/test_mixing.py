import itertools

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from ledgerloom.llm.mixing import fit_budget, mix

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 12), st.integers(1, 3)), min_size=1, max_size=4, unique_by=lambda t: t[0]), st.integers(0, 60))
def test_budget_is_nearest_sum(items, budget):
    size, have = np.array([i[0] for i in items]), np.array([i[1] for i in items])
    got = fit_budget(size, have, budget)
    assert (got >= 0).all() and (got <= have).all()
    sums = {sum(c * s for c, s in zip(pick, size)) for pick in itertools.product(*(range(h + 1) for h in have))}
    budget = min(budget, int((size * have).sum()))
    assert abs(int((got * size).sum()) - budget) == min(abs(s - budget) for s in sums)


def test_budget_gives_back():
    """Proportional shares alone cannot reach this sum."""
    size, have = np.array([11, 9, 2, 3]), np.array([3, 2, 2, 2])
    assert int((fit_budget(size, have, 46) * size).sum()) == 46
    size, have = np.array([700, 300, 41, 40]), np.array([10_000, 20_000, 500, 500])
    for budget in (9_000_001, 12_345_677, 5):
        near = int((fit_budget(size, have, budget) * size).sum())
        assert near == budget or budget == 5 and near == 0


def expected_targets(sizes, weights=(5, 2, 1)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    whole, fixed = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in fixed]
        rest = whole - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[t] for t in open_) for s in open_}
        above = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not above:
            return {**fixed, **share}
        fixed.update({s: 3 * sizes[s] for s in above})


def test_mix(spark):
    words = lambda n: " ".join("w" for _ in range(n))
    data = [(i, words(1 + i % 7), None, "big", 0) for i in range(400)] + [(1000 + i, words(3), None, "a", 0) for i in range(5)]
    data += [(2000 + i, words(2 + i), None, None, 0) for i in range(6)] + [(3000, None, None, "z", 0), (3001, "", None, "big", 0), (None, "x y", None, "b", None)]
    df = spark.createDataFrame(data, SCHEMA)
    out = mix(df).collect()
    assert len(out) == len(data)
    sizes, taken = {}, {}
    for r in out:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert r.taken <= 3 * r.size and r.taken % max(r.size, 1) == 0
    want = expected_targets(sizes)
    for r in out:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1.0, s
    again = mix(df.repartition(5)).collect()
    assert sorted((r.doc_id or -1, r.taken) for r in out) == sorted((r.doc_id or -1, r.taken) for r in again)


def test_hot_length_and_empty(spark):
    df = spark.createDataFrame([(i, "a b c", None, "s", 0) for i in range(5000)] + [(i + 9000, "q", None, "t", 0) for i in range(9000)], SCHEMA)
    out = mix(df)
    got = {r.source: r for r in out.groupBy("source").agg({"taken": "sum", "target": "max"}).collect()}
    for r in got.values():
        assert abs(r["sum(taken)"] - r["max(target)"]) <= 3
    assert mix(df.limit(0)).count() == 0
