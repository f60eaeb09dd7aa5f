import datetime as dt
import itertools
import random
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window, functions as F

from ledgerloom.operators import relational as R, temporal as T, tree, windows as W
from tests.conftest import rows

D = dt.date


# ---- temporal ----

HISTORY = [(1, D(2020, 1, 1), D(2020, 12, 31)), (2, D(2020, 6, 1), None), (3, None, None), (4, D(2020, 5, 1), D(2020, 4, 1)), (5, D(2020, 7, 1), D(2020, 7, 1))]


def test_as_of_edges(spark):
    df = spark.createDataFrame(HISTORY, "i int, s date, e date")

    def at(day, **kw):
        return [r[0] for r in rows(T.as_of(df, F.lit(day), "s", "e", **kw), "i")]
    assert at(D(2020, 1, 1)) == [1] and at(D(2020, 12, 31)) == [1] and at(D(2021, 1, 1)) == [] and at(D(2019, 12, 31)) == []
    assert at(D(2020, 7, 1)) == [1, 5]
    assert at(D(2021, 1, 1), open_end=True) == [2]
    assert at(D(2021, 1, 1), allow_missing=True) == [2, 3]


def test_overlap_short_form_equals_long_form(spark):
    days = [None] + [D(2020, 1, i) for i in range(1, 6)]
    cases = [(lo, hi, s, e) for lo in days[1:] for hi in days for s in days for e in days]
    df = spark.createDataFrame(cases, "lo date, hi date, s date, e date")
    today = F.lit(D(2020, 1, 3))
    short = T.overlaps(F.col("lo"), F.col("hi"), F.col("s"), F.col("e"), today)
    long = ((F.col("s") >= F.col("lo")) | F.col("lo").between(F.col("s"), F.col("e"))) & (F.col("e") >= F.col("lo")) & (
        (F.col("s") <= F.when(F.col("hi").isNotNull(), F.col("hi"))) | (F.col("s") <= F.when(F.col("hi").isNull(), today)))
    assert df.filter(F.coalesce(short, F.lit(False)) != F.coalesce(long, F.lit(False))).count() == 0


def test_as_of_join_cells_change_nothing(spark):
    rnd = random.Random(7)
    # one key holds a third of both sides
    key = lambda: 0 if rnd.random() < 0.34 else rnd.randrange(1, 20)
    day = lambda: D(1890, 1, 1) + dt.timedelta(days=rnd.randrange(0, 90000))
    points = spark.createDataFrame([(i, key(), day()) for i in range(400)], "i int, k int, d date")
    spans = [(j, key(), s, s + dt.timedelta(days=rnd.randrange(-5, 9000)) if rnd.random() < 0.8 else D(4712, 12, 31))
             for j in range(300) for s in [day()]]
    spans = spark.createDataFrame([*spans, (900, 0, D(1950, 1, 1), None)], "j int, k int, s date, e date")
    plain = rows(T.as_of_join(points, spans, ["k"], "d", "s", "e"), "i", "j", "s", "e")
    celled = rows(T.as_of_join(points, spans, ["k"], "d", "s", "e", cell_years=5), "i", "j", "s", "e")
    assert plain == celled and len(plain) > 1000
    kept = T.as_of_join(points, spans, ["k"], "d", "s", "e", "left")
    assert kept.select("i").distinct().count() == 400
    odd = points.union(spark.createDataFrame([(500, None, D(1990, 1, 1)), (501, 0, None), (502, 99, D(1990, 1, 1)), (501, 0, None)], "i int, k int, d date"))
    for how in ("left", "left_semi", "left_anti"):
        cols = ["i", "j", "s", "e"] if how == "left" else ["i"]
        want = T.as_of_join(odd, spans, ["k"], "d", "s", "e", how)
        for years in (1, 30):
            got = T.as_of_join(odd, spans, ["k"], "d", "s", "e", how, cell_years=years, horizon=(1950, 2050))
            assert rows(got, *cols) == rows(want, *cols) and got.columns == want.columns


def test_version_as_of(spark):
    archive = spark.createDataFrame([("a", 1, 0, 2), ("b", 1, 2, T.OPEN_VERSION), ("c", 2, 1, T.OPEN_VERSION)], "n string, h int, from_co_seq int, to_co_seq int")
    versions = spark.createDataFrame([(1, 0), (1, 1), (1, 2), (1, 3), (2, 0), (2, 1)], "h int, co_sequence int")
    assert rows(T.version_as_of(archive, versions, ["h"]), "n", "co_sequence") == [
        ("a", 0), ("a", 1), ("b", 2), ("b", 3), ("c", 1)]


def test_changes_at(spark):
    open_ = T.OPEN_VERSION
    versions = spark.createDataFrame([(1, 0), (1, 1), (1, 2)], "h int, co_sequence int")
    lines = spark.createDataFrame([(1, 1, 0, open_), (1, 2, 0, 2), (1, 3, 1, open_), (1, 4, 0, open_), (1, 5, 2, 2), (1, 6, 7, open_)], "h int, po_line_id int, from_co_seq int, to_co_seq int")
    ships = spark.createDataFrame([(1, 1, open_), (2, 1, open_)], "po_line_id int, from_co_seq int, to_co_seq int")
    dists = spark.createDataFrame([(1, 2, 3), (4, 1, open_), (4, 1, open_), (3, 0, open_)], "po_line_id int, from_co_seq int, to_co_seq int")
    got = T.changes_at(lines, versions, ["h"], [ships, dists], "po_line_id")
    assert rows(got, "po_line_id", "co_sequence") == [(1, 0), (1, 1), (2, 0), (3, 1), (4, 0), (4, 1)]
    assert rows(T.changes_at(lines, versions, ["h"]), "po_line_id", "co_sequence") == [(1, 0), (2, 0), (3, 1), (4, 0)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_version_joins_equal_range_joins(spark, seed):
    """Random documents, one of them hot; gaps, empty stretches, versions twice, NULLs."""
    rnd = random.Random(seed)
    doc = lambda: rnd.choice([1, 1, 1, 2, 3, None])
    end = lambda: rnd.choice([None, T.OPEN_VERSION, rnd.randrange(40), rnd.randrange(40)])
    archive = [(doc(), rnd.randrange(8), i, rnd.choice([None, *range(20)]), end()) for i in range(150)]
    child = [(rnd.randrange(8), rnd.randrange(30), end()) for _ in range(60)]
    versions = [(doc(), rnd.choice([rnd.randrange(40), rnd.randrange(10)])) for _ in range(60)]
    a = spark.createDataFrame(archive, "h int, line int, n int, from_co_seq int, to_co_seq int")
    v = spark.createDataFrame(versions, "h int, co_sequence int")
    c = spark.createDataFrame(child, "line int, from_co_seq int, to_co_seq int")
    meet = [(r, s) for r in archive for s in versions if None not in (r[0], r[3], r[4]) and r[0] == s[0] and r[3] <= s[1] < r[4]]
    assert rows(T.version_as_of(a, v, ["h"]), "n", "co_sequence") == sorted(((r[2], s[1]) for r, s in meet), key=lambda t: tuple((x is None, str(x)) for x in t))
    moved = {(k, low) for k, low, high in child if high == T.OPEN_VERSION}
    kept = [(r[2], s[1]) for r, s in meet if r[3] == s[1] or (r[4] == T.OPEN_VERSION and (r[1], s[1]) in moved)]
    assert rows(T.changes_at(a, v, ["h"], [c], "line"), "n", "co_sequence") == sorted(kept, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_document_of_many_lines_and_versions(spark):
    """10,000 lines and 1,000 versions of one document: no pair of rows is compared that does not match."""
    lines = spark.range(10_000).select(F.lit(1).alias("h"), F.col("id").alias("po_line_id"), F.lit(0).alias("from_co_seq"), F.lit(T.OPEN_VERSION).alias("to_co_seq"))
    history = spark.range(1000).select(F.lit(1).alias("h"), F.col("id").alias("from_co_seq"), (F.col("id") + 1).alias("to_co_seq"))
    ships = spark.range(5000).select((F.col("id") * 2).alias("po_line_id"), (F.col("id") % 1000).alias("from_co_seq"), F.lit(T.OPEN_VERSION).alias("to_co_seq"))
    versions = spark.range(1000).select(F.lit(1).alias("h"), F.col("id").alias("co_sequence"))
    changed = T.changes_at(lines, versions, ["h"], [ships], "po_line_id")
    assert changed.count() == 10_000 + 5000 - 5
    heads = T.version_as_of(history, versions, ["h"])
    assert heads.count() == 1000
    for df in (changed, heads):
        assert "SortMergeJoin" in (plan := df._jdf.queryExecution().executedPlan().toString()) or "BroadcastHashJoin" in plan
        assert not re.search(r"Join .*(<=|>=|<|>) ", plan)


# ---- joins ----


def shares(df):
    """Rows per partition, the largest first, of a plan whose shuffles stay as they are."""
    return sorted((r[1] for r in df.groupBy(F.spark_partition_id()).count().collect()), reverse=True)


def test_skewed_left_join(spark):
    """90 of 100 rows without a link, and one link that holds most of the others."""
    left = spark.range(20_000).select(
        F.col("id"), F.when(F.col("id") % 10 == 0, F.when(F.col("id") % 40 == 0, F.col("id") % 700).otherwise(7)).alias("link"), F.lit("t").alias("link_table"))
    right = spark.range(700).select(F.col("id").alias("link"), F.lit("t").alias("link_table"), (F.col("id") * 2).alias("v")).union(
        spark.createDataFrame([(7, "t", -1), (None, "t", -2), (7, None, -3)], "link long, link_table string, v long"))
    want = rows(left.join(right, ["link", "link_table"], "left"), "id", "link", "v")
    assert R.frequent_keys(left, ["link", "link_table"]) and len(R.frequent_keys(left, ["link", "link_table"], 0.1)) <= 10
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        for sketch in (None, left):
            got = R.left_join_skewed(left, right, ["link", "link_table"], sketch)
            assert rows(got, "id", "link", "v") == want and got.columns == left.join(right, ["link", "link_table"], "left").columns
            if sketch is not None:
                assert shares(got)[0] < 0.3 * len(want)
        assert shares(left.join(right, ["link", "link_table"], "left"))[0] > 0.8 * len(want)
        assert R.left_join_skewed(left.limit(0), right, ["link"], left.limit(0)).count() == 0
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)

ALTERNATIVES = [[("a1", "b1"), ("a2", "b2")], [("a3", "b1")], [("a4", "b3"), ("a2", "b4")]]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("seed", [1, 2])
def test_or_join_equals_nested_loop(spark, how, seed):
    rnd = random.Random(seed)
    v = lambda: None if rnd.random() < 0.2 else rnd.randrange(6)
    t = lambda: None if rnd.random() < 0.2 else rnd.choice("xyz")
    # the key repeats: several distributions of one line
    base = [(k, v(), v(), v(), t()) for k in range(60)]
    left = spark.createDataFrame([(i, *base[i % 60]) for i in range(90)], "i int, k int, a1 int, a2 int, a3 int, a4 string")
    right = spark.createDataFrame([(j % 30, v(), v(), t(), v()) for j in range(35)], "j int, b1 int, b2 int, b3 string, b4 int")
    cond = None
    for pairs in ALTERNATIVES:
        c = None
        for a, b in pairs:
            eq = F.col(a) == F.col(b)
            c = eq if c is None else c & eq
        cond = c if cond is None else cond | c
    want = left.join(right, cond, how)
    got = R.or_equi_join(left, right, ALTERNATIVES, ["k"], how)
    assert rows(got, *want.columns) == rows(want)
    probes = left.drop("i").distinct()  # one row per key
    assert rows(R.or_equi_join(left, right, ALTERNATIVES, ["k"], how, probes), *want.columns) == rows(want)
    assert rows(R.or_equi_join(left, right, ALTERNATIVES, ["k"], how, probes, sift=True), *want.columns) == rows(want)
    assert rows(R.or_equi_join(left, right.limit(0), ALTERNATIVES, ["k"], how, sift=True), "i") == rows(left.join(right.limit(0), cond, how), "i")
    assert "NestedLoop" not in plan_of(got) and "Cartesian" not in plan_of(got)


def test_sieve(spark):
    """A sieve keeps what occurs and little else; of many search rows those without a partner are never made."""
    keys = spark.range(0, 40_000, 4).select(F.xxhash64("id").alias("h"))
    sieve = R.key_sieve(keys)
    passed = [r[0] for r in spark.range(40_000).filter(R.may_hold(sieve, F.xxhash64("id"))).collect()]
    assert set(range(0, 40_000, 4)) <= set(passed) and len(passed) < 10_300
    left = spark.range(20_000).select("id", (F.col("id") % 5000).alias("a1"), (F.col("id") + 10**6).alias("a2"))
    right = spark.range(10).select((F.col("id") * 7).alias("b1"), F.col("id").alias("b2"))
    alternatives = [[("a1", "b1")], [("a2", "b2")]]
    # a filter that a search row must pass stands in the plan below the generator
    got = R.or_equi_join(left, right, alternatives, ["id"], "inner", sift=True)
    assert got.count() == 40 == R.or_equi_join(left, right, alternatives, ["id"], "inner").count()
    assert plan_of(got).count("scalar-subquery") + plan_of(got).count("Subquery") > 0


def test_or_join_across_number_types(spark):
    left = spark.createDataFrame([(1, 5), (2, 6)], "k int, a int")
    right = spark.createDataFrame([(5.0,), (7.0,)], "b double").select(F.col("b").cast("decimal(18,2)").alias("b"))
    assert rows(R.or_equi_join(left, right, [[("a", "b")]], ["k"], "left_semi"), "k") == [(1,)]
    assert rows(R.or_equi_join(left, right.select(F.col("b").cast("bigint").alias("b")), [[("a", "b")]], ["k"], "left_semi"), "k") == [(1,)]
    # numbers held as text: leading zeros are equal, other text meets nothing and ends nothing
    texts = spark.createDataFrame([("005", "q"), ("x7", "q"), (None, "q")], "b string, d string")
    two = [[("c", "d")], [("a", "b")]]
    asked = spark.createDataFrame([(1, 5, "-"), (2, 7, "q"), (3, 8, "-")], "k int, a bigint, c string")
    assert rows(R.or_equi_join(asked, texts, [[("a", "b")]], ["k"], "left_semi"), "k") == [(1,)]
    assert rows(R.or_equi_join(asked, texts, two, ["k"], "inner"), "k") == [(1,), (2,), (2,), (2,)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_one(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1, "x"), (3, "y"), (3, "z")], "r int, v string")
    assert rows(R.lookup_one(left, right, [("k", "r")], "v", "got")) == [(1, "x"), (2, None), (None, None)]
    with pytest.raises(PySparkException, match="more than one row"):
        R.lookup_one(left.unionByName(spark.createDataFrame([(3,)], "k int")), right, [("k", "r")], "v", "got").collect()


def test_arg_max_rows(spark):
    df = spark.createDataFrame([("a", 1, "H"), ("a", 3, "H"), ("a", 3, "W"), ("a", 9, "W"), ("b", None, "H"), ("c", 2, "W")], "k string, v int, t string")
    assert rows(R.arg_max_rows(df, ["k"], "v"), "k", "v") == [("a", 9), ("c", 2)]
    home = F.col("t") == "H"
    assert rows(R.arg_max_rows(df, ["k"], "v", among=home), "k", "v", "t") == [("a", 3, "H")]
    assert rows(R.arg_max_rows(df, ["k"], "v", among=home, both_sides=False), "k", "v", "t") == [("a", 3, "H"), ("a", 3, "W")]
    ties = spark.createDataFrame([("a", 3, 1), ("a", 3, 2), ("a", 1, 3)], "k string, v int, i int")
    assert rows(R.arg_max_rows(ties, ["k"], "v"), "i") == [(1,), (2,)]


def test_flags_counts_and_masks(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    other = spark.createDataFrame([(1,), (1,), (None,)], "r int")
    assert rows(R.exists_flag(df, other, [("k", "r")], "hit")) == [(1, True), (2, False), (None, False)]
    assert rows(R.semi(df, other, [("k", "r")])) == [(1,)]
    assert rows(R.with_group_count(df, other, ("k", "r"), "n")) == [(1, 2), (2, None), (None, None)]
    assert rows(R.mask_columns(df.withColumn("p", F.lit(5)), ["p"], F.col("k") == 1)) == [(1, None), (2, 5), (None, 5)]
    assert [r[0] for r in R.list_values(other).collect()] == [1, None]


# ---- windows ----

def hot_events(spark, n=900, seed=3):
    rnd = random.Random(seed)
    return spark.createDataFrame(
        [(i, 0 if rnd.random() < 0.4 else rnd.randrange(1, 30), rnd.randrange(0, 400), rnd.randrange(100) if rnd.random() < 0.15 else None) for i in range(n)],
        "i int, k int, t int, v int")


@pytest.mark.parametrize("width", [1, 7, 50, 1000])
def test_fill_and_lag_do_not_depend_on_chunks(spark, width):
    df = hot_events(spark)
    w = Window.partitionBy("k").orderBy("t", "i")
    literal = df.withColumn("f", F.coalesce("v", *(F.lag("v", n).over(w) for n in range(1, 8))))
    chunk = F.floor(F.col("t") / width)
    assert rows(W.fill_previous(df, {"f": "v"}, ["k"], ["t", "i"], 7, chunk), "i", "f") == rows(literal, "i", "f")
    assert rows(W.fill_previous(df, {"f": "v"}, ["k"], ["t", "i"], 7), "i", "f") == rows(literal, "i", "f")
    lags = df.select("i", *(F.lag("v", n).over(w).alias(f"lag_{n}") for n in range(1, 4)))
    assert rows(W.lag_steps(df, "v", ["k"], ["t", "i"], 3, chunk=chunk), *lags.columns) == rows(lags)


def test_fill_reaches_seven_rows_and_stays_in_its_order(spark):
    df = spark.createDataFrame([(1, 0, 5)] + [(1, n, None) for n in range(1, 9)] + [(2, 0, None)], "k int, t int, v int")
    got = dict(((r.k, r.t), r.f) for r in W.fill_previous(df, {"f": "v"}, ["k"], ["t"], 7).collect())
    assert got[(1, 1)] == 5 and got[(1, 7)] == 5 and got[(1, 8)] is None and got[(2, 0)] is None


def test_global_row_number(spark):
    df = hot_events(spark)
    want = df.withColumn("n", F.row_number().over(Window.orderBy("k", "i")).cast("bigint") + 999)
    assert rows(W.global_row_number(df, ["k", "i"], "n", 999), "i", "n") == rows(want, "i", "n")


def test_dense_rank_global(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",)], "c string")
    assert rows(W.dense_rank_global(df, "c", "r")) == [("a", 3), ("b", 2), ("b", 2), ("c", 1)]
    near_unique = spark.range(0, 30_000, 1, 8).select(F.col("id"), F.when(F.col("id") % 1000 != 3, F.col("id") * 7919 % 29_000).alias("c"))
    for descending in (True, False):
        key = F.desc_nulls_first("c") if descending else F.asc_nulls_last("c")
        want = near_unique.withColumn("r", F.dense_rank().over(Window.orderBy(key)).cast("bigint"))
        got = W.dense_rank_global(near_unique, "c", "r", descending)
        assert got.exceptAll(want).isEmpty() and got.count() == 30_000
        assert "SinglePartition" not in plan_of(got) and "Window" not in plan_of(got)


@pytest.mark.parametrize("size", [0, 1, 2, 6, 7, 9])
def test_slots(spark, size):
    df = spark.createDataFrame([("g", i, f"v{i}") for i in range(size)] + [("z", 0, "only")], "g string, i int, v string")
    got = {r.g: r for r in W.first_slots(df, ["g"], ["i"], 8, ["g"], {"one": ("v", [1]), "rest": ("v", range(2, 9))}).collect()}
    assert (got["z"].one, got["z"].rest) == ("only", None)
    if size:
        assert got["g"].one == "v0"
        assert got["g"].rest == (f"v{min(size, 8) - 1}" if size > 1 else None)
    assert "WindowGroupLimit" in plan_of(W.top_n(df, ["g"], [F.asc("i")], 3))


def test_slots_of_finer_groups_and_null_rank_last(spark):
    df = spark.createDataFrame([("g", "h1", None, "late"), ("g", "h1", 1, "first"), ("g", "h2", 2, "second"), ("g", "h3", 3, "third")], "g string, h string, r int, v string")
    got = rows(W.first_slots(df, ["g"], ["r"], 2, ["g", "h"], {"one": ("v", [1]), "two": ("v", [2])}))
    assert got == [("g", "h1", "first", None), ("g", "h2", None, "second"), ("g", "h3", None, None)]


# ---- tree ----

def test_flatten_tree(spark):
    nodes = spark.createDataFrame([
        (1, None, 0, "R"), (2, 1, 1, "G"), (3, 2, 2, "C1"), (4, 1, 2, "C2"), (5, None, 0, "LONE"), (6, None, 0, "OLD"), (7, 6, 2, "C1"), (8, 2, 2, "NOTEXT")],
        "tree_node_id int, parent_tree_node_id int, depth int, pk1_start_value string").withColumn("tree_version_id", F.lit(1))
    values = spark.createDataFrame([("R", "root"), ("G", "group"), ("C1", "one"), ("C2", "two"), ("OLD", "Historical Cost Centres"), ("LONE", "lone")], "flex_value string, description string")
    assert rows(tree.flatten_tree(nodes, values)) == [("R", "root", "G", "group", "C1", "one"), ("R", "root", None, None, "C2", "two")]


def test_random_semi_matches_itertools(spark):
    pairs = list(itertools.product(range(3), range(2)))
    df = spark.createDataFrame(pairs, "a int, b int")
    keys = spark.createDataFrame([(0, 1), (2, 0), (2, 0)], "x int, y int")
    assert rows(R.semi(df, keys, [("a", "x"), ("b", "y")])) == [(0, 1), (2, 0)]
