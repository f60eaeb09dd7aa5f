"""Joins and lookups that plain equi-joins do not cover directly."""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

Pair = tuple[str, str]


def _matches(pairs: Sequence[Pair]) -> Column:
    out = None
    for left, right in pairs:
        eq = F.col(left) == F.col(right)
        out = eq if out is None else out & eq
    return out


#: Words of 64 bits in the sieve of ``or_equi_join``: a quarter of a megabyte, whatever the tables hold.
SIEVE_WORDS = 1 << 15


def _place(h: Column) -> tuple[Column, Column]:
    return F.pmod(h, F.lit(SIEVE_WORDS)).cast("int"), F.pmod(F.shiftright(h, 32), F.lit(64)).cast("int")


def key_sieve(hashes: DataFrame) -> Column:
    """Which hashes (column ``h``) occur, as one value of fixed size: an array of bits that a plan computes once.

    Filled by pre-aggregation; ``may_hold`` tests it.  With very many hashes it lets all pass.
    """
    word, bit = _place(F.col("h"))
    filled = hashes.groupBy(word.alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)).alias("bits"))
    every = hashes.sparkSession.range(SIEVE_WORDS).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    merged = filled.unionByName(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    return merged.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda w: w["bits"])).scalar()


def may_hold(sieve: Column, h: Column) -> Column:
    word, bit = _place(h)
    return F.getbit(F.get(sieve, word), bit) == 1


def or_equi_join(left: DataFrame, right: DataFrame, alternatives: Sequence[Sequence[Pair]],
                 left_key: Sequence[str], how: str = "left", probes: DataFrame | None = None, sift: bool = False) -> DataFrame:
    """Join on "any of these equalities" as one equi-join instead of a nested loop.

    ``alternatives`` lists the conditions, each a set of (left column, right column) pairs; the
    column names of both sides must differ.  Each side gives one search row per alternative whose
    columns are all known: its number and its key.  These rows meet in a single shuffled (or, if
    the right side proves small, broadcast) join.  A pair is taken only by the first alternative it
    satisfies, so no duplicate arises and no de-duplication is needed.

    Only ``left_key`` and the compared columns of the left side take part in the search.  They are
    read from ``probes`` if given, a cheaper frame with one row per key that covers the keys of ``left``.
    ``sift``: search rows whose key no right row has are dropped before they are made (``key_sieve``), for a large left side
    of which few rows match.  ``how``: inner, left, left_semi, left_anti.
    """
    compared = list(dict.fromkeys([*left_key, *(a for pairs in alternatives for a, _ in pairs)]))
    semi = how in ("left_semi", "left_anti")
    asked = left.select(*compared).distinct() if probes is None else probes.select(*compared)
    target = right.select(*dict.fromkeys(b for pairs in alternatives for _, b in pairs)).distinct() if semi else right

    def typed(pair: Pair, side: int) -> Column:
        """The column in a type that both sides of the pair can be compared in; text that is no number meets no number."""
        a, b = asked.schema[pair[0]].dataType, target.schema[pair[1]].dataType
        c = F.col(pair[side])
        numbers = isinstance(a, T.NumericType) + isinstance(b, T.NumericType)
        texts = isinstance(a, T.StringType) + isinstance(b, T.StringType)
        if a != b and numbers == 2:
            return c.cast("bigint" if isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType) else "decimal(38,10)")
        return c.try_cast("decimal(38,10)") if numbers == texts == 1 else c

    def as_key(pair: Pair, side: int) -> Column:
        return typed(pair, side).cast("string")

    def matches(pairs: Sequence[Pair]) -> Column:
        return reduce(Column.__and__, (typed(pair, 0) == typed(pair, 1) for pair in pairs))

    def search_keys(side: int) -> list[Column]:
        return [F.concat(*(part for pair in pairs for part in (as_key(pair, side), F.lit("\x1f")))) for pairs in alternatives]

    def searches(df: DataFrame, side: int, tag: str, sieve: Column | None = None) -> DataFrame:
        # lists of none or one, as a subquery may not stand below a higher-order function
        keys = [F.when(key.isNotNull() if sieve is None else key.isNotNull() & may_hold(sieve, F.xxhash64(F.lit(i), key)),
                       F.array(F.struct(F.lit(i).alias("alt"), key.alias("key")))).otherwise(F.array())
                for i, key in enumerate(search_keys(side))]
        rows = df.select("*", F.explode(F.flatten(F.array(*keys))).alias("_s"))
        return rows.select("*", F.col("_s.alt").alias(f"_{tag}_alt"), F.col("_s.key").alias(f"_{tag}_key")).drop("_s")

    sieve = None
    if sift:
        known = [F.when(key.isNotNull(), F.xxhash64(F.lit(i), key)) for i, key in enumerate(search_keys(1))]
        sieve = key_sieve(target.select(F.explode(F.array_compact(F.array(*known))).alias("h")))
    hit = searches(asked, 0, "l", sieve).join(
        searches(target, 1, "r"), (F.col("_l_alt") == F.col("_r_alt")) & (F.col("_l_key") == F.col("_r_key")))
    first = None
    for i, pairs in enumerate(alternatives):
        first = F.when(matches(pairs), i) if first is None else first.when(matches(pairs), i)
    found = hit.filter(first == F.col("_l_alt")).select(
        *(F.col(k).alias(f"_k_{k}") for k in left_key), *([] if semi else right.columns))
    on = None
    for k in left_key:
        eq = F.col(k) == F.col(f"_k_{k}")
        on = eq if on is None else on & eq
    return left.join(found, on, how).drop(*(f"_k_{k}" for k in left_key))


def lookup_one(df: DataFrame, right: DataFrame, keys: Sequence[Pair], value: str, name: str,
               message: str = "lookup returned more than one row") -> DataFrame:
    """Add one looked-up column; a key with two rows is an error, but only if a row asks for it."""
    packed = right.groupBy(*(F.col(b).alias(f"_k{i}") for i, (_, b) in enumerate(keys))).agg(
        F.count(F.lit(1)).alias("_n"), F.max(value).alias("_value"))
    on = None
    for i, (a, _) in enumerate(keys):
        eq = F.col(a) == F.col(f"_k{i}")
        on = eq if on is None else on & eq
    checked = F.when(F.col("_n") > 1, F.raise_error(F.lit(f"{message}: {name}"))).otherwise(F.col("_value"))
    return (df.join(packed, on, "left").withColumn(name, checked)
            .drop("_n", "_value", *(f"_k{i}" for i in range(len(keys)))))


def arg_max_rows(df: DataFrame, keys: Sequence[str], by: str, among: Column | None = None,
                 both_sides: bool = True) -> DataFrame:
    """All rows (ties too) that hold the group's largest ``by``.

    The maximum is pre-aggregated and joined back, so a large group is never gathered in one task.
    ``among`` limits the rows the maximum is taken over; ``both_sides=False`` then lets other rows
    with the same value through as well.
    """
    pool = df if among is None else df.filter(among)
    tops = pool.groupBy(*(F.col(k).alias(f"_k_{k}") for k in keys)).agg(F.max(by).alias("_top"))
    rows = pool if both_sides else df
    on = F.col(by) == F.col("_top")
    for k in keys:
        on = (F.col(k) == F.col(f"_k_{k}")) & on
    return rows.join(tops, on, "left_semi")


def semi(df: DataFrame, keys: DataFrame, on: Sequence[Pair]) -> DataFrame:
    """Rows whose key occurs in the other frame."""
    right = keys.select(*(F.col(b).alias(f"_k{i}") for i, (_, b) in enumerate(on)))
    return df.join(right, _matches([(a, f"_k{i}") for i, (a, _) in enumerate(on)]), "left_semi")


def exists_flag(df: DataFrame, right: DataFrame, on: Sequence[Pair], name: str) -> DataFrame:
    """Add a boolean column: does the key occur in the other frame?  Usable under OR."""
    keys = right.select(*(F.col(b).alias(f"_k{i}") for i, (_, b) in enumerate(on))).distinct().withColumn("_hit", F.lit(True))
    joined = df.join(keys, _matches([(a, f"_k{i}") for i, (a, _) in enumerate(on)]), "left")
    return joined.withColumn(name, F.col("_hit").isNotNull()).drop("_hit", *(f"_k{i}" for i in range(len(on))))


def with_group_count(df: DataFrame, lines: DataFrame, on: Pair, name: str) -> DataFrame:
    """Add the number of rows of ``lines`` per key."""
    counts = lines.groupBy(F.col(on[1]).alias("_k")).agg(F.count(F.lit(1)).alias(name))
    return df.join(counts, F.col(on[0]) == F.col("_k"), "left").drop("_k")


def left_lookup(df: DataFrame, right: DataFrame, on: Sequence[Pair], take: dict[str, str], how: str = "left") -> DataFrame:
    """Join and take some columns of the right side under new names."""
    cols = [F.col(b).alias(f"_k{i}") for i, (_, b) in enumerate(on)]
    side = right.select(*cols, *(F.col(c).alias(n) for n, c in take.items()))
    return df.join(side, _matches([(a, f"_k{i}") for i, (a, _) in enumerate(on)]), how).drop(
        *(f"_k{i}" for i in range(len(on))))


def frequent_keys(df: DataFrame, keys: Sequence[str], support: float = 0.01) -> list[int]:
    """Hashes of the keys that hold more than a share ``support`` of the rows, and of some others: 1 / support at most.

    One pass with a bounded sketch per task; rows with a NULL key do not count.
    """
    known = df.select(*keys).dropna().select(F.xxhash64(*keys).alias("key"))
    return known.stat.freqItems(["key"], support).first()[0] or []


def left_join_skewed(left: DataFrame, right: DataFrame, keys: Sequence[str], sketch: DataFrame | None = None, spread: int = 64) -> DataFrame:
    """Left join on columns of the same names, for keys that are often NULL or that a few values dominate.

    Rows with a NULL key match nothing and would all go to one task; they are dealt over ``spread`` salts instead.  So are the
    rows of the keys that are frequent in ``sketch`` (a cheap frame with about the keys of ``left``), whose right rows are
    repeated for each salt.
    """
    unknown = reduce(Column.__or__, (F.col(k).isNull() for k in keys))
    hot = F.xxhash64(*keys).isin(frequent_keys(sketch, keys)) if sketch is not None else F.lit(False)
    salt = F.when(unknown | hot, F.pmod(F.xxhash64(*left.columns), F.lit(spread)).cast("int")).otherwise(0)
    salts = F.when(hot, F.sequence(F.lit(0), F.lit(spread - 1))).otherwise(F.array(F.lit(0)))
    return left.withColumn("_salt", salt).join(right.withColumn("_salt", F.explode(salts)), [*keys, "_salt"], "left").drop("_salt")


#: Between packed texts, before an escaped character, and a text that is NULL.
_BETWEEN, _ESCAPE, _NULL = "\x1f", "\x1b", "\x1b2"


def pack_texts(df: DataFrame, apart: Collection[str] = (), name: str = "_texts") -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """All text columns but those ``apart`` as one column, and what makes them columns again.

    A row with dozens of short texts is shuffled in far fewer bytes that way.  Equal rows, and no others, are packed to equal
    rows: separators within a text are escaped, and NULL is told from an empty text.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in apart]

    def escaped(c: str) -> Column:
        plain = F.replace(F.replace(F.col(c), F.lit(_ESCAPE), F.lit(f"{_ESCAPE}0")), F.lit(_BETWEEN), F.lit(f"{_ESCAPE}1"))
        return F.coalesce(plain, F.lit(_NULL))

    def text(c: Column) -> Column:
        plain = F.replace(F.replace(c, F.lit(f"{_ESCAPE}1"), F.lit(_BETWEEN)), F.lit(f"{_ESCAPE}0"), F.lit(_ESCAPE))
        return F.when(c != _NULL, plain)

    def unpack(rows: DataFrame) -> DataFrame:
        parts = rows.withColumn(name, F.split(name, _BETWEEN))
        return parts.select(*(c for c in parts.columns if c != name), *(text(F.get(name, F.lit(i))).alias(c) for i, c in enumerate(texts)))

    return df.select(*(c for c in df.columns if c not in texts), F.concat_ws(_BETWEEN, *map(escaped, texts)).alias(name)), unpack


def list_values(df: DataFrame, *cols: str | Column, order: Sequence[str | Column] | None = None) -> DataFrame:
    """Distinct values for a parameter list, NULL last."""
    out = df.select(*(cols or df.columns)).distinct()
    keys = order if order is not None else out.columns
    return out.orderBy(*(F.asc_nulls_last(k) if isinstance(k, str) else k for k in keys))


def mask_columns(df: DataFrame, cols: Sequence[str], when: Column) -> DataFrame:
    hide = F.coalesce(when, F.lit(False))
    return df.withColumns({c: F.when(~hide, F.col(c)) for c in cols})


def chain(df: DataFrame, *steps: Callable[[DataFrame], DataFrame]) -> DataFrame:
    for step in steps:
        df = df.transform(step)
    return df
