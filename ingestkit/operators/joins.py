"""Full outer equi-join.

``full_outer_join`` is Spark's own full outer join: one scan and one shuffle
a side.  Rows whose join key is null can never match; with
``spread_null_keys`` they are dealt over all tasks instead of hashing into one.

``split_outer_join`` has the same rows, computed as

    left LEFT JOIN right
    ∪  right LEFT ANTI JOIN matched
       where matched = distinct(left keys JOIN distinct(right keys))

It reads the sides two and three times.  In return a small right side (a
change feed against a large table) is broadcast after Spark's own size check
and the left side is never shuffled, and AQE can split a hot key of the left
side, which it cannot in a full outer join.  The caller chooses.

``spread_outer_join`` splits heavy keys.  Frequent-items sketches of both sides,
merged across tasks, find the keys that hold more than a share of a side's rows;
rows of such a key are dealt over ``salts`` tasks, the other side's rows of it are
copied to each, and a right row without a partner is found by an anti join with
the few heavy keys that the left side has.  All other rows take the plain join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _any_null(df: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [df[k].isNull() for k in keys])


def _padded(df: DataFrame, other: DataFrame, keep_left: bool) -> DataFrame:
    """``df`` with null columns standing in for ``other``'s columns."""
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in other.schema.fields]
    cols = [df[c] for c in df.columns]
    return df.select(*(cols + nulls if keep_left else nulls + cols))


def _sides(left: DataFrame, right: DataFrame, left_keys: Sequence[str],
           right_keys: Sequence[str] | None) -> tuple[list[str], list[str]]:
    rk, lk = list(right_keys or left_keys), list(left_keys)
    if len(lk) != len(rk) or not lk:
        raise ValueError("need the same, non-zero number of keys on both sides")
    clash = set(left.columns) & set(right.columns)
    if clash:
        raise ValueError(f"column names appear on both sides: {sorted(clash)}")
    return lk, rk


def _all_equal(pairs, null_safe: bool) -> Column:
    # by name (the two sides' names are distinct), so a self-join of frames
    # with a common lineage stays unambiguous
    return reduce(lambda x, y: x & y, [
        F.col(a).eqNullSafe(F.col(b)) if null_safe else F.col(a) == F.col(b) for a, b in pairs])


def full_outer_join(left: DataFrame, right: DataFrame, left_keys: Sequence[str],
                    right_keys: Sequence[str] | None = None, *, null_safe: bool = False,
                    spread_null_keys: bool = False) -> DataFrame:
    """Full outer equi-join; output = left columns then right columns.

    Column names of the two sides must be distinct.  ``null_safe=True``
    matches keys with ``<=>`` (null is one key value).  Otherwise null keys
    never match; ``spread_null_keys=True`` adds a spread of those rows to the
    join keys, worth it where many rows have none.
    """
    lk, rk = _sides(left, right, left_keys, right_keys)
    columns = [*left.columns, *right.columns]
    cond = _all_equal(zip(lk, rk, strict=True), null_safe)
    if spread_null_keys and not null_safe:
        def spread(df: DataFrame, keys: list[str], name: str) -> DataFrame:
            return df.withColumn(name, F.when(_any_null(df, keys), F.xxhash64(*df.columns)).otherwise(F.lit(0)))
        left, right = spread(left, lk, "__l_spread"), spread(right, rk, "__r_spread")
        cond = cond & (F.col("__l_spread") == F.col("__r_spread"))
    return left.join(right, cond, "full").select(*columns)


def split_outer_join(left: DataFrame, right: DataFrame, left_keys: Sequence[str],
                     right_keys: Sequence[str] | None = None, *, null_safe: bool = False) -> DataFrame:
    """The rows of :func:`full_outer_join` for a small or a skewed side; see
    the module docstring."""
    lk, rk = _sides(left, right, left_keys, right_keys)
    if null_safe:
        keyed_l, null_l, keyed_r, null_r = left, None, right, None
    else:
        l_null, r_null = _any_null(left, lk), _any_null(right, rk)
        keyed_l, null_l = left.where(~l_null), left.where(l_null)
        keyed_r, null_r = right.where(~r_null), right.where(r_null)
    joined = keyed_l.join(keyed_r, _all_equal(zip(lk, rk, strict=True), null_safe), "left") \
        .select(*left.columns, *right.columns)
    lkeys = keyed_l.select(*[F.col(k).alias(f"__lk{i}") for i, k in enumerate(lk)])
    rkeys = keyed_r.select(*[F.col(k).alias(f"__rk{i}") for i, k in enumerate(rk)]).distinct()
    matched = lkeys.join(rkeys, _all_equal([(f"__lk{i}", f"__rk{i}") for i in range(len(rk))], null_safe), "inner") \
        .select(*rkeys.columns).distinct()
    right_only = keyed_r.join(matched, _all_equal([(k, f"__rk{i}") for i, k in enumerate(rk)], null_safe), "left_anti")
    if null_r is not None:
        right_only = right_only.unionByName(null_r)
    out = joined.unionByName(_padded(right_only, left, keep_left=False))
    return out if null_l is None else out.unionByName(_padded(null_l, right, keep_left=True))


MAX_HEAVY_KEYS = 256


def heavy_keys(df: DataFrame, keys: Sequence[str], share: float, limit: int = MAX_HEAVY_KEYS) -> dict[int, int]:
    """Hashes of the keys that hold more than ``share`` of the rows, with their
    estimated counts (``limit`` of them at most can be above 1 / limit).  Rows
    with a null key part are not counted: they match nothing."""
    hashed = df.where(~_any_null(df, keys)).select(F.xxhash64(*keys).alias("h"))
    found = hashed.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(h, {limit}, {64 * limit})").alias("top")).first()
    return {r["item"]: r["count"] for r in found.top or [] if r["count"] > share * found.n}


def spread_outer_join(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str] | None = None, *,
                      share: float = 0.01, salts: int = 64) -> DataFrame:
    """The rows of :func:`full_outer_join` (null keys match nothing), with heavy
    keys spread over ``salts`` tasks each.  Reads both sides once more, for the
    sketches."""
    lk, rk = _sides(left, right, left_keys, right_keys)
    in_left, in_right = heavy_keys(left, lk, share), heavy_keys(right, rk, share)
    # a key that is heavy on both sides is dealt on the side that has more of it
    right_only = {h for h, n in in_right.items() if n > in_left.get(h, 0)}
    heavy = {"left": sorted(set(in_left) - right_only), "right": sorted(right_only)}
    every = [*heavy["left"], *heavy["right"]]
    if not every:
        return full_outer_join(left, right, lk, rk, spread_null_keys=True)

    def among(keys: list[str], hashes: list[int]) -> Column:
        return F.coalesce(F.xxhash64(*keys).isin(hashes), F.lit(False))

    def keyed(df: DataFrame, keys: list[str], hashes: list[int]) -> DataFrame:
        return df.where(~_any_null(df, keys) & among(keys, hashes))

    rest = full_outer_join(left.where(_any_null(left, lk) | ~among(lk, every)), right.where(_any_null(right, rk) | ~among(rk, every)),
                           lk, rk, spread_null_keys=True)
    columns = [*left.columns, *right.columns]
    for dealt, hashes in heavy.items():
        if hashes:
            many, few = (left, right) if dealt == "left" else (right, left)
            mk, fk = (lk, rk) if dealt == "left" else (rk, lk)
            rest = rest.unionByName(_dealt(keyed(many, mk, hashes), keyed(few, fk, hashes), mk, fk, salts).select(*columns))
    return rest


def _dealt(many: DataFrame, few: DataFrame, mk: list[str], fk: list[str], salts: int) -> DataFrame:
    """Full outer join in which the rows of ``many`` are dealt over salts."""
    salted = many.withColumn("__salt_m", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(salts)))
    copies = few.withColumn("__salt_f", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    same = _all_equal(zip(mk, fk, strict=True), False)
    joined = salted.join(copies, same & (F.col("__salt_m") == F.col("__salt_f")), "left").drop("__salt_m", "__salt_f")
    # at most as many rows as there are heavy keys
    there = many.select(*[F.col(k).alias(f"__there{i}") for i, k in enumerate(mk)]).distinct()
    alone = few.join(F.broadcast(there), _all_equal([(k, f"__there{i}") for i, k in enumerate(fk)], False), "left_anti")
    return joined.unionByName(_padded(alone, many, keep_left=False))
