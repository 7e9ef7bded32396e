"""De-duplication and the de-duplicating, insert-only merge.

``dedup_first`` keeps the first row per natural key.  It is written as
``row_number() = 1`` so that Catalyst plans a WindowGroupLimit in two
phases: a partial top-1 per key *before* the shuffle (a key that holds a
third of the rows is cut down to one row per map task) and a final one
after it.

``merge_insert_only`` inserts the source rows whose key is not yet in
the target inside a date window and never changes existing rows: one anti
join of the de-duplicated source with the target's distinct keys of the
window (partition pruning applies to a date-partitioned target; ``distinct``
combines hot keys map-side), followed by an append.  The source is read once;
its de-duplication and the join share one shuffle.  Two semantics:

* default - the window is applied to the source as a filter and keys
  match null-safely, so running the same merge twice inserts nothing.
* compat  - the window only takes part in the match condition (a source
  row outside it can never match and is inserted on every run) and keys
  use plain ``=`` (a null key never matches), as the original MERGE did.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order_cols(order_by: Sequence[str | Column]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order_by]


def dedup_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column],
                tie_breakers: Sequence[str | Column] = ()) -> DataFrame:
    """First row per ``keys`` by ``order_by`` then ``tie_breakers``.

    Pass tie-breakers that make (keys, order) unique, otherwise the survivor
    among tied rows is arbitrary (the original job ordered by a key column,
    so every row tied).
    """
    if not keys:
        raise ValueError("dedup_first needs at least one key column")
    w = Window.partitionBy(*keys).orderBy(*_order_cols(order_by), *_order_cols(tie_breakers))
    rn = "__row_num"
    return df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) == 1).drop(rn)


def _bounds(col: Column, lower, upper) -> Column:
    conds = []
    if lower is not None:
        conds.append(col >= F.lit(lower).cast("date"))
    if upper is not None:
        conds.append(col < F.lit(upper).cast("date"))
    return reduce(lambda a, b: a & b, conds) if conds else F.lit(True)


# What stands for null in a key column, next to a flag that says so.
_SIMPLE = ("string", "date", "timestamp", "timestamp_ntz", "boolean", "binary", "tinyint", "smallint", "int", "bigint",
           "float", "double", "decimal")
_STAND_IN = {"string": "", "date": "1970-01-01", "timestamp": "1970-01-01 00:00:00",
             "timestamp_ntz": "1970-01-01 00:00:00", "boolean": "false", "binary": ""}


def _key_parts(df: DataFrame, keys: Sequence[str], prefix: str, null_safe: bool) -> list[Column]:
    """The join key columns: as they are, or as (value, is null) pairs that
    compare null-safely with plain ``=`` and so share a partitioning."""
    out = []
    for i, k in enumerate(keys):
        if not null_safe:
            out.append(F.col(k).alias(f"{prefix}{i}"))
            continue
        kind = df.schema[k].dataType
        if kind.simpleString().split("(")[0] not in _SIMPLE:
            raise ValueError(f"key {k} is of type {kind.simpleString()}; merge keys are of simple types")
        stand_in = F.lit(_STAND_IN.get(kind.simpleString().split("(")[0], "0")).cast(kind)
        out += [F.coalesce(F.col(k), stand_in).alias(f"{prefix}{i}"), F.col(k).isNull().alias(f"{prefix}{i}n")]
    return out


FILTER_BYTES = 8 << 20          # of the key filter, whatever the number of keys
_PIECE = 4096                   # bytes of one bitmap
MAX_PARTITION_VALUES = 10_000


def _slot(parts: Sequence[str], filter_bytes: int) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(filter_bytes * 8))


def with_key_filter(target: DataFrame, source: DataFrame, target_keys: Sequence[str], source_keys: Sequence[str],
                    filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """The target rows whose key may be in the source: a Bloom filter of the
    source's keys, built by an aggregation of bitmaps (one hash, so many keys make
    it let more rows pass) and broadcast: at most ``filter_bytes``, however large
    the source is."""
    slots = source.select(_slot(source_keys, filter_bytes).alias("__slot"))
    pieces = slots.groupBy(F.expr(f"__slot div {_PIECE * 8}").alias("__piece")).agg(
        F.bitmap_construct_agg(F.expr(f"__slot % {_PIECE * 8}")).alias("__bits"))
    marked = target.withColumn("__slot", _slot(target_keys, filter_bytes))
    marked = marked.join(F.broadcast(pieces), F.expr(f"__slot div {_PIECE * 8}") == F.col("__piece"))
    at = F.expr(f"cast((__slot % {_PIECE * 8}) div 8 as int)") + 1
    byte = F.conv(F.hex(F.substring("__bits", at, F.lit(1))), 16, 10).cast("int")
    return marked.where(F.getbit(byte, F.expr("cast(__slot % 8 as int)")) == 1).select(*target.columns)


def with_source_partitions(target: DataFrame, source: DataFrame, partition_keys: Sequence[str],
                           limit: int = MAX_PARTITION_VALUES) -> DataFrame:
    """The target's partitions that the source has rows for, as a filter that
    reaches the scan.  ``partition_keys`` are merge keys that the target is
    partitioned by.  Beyond ``limit`` values a column is not filtered."""
    for key in partition_keys:
        values = [r[0] for r in source.select(key).distinct().limit(limit + 1).collect()]
        if len(values) <= limit:
            there = F.col(key).isin([v for v in values if v is not None])
            target = target.where(there | F.col(key).isNull() if None in values else there)
    return target


def merge_new_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], *,
                   order_by: Sequence[str | Column], tie_breakers: Sequence[str | Column] = (),
                   bound_column: str | None = None, lower=None, upper=None,
                   mode: str = "default", columns: Sequence[str] | None = None,
                   partition_keys: Sequence[str] = (), key_filter: bool = False) -> DataFrame:
    """The rows an insert-only merge adds to ``target`` (not yet appended),
    in the target's columns.

    ``order_by`` and ``tie_breakers`` decide which source row of a key is
    inserted.  ``lower``/``upper`` form the half-open window ``[lower, upper)``
    on ``bound_column`` for both sides.  ``columns`` is the insert column list
    (default: all); the target's other columns are null in the inserted rows.

    A source that is small against the target can prune it, at the price of
    reading the source once more for each: ``partition_keys`` (merge keys that
    the target is partitioned by) skips partitions without a source row, and
    ``key_filter`` drops target rows before their shuffle by a Bloom filter of the
    source's keys.  The exact join decides either way.
    """
    if mode not in ("default", "compat"):
        raise ValueError(f"mode must be 'default' or 'compat', not {mode!r}")
    if not order_by:
        raise ValueError("a merge needs order_by, else the row inserted for a key is arbitrary")
    null_safe = mode == "default"
    listed = list(columns or target.columns)
    out = [F.col(f.name) if f.name in listed else F.lit(None).cast(f.dataType).alias(f.name)
           for f in target.schema.fields]
    src = source
    if null_safe and bound_column is not None:
        src = src.where(_bounds(F.col(bound_column), lower, upper))
    parts = _key_parts(source, keys, "__s", null_safe)
    src = src.select("*", *parts)
    names = [c for c in src.columns if c not in source.columns]
    src = dedup_first(src, names, order_by, tie_breakers)
    tgt = target
    if bound_column is not None:
        tgt = tgt.where(_bounds(F.col(bound_column), lower, upper))
    if set(partition_keys) - set(keys):
        raise ValueError(f"partition_keys must be merge keys: {sorted(set(partition_keys) - set(keys))}")
    incoming = source.where(_bounds(F.col(bound_column), lower, upper)) if null_safe and bound_column is not None else source
    tgt = with_source_partitions(tgt, incoming, partition_keys)
    held = tgt.select(*_key_parts(target, keys, "__t", null_safe))
    if key_filter:
        held = with_key_filter(held, incoming.select(*parts), held.columns, names)
    there = held.distinct()
    on = reduce(lambda x, y: x & y, [F.col(n) == F.col("__t" + n[3:]) for n in names])
    if not null_safe and bound_column is not None:
        # compat: the source window is part of the match condition
        on = on & F.coalesce(_bounds(F.col(bound_column), lower, upper), F.lit(False))
    return src.join(there, on, "left_anti").select(*out)


def merge_insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str], **kw) -> DataFrame:
    """The target as it reads after the merge: target rows plus new rows.

    This is the side-effect-free view of the result; to persist, use
    :func:`merge_into_table`, which appends only the new rows.
    """
    added = merge_new_rows(target, source, keys, **kw)
    return target.select(*added.columns).unionByName(added)


def merge_into_table(target_table: str, source: DataFrame, keys: Sequence[str], **kw) -> int:
    """Insert-only MERGE into a table: append only the new rows.

    The existing rows are never rewritten (the target is only read for its
    keys inside the window, which partition pruning bounds for a
    date-partitioned table).  The append is one job commit, so a failed run
    leaves the table unchanged and, in the default mode, running the merge
    again inserts nothing.  Returns the number of rows inserted.
    """
    from pyspark.sql import Observation

    from ingestkit.sinks.tables import append_table

    spark = source.sparkSession
    added = merge_new_rows(spark.table(target_table), source, keys, **kw)
    obs = Observation("merge_inserted")
    append_table(added.observe(obs, F.count(F.lit(1)).alias("rows")), target_table)
    return int(obs.get["rows"])
