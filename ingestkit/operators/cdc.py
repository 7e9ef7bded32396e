"""Change capture into a type-2 slowly changing dimension (SCD2).

A dimension row carries a key, one or more tracked attributes, a
modification date, a source code, an ``is_current`` flag and an
effective interval.  A staging feed carries key, attributes and
modification date.  Two feeds are supported:

* ``full``  - the feed is a complete snapshot: a current key that is
  absent from the feed was deleted and gets closed.
* ``delta`` - the feed only carries changes: absent keys stay as they are.

Two semantics are offered:

* ``mode="default"`` - only current rows are compared; history passes
  through untouched; keys and attributes are compared null-safely; a vanished key
  is closed on ``as_of`` (full feed) instead of being dropped, unless its
  version begins after ``as_of``; staging is reduced to one row per key; a
  late row (dated before the current version began or, for a key without a
  current row, before its last version ended) changes nothing, and neither does
  a row without a date, so no interval ends before it starts and none overlap.
  Applying the same feed twice is a no-op.  Feeds with several changes a key,
  and late rows that belong in the history: :mod:`ingestkit.operators.history`.
* ``mode="compat"`` - the original job's results, row for row: every
  target row (history included) is compared with a null-unsafe ``<>``,
  rows classified DELETE are left out of the result, the new version
  inherits the old end date, and staging duplicates fan out (history rows
  times feed rows of a key, which a hot key makes large by definition).

Plan shape: target and feed are joined by one full outer join (one scan and
one shuffle a side, plus the feed's reduction).  In the default mode the reduced
feed also learns when a closed key ended: from (key, end) of the history rows
that end after the feed's first date, which are few or none for a feed that is
in time.  A default-mode delta feed is
small against the dimension by nature, so it takes the split form of the join
that lets Spark broadcast it (:mod:`ingestkit.operators.joins`).  Every joined
row is turned into its 1-2 output rows by a single
``inline(array(struct, ...))`` generator; nothing is cached.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ingestkit.operators.joins import full_outer_join, split_outer_join
from ingestkit.operators.merge import dedup_first

# Fixed values used by the original jobs.
HIGH_DATE = "9999-12-31"
INSERT_SOURCE_CODE = "bronze_data"
ACTIONS = ("UPSERT", "DELETE", "INSERT", "NOACTION")

_S_KEY = "__s_key"
_S_MOD = "__s_mod"
_S_ENDED = "__s_ended"          # when the key's last closed version ended


def _s_attr(i: int) -> str:
    return f"__s_attr{i}"


@dataclass(frozen=True)
class Scd2Columns:
    """Column roles of the dimension (target) and the staging feed."""

    key: str = "sk_id"
    attrs: tuple[str, ...] = ("attr",)
    mod_dt: str = "mod_dt"
    source_code: str = "data_src_cd"
    is_current: str = "is_current"
    start: str = "eff_start_dt"
    end: str = "eff_end_dt"
    src_key: str = "src_id"
    src_attrs: tuple[str, ...] = ("src_attr",)
    src_mod_dt: str = "src_mod_dt"
    extra: tuple[str, ...] = field(default=())

    @property
    def target_columns(self) -> list[str]:
        return [self.key, *self.attrs, self.mod_dt, self.source_code,
                self.is_current, self.start, self.end]


def _types(df: DataFrame) -> dict[str, object]:
    return {f.name: f.dataType for f in df.schema.fields}


def _conform_staging(staging: DataFrame, target: DataFrame, c: Scd2Columns) -> DataFrame:
    """Staging columns renamed to internal names and cast to target types."""
    tt = _types(target)
    cols = [F.col(c.src_key).cast(tt[c.key]).alias(_S_KEY)]
    for i, (a, sa) in enumerate(zip(c.attrs, c.src_attrs)):
        cols.append(F.col(sa).cast(tt[a]).alias(_s_attr(i)))
    cols.append(F.col(c.src_mod_dt).cast(tt[c.mod_dt]).alias(_S_MOD))
    return staging.select(*cols)


def latest_per_key(stg: DataFrame, c: Scd2Columns) -> DataFrame:
    """One staging row per key: latest modification date, then the largest
    attribute values (nulls lowest) as a deterministic tie-break.  Planned
    as a two-phase top-1 (partial before the shuffle, so a hot key is cut
    to one row per map task); its output is hash-partitioned by key, which
    the join reuses."""
    payload = [_s_attr(i) for i in range(len(c.attrs))]
    return dedup_first(stg, [_S_KEY], [F.col(_S_MOD).desc_nulls_last()],
                       [F.col(p).desc_nulls_last() for p in payload])


def _join_with_staging(target: DataFrame, stg: DataFrame, c: Scd2Columns, *,
                       null_safe: bool, small_feed: bool) -> DataFrame:
    """``target FULL OUTER JOIN staging ON key`` with presence markers."""
    tcols = c.target_columns + list(c.extra)
    s_cols = [_S_KEY, *[_s_attr(i) for i in range(len(c.attrs))], _S_MOD]
    s_cols += [_S_ENDED] if _S_ENDED in stg.columns else []
    left = target.select(*tcols, F.lit(True).alias("__t_present"))
    right = stg.select(*s_cols, F.lit(True).alias("__s_present"))
    join = split_outer_join if small_feed else full_outer_join
    return join(left, right, [c.key], [_S_KEY], null_safe=null_safe)


def _any(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds)


def _all(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)


def _compat_action(c: Scd2Columns) -> Column:
    n = len(c.attrs)
    differs = _any([F.col(c.attrs[i]) != F.col(_s_attr(i)) for i in range(n)])
    src_null = _all([F.col(_s_attr(i)).isNull() for i in range(n)])
    return (F.when(differs, "UPSERT")
            .when(src_null & F.col(c.is_current), "DELETE")
            .when(F.col(c.key).isNull(), "INSERT")
            .otherwise("NOACTION"))


def _default_action(c: Scd2Columns, feed: str, as_of: Column) -> Column:
    n = len(c.attrs)
    changed = _any([~F.col(c.attrs[i]).eqNullSafe(F.col(_s_attr(i))) for i in range(n)])
    absent = F.when(F.col(c.start) > as_of, "NOACTION").otherwise("DELETE") if feed == "full" else F.lit("NOACTION")
    undated = F.col(_S_MOD).isNull()
    return (F.when(F.col("__t_present").isNull(),
                   F.when(undated | (F.col(_S_MOD) < F.col(_S_ENDED)), "NOACTION").otherwise("INSERT"))
            .when(F.col("__s_present").isNull(), absent)
            .when(undated | (F.col(_S_MOD) < F.col(c.start)), "NOACTION")      # late: older than this version
            .when(changed, "UPSERT")
            .otherwise("NOACTION"))


def _is_current(c: Scd2Columns) -> Column:
    return F.coalesce(F.col(c.is_current), F.lit(False))


def classify_changes(target: DataFrame, staging: DataFrame, *, mode: str = "compat",
                     feed: str = "full", columns: Scd2Columns | None = None, as_of: str | Column | None = None,
                     dedup_staging: bool | None = None, null_keys: bool = True) -> DataFrame:
    """Joined target/staging rows with an ``action`` column.

    Output: the target columns, ``src_key``/``src_attrs``/``src_mod_dt``
    under their staging names, and ``action``.  In compat mode every target
    row takes part; in default mode only current rows do (history is not
    part of this output).
    """
    c = columns or Scd2Columns()
    joined, _history = _classified(target, staging, c, mode, feed, _as_date(as_of), dedup_staging, null_keys)
    out = [*c.target_columns, *c.extra,
           F.col(_S_KEY).alias(c.src_key),
           *[F.col(_s_attr(i)).alias(sa) for i, sa in enumerate(c.src_attrs)],
           F.col(_S_MOD).alias(c.src_mod_dt), "action"]
    return joined.select(*out)


def _as_date(as_of: str | Column | None) -> Column:
    return F.current_date() if as_of is None else as_of if isinstance(as_of, Column) else F.to_date(F.lit(as_of))


def _with_last_end(stg: DataFrame, history: DataFrame, c: Scd2Columns, null_keys: bool, feed_from) -> DataFrame:
    """The reduced feed with the date on which the key's closed versions ended,
    where that is after the feed's first date."""
    since = stg.agg(F.min(_S_MOD)).scalar() if feed_from is None else F.lit(feed_from)
    ended = history.where(F.col(c.end) > since).groupBy(F.col(c.key).alias("__h_key")).agg(F.max(c.end).alias(_S_ENDED))
    same = F.col(_S_KEY).eqNullSafe(F.col("__h_key")) if null_keys else F.col(_S_KEY) == F.col("__h_key")
    return stg.join(ended, same, "left").drop("__h_key")


def _classified(target, staging, c, mode, feed, as_of, dedup_staging, null_keys, feed_from=None,
                closed=None):
    if mode not in ("default", "compat"):
        raise ValueError(f"mode must be 'default' or 'compat', not {mode!r}")
    if feed not in ("full", "delta"):
        raise ValueError(f"feed must be 'full' or 'delta', not {feed!r}")
    target = target.select(*c.target_columns, *c.extra)
    stg = _conform_staging(staging, target, c)
    if dedup_staging is None:
        dedup_staging = mode == "default"
    if dedup_staging:
        stg = latest_per_key(stg, c)
    if mode == "compat":
        # null keys never match (plain "="), as in the original job
        joined = _join_with_staging(target, stg, c, null_safe=False, small_feed=False)
        return joined.withColumn("action", _compat_action(c)), None
    # default: a null key is one more key value, so a re-run finds its row
    live = _is_current(c)
    history = target.where(~live)
    stg = _with_last_end(stg, history if closed is None else closed, c, null_keys, feed_from)
    joined = _join_with_staging(target.where(live), stg, c, null_safe=null_keys,
                                small_feed=feed == "delta")
    return joined.withColumn("action", _default_action(c, feed, as_of)), history


def scd2_apply(target: DataFrame, staging: DataFrame, *, feed: str = "full",
               mode: str = "default", as_of: str | Column | None = None,
               columns: Scd2Columns | None = None, high_date: str = HIGH_DATE,
               insert_source_code: str = INSERT_SOURCE_CODE,
               dedup_staging: bool | None = None, flag_deletes: bool = False,
               order_by_key: bool = False, null_keys: bool = True, feed_from=None,
               closed: DataFrame | None = None) -> DataFrame:
    """The dimension after applying ``staging``; see the module docstring.

    ``as_of`` is the close date of deleted keys (full feed, default mode);
    it defaults to ``current_date()``, which is not reproducible, so pass
    it explicitly in jobs that must be re-runnable.  ``null_keys=False`` says
    that the key is never null: the join then compares with plain ``=`` and
    keeps a dimension bucketed by key where it is.  ``feed_from`` (a date) says
    that no feed row is dated earlier, so that the filter on history reaches the
    scan; without it Spark finds the date first.  ``closed`` are the history rows
    when ``target`` holds current rows only (they are looked up, not returned).
    """
    c = columns or Scd2Columns()
    as_of_col = _as_date(as_of)
    joined, history = _classified(target, staging, c, mode, feed, as_of_col, dedup_staging, null_keys, feed_from, closed)
    tt = _types(target)
    n = len(c.attrs)
    high = F.to_date(F.lit(high_date))

    def row(key, attrs, mod, src_cd, current, start, end, deleted):
        fields = [key.cast(tt[c.key]).alias(c.key)]
        fields += [a.cast(tt[name]).alias(name) for a, name in zip(attrs, c.attrs)]
        fields += [mod.cast(tt[c.mod_dt]).alias(c.mod_dt),
                   src_cd.cast(tt[c.source_code]).alias(c.source_code),
                   current.cast("boolean").alias(c.is_current),
                   start.cast(tt[c.start]).alias(c.start),
                   end.cast(tt[c.end]).alias(c.end)]
        fields += [F.col(x).alias(x) for x in c.extra]
        if flag_deletes:
            fields.append(F.lit(deleted).alias("is_deleted"))
        return F.struct(*fields)

    t_attrs = [F.col(a) for a in c.attrs]
    s_attrs = [F.col(_s_attr(i)) for i in range(n)]
    key, mod, src_cd = F.col(c.key), F.col(c.mod_dt), F.col(c.source_code)
    start, end, s_mod = F.col(c.start), F.col(c.end), F.col(_S_MOD)

    keep = row(key, t_attrs, mod, src_cd, F.col(c.is_current), start, end, False)
    closed = row(key, t_attrs, mod, src_cd, F.lit(False), start, s_mod, False)
    new_end = end if mode == "compat" else high
    new_version = row(key, s_attrs, s_mod, src_cd, F.lit(True), s_mod, new_end, False)
    inserted = row(F.col(_S_KEY), s_attrs, s_mod, F.lit(insert_source_code), F.lit(True),
                   s_mod, high, False)
    deleted = row(key, t_attrs, mod, src_cd, F.lit(False), start, as_of_col, True)

    action = F.col("action")
    emitted = (F.when(action == "UPSERT", F.array(closed, new_version))
               .when(action == "INSERT", F.array(inserted))
               .when((action == "NOACTION") & F.col("__t_present"), F.array(keep)))
    if mode == "default":
        # a late or undated row of a key without a current row adds nothing
        emitted = emitted.when(action == "DELETE", F.array(deleted))
    # compat: DELETE rows produce nothing (the original union leaves them out)
    out_cols = c.target_columns + list(c.extra) + (["is_deleted"] if flag_deletes else [])
    # inline(null) emits no rows, which is how compat DELETE rows disappear
    result = joined.select(F.inline(emitted)).select(*out_cols)
    if history is not None:
        hist = history.select(*c.target_columns, *c.extra)
        if flag_deletes:
            hist = hist.withColumn("is_deleted", F.lit(False))
        result = result.unionByName(hist)
    if order_by_key:
        result = result.orderBy(c.key)
    return result


def scd2_write_back(target_table: str, staging: DataFrame, **options) -> dict[str, object]:
    """Apply a feed to a dimension table: :func:`ingestkit.operators.dimension.write_back`."""
    from ingestkit.operators.dimension import write_back

    return write_back(target_table, staging, **options)


def scd2_view(target_table: str, staging_table: str, *, view: str = "merged_cdc",
              **options) -> DataFrame:
    """Apply a staging *table* to a dimension *table* and expose the result
    as a temporary view for SQL (nothing is written)."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    result = scd2_apply(spark.table(target_table), spark.table(staging_table), **options)
    result.createOrReplaceTempView(view)
    return result
