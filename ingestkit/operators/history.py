"""Changes put in their place in a dimension's history.

``splice_changes`` applies a feed with any number of changes a key, in time or
late.  A dimension's version and a change say the same thing: from this date on
the key has these attributes.  So the versions of the keys that the feed touches
and the changes form one timeline a key, in which every entry lasts until the
next one; a version that ended without a successor puts its end on the timeline.
Of entries of one key and date the greatest attributes count (nulls lowest; a
stored version before an equal change).  Hence the result is the same in
whatever order and in however many feeds the changes arrive, applying a feed
again changes nothing, and no two intervals of a key overlap.

A change that repeats the attributes before it stays an entry of its own: a
still later arrival may come between them.  ``collapse_versions`` merges such
neighbours for reading.

Plan: only versions that end after their key's first change take part; all
others pass through.  A feed that is small is broadcast by Spark after its own
size check and the dimension is never shuffled; else both sides are.  The
timeline is shuffled by (key, month), so a key with very many changes is spread;
what crosses months comes from a summary with one row a (key, month).

Cases: a null key is one more key value; changes without a date cannot be
placed and are left out; versions without a start, or that do not end after
their start, cover no time and pass through as they are; null attributes are
values; columns in ``extra`` keep their value for versions and are null for
changes; an empty feed gives the dimension, an empty dimension the changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ingestkit.operators.cdc import _S_KEY, _S_MOD, HIGH_DATE, INSERT_SOURCE_CODE, Scd2Columns, _conform_staging, _s_attr
from ingestkit.operators.merge import _key_parts, dedup_first

_ID = ["__k0", "__k0n"]               # the key as (value, is null)


def _block(date: str) -> Column:
    """Dates that are ordered together: a month of dates, a day of timestamps."""
    return F.date_trunc("month", F.col(date))


def _touched(target: DataFrame, changes: DataFrame, c: Scd2Columns) -> DataFrame:
    """The target with the date of its key's first change (null: none)."""
    first = changes.groupBy(*[F.col(k).alias(f"{k}_") for k in _ID]).agg(F.min(_S_MOD).alias("__first"))
    same = (F.col("__k0") == F.col("__k0_")) & (F.col("__k0n") == F.col("__k0n_"))
    return target.join(first, same, "left").drop("__k0_", "__k0n_")


def splice_changes(target: DataFrame, changes: DataFrame, *, columns: Scd2Columns | None = None,
                   high_date: str = HIGH_DATE, insert_source_code: str = INSERT_SOURCE_CODE) -> DataFrame:
    """The dimension with ``changes`` in their place; see the module docstring.

    A change takes the source code of the version before it, or
    ``insert_source_code`` if the key has none there.
    """
    c = columns or Scd2Columns()
    types = {f.name: f.dataType for f in target.schema.fields}
    out = [*c.target_columns, *c.extra]
    high = F.lit(high_date).cast(types[c.end])
    target = target.select(*out)
    target = target.select("*", *_key_parts(target, [c.key], "__k", True))
    feed = _conform_staging(changes, target, c).where(F.col(_S_MOD).isNotNull())
    feed = feed.select("*", *_key_parts(feed, [_S_KEY], "__k", True))
    attrs = [_s_attr(i) for i in range(len(c.attrs))]
    feed = dedup_first(feed, [*_ID, _S_MOD], [F.col(a).desc_nulls_last() for a in attrs])

    marked = _touched(target, feed, c)
    before = F.col("__first").isNull() | F.col(c.start).isNull() | (F.col(c.start) >= F.coalesce(c.end, high)) | \
        ((F.col(c.end) <= F.col("__first")) & (F.col(c.start) < F.col("__first")))
    passing = marked.where(before).select(*out)

    def entry(date: Column, kind: int, key: Column, values: list[Column], mod: Column, code: Column, stored: bool, extra: list[Column]):
        return F.struct(
            date.alias("__date"), F.lit(kind).alias("__kind"), key.cast(types[c.key]).alias(c.key),
            *[v.cast(types[a]).alias(a) for v, a in zip(values, c.attrs, strict=True)], mod.cast(types[c.mod_dt]).alias(c.mod_dt),
            F.struct(code.cast(types[c.source_code]).alias("code")).alias("__code") if stored or not kind
            else F.lit(None).cast(F"struct<code:{types[c.source_code].simpleString()}>").alias("__code"),
            F.lit(stored).alias("__stored"), *[e.cast(types[x]).alias(x) for e, x in zip(extra, c.extra, strict=True)])

    nulls, none = [F.lit(None)] * len(c.attrs), [F.lit(None)] * len(c.extra)
    version = entry(F.col(c.start), 1, F.col(c.key), [F.col(a) for a in c.attrs], F.col(c.mod_dt), F.col(c.source_code), True,
                    [F.col(x) for x in c.extra])
    end = entry(F.col(c.end), 0, F.col(c.key), nulls, F.lit(None), F.lit(insert_source_code), False, none)
    ended = F.col(c.end) < high
    stored = marked.where(~before).select(*_ID, F.inline(F.when(ended, F.array(version, end)).otherwise(F.array(version))))
    change = entry(F.col(_S_MOD).cast(types[c.start]), 1, F.col(_S_KEY), [F.col(a) for a in attrs], F.col(_S_MOD), F.lit(None), False, none)
    line = stored.unionByName(feed.select(*_ID, F.inline(F.array(change)))).withColumn("__block", _block("__date"))

    # one entry a date; all windows here share the shuffle by (key, month)
    group = [*_ID, "__block"]
    same_date = Window.partitionBy(*group, "__date", "__kind").orderBy(
        *[F.col(a).desc_nulls_last() for a in c.attrs], F.col("__stored").desc())
    line = line.repartition(*group).withColumn("__nth", F.row_number().over(same_date)).where("__nth = 1")
    in_block = Window.partitionBy(*group).orderBy("__date", "__kind")
    so_far = in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    line = line.withColumns({"__next": F.lead("__date").over(in_block), "__own": F.last("__code", ignorenulls=True).over(so_far)})

    summary = line.groupBy(*group).agg(
        F.min("__date").alias("__from"), F.max_by("__own", F.struct("__date", "__kind")).alias("__last"))
    over_blocks = Window.partitionBy(*_ID).orderBy("__block")
    summary = summary.select(
        *[F.col(g).alias(f"{g}_") for g in group], F.lead("__from").over(over_blocks).alias("__after"),
        F.last("__last", ignorenulls=True).over(over_blocks.rowsBetween(Window.unboundedPreceding, -1)).alias("__earlier"))
    on = (F.col("__k0") == F.col("__k0_")) & (F.col("__k0n") == F.col("__k0n_")) & (F.col("__block") == F.col("__block_"))
    line = line.join(summary, on).where("__kind = 1")

    until = F.coalesce("__next", "__after").cast(types[c.end])
    code = F.coalesce("__own", "__earlier", F.struct(F.lit(insert_source_code).cast(types[c.source_code]).alias("code")))["code"]
    spliced = line.select(
        c.key, *c.attrs, c.mod_dt, code.alias(c.source_code), until.isNull().alias(c.is_current),
        F.col("__date").cast(types[c.start]).alias(c.start), F.coalesce(until, high).alias(c.end), *c.extra)
    return passing.unionByName(spliced.select(*out))


def collapse_versions(dimension: DataFrame, *, columns: Scd2Columns | None = None) -> DataFrame:
    """The dimension for reading: versions of a key that follow each other
    without a gap and with equal attributes become one, from the first's start
    to the last's end; the other columns are the first's.  Rows that cover no
    time, or have no start, stay as they are.  A key's versions are ordered in
    one task, on disk beyond its memory."""
    c = columns or Scd2Columns()
    out = [*c.target_columns, *c.extra]
    covers = F.coalesce(F.col(c.start) < F.col(c.end), F.lit(False))
    rows = dimension.select(*out, covers.alias("__covers"), F.struct(*c.attrs).alias("__value"))
    line = rows.where("__covers")
    by_key = Window.partitionBy(c.key).orderBy(c.start)
    goes_on = F.lag(c.end).over(by_key).eqNullSafe(F.col(c.start)) & F.lag("__value").over(by_key).eqNullSafe(F.col("__value"))
    line = line.withColumn("__first", ~F.coalesce(goes_on, F.lit(False)))
    # an island lasts until the end of the row before the next island
    line = line.withColumns({"__end_before": F.lag(c.end).over(by_key), "__flag_before": F.lag(c.is_current).over(by_key)})
    last = Window.partitionBy(c.key)
    line = line.withColumns({"__last_end": F.max(c.end).over(last), "__any_current": F.max(c.is_current).over(last)}).where("__first")
    line = line.withColumns({
        c.end: F.coalesce(F.lead("__end_before").over(by_key), F.col("__last_end")),
        c.is_current: F.coalesce(F.lead("__flag_before").over(by_key), F.col("__any_current"))})
    return line.select(*out).unionByName(rows.where(~F.col("__covers")).select(*out))
