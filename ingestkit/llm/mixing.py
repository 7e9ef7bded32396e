"""Mixing sources to target weights.

Sizes are summed per source; the whole mix is as large as the corpus.  Each
source's target is its share of that total by weight, stopped at ``max_repeat``
times the source's own size, the excess reshared by weight among the others
(water-filling).  ``target / size`` is the source's repetition rate: each of
its documents is emitted ``floor(rate)`` times, plus one more copy when the
document's hash, read as a number in [0, 1), is below the rate's fraction.

Plan: one aggregation with map-side combine (a source holding most rows is
combined in every task), a source-level table, and a narrow pass over the
documents.  The source table is broadcast after its row count was checked;
beyond the limit the join is left to Spark (AQE splits a hot source).

Cases: null text has size 0; a null source is a source of its own, sorted
last; a source of size 0 gets target and rate 0 (its documents are not
emitted); an empty table gives an empty mix; repeated rows are documents of
their own with the same hash, hence the same decision; a null doc_id hashes
like the empty string; columns with other names pass through, and the
output columns replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ingestkit.session import work_root

# Words are maximal runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
MAX_BROADCAST_SOURCES = 50_000


def word_count(text: str = "text") -> Column:
    """Number of words of a text column; null counts as 0."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def hash_fraction(doc_id: str, seed: str) -> Column:
    """A reproducible number in [0, 1) from the row's id."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), max_repeat: int = 3) -> DataFrame:
    """Per source: source_size, weight, target, rate.

    ``sizes`` has columns source and size.  Sources sorted by code point take
    the weights in turn.  With caps ``max_repeat * size`` sorted by cap per
    weight, the first k sources are stopped at their caps and the others share
    the rest at one level per weight; k is the smallest number that leaves
    none above its cap.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # source-level from here on: one row per source
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (turn + 1).cast("int")))
    per = per.withColumn("__cap", F.lit(max_repeat) * F.col("source_size"))
    by_cap = Window.orderBy((F.col("__cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = (per.withColumn("__capped", F.coalesce(F.sum("__cap").over(before), F.lit(0)))
           .withColumn("__used", F.coalesce(F.sum("weight").over(before), F.lit(0)))
           .withColumn("__total", F.sum("source_size").over(whole))
           .withColumn("__weights", F.sum("weight").over(whole)))
    # the level if every source from this one on were below its cap
    per = per.withColumn("__level", (F.col("__total") - F.col("__capped")) / (F.col("__weights") - F.col("__used")))
    fits = F.col("__level") * F.col("weight") <= F.col("__cap")
    per = per.withColumn("__share", F.min(F.when(fits, F.struct("__capped", "__level"))).over(whole)["__level"])
    target = F.least(F.col("__cap").cast("double"), F.col("__share") * F.col("weight"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return (per.withColumn("target", target).withColumn("rate", rate)
            .select("source", "source_size", "weight", "target", "rate"))


def plan_mix(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source",
             weights: Sequence[int] = (1, 2, 3), max_repeat: int = 3, seed: str = "mix") -> DataFrame:
    """The documents with size, source_size, target and copies."""
    work_root(documents.sparkSession)
    own = {"size", "source_size", "target", "copies"}
    kept = documents.drop(*[c for c in documents.columns if c in own and c not in (doc_id, text, source)])
    sized = kept.withColumn("size", word_count(text))
    targets = source_targets(sized.select(F.col(source).alias("source"), "size"), weights, max_repeat)
    targets = targets.select(F.col("source").alias("__source"), "source_size", "target", F.col("rate").alias("__rate")).checkpoint()
    if targets.count() <= MAX_BROADCAST_SOURCES:
        targets = F.broadcast(targets)
    joined = sized.join(targets, F.col(source).eqNullSafe(F.col("__source")), "left").drop("__source")
    whole = F.floor("__rate")
    extra = (hash_fraction(doc_id, seed) < F.col("__rate") - whole).cast("long")
    return joined.withColumn("copies", whole + extra).drop("__rate")


def emit_mix(planned: DataFrame) -> DataFrame:
    """Every document as many times as planned (columns of the plan stay)."""
    times = planned.where(F.col("copies") > 0)
    return times.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))


def mix_digest(planned: DataFrame) -> DataFrame:
    """One row per document with the words that the emitted copies hold."""
    narrow = planned.select("doc_id", "size", "source_size", "target", "copies",
                            F.monotonically_increasing_id().alias("__row")).checkpoint()
    emitted = emit_mix(narrow).groupBy(F.col("__row").alias("__of")).agg(F.sum("size").alias("taken"))
    return narrow.join(emitted, F.col("__row") == F.col("__of"), "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
