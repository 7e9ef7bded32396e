"""Merkle manifest of a data set, with a proof for every row.

Every row is a leaf: the digest of its fields.  The leaves of a source, in the
order of their ids, form a tree: while several nodes remain, every 16
consecutive ones become one, the digest of their digests.  The sources' top
nodes, in the order of the sources, form the upper tree in the same way.

Labels: a node carries the interval [lo, hi) of the leaf ranks it covers (ranks
within its source; in the upper tree, ranks of sources), so one node is an
ancestor of another exactly when its interval contains the other's.  A node of
level k spans at most 16**k ranks and starts at a multiple of them, so the
containment join of a level goes by the bucket ``lo div 16**k``: every bucket
holds one node of level k and up to 16 of the level below.  The siblings of a
node are its parent's interval less its own: the parent's children that end
before it (left) or begin after it (right).

Plan: leaves are digested where they are read (texts are never shuffled) and
ranked by range partitions; a source that holds most rows is only a longer
range.  A level is one aggregation of 16 rows a group; levels shrink by 16, so
the first one is nearly all the work.  Proofs go down the levels: a node hands
its path to its children, so what leaves share is joined once a parent and never
once an ancestor.  A path is an array with (left, right) a level, leaf first.

Cases: null fields are written as ``-``, so null and empty text differ; a null
source is a source of its own, the first; null ids come first; rows with one id
are leaves of their own, ordered by their digest (rows equal in all fields are
interchangeable); a source with one leaf has that leaf as its top; an empty
table gives no rows; other columns do not enter the digests.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ingestkit.llm.ranks import ranked
from ingestkit.session import work_root

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
MAX_BROADCAST_SOURCES = 50_000
_PATH = "array<struct<left:string,right:string>>"


def _field(value: Column) -> Column:
    """``-`` for null, else the length in bytes, a colon and the value."""
    value = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[_field(v) for v in values]), 256)


def lower_ascii(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


@dataclass
class Forest:
    """Trees over ranked leaves: ``levels[0]`` the leaves, ``levels[k]`` the
    nodes of level k with their children; ``n`` is the tree's number of leaves."""

    levels: list[DataFrame]

    def tops(self) -> DataFrame:
        """The top node of every tree: tree, level, digest."""
        out = None
        for k, nodes in enumerate(self.levels):
            top = nodes.where(F.col("n") <= FAN**k).select("tree", F.lit(k).alias("level"), "digest")
            out = top if out is None else out.unionByName(top)
        return out


def grow(leaves: DataFrame, fan: int = FAN) -> Forest:
    """``leaves``: tree, lo, hi, n, digest (stored)."""
    largest = leaves.agg(F.max("n")).first()[0] or 0
    levels, k = [leaves], 0
    while fan**k < largest:
        below = levels[k].where(F.col("n") > fan**k)
        k += 1
        kids = F.array_sort(F.collect_list(F.struct("lo", "hi", "digest")))         # at most ``fan``
        nodes = below.groupBy("tree", F.expr(f"lo div {fan**k}").alias("__bucket")).agg(
            F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("n").alias("n"), kids.alias("kids"))
        levels.append(nodes.drop("__bucket").withColumn("digest", F.sha2(F.concat_ws("", "kids.digest"), 256)).checkpoint())
    return Forest(levels)


def _attached(below: DataFrame, above: DataFrame, k: int, fan: int, carried: Sequence[str]) -> DataFrame:
    """Nodes of level k - 1 with the path that their parent of level k hands on."""
    kid = below.withColumn("__bucket", F.expr(f"lo div {fan**k}"))
    parent = above.select(F.col("tree").alias("__tree"), F.expr(f"lo div {fan**k}").alias("__of"), F.col("lo").alias("__lo"),
                          F.col("hi").alias("__hi"), F.col("kids").alias("__kids"), F.col("path").alias("__path"))
    inside = (F.col("tree") == F.col("__tree")) & (F.col("__bucket") == F.col("__of")) & \
        (F.col("__lo") <= F.col("lo")) & (F.col("hi") <= F.col("__hi"))
    rest_left = F.filter("__kids", lambda x: x["hi"] <= F.col("lo"))
    rest_right = F.filter("__kids", lambda x: x["lo"] >= F.col("hi"))
    here = F.struct(F.concat_ws("", rest_left["digest"]).alias("left"), F.concat_ws("", rest_right["digest"]).alias("right"))
    return kid.join(parent, inside).select(*carried, F.concat(F.array(here), F.col("__path")).alias("path"))


def paths(forest: Forest, above: DataFrame | None = None, fan: int = FAN) -> DataFrame:
    """The leaves with their path.  ``above`` (tree, path) continues the path
    beyond every tree's top; without it a path ends there."""
    top = len(forest.levels) - 1
    handed = None
    for k in range(top, -1, -1):
        nodes = forest.levels[k]
        mine = nodes.where(F.col("n") <= fan**k)                     # the tops of this level
        if above is None:
            mine = mine.withColumn("path", F.array().cast(_PATH))
        else:
            mine = mine.join(above.select(F.col("tree").alias("__tree"), "path"), F.col("tree") == F.col("__tree")).drop("__tree")
        if handed is not None:
            rest = nodes.where(F.col("n") > fan**k)
            mine = mine.select(*nodes.columns, "path").unionByName(_attached(rest, handed, k + 1, fan, nodes.columns))
        handed = mine.checkpoint() if k else mine
    return handed


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda h, p: F.sha2(F.concat(p["left"], h, p["right"]), 256))


def proof_digest(path: Column) -> Column:
    """The digest of all siblings, level by level, left to right."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda p: F.concat(p["left"], p["right"]))), 256)


@dataclass
class Manifest:
    """``leaves``: tree, lo, hi, n, digest and the carried columns; ``sources``:
    tree, source, n, level, subroot; ``root`` null for an empty table."""

    forest: Forest
    upper: Forest
    sources: DataFrame
    root: str | None

    def proofs(self) -> DataFrame:
        """Every leaf with its path up to the root."""
        over = paths(self.upper).select(F.col("lo").alias("tree"), "path")
        return paths(self.forest, over.checkpoint())


def build_manifest(documents: DataFrame, *, fields: Sequence[str] = FIELDS, source: str = "source", order: str = "doc_id",
                   carry: dict[str, Column] | None = None) -> Manifest:
    """The manifest over ``fields``; ``carry`` adds columns to the leaves."""
    work_root(documents.sparkSession)
    clash = {"tree", "lo", "hi", "n", "digest", "path", "kids"} & set(carry or {})
    if clash:
        raise ValueError(f"carried columns have names of the manifest's own: {sorted(clash)}")
    leaves = documents.select(F.col(source).alias("__source"), F.col(order).alias("__order"),
                              leaf_digest(*[F.col(f) for f in fields]).alias("digest"),
                              *[c.alias(n) for n, c in (carry or {}).items()]).checkpoint()
    placed = ranked(leaves, ["__source", "__order", "digest"], "__rank").drop("__order").checkpoint()
    held = placed.groupBy("__source").agg(F.min("__rank").alias("__start"), F.count(F.lit(1)).alias("n")).checkpoint()
    sources = ranked(held, ["__start"], "tree").withColumnRenamed("__source", "__of").checkpoint()
    n_sources = sources.count()
    small = F.broadcast(sources) if n_sources <= MAX_BROADCAST_SOURCES else sources
    lo = F.col("__rank") - F.col("__start")
    leaves = placed.join(small, F.col("__source").eqNullSafe(F.col("__of"))).select(
        "tree", lo.alias("lo"), (lo + 1).alias("hi"), "n", "digest", *(carry or {})).checkpoint()
    forest = grow(leaves)
    tops = forest.tops().checkpoint()
    upper = grow(tops.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("lo"), (F.col("tree") + 1).alias("hi"),
                             F.lit(n_sources).cast("long").alias("n"), "digest").checkpoint())
    top = upper.tops().first()
    listed = sources.join(tops.withColumnRenamed("digest", "subroot"), "tree").select(
        "tree", F.col("__of").alias("source"), "n", "level", "subroot")
    return Manifest(forest, upper, listed, top.digest if top else None)


def tamper_report(documents: DataFrame, tampered_text: Column, *, fields: Sequence[str] = FIELDS, doc_id: str = "doc_id") -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified for
    every row, where ``tampered_text`` (null: untouched) is the text that the
    fold sees instead."""
    other = leaf_digest(*[tampered_text if f == "text" else F.col(f) for f in fields])
    carry = {"doc_id": F.col(doc_id), "__seen": F.when(tampered_text.isNotNull(), other)}
    manifest = build_manifest(documents, fields=fields, order=doc_id, carry=carry)
    tops = manifest.sources.select(F.col("tree").alias("__tree"), "subroot").checkpoint()
    if tops.count() <= MAX_BROADCAST_SOURCES:
        tops = F.broadcast(tops)
    root = F.lit(manifest.root).cast("string")
    found = manifest.proofs().join(tops, F.col("tree") == F.col("__tree")).select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", root.alias("root"), proof_digest(F.col("path")).alias("proof_sha256"),
        fold(F.coalesce("__seen", "digest"), F.col("path")).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
