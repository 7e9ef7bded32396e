"""Prefix trie of all conversations, by recursion on half the depth.

A conversation is a sequence of turns; a node of depth d is a distinct sequence
of first d turns.  The recursion halves the depth: every sequence is cut at the
middle, the upper half is named by its content, the distinct upper halves form
the upper trie and the lower halves, under the node where they were cut, the
lower forests; all of one width are handled together in one pass, so there are
log2(longest) passes however many tries they hold.

1. Names of aligned stretches of 2**k turns, from those of half the width.
2. From the widest down: a path (root, stretch) is cut into its upper path
   (root, first half) and its lower path (cut node, second half); upper paths
   with one name become one, with the number of their conversations and the
   smallest of them.  Paths of one turn are the nodes.
3. Totals (leaves, saved tokens) of the forest below every root within one
   width, from the narrowest up: the upper trie's own, plus those of the lower
   forests grafted on at the cut nodes.
4. From the widest down, what lies below a root's own width: the totals of the
   nodes where its paths end, which are cut at a greater width and so are known.

Every step is a join on unique keys or an aggregation with map-side combine; a
turn is a row of its own, so a conversation or a first turn that holds a third of
all rows is spread like any other.  Names are SHA-256 digests.

Cases: null role or text is empty; null turn comes first, turns with one number
are ordered by digest and repeated rows are turns of their own; rows without a
conversation id belong to no conversation and are left out; a conversation
without turns is a member of the root; an empty table gives no rows, not even a
root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ingestkit.llm.ranks import ranked
from ingestkit.llm.stage import Stage
from ingestkit.llm.textscan import SMALL_BATCHES
from ingestkit.session import scoped_conf

ID_BLOCK = 1 << 16          # ids listed in one row: at most so many
NO_ONE = hashlib.sha256(b"").hexdigest()


def _name(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _root() -> Column:
    return F.lit("root").cast("binary")


def _end() -> Column:
    return F.lit("end").cast("binary")


def token(role: Column, text: Column) -> Column:
    """Digest of a turn (role and text, told apart by the role's length)."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, at (0-based place), token, n_bytes, n_turns of every turn."""
    stage = Stage(conversations.sparkSession)
    turns = stage(conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", token(F.col("role"), F.col("text")).alias("token"),
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes")), "turns")
    placed = stage(ranked(turns, ["conv_id", "turn", "token"], "__rank"), "ranked-turns")
    convs = stage(placed.groupBy("conv_id").agg(F.min("__rank").alias("__start"), F.count(F.lit(1)).alias("n_turns")), "convs")
    return stage.finish(placed.join(convs, "conv_id").select(
        "conv_id", (F.col("__rank") - F.col("__start")).alias("at"), "token", "n_bytes", "n_turns"))


def branch(turns: DataFrame, family: int = 5, span: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that share openings: each begins with the first
    ``crc32(id) mod span`` turns of its family's first conversation
    (``id - id mod family``) and goes on with its own turns after as many.
    Returns (turns, members), as :func:`prefix_trie` takes them."""
    stage = Stage(turns.sparkSession)
    first = (F.col("conv_id") - F.pmod("conv_id", F.lit(family))).alias("first")
    head = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(span)).alias("head")
    convs = stage(turns.where("at = 0").select("conv_id", "n_turns", first, head), "members")
    firsts = convs.select(F.col("conv_id").alias("first"), F.col("n_turns").alias("n_first"))
    convs = stage(convs.join(firsts, "first", "left").select(
        "conv_id", "first", "head", F.least("head", F.coalesce("n_first", F.lit(0))).alias("taken"),
        F.greatest(F.col("n_turns") - F.col("head"), F.lit(0)).alias("own")), "openings")
    members = convs.select("conv_id", (F.col("taken") + F.col("own")).alias("n_turns")).checkpoint()
    own = turns.drop("n_turns").join(convs, "conv_id").where("at >= head").select(
        "conv_id", (F.col("at") - F.col("head") + F.col("taken")).alias("at"), "token", "n_bytes")
    # at most span - 1 rows of a conversation, for at most ``family`` others
    opening = turns.where(F.col("at") < span - 1).select(F.col("conv_id").alias("first"), "at", "token", "n_bytes")
    taken = convs.join(opening, "first").where("at < head").select("conv_id", "at", "token", "n_bytes")
    return stage.finish(own.unionByName(taken)), members


def _stretches(turns: DataFrame, depth: int, stage: Stage) -> list[DataFrame]:
    """By k: conv_id, j, g (name), size and the halves' names of every aligned
    stretch of 2**k turns (the last of a conversation may be shorter)."""
    out = [turns.select("conv_id", F.col("at").alias("j"), F.col("token").alias("g"), F.lit(1).cast("long").alias("size"))]
    for k in range(1, depth + 1):
        half = F.col("j") % 2
        joined = out[-1].groupBy("conv_id", F.expr("j div 2").alias("j2")).agg(
            F.max(F.when(half == 0, F.col("g"))).alias("g1"), F.max(F.when(half == 1, F.col("g"))).alias("g2"), F.sum("size").alias("size"))
        out.append(stage(joined.select("conv_id", F.col("j2").alias("j"), _name("g1", F.coalesce("g2", _end())).alias("g"),
                                       "size", "g1", "g2"), f"stretches-{k}"))
    return out


def _paths(stretches: list[DataFrame], stage: Stage) -> list[DataFrame]:
    """By k: root, g, conv_id (smallest member), j, n (members), end (name of
    the node where a path of full width ends) and last (smallest conversation
    that ends inside this path), for the distinct paths of width 2**k."""
    top = len(stretches) - 1
    full = F.col("size") == 2**top
    whole = stretches[top].groupBy("g", "size").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n"))
    out = {top: stage(whole.select(_root().alias("root"), "g", "conv_id", F.lit(0).cast("long").alias("j"), "n",
                                   F.when(full, _name(_root(), "g")).alias("end"), F.col("conv_id").alias("last")), "paths")}
    for k in range(top, 0, -1):
        cut = _name("root", "g1")
        halves = out[k].drop("g").join(stretches[k].drop("g"), ["conv_id", "j"]).withColumn("deep", F.col("size") >= 2**(k - 1))
        upper = halves.groupBy("root", "g1", "deep").agg(
            F.min("conv_id").alias("conv_id"), (F.max("j") * 2).alias("j"), F.sum("n").alias("n"),
            F.min(F.when(F.col("g2").isNull(), F.col("last"))).alias("last")) \
            .select("root", F.col("g1").alias("g"), "conv_id", "j", "n", F.when(F.col("deep"), cut).alias("end"), "last")
        lower = halves.where(F.col("g2").isNotNull()).select(
            cut.alias("root"), F.col("g2").alias("g"), "conv_id", (F.col("j") * 2 + 1).alias("j"), "n", "end", "last")
        out[k - 1] = stage(upper.unionByName(lower), f"paths-{k - 1}")
    return [out[k] for k in range(top + 1)]


_TOTALS = ("n_leaves", "saved")


def _sums(rows: DataFrame) -> DataFrame:
    return rows.groupBy("root", "depth").agg(*[F.sum(c).alias(c) for c in _TOTALS])


def _grafted(paths: DataFrame, k: int, odd: int, below: DataFrame) -> DataFrame:
    """Totals below the ends of full paths of width 2**k, at the paths' roots."""
    ends = paths.where(F.col("end").isNotNull() & (F.col("j") % 2 == odd)).select("root", (F.col("j") * 2**k).alias("depth"), "end")
    return ends.join(below.select(F.col("root").alias("end"), *_TOTALS), "end").select("root", "depth", *_TOTALS)


def _below(nodes: DataFrame, paths: list[DataFrame], stage: Stage) -> DataFrame:
    """root, n_leaves, saved: totals of all nodes below every inner node."""
    own = [stage(_sums(nodes.select("root", F.col("j").alias("depth"), (F.col("n_children") == 0).cast("long").alias("n_leaves"), "saved")), "forests-0")]
    top = len(paths) - 1
    for k in range(top):
        upper = own[k].where(F.col("depth") % 2**(k + 1) == 0)
        own.append(stage(_sums(upper.unionByName(_grafted(paths[k], k, 0, own[k]))), f"forests-{k + 1}"))
    done = own[top]
    for k in range(top - 1, -1, -1):
        roots = own[k].where(F.col("depth") % 2**(k + 1) != 0)
        whole = _sums(roots.unionByName(_grafted(paths[k], k, 1, done)))
        done = done.unionByName(stage(whole, f"totals-{k}"))
    return done.drop("depth")


def _digests(ends: DataFrame) -> DataFrame:
    """conv_id (smallest), ends_sha256 of every group: the ids are listed a
    block at a time and a group's blocks pass through one running digest."""
    blocks = ends.groupBy("g", F.expr(f"conv_id div {ID_BLOCK}").alias("block")).agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
    lists = blocks.select(F.hex("g").alias("g"), "block", F.col("ids")[0].alias("least"), F.concat_ws(",", F.col("ids").cast("array<string>")).alias("ids"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, least, state = None, None, None
        for batch in batches:
            found = []
            for g, first, ids in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
                if g != now:
                    if now is not None:
                        found.append((least, state.hexdigest()))
                    now, least, state = g, first, hashlib.sha256()
                    state.update(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.string())],
                                                 ["conv_id", "ends_sha256"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([least], pa.int64()), pa.array([state.hexdigest()], pa.string())], ["conv_id", "ends_sha256"])

    return lists.repartition("g").sortWithinPartitions("g", "block").mapInArrow(digests, "conv_id long, ends_sha256 string")


def _root_row(members: DataFrame) -> DataFrame:
    """The root without its totals, no row if there is no conversation."""
    none = F.lit(None).cast("binary")
    return members.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n"),
                       F.min(F.when(F.col("n_turns") == 0, F.col("conv_id"))).alias("last")).where("n > 0").select(
        none.alias("root"), _root().alias("end"), none.alias("g"), "conv_id", F.lit(-1).cast("long").alias("j"), "n", "last",
        F.lit(0).cast("long").alias("saved"))


def prefix_trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """The nodes of the trie.

    ``turns``: conv_id, at (0-based, without gaps), token, n_bytes; ``members``:
    conv_id of every conversation, with or without turns, and n_turns (both
    stored).  Output: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256, name (digest of the path)
    and token (digest of the last turn).
    """
    spark = turns.sparkSession
    stage = Stage(spark)
    longest = members.agg(F.max("n_turns")).first()[0] or 0
    depth = max(longest - 1, 0).bit_length()
    stretches = _stretches(turns, depth, stage)
    paths = _paths(stretches, stage)
    kids = stage(paths[0].groupBy("root").agg(F.count(F.lit(1)).alias("n_children")), "children")
    bytes_of = turns.select("conv_id", F.col("at").alias("j"), "n_bytes")
    found = paths[0].join(bytes_of, ["conv_id", "j"]).select(
        "root", "end", "g", "conv_id", "j", "n", "last", ((F.col("n") - 1) * F.col("n_bytes")).alias("saved"))
    every = stage(found.unionByName(_root_row(members)).join(kids.select(F.col("root").alias("end"), "n_children"), "end", "left")
                  .withColumn("n_children", F.coalesce("n_children", F.lit(0))), "nodes")
    below = _below(every.where("j >= 0"), paths, stage)
    parents = stage(every.where("n_children > 0").select(F.col("end").alias("root"), F.col("conv_id").alias("parent_conv_id")), "parents")

    whole = stretches[depth].select("conv_id", "g").unionByName(
        members.where("n_turns = 0").select("conv_id", _root().alias("g")))
    with scoped_conf(spark, SMALL_BATCHES):
        ends = stage(_digests(whole), "ends")
    listed = every.join(parents, "root", "left") \
        .join(below.select(F.col("root").alias("end"), "n_leaves", F.col("saved").alias("under")), "end", "left") \
        .join(ends.select(F.col("conv_id").alias("last"), "ends_sha256"), "last", "left")
    return stage.finish(listed.select(
        "conv_id", (F.col("j") + 1).alias("depth"), "parent_conv_id", F.col("n").alias("n_convs"), "n_children",
        F.coalesce("n_leaves", F.lit(1)).cast("long").alias("n_leaves"),
        (F.col("saved") + F.coalesce("under", F.lit(0))).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_ONE)).alias("ends_sha256"), F.hex("end").alias("name"), F.hex("g").alias("token")))
