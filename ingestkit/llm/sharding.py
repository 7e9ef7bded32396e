"""Sharding by a hierarchical weighted hash tree.

The tree has three levels: regions hold racks, racks hold shards.  A row
descends from the root; at each level every child makes a weighted hash draw
``-ln(u) / weight`` with ``u`` hashed from the row's id and the child's name,
and the smallest draw wins, so a child is taken with probability equal to its
share of the weights.  A node weighs as many shards as it holds.  When a
weight changes, rows move only into (or out of) that node; one more shard
arrives as a region of its own, so rows move into it and nowhere else.

Slots number each shard's rows from 0 without gaps, in the order of (hash
block, id, text checksum, size).  The count of every (shard, block) gives the
block's first slot, so no task holds a whole shard.

Cases: null text has no bytes and checksum 0; a null id is hashed like the
empty string; rows with the same id go to the same shard and take successive
slots; an empty table gives no rows; other columns are dropped unless named.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# region -> rack -> shards
Topology = dict[str, dict[str, Sequence[int]]]
EIGHT: Topology = {"east": {"e1": (0, 1), "e2": (2, 3)}, "west": {"w1": (4, 5), "w2": (6, 7)}}


def grown(topology: Topology, region: str = "new") -> Topology:
    """The topology with one more shard, in a region of its own."""
    last = max(s for racks in topology.values() for shards in racks.values() for s in shards)
    return {**topology, region: {f"{region}1": (last + 1,)}}


def _draw(key: Column, node: str, weight: int) -> Column:
    digest = F.md5(F.concat(F.lit(node + ":"), key).cast("binary"))
    u = (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 48))
    return -F.log(u) / F.lit(float(weight))


def _weight(node) -> int:
    return sum(map(_weight, node.values())) if isinstance(node, dict) else len(node) if isinstance(node, tuple | list) else 1


def _descend(key: Column, node, path: str) -> Column:
    """The shard that a row reaches below ``node``."""
    if isinstance(node, int):
        return F.lit(node)
    children = node.items() if isinstance(node, dict) else [(f"s{s}", s) for s in node]
    options = [(_draw(key, f"{path}/{name}", _weight(child)), _descend(key, child, f"{path}/{name}"))
               for name, child in children]
    if len(options) == 1:
        return options[0][1]
    best = F.least(*[d for d, _ in options])
    return reduce(lambda rest, x: F.when(x[0] == best, x[1]).otherwise(rest), reversed(options[:-1]), options[-1][1])


def shard_of(doc_id: str, topology: Topology = EIGHT) -> Column:
    return _descend(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), topology, "root").cast("int")


def assign_shards(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                  topology: Topology = EIGHT, keep: Sequence[str] = (), block_digits: int = 3) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (and ``keep``).

    ``block_digits`` hexadecimal digits of the id's hash name a block; a task
    sorts one (shard, block) at a time, so choose them so that the rows of one
    block fit a task: 3 digits are 4,096 blocks a shard.
    """
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    raw = F.coalesce(F.col(text), F.lit(""))
    rows = documents.select(
        F.col(doc_id).alias("doc_id"), *[c for c in keep if c != doc_id],
        (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"),
        shard_of(doc_id, topology).alias("shard"), shard_of(doc_id, grown(topology)).alias("grown_shard"),
        F.substring(F.md5(F.concat(F.lit("slot:"), key).cast("binary")), 1, block_digits).alias("__block"))
    counts = rows.groupBy("shard", "__block").agg(F.count(F.lit(1)).alias("__n"))
    ahead = Window.partitionBy("shard").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "__block", F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__first"))
    inside = Window.partitionBy("shard", "__block").orderBy("doc_id", "text_crc32", "size")
    numbered = rows.withColumn("__row", F.row_number().over(inside))
    slot = (F.col("__first") + F.col("__row") - 1).alias("slot")
    # at most shards * 16**block_digits rows
    return numbered.join(F.broadcast(first), ["shard", "__block"]).select(
        "doc_id", *[c for c in keep if c != doc_id], "size", "text_crc32", "law", "shard", slot, "grown_shard")
