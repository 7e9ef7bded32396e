"""Removal of repeated byte strings by merging shard Burrows-Wheeler transforms.

Every byte covered by a ``length``-byte string that also starts anywhere else
in the corpus is removed.  A suffix array of the whole corpus is not needed
for that: only strings that can repeat are sorted.

1. Anchors.  The ``gram``-byte strings of a window are hashed; the smallest
   (leftmost) one is the window's anchor, so equal windows have equal anchors
   at equal places.  Windows whose anchor occurs once cannot repeat.
2. Contexts.  For an anchor that occurs again, the run of window starts that
   share it is cut out, with the bytes of their windows.  Every window start
   lies in exactly one context.  Equal contexts are one with a number of
   occurrences (a combined aggregation); with two of them all their starts
   are repeated.
3. Shards.  The different contexts of an anchor meet in one task, which takes
   them in shards of bounded size.  A shard's suffixes are sorted and written
   as its Burrows-Wheeler transform over an alphabet of ``symbol``-byte blocks:
   for every suffix in order, the block before it.
4. Merge.  The shards' transforms are merged by refining their interleave:
   one stable pass over the blocks before the suffixes turns an interleave that
   is right for h blocks into one that is right for h + 1.  The passes also
   carry which neighbours share their prefix so far; after
   ``length / symbol`` passes the runs that still share it are the repeated
   intervals.  Suffixes are never sorted across shards.

An anchor with more than ``hot`` different contexts (the edges of a passage
found in very many documents) is not brought into one task: its windows are
hashed one by one and counted by an aggregation, which is exact as well.
Equal texts of at least ``length`` bytes are removed wholly.

Cases: null and empty texts have no bytes; texts shorter than ``length`` lose
nothing; repeated rows are equal texts; matches never cross documents; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ingestkit.llm import textscan
from ingestkit.session import remove_folder, scoped_conf, scratch_dir, work_root

PIECE = 4 << 20
SHARD = 1 << 18
TASK_BYTES = 1 << 20


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """(document, anchor place, first start, last start, hash) of each run of
    window starts that share an anchor; places count from the buffer's begin."""
    width, n = length - gram + 1, len(data) - gram + 1
    m = n - width + 1
    if m <= 0:
        z = np.zeros(0, np.int64)
        return z, z, z, z, np.zeros(0, np.uint64)
    at = np.arange(n)
    h = textscan.span_hash(textscan.prefix_sums(data, textscan.TABLE_EXACT), at, at + gram)
    bits = np.uint64(int(n).bit_length())
    key = (h >> bits << bits) | at.astype(np.uint64)
    # sliding minimum from running minima of blocks, forwards and backwards
    blocks = np.append(key, np.full((-n) % width, np.iinfo(np.uint64).max, np.uint64)).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(back[:m], ahead[width - 1:width - 1 + m])
    place = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:m]
    start = np.flatnonzero(at[:m] + length <= offsets[doc + 1])
    if not len(start):
        z = np.zeros(0, np.int64)
        return z, z, z, z, np.zeros(0, np.uint64)
    place, doc = place[start], doc[start]
    new = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)])
    last = start[np.r_[new[1:] - 1, len(start) - 1]]
    return doc[new], place[new], start[new], last, h[place[new]]


def _pieces(batch: pa.RecordBatch, length: int):
    """(bytes, offsets, rows, place of each text's piece): very long texts are
    cut into pieces whose windows do not overlap."""
    data, offsets = textscan.as_buffer(batch.column("text"))
    if len(data) <= 2 * PIECE:
        yield data, offsets, np.arange(batch.num_rows), 0
        return
    for row in range(batch.num_rows):
        a, b = int(offsets[row]), int(offsets[row + 1])
        for p in range(a, max(b - length + 1, a + 1), PIECE):
            part = data[p:min(b, p + PIECE + length - 1)]
            yield part, np.array([0, len(part)]), np.array([row]), p - a


def _emit_anchors(length: int, gram: int):
    def run(batches):
        for batch in textscan.chunks(batches, "text"):
            keys = [batch.column(c).to_numpy() for c in ("h1", "h2")]
            for data, offsets, rows, base in _pieces(batch, length):
                doc, place, _, _, h = anchors(data, offsets, length, gram)
                if len(doc):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(k[rows[doc]]) for k in keys] + [pa.array(h.view(np.int64)), pa.array(place - offsets[doc] + base)],
                        names=["h1", "h2", "fp", "at"])
    return run


def _emit_contexts(length: int, gram: int):
    def run(batches):
        for batch in textscan.chunks(batches, "text"):
            keys = [batch.column(c).to_numpy() for c in ("h1", "h2")]
            wanted = batch.column("ats")
            owner = np.repeat(np.arange(batch.num_rows), np.diff(wanted.offsets.to_numpy()))
            wanted = set(zip(owner.tolist(), wanted.flatten().to_pylist(), strict=True))
            for data, offsets, rows, base in _pieces(batch, length):
                doc, place, first, last, h = anchors(data, offsets, length, gram)
                row, at = rows[doc], place - offsets[doc] + base
                use = np.array([x in wanted for x in zip(row.tolist(), at.tolist(), strict=True)], bool)
                doc, place, first, last, h, row = (x[use] for x in (doc, place, first, last, h, row))
                if not len(doc):
                    continue
                raw = data.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k[row]) for k in keys] + [
                        pa.array(h.view(np.int64)), pa.array(first - offsets[doc] + base), pa.array(place - first),
                        pa.array([raw[a:b + length] for a, b in zip(first, last, strict=True)], pa.binary())],
                    names=["h1", "h2", "fp", "first", "lead", "ctx"])
    return run


def stable_order(*keys: np.ndarray) -> np.ndarray:
    """Stable order by non-negative integers below 2**32, the last key first
    in rank: numpy sorts 16-bit keys by counting."""
    order = None
    for key in keys:
        key = key.astype(np.uint32)
        for half in (key & np.uint32(0xFFFF), key >> np.uint32(16)):
            half = half.astype(np.uint16)
            if order is None:
                order = np.argsort(half, kind="stable")
            elif half.any():
                order = order[np.argsort(half[order], kind="stable")]
    return order


class Shards:
    """Suffixes of strings, dealt into shards, over an alphabet of blocks.

    A string of n bytes has the suffixes 0..n; one of fewer than ``symbol``
    bytes is an end: it sorts before all others, ends among themselves by
    place.  ``symbols[i]`` is the rank of the block at i.
    """

    def __init__(self, strings: list[bytes], symbol: int, shard_bytes: int = SHARD):
        sizes = np.array([len(s) + 1 for s in strings])
        self.begin = np.r_[0, np.cumsum(sizes)[:-1]]
        data = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
        n, self.symbol = len(data), symbol
        string = np.repeat(np.arange(len(strings)), sizes)
        left = (self.begin + sizes - 1)[string] - np.arange(n)           # bytes from here to the string's end
        self.is_end = left < symbol
        self.last = np.arange(n) + left // symbol * symbol               # the end that a suffix leads to
        full = np.flatnonzero(~self.is_end)
        block = textscan.span_hash(textscan.prefix_sums(data, textscan.TABLE_EXACT), full, full + symbol)
        self.symbols = np.full(n, -1, np.int32)
        self.symbols[full] = np.unique(block, return_inverse=True)[1]
        self.has_before = np.arange(n) - self.begin[string] >= symbol
        # whole strings to shards of about shard_bytes
        shard_of = (np.cumsum(sizes) - sizes) // shard_bytes
        edges = np.r_[np.flatnonzero(np.r_[True, shard_of[1:] != shard_of[:-1]]), len(strings)]
        at = np.r_[self.begin, n]
        self.orders = [self._sorted(int(at[p]), int(at[q])) for p, q in zip(edges, edges[1:], strict=False)]

    def _sorted(self, a: int, b: int) -> np.ndarray:
        """The places of one shard's suffixes in order, by doubled prefixes."""
        n, place, ends = b - a, np.arange(b - a), self.is_end[a:b]
        rank = np.empty(n, np.int64)
        rank[ends] = np.arange(ends.sum())
        rank[~ends] = self.symbols[a:b][~ends] + ends.sum()
        step = self.symbol
        while True:
            # a suffix that is compared up to its end has a rank of its own
            more = np.flatnonzero(place + step <= self.last[a:b] - a)
            follow = np.zeros(n, np.int64)
            follow[more] = rank[more + step] + 1
            order = stable_order(follow, rank)
            one, two = rank[order], follow[order]
            fresh = np.r_[False, (one[1:] != one[:-1]) | (two[1:] != two[:-1])]
            if fresh.sum() == n - 1:
                return order + a
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(fresh)
            step *= 2

    def transforms(self) -> list[np.ndarray]:
        """Per shard and suffix in order: the block before it, -1 without one."""
        return [np.where(self.has_before[o], self.symbols[np.maximum(o - self.symbol, 0)], -1) for o in self.orders]


def merge_transforms(transforms: list[np.ndarray], ends: list[int], rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Merges shard transforms.

    ``ends`` is the number of end suffixes of each shard.  Returns the
    interleave (the shard of each suffix of the merged order) and, for each,
    the number of its interval: suffixes of one interval share ``rounds`` blocks.
    """
    kind = np.uint8 if len(transforms) < 256 else np.uint16 if len(transforms) < 65536 else np.int64
    shards = np.arange(len(transforms)).astype(kind)
    z = np.repeat(shards, [len(t) for t in transforms])
    before = np.concatenate(transforms)
    end_z = np.repeat(shards, ends)
    interval = np.zeros(len(z), np.int32)
    for _ in range(rounds):
        # the k-th suffix of a shard in the interleave is the k-th of its transform
        where = np.argsort(z, kind="stable")
        block = np.empty(len(z), np.int32)
        block[where] = before
        some = np.flatnonzero(block >= 0)
        order = some[stable_order(block[some])]
        fresh = np.ones(len(order), np.int32)
        fresh[1:] = (block[order][1:] != block[order][:-1]) | (interval[order][1:] != interval[order][:-1])
        z = np.r_[end_z, z[order]]
        interval = np.r_[np.arange(len(end_z)), len(end_z) - 1 + np.cumsum(fresh)].astype(np.int32)
    return z, interval


def repeated_starts(strings: list[bytes], length: int, symbol: int, shard_bytes: int = SHARD) -> list[np.ndarray]:
    """For every string, which of its places begin a ``length``-byte string
    that begins at another place too."""
    s = Shards(strings, symbol, shard_bytes)
    z, interval = merge_transforms(s.transforms(), [int(s.is_end[o].sum()) for o in s.orders], length // symbol)
    place = np.empty(len(z), np.int64)
    place[np.argsort(z, kind="stable")] = np.concatenate(s.orders)
    hit = np.zeros(len(z), bool)
    hit[place] = np.bincount(interval)[interval] > 1
    return [hit[b:b + max(len(t) - length + 1, 0)] for b, t in zip(s.begin, strings, strict=True)]


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.r_[0, flags.astype(np.int8), 0]))
    return edge[::2], edge[1::2]


def _merge_contexts(length: int, symbol: int):
    """Rows sorted by anchor -> (c1, c2, runs of repeated starts)."""
    def solve(rows: list[tuple]):
        found = [(c1, c2, *_runs(flags)) for (c1, c2, _), flags in
                 zip(rows, repeated_starts([r[2] for r in rows], length, symbol), strict=True) if flags.any()]
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found]), pa.array([f[1] for f in found]),
                 pa.array([f[2].tolist() for f in found], pa.list_(pa.int64())),
                 pa.array([f[3].tolist() for f in found], pa.list_(pa.int64()))], names=["c1", "c2", "a", "b"])

    def run(batches):
        held, size, last = [], 0, None
        for batch in batches:
            for fp, *row in zip(*(batch.column(c).to_pylist() for c in ("fp", "c1", "c2", "ctx")), strict=True):
                if size >= TASK_BYTES and fp != last:
                    yield from solve(held)
                    held, size = [], 0
                held.append(tuple(row))
                size, last = size + len(row[2]) + 1, fp
        if held:
            yield from solve(held)
    return run


def _emit_windows(length: int):
    """(window hashes, context, start) of the contexts of hot anchors."""
    def run(batches):
        for batch in textscan.chunks(batches, "ctx"):
            data, offsets = textscan.as_buffer(batch.column("ctx"))
            at = np.concatenate([np.arange(a, b - length + 1) for a, b in zip(offsets, offsets[1:], strict=False)])
            row = np.searchsorted(offsets, at, "right") - 1
            pre = textscan.prefix_sums(data, textscan.TABLE_EXACT)
            half = length // 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(textscan.span_hash(pre, at, at + length).view(np.int64)),
                 pa.array(textscan.span_hash(pre, at, at + half).view(np.int64))] +
                [pa.array(batch.column(c).to_numpy()[row]) for c in ("c1", "c2")] + [pa.array(at - offsets[row])],
                names=["w1", "w2", "c1", "c2", "start"])
    return run


def _cut(length: int):
    """Texts with their spans -> what is left of them."""
    def run(batches):
        for batch in textscan.chunks(batches, "text"):
            data, offsets = textscan.as_buffer(batch.column("text"))
            raw, copies = data.tobytes(), batch.column("copies").to_numpy()
            removed, spans, digest, cuts = [], [], [], []
            for i, found in enumerate(batch.column("spans").to_pylist()):
                a, b = int(offsets[i]), int(offsets[i + 1])
                merged: list[list[int]] = []
                if copies[i] > 1 and b - a >= length:
                    merged = [[0, b - a]]
                else:
                    for s in sorted((s["first"], s["last"]) for s in found or ()):
                        if merged and s[0] <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], s[1])
                        else:
                            merged.append(list(s))
                h, at = hashlib.sha256(), a
                for p, q in merged:
                    h.update(raw[at:a + p])
                    at = a + q
                h.update(raw[at:b])
                digest.append(h.hexdigest())
                removed.append(sum(q - p for p, q in merged))
                spans.append(len(merged))
                cuts.append([{"start": p, "end": q} for p, q in merged])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                 pa.array(digest), pa.array(cuts, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])
    return run


def _merged(spans: DataFrame, key: list[str]) -> DataFrame:
    """Spans (key, first, last) with those of a text that touch made one, as
    an array per text; one shuffle by the key serves all steps."""
    order = Window.partitionBy(*key).orderBy("first", "last")
    reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.coalesce(F.col("first") > reach, F.lit(True)).cast("int")
    island = F.sum("apart").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    runs = spans.withColumn("apart", apart).withColumn("island", island)
    one = runs.groupBy(*key, "island").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return one.groupBy(*key).agg(F.collect_list(F.struct("first", "last")).alias("spans"))


def remove_repeats(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", length: int = 200,
                   gram: int = 48, symbol: int = 40, hot: int = 16_384,
                   max_broadcast_bytes: int = 64 << 20) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed (byte spans).

    The texts are joined with their anchors and with their spans by content
    hash.  A side of at most ``max_broadcast_bytes`` (counted first) is
    broadcast, so the texts stay where they are; a larger one makes Spark
    shuffle the texts.
    """
    if length % symbol or not 0 < gram < length:
        raise ValueError("length must be a multiple of symbol and longer than gram")
    spark = documents.sparkSession
    work_root(spark)

    paths: list[str] = []

    def stored(df: DataFrame, name: str) -> DataFrame:
        paths.append(scratch_dir(spark, name))
        with scoped_conf(spark, textscan.SMALL_BATCHES):
            df.write.parquet(paths[-1])
        return spark.read.parquet(paths[-1])

    def joined_with_texts(texts: DataFrame, side: DataFrame, on, how: str, items: str, item_bytes: int) -> DataFrame:
        size = side.agg(F.sum(F.size(items).cast("long") * item_bytes + 64)).first()[0] or 0
        return texts.join(F.broadcast(side) if size <= max_broadcast_bytes else side, on, how)

    body = F.coalesce(F.col(text), F.lit(""))
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), body.alias("text")) \
        .withColumn("h1", F.xxhash64("text")).withColumn("h2", F.xxhash64(F.lit(1), "text"))
    long_ = rows.where(F.octet_length("text") >= length)
    key = ["h1", "h2"]
    texts = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("rep"))

    found = stored(long_.select(*key, "text").mapInArrow(_emit_anchors(length, gram), "h1 long, h2 long, fp long, at long"), "anchors")
    place = F.xxhash64("h1", "h2", "at")
    again = found.groupBy("fp").agg(F.min(place).alias("x"), F.max(place).alias("y")).where("x <> y").select("fp")
    # stored, so that either side of the join is shuffled for it and AQE can
    # split the places of a very frequent anchor
    again = stored(again, "repeated-anchors")
    lists = found.join(again, "fp", "left_semi").groupBy(*key).agg(F.collect_set("at").alias("ats"))
    lists = stored(lists.join(texts, key).select(F.col("h1").alias("k1"), F.col("h2").alias("k2"), "rep", "ats"), "lists")
    # one document of each text
    wide = joined_with_texts(long_, lists, (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2"))
                             & F.col("doc_id").eqNullSafe(F.col("rep")), "inner", "ats", 8)
    contexts = wide.select(*key, "text", "ats").mapInArrow(
        _emit_contexts(length, gram), "h1 long, h2 long, fp long, first long, lead long, ctx binary")
    contexts = stored(contexts.withColumn("c1", F.xxhash64("fp", "lead", "ctx")).withColumn("c2", F.xxhash64("ctx", "lead")),
                      "contexts")
    for path in paths[:-1]:
        remove_folder(spark, path)
    del paths[:-1]

    ctx = ["c1", "c2"]
    one = stored(contexts.groupBy("fp", *ctx).agg(F.count(F.lit(1)).alias("n"), F.first("ctx").alias("ctx")), "distinct-contexts")
    width = stored(one.groupBy("fp").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "widths")     # for AQE, as above
    met = one.join(width, "fp")
    cold = met.where(F.col("m") <= hot).select("fp", *ctx, "ctx").repartition("fp").sortWithinPartitions("fp") \
        .mapInArrow(_merge_contexts(length, symbol), "c1 long, c2 long, a array<long>, b array<long>")
    cold = cold.select(*ctx, F.explode(F.arrays_zip("a", "b")).alias("s")).select(
        *ctx, F.col("s.a").alias("a"), F.col("s.b").alias("b"))
    windows = met.where(F.col("m") > hot).select(*ctx, "ctx").mapInArrow(
        _emit_windows(length), "w1 long, w2 long, c1 long, c2 long, start long")
    twice = windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("w1", "w2")
    warm = windows.join(twice, ["w1", "w2"], "left_semi").select(*ctx, F.col("start").alias("a"), (F.col("start") + 1).alias("b"))
    whole = one.where("n > 1").select(*ctx, F.lit(0).cast("long").alias("a"),
                                      (F.octet_length("ctx") - length + 1).cast("long").alias("b"))
    runs = cold.unionByName(warm).unionByName(whole)

    # runs of starts [a, b) of a context -> bytes of the text
    spans = contexts.select(*key, "first", *ctx).join(runs, ctx).select(
        *key, (F.col("first") + F.col("a")).alias("first"), (F.col("first") + F.col("b") + length - 1).alias("last"))
    # only the texts that lose something
    spans = texts.join(_merged(spans, key), key, "left").where("copies > 1 or spans is not null").select(
        *key, "copies", F.coalesce("spans", F.array().cast("array<struct<first:bigint,last:bigint>>")).alias("spans"))
    spans = stored(spans, "spans")
    whole_texts = joined_with_texts(rows, spans, key, "left", "spans", 16)
    left = stored(whole_texts.select("doc_id", "text", F.coalesce("copies", F.lit(1)).alias("copies"), "spans").mapInArrow(
        _cut(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                      "removed array<struct<start:long,end:long>>"), "left")
    for path in paths[:-1]:
        remove_folder(spark, path)
    return left


def repeats_digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
