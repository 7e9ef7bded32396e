"""Near-duplicate documents by bottom-k sketches of one hash function.

A document's set is its distinct ``n``-word shingles.  Its sketch is the ``k``
smallest hash values of the set.

1. Documents with equal sets (two independent 63-bit sums and the size) are
   one class, represented by its smallest id.
2. Inverted lists: sketch values that at least two classes retain.  Two sets
   right at the threshold share fewer than ``need`` of ``k`` sketch values with
   a probability of at most ``loss`` (a binomial tail; sets that fit into the
   sketch share all that the threshold asks for), so they share one among each
   one's ``size - need + 1`` rarest values.  Only those are kept
   in lists; very frequent values are only kept by documents made of them.
3. First round: each member of a list is compared with its hub, the member
   that shares most of its sketch with others (the original of edited copies).
   Second round: members that a list still holds apart.  Lists with the same
   largest component form one group; the group's other members meet each
   other and that component, dealt into blocks of bounded size, two of which
   meet in one task.  A task returns one edge a member, never the pairs.
4. A pair goes on if the sketch of its union estimates a similarity of at
   least ``need / k``, which is the same tail; the exact similarity of the full
   sets decides.  ``exact=True`` takes whole sets as sketches: it loses no link,
   at the price of lists of all shingles.

Cases: null, empty or word-free texts have no set and link with nothing; a
text of fewer than ``n`` words is one shingle; rows that share an id count as
one document with the links of all of them; a null id links with nothing and
has a null component; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingestkit.llm import textscan
from ingestkit.llm.components import connected_components
from ingestkit.session import remove_folder, scoped_conf, scratch_dir, work_root

MAX_BROADCAST_IDS = 2_000_000      # 16 MB of ids; beyond, the texts are shuffled by id
SKETCH = "doc_id long, n_shingles long, sig_a long, sig_b long, sketch array<long>"


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, n: int) -> list[np.ndarray]:
    """The sorted distinct 63-bit shingle hashes of every document."""
    h, _, counts = textscan.word_hashes(data, offsets)
    ends = np.cumsum(counts)
    muls = textscan.powers(n + 1, np.uint64(0xD6E8FEB86659FD93))
    rolled = np.zeros(max(len(h) - n + 1, 0), np.uint64)
    for j in range(n):
        rolled += h[j:j + len(rolled)] * muls[j + 1]
    rolled = textscan.mix(rolled) >> np.uint64(1)
    out = []
    for end, count in zip(ends, counts, strict=True):
        if count >= n:
            out.append(np.unique(rolled[end - count:end - n + 1]))
        elif count:
            few = np.array([np.sum(h[end - count:end] * muls[1:count + 1]) + np.uint64(count)], np.uint64)
            out.append(textscan.mix(textscan.mix(few)) >> np.uint64(1))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _sketches(n: int, k: int):
    def run(batches):
        for batch in textscan.chunks(batches, "text", textscan.SMALL_CHUNK):
            sets = shingle_hashes(*textscan.as_buffer(batch.column("text")), n)
            low = [s[:k] for s in sets]
            sig = [(textscan.mix(s).sum(), textscan.mix(s + np.uint64(1)).sum()) if len(s) else (0, 0) for s in sets]
            sig = (np.array(sig, np.uint64) >> np.uint64(1)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array(sig[:, 0]), pa.array(sig[:, 1]),
                textscan.list_column(np.concatenate(low).astype(np.int64), [len(s) for s in low], pa.int64())],
                names=["doc_id", "n_shingles", "sig_a", "sig_b", "sketch"])
    return run


def _sets(n: int):
    def run(batches):
        for batch in textscan.chunks(batches, "text", textscan.SMALL_CHUNK):
            sets = shingle_hashes(*textscan.as_buffer(batch.column("text")), n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), textscan.list_column(np.concatenate(sets).astype(np.int64), [len(s) for s in sets], pa.int64())],
                names=["rep", "set"])
    return run


def _full_sets(documents: DataFrame, ids: DataFrame, *, doc_id: str, text: str, n: int) -> DataFrame:
    """(rep, set) of the documents named in ``ids``; rows that share an id
    bring a set each."""
    if ids.count() <= MAX_BROADCAST_IDS:
        ids = F.broadcast(ids)
    docs = documents.select(F.col(doc_id).cast("long").alias("rep"), F.col(text).alias("text"))
    return docs.join(ids, "rep", "left_semi").mapInArrow(_sets(n), "rep long, set array<long>")


def sketch_documents(documents: DataFrame, *, doc_id: str, text: str, n: int, k: int) -> DataFrame:
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_sketches(n, k), SKETCH)


def _compatible(a: str, b: str, percent: int):
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def least_shared(k: int, percent: int, loss: float) -> int:
    """The largest m such that fewer than m of k independent draws of chance
    ``percent`` come out with a probability of at most ``loss``."""
    p, tail = percent / 100, 0.0
    for m in range(k + 1):
        tail += math.comb(k, m) * p**m * (1 - p) ** (k - m)
        if tail > loss:
            return m
    return k


def listed(classes: DataFrame, need: int, percent: int, stored) -> DataFrame:
    """(v, rep, n, shares): the rarest sketch values of each class that others
    retain too, and how many of its values others retain.  Counts are stored, so
    that a join with them shuffles both sides and AQE can split a hot value."""
    entries = classes.select("rep", "n", F.size("sketch").alias("sz"), F.explode("sketch").alias("v"))
    df = stored(entries.groupBy("v").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "frequencies")
    # values that no other class retains are the rarest and need no list
    mine = entries.join(df, "v").groupBy("rep", "n", "sz").agg(
        F.array_sort(F.collect_list(F.struct("df", "v"))).alias("shared"))
    must = F.least(F.lit(need), F.ceil(F.col("sz") * percent / 100)).cast("int")
    room = F.col("sz") - must + 1 - (F.col("sz") - F.size("shared"))
    return mine.where(room > 0).select(
        "rep", "n", F.size("shared").alias("shares"), F.explode(F.slice("shared", 1, room.cast("int"))).alias("s")) \
        .select(F.col("s.v").alias("v"), "rep", "n", "shares")


def _estimated(pairs: DataFrame, classes: DataFrame, k: int | None, estimate: float) -> DataFrame:
    """Pairs whose union sketch estimates at least ``estimate``; without ``k``
    all of them, as the sketches are the sets."""
    if k is None:
        return pairs
    sk = classes.select("rep", "sketch")
    both = (pairs.join(sk.select(F.col("rep").alias("a"), F.col("sketch").alias("sa")), "a")
            .join(sk.select(F.col("rep").alias("b"), F.col("sketch").alias("sb")), "b"))
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)
    shared = F.size(F.array_intersect(union, F.array_intersect("sa", "sb")))
    return both.where(shared >= F.lit(estimate) * F.size(union)).select("a", "b")


def union_estimates(a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
    """Estimated similarity of the sketches in the rows of ``a`` and ``b``
    (sorted, filled up with -1 and -2)."""
    both = np.sort(np.hstack([a, b]), axis=1)
    real = both >= 0
    again = np.zeros(both.shape, bool)
    again[:, 1:] = real[:, 1:] & (both[:, 1:] == both[:, :-1])
    place = np.cumsum(real & ~again, axis=1)          # rank in the union
    return (again & (place <= k)).sum(axis=1) / np.maximum(np.minimum(place[:, -1], k), 1)


def shared_counts(sets: list[np.ndarray], rows: np.ndarray, columns: np.ndarray, width: int = 8192) -> np.ndarray:
    """Sizes of the intersections of ``sets[rows]`` with ``sets[columns]``."""
    used = np.r_[rows, columns]
    values, inverse, count = np.unique(np.concatenate([sets[i] for i in used]), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(used)), [len(sets[i]) for i in used])
    keep = count[inverse] > 1
    name, owner = np.unique(inverse[keep], return_inverse=True)[1], owner[keep]
    order = np.argsort(name, kind="stable")
    name, owner = name[order], owner[order]
    out = np.zeros((len(rows), len(columns)), np.float32)
    for first in range(0, int(name[-1]) + 1 if len(name) else 0, width):
        p, q = np.searchsorted(name, [first, first + width])
        member = np.zeros((len(used), width), np.float32)
        member[owner[p:q], name[p:q] - first] = 1
        out += member[:len(rows)] @ member[len(rows):].T
    return out.astype(np.int64)


def _links_of_blocks(sets: list[np.ndarray], part: np.ndarray, left: np.ndarray, *, k: int | None, need: int,
                     percent: int, estimate: float) -> np.ndarray:
    """For each member, the first member of its component within the two
    blocks; ``part`` is the component that a member is in already."""
    n = len(sets)
    rows, columns = (np.flatnonzero(left), np.flatnonzero(~left)) if not left.all() else (np.arange(n), np.arange(n))
    low = [s[:k] for s in sets]
    size = np.array([len(s) for s in sets])
    must = np.minimum(need, -(-np.array([len(s) for s in low]) * percent // 100))
    shared = shared_counts(low, rows, columns)
    ok = shared >= np.maximum(must[rows][:, None], must[columns][None, :])
    ok &= part[rows][:, None] != part[columns][None, :]
    small, large = (f(size[rows][:, None], size[columns][None, :]) for f in (np.minimum, np.maximum))
    ok &= small * 100 >= large * percent
    i, j = np.nonzero(ok)
    i, j = rows[i], columns[j]
    if left.all():
        i, j = i[i < j], j[i < j]
    near = np.arange(n)
    if not len(i):
        return near
    if k is not None:
        filled = [np.full((n, k), fill, np.int64) for fill in (-1, -2)]
        for r, s in enumerate(low):
            filled[0][r, :len(s)] = filled[1][r, :len(s)] = s
        good = np.concatenate([union_estimates(filled[0][i[p:p + 8192]], filled[1][j[p:p + 8192]], k) >= estimate
                               for p in range(0, len(i), 8192)])
        i, j = i[good], j[good]
    if not len(i):
        return near
    if len(i) <= 256:
        inter = np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(i, j, strict=True)])
    else:
        used = np.unique(i), np.unique(j)
        inter = shared_counts(sets, *used)[np.searchsorted(used[0], i), np.searchsorted(used[1], j)]
    link = inter * 100 >= (size[i] + size[j] - inter) * percent
    i, j = i[link], j[link]
    while True:                                       # smallest member reachable by links
        new = near.copy()
        np.minimum.at(new, i, near[j])
        np.minimum.at(new, j, near[i])
        new = new[new]
        if (new == near).all():
            return near
        near = new


def _solve_groups(options: dict):
    key = ["top", "g", "h"]

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = pa.Table.from_batches([batch])
            held = now if held is None else pa.concat_tables([held, now])
            keys = np.stack([held.column(c).to_numpy() for c in key])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            if len(cuts):
                yield from emit(held, np.r_[0, cuts])
                held = held.slice(int(cuts[-1]))
        if held is not None:
            yield from emit(held, np.array([0, held.num_rows]))

    def emit(t: pa.Table, cuts: np.ndarray):
        ids, part, left = (t.column(c).to_numpy() for c in ("rep", "part", "left"))
        column = t.column("set").combine_chunks()
        flat, at = column.flatten().to_numpy(), column.offsets.to_numpy() - column.offsets.to_numpy()[0]
        a, b = [], []
        for p, q in zip(cuts, cuts[1:], strict=False):
            if q - p > 1 and left[p:q].any():
                sets = [flat[x:y] for x, y in zip(at[p:q], at[p + 1:q + 1], strict=True)]
                near = _links_of_blocks(sets, part[p:q], left[p:q], **options)
                own = np.flatnonzero(near != np.arange(q - p))
                a.append(ids[p:q][near[own]])
                b.append(ids[p:q][own])
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])
    return run


def _groups(lists: DataFrame, found: DataFrame, block: int, block_shingles: int, stored) -> DataFrame:
    """(rep, part, top, g, h, left): the members that lists hold apart, once
    for every two blocks that meet."""
    marked = lists.join(found, F.col("rep") == F.col("node"), "left") \
        .select("v", "rep", "n", F.coalesce("component", "rep").alias("part"))
    sizes = marked.groupBy("v", "part").agg(F.count(F.lit(1)).alias("m"))
    apart = sizes.groupBy("v").agg(F.count(F.lit(1)).alias("parts"), F.max(F.struct("m", "part")).alias("top")) \
        .where("parts > 1").select("v", F.col("top.part").alias("top"))
    apart = stored(apart, "lists-apart")
    members = marked.join(apart, "v").select("top", "rep", "n", "part").distinct() \
        .withColumn("minor", F.col("part") != F.col("top"))

    def blocks(minor: bool):
        mine = F.col("minor") == F.lit(minor)
        return F.greatest(F.ceil(F.sum(mine.cast("long")) / block),
                          F.ceil(F.sum(F.when(mine, F.col("n")).otherwise(0)) / block_shingles)).cast("int")
    count = members.groupBy("top").agg(blocks(True).alias("nm"), blocks(False).alias("nt"))
    dealt = members.join(count, "top").withColumn(
        "own", F.pmod(F.xxhash64("rep"), F.when(F.col("minor"), F.col("nm")).otherwise(F.col("nt"))).cast("int"))
    # blocks 0..nm-1 are of other members, from nm on of the largest component
    none = F.array().cast("array<int>")
    range_ = lambda first, n: F.when(n > 0, F.sequence(first, first + n - 1)).otherwise(none)
    other = F.when(F.col("minor"), range_(F.lit(0), F.col("nm") + F.col("nt"))).otherwise(range_(F.lit(0), F.col("nm")))
    place = F.when(F.col("minor"), F.col("own")).otherwise(F.col("own") + F.col("nm"))
    return dealt.withColumn("place", place).withColumn("other", F.explode(other)).select(
        "rep", "part", "top", F.least("place", "other").alias("g"), F.greatest("place", "other").alias("h"),
        (F.col("place") <= F.col("other")).alias("left"))


def near_duplicates(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", n: int = 5, k: int = 64,
                    percent: int = 75, loss: float = 1e-8, exact: bool = False, block: int = 256,
                    block_shingles: int = 1_000_000) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.  ``loss``
    bounds the chance to miss a pair right at the threshold; ``exact`` misses none."""
    spark = documents.sparkSession
    need = 1 << 40 if exact else least_shared(k, percent, loss)
    estimate, k = need / k, None if exact else k
    work_root(spark)
    paths: list[str] = []

    def stored(df: DataFrame, name: str) -> DataFrame:
        paths.append(scratch_dir(spark, name))
        with scoped_conf(spark, textscan.SMALL_BATCHES):
            df.write.parquet(paths[-1])
        return spark.read.parquet(paths[-1])

    sketched = stored(sketch_documents(documents, doc_id=doc_id, text=text, n=n, k=k), "sketches")
    with_set = sketched.where("n_shingles > 0 and doc_id is not null")
    same = ["n_shingles", "sig_a", "sig_b"]
    classes = with_set.groupBy(*same).agg(F.min("doc_id").alias("rep"), F.first("sketch").alias("sketch")) \
        .select("rep", F.col("n_shingles").alias("n"), *same, "sketch")
    classes = stored(classes, "classes")
    lists = stored(listed(classes, need, percent, stored), "lists")
    sets = stored(_full_sets(documents, lists.select("rep").distinct(), doc_id=doc_id, text=text, n=n), "sets")

    hubs = stored(lists.groupBy("v").agg(F.max(F.struct("shares", (-F.col("rep")).alias("x"), "rep", "n")).alias("h")), "hubs")
    star = lists.join(hubs, "v").where(_compatible("n", "h.n", percent)).select(
        F.col("h.rep").alias("a"), F.col("rep").alias("b")).where("a <> b").distinct()
    star = stored(_estimated(star, classes, k, estimate), "star")
    own = star.join(sets.select(F.col("rep").alias("b"), F.col("set").alias("set_b")), "b")
    both = own.join(sets.select(F.col("rep").alias("a"), F.col("set").alias("set_a")), "a")
    inter = F.size(F.array_intersect("set_a", "set_b"))
    first = stored(both.where(inter * 100 >= (F.size("set_a") + F.size("set_b") - inter) * percent).select("a", "b"), "links")
    found = connected_components(first)

    groups = _groups(lists, found, block, block_shingles, stored)
    key = ["top", "g", "h"]
    options = {"k": k, "need": need, "percent": percent, "estimate": estimate}
    second = stored(groups.join(sets, "rep").select("rep", "part", "left", "set", *key).repartition(*key)
                    .sortWithinPartitions(*key).mapInArrow(_solve_groups(options), "a long, b long"), "links")

    class_of = with_set.join(classes.drop("sketch", "n"), same).select("doc_id", "rep")
    exact = class_of.where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    found = connected_components(first.unionByName(second).unionByName(exact))
    sizes = stored(sketched.select("doc_id", "n_shingles"), "set-sizes")
    for path in paths[:-1]:
        remove_folder(spark, path)
    return sizes.join(found, F.col("doc_id") == F.col("node"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")) \
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _without_copies(documents: DataFrame, doc_id: str, **options) -> DataFrame:
    """The documents, of distinct ids, without the copies.  The ids that go are
    broadcast after a count, so that no text is shuffled."""
    gone = near_duplicates(documents, doc_id=doc_id, **options).where(~F.col("kept")).select(F.col("doc_id").alias("__gone")).checkpoint()
    if gone.count() <= MAX_BROADCAST_IDS:
        gone = F.broadcast(gone)
    return documents.join(gone, F.col(doc_id) == F.col("__gone"), "left_anti")


def drop_near_duplicates(documents: DataFrame, **options) -> DataFrame:
    """The documents without the copies: one of each component stays."""
    doc_id = options.get("doc_id", "doc_id")
    kept = near_duplicates(documents, **options).where("kept").select(F.col("doc_id").alias("__kept")).distinct()
    with_id = documents.where(F.col(doc_id).isNotNull()).join(kept, F.col(doc_id) == F.col("__kept"), "left_semi")
    return with_id.dropDuplicates([doc_id]).unionByName(documents.where(F.col(doc_id).isNull()))


def drop_near_copies(documents: DataFrame, *, doc_id: str = "doc_id", **options) -> DataFrame:
    """One row of each component of rows, that of the smallest id: rows of one
    id are documents of their own, and those without an id are linked too."""
    spark = documents.sparkSession
    work_root(spark)
    ids = documents.select(F.col(doc_id).cast("long").alias("__id"))
    odd = ids.groupBy("__id").agg(F.count(F.lit(1)).alias("__n")).where("__id is null or __n > 1")
    if odd.isEmpty():
        return _without_copies(documents, doc_id, **options)
    path = scratch_dir(spark, "keyed-rows")       # read again with the same keys
    with scoped_conf(spark, textscan.SMALL_BATCHES):
        documents.withColumn("__key", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    found = near_duplicates(rows, doc_id="__key", **options).select(F.col("doc_id").alias("__key"), "component_id")
    own = rows.select("__key", F.col(doc_id).cast("long").alias("__id")).join(found, "__key")
    first = F.min(F.struct(F.col("__id").isNull(), F.col("__id"), F.col("__key")))
    kept = own.groupBy("component_id").agg(first.alias("__first")).select(F.col("__first.__key").alias("__key"))
    return rows.join(kept, "__key", "left_semi").select(*documents.columns)
