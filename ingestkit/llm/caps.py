"""Embedding near-duplicates by spherical-cap filters.

A filter is the cap of unit vectors whose inner product with the filter's
direction is at least some threshold.  Directions come from random product
codes: after a seeded rotation the vector is cut into blocks, each block has
``K`` random code vectors, and a direction is one code vector per block.  A
vector is list-decoded to all directions it exceeds, block by block, dropping
partial sums that the best remaining blocks cannot lift over the threshold.

The threshold follows from the number of vectors (a filter holds about
``bucket`` of them).  Directions of one code are not independent, so several
small codes with rotations of their own are used: as many as bring the chance
that a pair right at the cosine limit shares no filter below ``miss``, by
that chance for one code, measured on random pairs of that cosine.

Vectors meet in the groups (label, dimension, filter); a group is dealt into
blocks of at most ``block`` vectors and every two blocks meet in one task.  A
pair counts in the smallest filter it shares, hence once; a vector travels with
the number of its filter only, and the task decodes those that have a near one
again.  Decoding therefore works on whole numbers held in doubles: every sum is
exact, so a vector exceeds the same filters wherever it is decoded.  Equal vectors of a
label are one vector with a number of copies.  A task returns the number of
links of each vector and, per group, one edge a vector towards the group's
component, never the pairs.

Cases: vectors that are null, empty, zero or hold null or non-finite values,
and vectors with a null label or id, link with nothing; vectors of different
length do not link; repeated rows are links of each other; rows that share an id
share their links; components may be floats, doubles or whole numbers; a null id has a
null component; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingestkit.llm import textscan
from ingestkit.llm.components import connected_components
from ingestkit.llm.stage import Stage
from ingestkit.session import scoped_conf


def _cap(d: int, s: np.ndarray) -> np.ndarray:
    """Share of the unit sphere in d dimensions above height s."""
    x = np.linspace(-1, 1, 20001)
    area = np.cumsum((1 - x * x).clip(0) ** ((d - 3) / 2))
    return 1 - np.interp(s, x, area / area[-1])


def _both(d: int, s: float, rho: float) -> float:
    """Share of directions that exceed s for both vectors of a pair at rho."""
    x = np.linspace(-1, 1, 20001)
    weight = (1 - x * x).clip(0) ** ((d - 3) / 2)
    up = x >= s
    need = (s - rho * x[up]) / np.maximum(np.sqrt((1 - rho * rho) * (1 - x[up] ** 2)), 1e-12)
    return float((weight[up] * _cap(d - 1, np.clip(need, -1, 1))).sum() / weight.sum())


def plan_filters(n: int, d: int, cosine: float, *, bucket: int, each: float = 2.0, miss: float = 1e-4,
                 seed: int = 5) -> dict:
    """Threshold, blocks, code vectors per block and number of codes for ``n``
    vectors of ``d`` dimensions; below 8 dimensions one filter holds all."""
    if d < 8:
        return {"d": d, "codes": 0}
    share = min(5e-3, max(bucket / max(n, 1), 1e-12))
    heights = np.linspace(0, 1, 20001)
    height = round(float(heights[np.argmax(_cap(d, heights) <= share)]) * GRID) / GRID
    total = each / max(_both(d, height, cosine), 1e-15)
    blocks = 2 if total < 1e6 else 4
    plan = {"d": d, "height": height, "blocks": blocks, "codes": math.ceil(total ** (1 / blocks)), "seed": seed, "repeat": 3}
    rng = np.random.default_rng(seed + 1)
    x, side = rng.standard_normal((2, 300, d))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side -= (side * x).sum(axis=1, keepdims=True) * x
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    found = [list_decode(v, plan) for v in (x, cosine * x + math.sqrt(1 - cosine * cosine) * side)]
    wide = plan["codes"] ** blocks
    pairs = [set(zip(row.tolist(), name.tolist(), strict=True)) for row, name in found]
    hit = {(row, name // wide) for row, name in pairs[0] & pairs[1]}
    lost = max(1 - len(hit) / (300 * plan["repeat"]), 0.05)
    return plan | {"repeat": max(2, math.ceil(math.log(miss) / math.log(lost)))}


# Coordinates are whole multiples of 1 / GRID; sums of products stay below 2**53.
GRID = 2.0 ** 24


def code_vectors(plan: dict, repetition: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(rotation, per block the scaled code vectors) of one code, on the grid."""
    cache = textscan.process_cache()
    key = ("cap codes", *sorted(plan.items()), repetition)
    if key not in cache:
        cache[key] = _code_vectors(plan, repetition)
    return cache[key]


def _code_vectors(plan: dict, repetition: int) -> tuple[np.ndarray, list[np.ndarray]]:
    d, blocks = plan["d"], plan["blocks"]
    rng = np.random.default_rng([plan["seed"], d, repetition])
    rotation = np.linalg.qr(rng.standard_normal((d, d)))[0]
    out = []
    for part in np.array_split(np.arange(d), blocks):
        c = rng.standard_normal((plan["codes"], len(part)))
        out.append(np.round(c / np.linalg.norm(c, axis=1, keepdims=True) / math.sqrt(blocks) * GRID) / GRID)
    return np.round(rotation * GRID) / GRID, out


def list_decode(unit: np.ndarray, plan: dict, upto: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter) of every direction that a row of ``unit`` exceeds, of the
    first ``upto`` codes or of all."""
    if not plan["codes"]:
        return np.arange(len(unit)), np.zeros(len(unit), np.int64)
    found, unit = [], np.round(unit * GRID) / GRID
    for repetition in range(plan["repeat"] if upto is None else upto):
        rotation, codes = code_vectors(plan, repetition)
        turned = np.round(unit @ rotation * GRID) / GRID
        cuts = np.cumsum([0] + [c.shape[1] for c in codes])
        scores = [turned[:, a:b] @ c.T for a, b, c in zip(cuts, cuts[1:], codes, strict=False)]
        best = np.array([s.max(axis=1) for s in scores])
        rest = np.vstack([np.cumsum(best[::-1], axis=0)[::-1][1:], np.zeros((1, len(unit)))])
        row, name, total = np.arange(len(unit)), np.full(len(unit), repetition, np.int64), np.zeros(len(unit))
        for s, more in zip(scores, rest, strict=True):
            sums = total[:, None] + s[row]
            at, code = np.nonzero(sums >= (plan["height"] - more[row])[:, None])
            row, name, total = row[at], name[at] * s.shape[1] + code, sums[at, code]
        found.append((row, name))
    return np.concatenate([r for r, _ in found]), np.concatenate([f for _, f in found])


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _decode(plans: dict[int, dict]):
    """A row for every filter of every vector; the vector itself comes along."""
    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                vectors = part.column("embedding")
                size = np.diff(vectors.offsets.to_numpy())
                for d in np.unique(size):
                    rows = np.flatnonzero(size == d)
                    x = vectors.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
                    row, name = list_decode(_unit(x), plans[int(d)])
                    own = part.take(pa.array(rows[row]))
                    yield pa.RecordBatch.from_arrays(
                        own.columns + [pa.array(np.full(len(row), d, np.int32)), pa.array(name)],
                        names=own.schema.names + ["d", "filter"])
    return run


def _count_filters(plans: dict[int, dict]):
    """(label, d, filter, m) with m vectors, added up within the task."""
    def run(batches):
        for batch in _decode(plans)(batches):
            t = pa.Table.from_batches([batch.select(["label", "d", "filter"])])
            t = t.group_by(["label", "d", "filter"]).aggregate([([], "count_all")])
            yield from t.rename_columns(["label", "d", "filter", "m"]).to_batches()
    return run


def _component_labels(near: np.ndarray) -> np.ndarray:
    label = np.arange(len(near))
    while True:
        new = np.where(near, label[None, :], len(near)).min(axis=1)
        new = np.minimum(new, label)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _common_before(a: np.ndarray, b: np.ndarray, lists: list[np.ndarray], own: int) -> np.ndarray:
    """For pairs (a, b): whether they share a filter smaller than ``own``."""
    used = np.unique(np.r_[a, b])
    short = {int(i): lists[i][lists[i] < own] for i in used}
    names = np.unique(np.concatenate(list(short.values()))) if len(used) else np.zeros(0, np.int64)
    if not len(names):
        return np.zeros(len(a), bool)
    member = np.zeros((len(used), len(names)), np.float32)
    for r, i in enumerate(used):
        member[r, np.searchsorted(names, short[int(i)])] = 1
    shared = member @ member.T
    at = np.searchsorted(used, np.r_[a, b])
    return shared[at[:len(a)], at[len(a):]] > 0


def _lists(x: np.ndarray, at: np.ndarray, plan: dict, upto: int | None = None) -> list:
    """The filters of the rows ``at`` of x (none for the others)."""
    lists = [None] * len(x)
    for first in range(0, len(at), 256):
        some = at[first:first + 256]
        row, name = list_decode(_unit(x[some]), plan, upto)
        name = name[np.argsort(row, kind="stable")]
        for i, own in zip(some, np.split(name, np.cumsum(np.bincount(row, minlength=len(some)))[:-1]), strict=True):
            lists[i] = own
    return lists


def _near(rows: dict, cosine: float) -> np.ndarray:
    """Which vectors of one pair of blocks are near."""
    x = rows["x"]
    near = (x @ x.T) / (rows["norm"][:, None] * rows["norm"][None, :]) >= cosine
    np.fill_diagonal(near, False)
    if rows["left"].any() and not rows["left"].all():     # two different blocks
        near &= rows["left"][:, None] != rows["left"][None, :]
    return near


def _links_of_group(rows: dict, lists: list, cosine: float):
    """(ids, links) and (id, towards) of one pair of blocks."""
    ids, near = rows["rep"], _near(rows, cosine)
    a, b = np.nonzero(np.triu(near))
    label = _component_labels(near)
    fresh = ~_common_before(a, b, lists, rows["filter"])
    count = np.zeros(len(ids), np.int64)
    np.add.at(count, a[fresh], rows["copies"][b[fresh]])
    np.add.at(count, b[fresh], rows["copies"][a[fresh]])
    smallest = np.full(len(ids), np.iinfo(np.int64).max)
    np.minimum.at(smallest, label, ids)
    some = near.any(axis=1)
    return ids[some], count[some], smallest[label][some]


def _verify(cosine: float, plans: dict[int, dict]):
    key = ["label", "d", "filter", "g", "h"]

    def read(t: pa.Table) -> dict:
        d = t.column("d")[0].as_py()
        x = t.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
        return {"rep": t.column("rep").to_numpy(), "copies": t.column("copies").to_numpy(), "x": x, "d": d,
                "norm": np.sqrt((x * x).sum(axis=1)), "left": t.column("left").to_numpy(),
                "filter": t.column("filter")[0].as_py()}

    def link(groups: list[dict]):
        """Of groups of one length: their near vectors are decoded together."""
        some = [_near(g, cosine).any(axis=1) for g in groups]
        groups, some = zip(*[(g, at) for g, at in zip(groups, some, strict=True) if at.any()], strict=True) \
            if any(at.any() for at in some) else ((), ())
        if not groups:
            return
        plan, sizes = plans[groups[0]["d"]], np.cumsum([0] + [len(at) for at in some])
        if plan["codes"]:   # only codes up to a filter's own can hold a smaller one
            upto = int(max(g["filter"] for g in groups) // plan["codes"] ** plan["blocks"]) + 1
            lists = _lists(np.concatenate([g["x"] for g in groups]), np.flatnonzero(np.concatenate(some)), plan, upto)
        else:
            lists = [np.zeros(1, np.int64)] * int(sizes[-1])
        for g, p, q in zip(groups, sizes, sizes[1:], strict=False):
            yield _links_of_group(g, lists[p:q], cosine)

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
        groups = [read(t.slice(p, q - p)) for p, q in zip(cuts, cuts[1:], strict=False) if q - p > 1]
        found = [r for d in {g["d"] for g in groups} for r in link([g for g in groups if g["d"] == d])]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)],
                                             names=["rep", "links", "towards"])
    return run


def near_vectors(vectors: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
                 cosine: float = 0.93, bucket: int = 200, miss: float = 1e-4, block: int = 1024) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    stage = Stage(spark)
    e = F.col("embedding")
    sane = (F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists(e, lambda x: x != 0) & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    # components stay floats if they are, all other numbers are doubles
    held = vectors.schema[embedding].dataType.elementType.simpleString()
    kind = "float" if held == "float" else "double"
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast(f"array<{kind}>").alias("embedding"),
                          F.col(label).cast("long").alias("label"))
    rows = rows.withColumn("ok", F.coalesce(sane, F.lit(False))) \
        .withColumn("h1", F.xxhash64(e)).withColumn("h2", F.xxhash64(F.lit(1), e))
    same = ["label", "h1", "h2"]
    one = rows.where("ok").groupBy(*same).agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"),
                                              F.first("embedding").alias("embedding"))
    one = stage(one, "vectors")
    # one row a vector length
    plans = {r.d: plan_filters(r.n, r.d, cosine, bucket=bucket, miss=miss)
             for r in one.groupBy(F.size("embedding").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()}

    basic = one.select("rep", "copies", "label", "embedding")
    at = ["label", "d", "filter"]
    entries = basic.mapInArrow(_decode(plans), f"rep long, copies long, label long, embedding array<{kind}>, d int, filter long")
    # only groups above one block are cut; stored, so that their size is known when the join is planned
    sizes = one.select("label", "embedding").mapInArrow(_count_filters(plans), "label long, d int, filter long, m long")
    wide = stage(sizes.groupBy(*at).agg(F.sum("m").alias("m")).where(F.col("m") > block), "vector-groups")
    # blocks of a group; each two of them meet once, a block also meets itself
    dealt = entries.join(wide, at, "left").withColumn("nb", F.coalesce(F.ceil(F.col("m") / block), F.lit(1)).cast("int")) \
        .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("nb")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    meet = dealt.select("rep", "copies", "embedding", *at, F.least("own", "other").alias("g"),
                        F.greatest("own", "other").alias("h"), (F.col("own") < F.col("other")).alias("left"))
    key = [*at, "g", "h"]
    found = meet.repartition(*key).sortWithinPartitions(*key).mapInArrow(_verify(cosine, plans), "rep long, links long, towards long")
    with scoped_conf(spark, textscan.SMALL_BATCHES):
        found = stage(found, "vector-links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select(F.col("rep").alias("a"), F.col("towards").alias("b")))
    per = one.select(*same, "rep", "copies").join(links, "rep", "left").join(parts, F.col("rep") == F.col("node"), "left") \
        .select(*same, F.lit(True).alias("ok"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"),
                F.coalesce("component", "rep").alias("c"))
    result = rows.drop("embedding").join(per, [*same, "ok"], "left").select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("c", "vec_id").alias("component_id")) \
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    return stage.finish(result)
