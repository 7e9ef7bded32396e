"""Language identification: family first, then one-versus-one within it.

Features are hashed byte trigrams of the lower-cased text, everything but
letters read as one blank, square-rooted and scaled to length one.  Linear
support vector machines are trained on a bounded sample of the labelled rows:
one machine a family against the rest, and one for every two languages of a
family, all in one job, a machine a group.  A text gets the family of the largest margin, then the
language that wins most of its family's duels (ties: the larger sum of
margins).  The score is the product of the family's and the duels' logistic
confidences.

``sample_per_language`` bounds the training rows: the distinct texts of each
language with the smallest hashes, one row each, so the sample is a fixed one
that copies of a text do not change.  ``rows_per_machine`` bounds the rows of one
machine: with more, it takes the same smaller number of each language.  More
than ``max_languages`` different labels are an error.  Prediction is one narrow pass over whole texts.

Cases: null texts and texts without a letter are ``und`` with score 0; so is
everything when there is no labelled row; with one language all texts with a
letter get it; languages without a known family are families of their own;
a null id counts as held out; an empty table gives no rows; other columns
pass through, columns named like the outputs are replaced.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ingestkit.llm import textscan
from ingestkit.session import remove_folder, scratch_dir, work_root

# Which languages are close relatives.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance",
    "ru": "slavic", "uk": "slavic", "pl": "slavic", "cs": "slavic", "bg": "slavic", "sk": "slavic",
}
DIMENSIONS = 2048
ROWS = 256                  # texts whose features are held at a time, as single or as double precision numbers
UNKNOWN = "und"

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_FOLD = np.where(_LETTER | (np.arange(256) >= 128), np.arange(256), 32).astype(np.uint32)
_FOLD[65:91] = np.arange(97, 123)


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of length one (or zero) per text."""
    n = len(offsets) - 1
    if len(data) < 3:
        return np.zeros((n, DIMENSIONS), np.float32)
    b = _FOLD[data]
    code = (b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)) * np.uint32(0x9E3779B1) >> np.uint32(21)
    at = np.arange(len(code))
    doc = np.repeat(np.arange(n), np.diff(offsets))[:len(code)]
    whole = at + 3 <= offsets[doc + 1]
    count = np.bincount(doc[whole] * DIMENSIONS + code[whole], minlength=n * DIMENSIONS).reshape(n, DIMENSIONS)
    x = np.sqrt(count.astype(np.float32))
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    plain = np.r_[0, np.cumsum(_LETTER[data])]
    found = plain[offsets[1:]] > plain[offsets[:-1]]
    for i in np.flatnonzero(~found):             # other scripts: look at the characters
        found[i] = any(map(str.isalpha, data[offsets[i]:offsets[i + 1]].tobytes().decode()))
    return found


def held_out(doc_id: str, folds: int = 5) -> Column:
    """Whether the crc32 of the id as text leaves no remainder."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds == 0


def _featurize(batches):
    for batch in textscan.chunks(batches, "text", textscan.SMALL_CHUNK, ROWS):
        x = features(*textscan.as_buffer(batch.column("text")))
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in ("lang", "h", "rank")],
             textscan.list_column(x.ravel(), [DIMENSIONS] * len(x), pa.float32())], names=["lang", "h", "rank", "x"])


def fit_machine(x: np.ndarray, y: np.ndarray, *, reg: float, max_iter: int) -> np.ndarray:
    """Weights and intercept of the linear support vector machine (squared
    hinge loss, intercept free) for rows ``x`` and classes ``y`` of 1 and -1,
    by Newton steps whose systems conjugate gradients solve.  Sums are of
    double precision; ``x`` is not copied, but ``ROWS`` rows at a time."""
    every = np.arange(len(x))
    keep = np.r_[np.full(x.shape[1], reg), 1e-9]

    def blocks(rows):
        for p in range(0, len(rows), ROWS):
            yield slice(p, p + ROWS), x[rows[p:p + ROWS]].astype(np.float64)

    def margins(w):
        out = np.empty(len(x))
        for at, b in blocks(every):
            out[at] = b @ w[:-1] + w[-1]
        return out

    def weighed(rows, v):
        """The sum of the rows, each times its number in ``v``."""
        out = np.zeros(x.shape[1] + 1)
        for at, b in blocks(rows):
            out[:-1] += b.T @ v[at]
        out[-1] = v.sum()
        return out

    def bend(rows, way):
        """The sum of the rows, each times its product with ``way``."""
        out = np.zeros(x.shape[1] + 1)
        for _, b in blocks(rows):
            v = b @ way[:-1] + way[-1]
            out[:-1] += b.T @ v
            out[-1] += v.sum()
        return out

    def loss(w):
        return 0.5 * (keep * w * w).sum() + 0.5 * np.square(np.maximum(1 - y * margins(w), 0)).mean()

    w = np.zeros(x.shape[1] + 1)
    for _ in range(max_iter):
        miss = np.maximum(1 - y * margins(w), 0)
        gradient = keep * w - weighed(every, y * miss) / len(y)
        size = np.linalg.norm(gradient)
        if size < 1e-7:
            break
        inside = np.flatnonzero(miss > 0)
        step, left, way = np.zeros_like(w), -gradient, -gradient
        for _ in range(60):
            bent = keep * way + bend(inside, way) / len(y)
            far = left @ left / (way @ bent)
            step, rest = step + far * way, left - far * bent
            if np.linalg.norm(rest) < 1e-3 * size:
                break
            left, way = rest, rest + (rest @ rest) / (left @ left) * way
        now, length = loss(w), 1.0
        while loss(w + length * step) > now + 1e-4 * length * (gradient @ step) and length > 1e-6:
            length /= 2
        w = w + length * step
    return w


def _fit_group(max_iter: int, reg: float):
    def run(t: pa.Table) -> pa.Table:
        # the same sums whatever the order of arrival
        order = pc.sort_indices(t.select(["h", "lang"]), [("h", "ascending"), ("lang", "ascending")]).to_numpy()
        place, x, first = np.argsort(order), np.empty((len(order), DIMENSIONS), np.float32), 0
        for chunk in t.column("x").chunks:
            part = chunk.flatten().to_numpy().reshape(-1, DIMENSIONS)
            x[place[first:first + len(part)]] = part
            first += len(part)
        w = fit_machine(x, t.column("y").to_numpy()[order], reg=reg, max_iter=max_iter)
        return pa.table({"machine": t.column("machine").slice(0, 1), "w": pa.array([w], pa.list_(pa.float64()))})
    return run


def train(rows: DataFrame, *, sample_per_language: int = 800, rows_per_machine: int = 16384, max_languages: int = 64,
          max_iter: int = 25, reg: float = 1e-4) -> dict:
    """The model from the text and lang of the rows to learn from."""
    spark = rows.sparkSession
    work_root(spark)
    rows = rows.where("lang is not null and text is not null")
    rows = rows.select("lang", "text", F.xxhash64(F.lit("langid"), "text").alias("h"))
    names_path, path = scratch_dir(spark, "langid-texts"), scratch_dir(spark, "langid-sample")
    rows.select("lang", "h").distinct().write.parquet(names_path)
    texts = spark.read.parquet(names_path)
    counts = texts.groupBy("lang").agg(F.count(F.lit(1)).alias("texts_of"))
    langs = sorted(r.lang for r in counts.limit(max_languages + 1).collect())
    if len(langs) > max_languages:
        raise ValueError(f"column lang has more than {max_languages} values (max_languages)")
    # four times as many as wanted, or all, are ranked; one count a language is broadcast
    few = texts.join(F.broadcast(counts), "lang").where(
        F.pmod("h", F.lit(1 << 40)) * F.col("texts_of").cast("double") <= F.lit(4.0 * sample_per_language * (1 << 40)))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 40)), "h"))
    drawn = few.withColumn("rank", rank).where(F.col("rank") <= sample_per_language).select("lang", "h", "rank")
    # at most sample_per_language rows a language
    sample = rows.join(F.broadcast(drawn), ["lang", "h"]).groupBy("lang", "h", "rank").agg(F.min("text").alias("text"))
    sample.mapInArrow(_featurize, "lang string, h long, rank int, x array<float>").write.parquet(path)
    sample = spark.read.parquet(path)

    families = sorted({FAMILIES.get(x, x) for x in langs})
    members = {f: [x for x in langs if FAMILIES.get(x, x) == f] for f in families}
    # (machine, languages of class 1, languages of class -1); with two families one machine serves both
    machines = [((f,), members[f], [x for x in langs if x not in members[f]])
                for f in families[:1 if len(families) == 2 else None]] if len(families) > 1 else []
    machines += [((f, a, b), [a], [b]) for f in families for a, b in itertools.combinations(members[f], 2)]
    model = {"families": families, "members": members, "top": [np.zeros(DIMENSIONS + 1)] * len(families),
             "duels": {f: [] for f in families}}
    if machines:
        part = [(i, x, y, max(1, rows_per_machine // len(yes + no)))
                for i, (_, yes, no) in enumerate(machines) for y, side in ((1.0, yes), (-1.0, no)) for x in side]
        part = spark.createDataFrame(part, "machine int, lang string, y double, most int")
        # a group holds at most rows_per_machine rows, or one a language
        fitted = sample.join(F.broadcast(part), "lang").where("rank <= most").groupBy("machine") \
            .applyInArrow(_fit_group(max_iter, reg), "machine int, w array<double>")
        weights = {r.machine: np.array(r.w) for r in fitted.collect()}          # one row a machine
        for i, (name, _, _) in enumerate(machines):
            if len(name) == 3:
                model["duels"][name[0]].append((*name[1:], weights[i]))
            else:
                model["top"][families.index(name[0])] = weights[i]
        if len(families) == 2:
            model["top"][1] = -model["top"][0]
    remove_folder(spark, path)
    remove_folder(spark, names_path)
    return model


def _logistic(x):
    return 1 / (1 + np.exp(-2 * np.clip(x, -40, 40)))


def predict(data: np.ndarray, offsets: np.ndarray, model: dict) -> tuple[list[str], np.ndarray]:
    n = len(offsets) - 1
    best, score = np.array([UNKNOWN] * n, object), np.zeros(n)
    if not model["families"]:
        return list(best), score
    ok = has_letter(data, offsets)
    x = features(data, offsets)
    x = np.hstack([x, np.ones((n, 1), np.float32)])
    margins = x @ np.array(model["top"]).T
    pick = margins.argmax(axis=1)
    for i, f in enumerate(model["families"]):
        at = np.flatnonzero(ok & (pick == i))
        langs = model["members"][f]
        sure = _logistic(margins[at, i]) if len(model["families"]) > 1 else np.ones(len(at))
        wins, total, duel = (np.zeros((len(at), len(langs))) for _ in range(3))
        for a, b, w in model["duels"][f]:
            m, p, q = x[at] @ w, langs.index(a), langs.index(b)
            wins[:, p] += m >= 0
            wins[:, q] += m < 0
            total[:, p] += m
            total[:, q] -= m
            duel[:, p] += _logistic(m)
            duel[:, q] += _logistic(-m)
        rank = wins * 1e6 + np.clip(total, -1e5, 1e5)
        chosen = rank.argmax(axis=1)
        best[at] = [langs[c] for c in chosen]
        score[at] = sure * (duel[np.arange(len(at)), chosen] / (len(langs) - 1) if len(langs) > 1 else 1)
    return list(best), score


def identify(documents: DataFrame, model: dict, *, text: str = "text") -> DataFrame:
    """The documents with lang_pred and score; one narrow pass."""
    rows = documents.drop(*[c for c in ("lang_pred", "score") if c in documents.columns])
    held = documents.sparkSession.sparkContext.broadcast(model)   # machines * DIMENSIONS numbers

    def run(batches):
        for batch in textscan.chunks(batches, text, textscan.SMALL_CHUNK, ROWS):
            lang, score = predict(*textscan.as_buffer(batch.column(text)), held.value)
            yield pa.RecordBatch.from_arrays(batch.columns + [pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                             names=batch.schema.names + ["lang_pred", "score"])

    schema = rows.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    return rows.mapInArrow(run, schema)


def with_letter(documents: DataFrame, *, text: str = "text") -> DataFrame:
    """The documents whose text has a letter."""
    def run(batches):
        for batch in textscan.chunks(batches, text, textscan.SMALL_CHUNK):
            yield batch.filter(pa.array(has_letter(*textscan.as_buffer(batch.column(text)))))
    return documents.mapInArrow(run, documents.schema)


def train_on(documents: DataFrame, **options) -> dict:
    """A model from the labelled documents that are not held out."""
    return train(documents.where(~held_out("doc_id")), **options)
