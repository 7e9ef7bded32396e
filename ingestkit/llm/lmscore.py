"""Cross-entropy difference of two matched bigram language models.

The target model learns from the target documents, the background model from
all documents.  Both share one vocabulary, one smoothing and one list of
bigrams, so that only their counts differ.  A document's score is the mean per
token of (target loss - background loss): the lower, the closer to the target.

Words are lower-cased runs of letters and digits, known by 64-bit hashes.
Every word and every bigram of the corpus is in the models, however rare.
With u the word before w, V the number of words and one more for the unknown:

    P(w | u) = mix * c(u, w) / c(u) + (1 - mix) * (c(w) + add) / (N + add * V)

Plan: each task cuts its texts into blocks of about ``block_tokens`` tokens.  A
block is staged as its distinct words, its distinct bigrams and each
document's bigrams as numbers of that list.  Its keys (bigrams, words, words
as the one before) go with their counts to the bucket of their hash range; a
bucket adds them up and answers each block with the sums, in the order of the
block's keys.  So one shuffle both counts and looks up, a task holds one block or
one bucket (about ``bucket_keys`` keys) at a time, and a key is met once a block
however common it is.  Neither the texts nor the models are shipped.  A block sends
a bucket one row if it has keys for it, so there are never more rows than keys:
blocks times buckets at most, and as many as there are keys beyond that.

Cases: null and word-free texts have no tokens and null losses; target ids
that are null or unknown are ignored; an empty target leaves the target model
at its prior; repeated rows count each; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingestkit.llm import textscan
from ingestkit.session import remove_folder, scoped_conf, scratch_dir, work_root

MAX_BROADCAST_IDS = 2_000_000      # 16 MB of ids; beyond, the texts are shuffled by id
MIN_BUCKETS = 48
START = np.uint64(0x5851F42D4C957F2D)     # in the place of a word's hash
PAIR, WORD, BEFORE = 0, 1, 2       # kinds of key, in its two lowest bits
WORD_LUT = textscan.word_bytes([(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes, compressed by the place of a byte in its number."""
    parts = []
    for x in arrays:
        raw = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T.tobytes()
        parts.append((x.dtype.str, len(x), pa.compress(raw, "zstd", asbytes=True) if raw else b""))
    return pickle.dumps(parts, 5)


def unpack(body: bytes) -> list[np.ndarray]:
    out = []
    for kind, n, raw in pickle.loads(body):
        dtype = np.dtype(kind)
        flat = np.frombuffer(pa.decompress(raw, n * dtype.itemsize, "zstd", asbytes=True) if raw else b"", np.uint8)
        out.append(np.ascontiguousarray(flat.reshape(dtype.itemsize, n).T).view(dtype).reshape(n))
    return out


def _deltas(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=values.dtype.type(0))


def _block(held: list) -> tuple[int, int, int, bytes]:
    """(tokens, tokens of targets, keys, body) of a list of (ids, target, word
    hashes, tokens per document)."""
    ids = pa.concat_arrays([x[0] for x in held])
    target, word, tokens = (np.concatenate([x[j] for x in held]) for j in (1, 2, 3))
    names, w = np.unique(word, return_inverse=True)
    u = np.r_[np.int64(0), w[:-1]] if len(w) else w
    u[(np.cumsum(tokens) - tokens)[tokens > 0]] = len(names)
    pairs, at = np.unique(u * len(names) + w, return_inverse=True)
    doc = np.repeat(np.arange(len(tokens)), tokens)
    at = np.sort(doc * len(pairs) + at) - doc * len(pairs)
    body = pack(ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(), tokens, target, _deltas(names), _deltas(pairs),
                _deltas(at))
    return len(word), int(tokens[target].sum()), len(pairs) + 2 * len(names) + 1, body


def _open(body: bytes) -> list[np.ndarray]:
    *rest, names, pairs, at = unpack(body)
    return [*rest, np.cumsum(names, dtype=np.uint64), np.cumsum(pairs), np.cumsum(at)]


def _blocks(block_tokens: int):
    def run(batches):
        context = TaskContext.get()
        first = (context.partitionId() if context else 0) << 32
        waiting, size, done = [], 0, 0
        row = lambda: pa.RecordBatch.from_arrays([pa.array([x]) for x in (first + done, *_block(waiting))],
                                                 names=["block", "tokens", "target_tokens", "keys", "body"])
        for batch in textscan.chunks(batches, "text"):
            h, _, tokens = textscan.word_hashes(*textscan.as_buffer(batch.column("text")), WORD_LUT)
            if waiting and size + len(h) > block_tokens:
                yield row()
                waiting, size, done = [], 0, done + 1
            waiting.append((batch.column("doc_id"), batch.column("target").to_numpy(zero_copy_only=False), h, tokens))
            size += len(h)
        if waiting:
            yield row()
    return run


def _keys(names: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Keys of a block: its pairs, its words, and its words and the start as the one before."""
    before = np.r_[names, START]
    of_pair = textscan.mix(textscan.mix(before[pairs // len(names)]) * np.uint64(3) + names[pairs % len(names)])
    kinds = [(of_pair, PAIR), (textscan.mix(names), WORD), (textscan.mix(before + np.uint64(1)), BEFORE)]
    return np.concatenate([h & ~np.uint64(3) | np.uint64(kind) for h, kind in kinds])


def _requests(buckets: int):
    """Rows (block, bucket, body): keys of the block in order, with its counts
    in all texts and in target texts."""
    def run(batches):
        for batch in batches:
            for block, body in zip(batch.column("block").to_pylist(), batch.column("body"), strict=True):
                _, _, tokens, target, names, pairs, at = _open(body.as_py())
                if not len(names):
                    continue
                keys = _keys(names, pairs)
                order = np.argsort(keys)
                counts = []
                for of_token in (None, np.repeat(target, tokens).astype(float)):
                    two = np.bincount(at, of_token, len(pairs)).astype(float)
                    counts.append(np.r_[two, np.bincount(pairs % len(names), two, len(names)),
                                        np.bincount(pairs // len(names), two, len(names) + 1)].astype(np.int64)[order])
                keys = keys[order]
                bucket = ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
                cut = np.r_[0, np.flatnonzero(np.diff(bucket)) + 1, len(keys)]
                rows = [pack(_deltas(keys[a:b]), counts[0][a:b], counts[1][a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([block] * len(rows)), pa.array(bucket[cut[:-1]]), pa.array(rows)],
                                                 names=["block", "bucket", "body"])
    return run


def _add_up(table: pa.Table) -> pa.Table:
    """Of one bucket: the sums, for each block in the order of its keys, and the
    number of words (in one row)."""
    parts = [unpack(x.as_py()) for x in table.column("body")]
    lengths = np.cumsum([0] + [len(k) for k, _, _ in parts])
    names, inverse = np.unique(np.concatenate([np.cumsum(k, dtype=np.uint64) for k, _, _ in parts]), return_inverse=True)
    n, t = (np.bincount(inverse, np.concatenate([x[j] for x in parts]), len(names)).astype(np.int64) for j in (1, 2))
    bodies = [pack(n[inverse[a:b]], t[inverse[a:b]]) for a, b in zip(lengths[:-1], lengths[1:], strict=True)]
    words = np.zeros(len(parts), np.int64)
    words[0] = np.count_nonzero(names & np.uint64(3) == WORD)
    return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "words": words, "body": pa.array(bodies, pa.binary())})


def _score(totals: tuple[int, int], n_words: int, mix: float, add: float):
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("bucket").to_pylist(), table.column("body").to_pylist(), strict=True), key=lambda r: r[0])
        null, ids, tokens, _, names, pairs, at = _open(rows[0][1])
        columns = [pa.array(ids, pa.int64(), mask=null), pa.array(tokens, pa.int64())]
        keys = _keys(names, pairs) if len(names) else np.zeros(0, np.uint64)
        answers = [unpack(body) for _, body in rows[1:]]
        if sum(len(n) for n, _ in answers) != len(keys):
            raise RuntimeError("a block's counts are not complete")
        if len(names):
            order, counts = np.argsort(keys), np.empty((2, len(keys)))
            for j in range(2):
                counts[j, order] = np.concatenate([x[j] for x in answers])
            doc = np.repeat(np.arange(len(tokens)), tokens)
        for j in (1, 0):
            mean = np.zeros(len(tokens))
            if len(names):
                two, one, before = np.split(counts[j], [len(pairs), len(pairs) + len(names)])
                alone = (1 - mix) * (one + add) / (totals[j] + add * (n_words + 1))
                known = mix * two / np.maximum(before[pairs // len(names)], 1)
                loss = -np.log(known + alone[pairs % len(names)])
                mean = np.bincount(doc, loss[at], len(tokens)) / np.maximum(tokens, 1)
            columns.append(pa.array(mean, pa.float64(), mask=tokens == 0))
        return pa.Table.from_arrays(columns, names=["doc_id", "n_tokens", "loss_target", "loss_background"])
    return run


def cross_entropy_difference(documents: DataFrame, targets: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                             target_id: str = "doc_id", mix: float = 0.7, add: float = 0.5, block_tokens: int = 1 << 20, bucket_keys: int = 2_000_000) -> DataFrame:
    """doc_id, n_tokens, loss_target, loss_background, score."""
    spark = documents.sparkSession
    work_root(spark)
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    chosen = targets.where(F.col(target_id).isNotNull()).select(F.col(target_id).cast("long").alias("__id")).distinct() \
        .withColumn("target", F.lit(True))
    if chosen.count() <= MAX_BROADCAST_IDS:
        chosen = F.broadcast(chosen)
    flagged = rows.join(chosen, F.col("doc_id") == F.col("__id"), "left") \
        .select("doc_id", "text", F.coalesce("target", F.lit(False)).alias("target"))
    staged, answered = scratch_dir(spark, "lm-blocks"), scratch_dir(spark, "lm-counts")
    with scoped_conf(spark, textscan.SMALL_BATCHES):
        flagged.mapInArrow(_blocks(block_tokens), "block long, tokens long, target_tokens long, keys long, body binary") \
            .write.parquet(staged)
        blocks = spark.read.parquet(staged)
        *totals, keys = (x or 0 for x in blocks.agg(F.sum("tokens"), F.sum("target_tokens"), F.sum("keys")).first())
        buckets = max(MIN_BUCKETS, -(-keys // bucket_keys))
        blocks.select("block", "body").mapInArrow(_requests(buckets), "block long, bucket long, body binary") \
            .groupBy("bucket").applyInArrow(_add_up, "block long, bucket long, words long, body binary").write.parquet(answered)
    answers = spark.read.parquet(answered)
    n_words = answers.agg(F.sum("words")).first()[0] or 0
    scored = blocks.select("block", F.lit(-1).cast("long").alias("bucket"), "body").unionByName(answers.drop("words")) \
        .groupBy("block").applyInArrow(_score(tuple(totals), n_words, mix, add),
                                       "doc_id long, n_tokens long, loss_target double, loss_background double")
    scored = scored.withColumn("score", F.col("loss_target") - F.col("loss_background")).checkpoint()
    for path in (staged, answered):
        remove_folder(spark, path)
    return scored
