"""Benchmark decontamination with one Aho-Corasick automaton.

Texts are normalised to their words (A-Z lower-cased, runs of letters, digits
and non-ASCII characters) joined by single blanks.  Every window of ``window``
consecutive words of a benchmark item, or the whole item when it is shorter,
is a pattern of the automaton, with a blank on either side so that it matches
whole words only.  Each document is scanned once; a match's end gives its
last word, and the words' places in the original give byte offsets.

The patterns are broadcast after their size was checked.  A benchmark beyond
``max_pattern_bytes`` is dealt into slices of items, each with an automaton of
its own; the documents are then scanned for one slice after another, stored
between the scans, still without a shuffle.

Cases: null or word-free texts have no words and no hits; null or word-free
items have no windows; items with the same text are all listed; an item with
a null id marks words but is not listed; repeated documents are judged each;
empty tables give no rows or no hits; other columns are not returned.
"""

from __future__ import annotations

import uuid

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingestkit.llm import textscan
from ingestkit.session import remove_folder, scratch_dir

WORD_LUT = textscan.word_bytes([(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])
_NORMAL = bytes(32 if not WORD_LUT[b] else b + 32 if 65 <= b <= 90 else b for b in range(256))
RESULT = ("n_words long, word_spans array<struct<first:int,last:int>>, "
          "byte_spans array<struct<start:long,end:long>>, items array<string>")


def normal_words(raw: bytes) -> list[bytes]:
    return raw.translate(_NORMAL).split()


def patterns_of(items: list[tuple[str | None, str | None]], window: int) -> dict[str, tuple[int, list[str]]]:
    """Pattern -> (number of words, ids of the items that hold it)."""
    found: dict[str, tuple[int, list[str]]] = {}
    for item, text in items:
        words = normal_words((text or "").encode())
        for i in range(max(1, len(words) - window + 1) if words else 0):
            part = words[i:i + window]
            _, ids = found.setdefault((b" " + b" ".join(part) + b" ").decode("latin-1"), (len(part), []))
            if item is not None and item not in ids:
                ids.append(item)
    return found


def automaton(patterns: dict[str, tuple[int, list[str]]]):
    a = ahocorasick.Automaton()
    for p, value in patterns.items():
        a.add_word(p, value)
    if patterns:
        a.make_automaton()
    return a


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def scan_text(a, raw: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
    """(number of words, maximal hit word ranges, items) of one text."""
    words = normal_words(raw)
    if not words or not len(a):
        return len(words), [], set()
    joined = b" " + b" ".join(words) + b" "
    spans, items, blanks = [], set(), None
    for end, (size, ids) in a.iter(joined.decode("latin-1")):
        if blanks is None:
            blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
        last = int(np.searchsorted(blanks, end)) - 1
        spans.append((last - size + 1, last))
        items.update(ids)
    return len(words), _merge(spans), items


def _scan(patterns, text: str, name: str):
    def run(batches):
        cache = textscan.process_cache()            # one automaton at a time, kept between tasks
        if cache.get("automaton", ("",))[0] != name:
            cache["automaton"] = (name, automaton(patterns.value))
        a = cache["automaton"][1]
        for batch in textscan.chunks(batches, text):
            data, offsets = textscan.as_buffer(batch.column(text))
            raw = data.tobytes()
            n_words, spans, places, items = [], [], [], []
            before = batch.column("word_spans").to_pylist(), batch.column("items").to_pylist()
            for i in range(batch.num_rows):
                one = raw[offsets[i]:offsets[i + 1]]
                n, hit, ids = scan_text(a, one)
                hit = _merge(hit + [(s["first"], s["last"]) for s in before[0][i]])
                n_words.append(n)
                spans.append([{"first": x, "last": y} for x, y in hit])
                items.append(sorted(ids | set(before[1][i])))
                place = []
                if hit:
                    start, end, _ = textscan.words(np.frombuffer(one, np.uint8), np.array([0, len(one)]), WORD_LUT)
                    place = [{"start": int(start[x]), "end": int(end[y])} for x, y in hit]
                places.append(place)
            made = {"n_words": pa.array(n_words, pa.int64()),
                    "word_spans": pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
                    "byte_spans": pa.array(places, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    "items": pa.array(items, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([made.get(c, batch.column(c)) for c in batch.schema.names],
                                             names=batch.schema.names)
    return run


def _held(items: DataFrame, window: int):
    spark = items.sparkSession
    return spark.sparkContext.broadcast(patterns_of([(r.id, r.body) for r in items.collect()], window))


def _scan_in_turn(none: DataFrame, items: DataFrame, window: int, slices: int, text: str) -> DataFrame:
    """The documents scanned for one slice of the items after another; what a
    slice finds is added to the rows and stored, so that one automaton is held
    at a time, by the driver and by every worker."""
    spark, found, before = none.sparkSession, none, None
    for k in range(slices):
        part = items.where(F.pmod(F.xxhash64("id", "body"), F.lit(slices)) == k)
        held = _held(part, window)
        path = scratch_dir(spark, "scanned")
        found.mapInArrow(_scan(held, text, uuid.uuid4().hex), none.schema).write.parquet(path)
        held.destroy()
        found = spark.read.schema(none.schema).parquet(path)
        if before:
            remove_folder(spark, before)
        before = path
    return found


def find_overlaps(documents: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = 10, max_pattern_bytes: int = 64 << 20) -> DataFrame:
    """The documents with n_words, word_spans, byte_spans, items and n_hit."""
    spark = documents.sparkSession
    items = benchmark.select(F.col(item_id).cast("string").alias("id"), F.col(item_text).alias("body"))
    # an item of b bytes has windows of at most b * window bytes in all
    total = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    slices = -(-total * window // max_pattern_bytes) or 1
    own = ("n_words", "word_spans", "byte_spans", "items", "n_hit")
    out = documents.drop(*[c for c in documents.columns if c in own])
    none = out.select("*", F.lit(0).cast("long").alias("n_words"),
                      F.array().cast("array<struct<first:int,last:int>>").alias("word_spans"),
                      F.array().cast("array<struct<start:long,end:long>>").alias("byte_spans"),
                      F.array().cast("array<string>").alias("items"))
    if slices == 1:
        found = none.mapInArrow(_scan(_held(items, window), text, uuid.uuid4().hex), none.schema)
    else:
        found = _scan_in_turn(none, items, window, slices, text)
    hit = F.aggregate("word_spans", F.lit(0).cast("long"), lambda a, s: a + s["last"] - s["first"] + 1)
    return found.withColumn("n_hit", hit)


def overlap_digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", F.array_sort("items")).cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))
