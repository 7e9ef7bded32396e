"""Vectorised scanning of a batch of texts.

A batch is one UTF-8 byte buffer plus document offsets; every pass below is
a numpy operation over the buffer, so the cost is a few nanoseconds a byte.
Words get 64-bit hashes from a prefix sum of ``table[byte] * P**position``:
the hash of any substring is a difference of two prefix sums times the
inverse power of its start.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SEED = 20240607
_POWER = np.uint64(0x9E3779B97F4A7C15)          # odd, hence invertible mod 2**64
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
CHUNK_BYTES = 1 << 20
SMALL_CHUNK = 1 << 18         # where a pass holds many numbers a byte; a worker keeps what its largest chunk took
# For writes that pass texts or sets through Python: bounds what a batch holds.
SMALL_BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20)}


def _table(lower: bool) -> np.ndarray:
    t = np.random.default_rng(_SEED).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    if lower:
        t[65:91] = t[97:123]
    return t


TABLE_EXACT, TABLE_LOWER = _table(False), _table(True)


def word_bytes(excluded: list[tuple[int, int]]) -> np.ndarray:
    """Lookup table: which bytes belong to words, given excluded byte ranges."""
    lut = np.ones(256, bool)
    for a, b in excluded:
        lut[a:b + 1] = False
    return lut


NON_SPACE = word_bytes([(0x20, 0x20), (0x09, 0x0D)])


def powers(n: int, base: np.uint64) -> np.ndarray:
    """``base**0 .. base**(n-1)`` modulo 2**64."""
    out = np.empty(max(n, 1), np.uint64)
    out[0], done = 1, 1
    while done < n:
        step = min(done, n - done)
        out[done:done + step] = out[:step] * (out[done - 1:done] * base)
        done += step
    return out[:n]


def process_cache() -> dict:
    """A dictionary that lives as long as the worker process (functions are
    shipped by value, so module globals are new in every task)."""
    return sys.__dict__.setdefault("_ingestkit_llm_cache", {})


def _cached_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    cache = process_cache()
    if n > CHUNK_BYTES * 2:       # one very long text: not kept
        return powers(n, _POWER), powers(n, _INVERSE)
    if len(cache.get("p", ())) < n:
        size = min(CHUNK_BYTES * 2, 1 << n.bit_length())
        cache["p"], cache["q"] = powers(size, _POWER), powers(size, _INVERSE)
    return cache["p"][:n], cache["q"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word (returns a copy)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def prefix_sums(data: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, inverse powers) for :func:`span_hash`."""
    p, q = _cached_powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * p[:len(data)], out=sums[1:])
    return sums, q


def span_hash(prefix: tuple[np.ndarray, np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    sums, q = prefix
    return mix((sums[end] - sums[start]) * q[start])


def as_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; a null text is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offs, data = texts.buffers()
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64) \
        if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES, rows: int = 1 << 31) -> Iterator[pa.RecordBatch]:
    """Sub-batches of at most ``limit`` text bytes (or one single text) and at most ``rows`` rows."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = as_buffer(batch.column(text))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
            last = min(max(last, first + 1), first + rows, batch.num_rows)
            yield batch.slice(first, last - first)
            first = last


def words(data: np.ndarray, offsets: np.ndarray, lut: np.ndarray = NON_SPACE):
    """(start, end, document index) of every maximal run of word bytes; a run
    never crosses documents."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = lut[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def word_hashes(data, offsets, lut=NON_SPACE, table=TABLE_LOWER):
    """(hash, document index, words per document) for all words of a batch.
    Long texts are hashed a stretch of words at a time."""
    start, end, doc = words(data, offsets, lut)
    h, first = np.zeros(len(start), np.uint64), 0
    while first < len(start):
        last = max(int(np.searchsorted(end, start[first] + 2 * CHUNK_BYTES, "right")), first + 1)
        at = start[first]
        part = prefix_sums(data[at:end[last - 1]], table)
        h[first:last] = span_hash(part, start[first:last] - at, end[first:last] - at)
        first = last
    return h, doc, np.bincount(doc, minlength=len(offsets) - 1)


def list_column(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column from flat values and list lengths."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
