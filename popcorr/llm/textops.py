"""Arrow and numpy helpers for tasks: texts as one byte array, words and shingles as hashes.

All functions work on a bounded slice of a batch (``slices``), whatever the
batch holds, and keep no state between slices.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on together in a task.
SLICE_BYTES = 2 << 20

U64 = np.uint64
# odd multipliers of the 64-bit mixing function (fixed values)
_M1, _M2, _GOLD = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB), U64(0x9E3779B97F4A7C15)
_BASE = U64(0xD1342543DE82EF95)
_BASE_INV = U64(pow(int(_BASE), -1, 1 << 64))

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: As SPACE, with all ASCII punctuation.
NOT_WORD = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


@contextmanager
def settings(spark, wanted: dict[str, str]):
    """Session settings for the jobs run inside."""
    old = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def arrow_rows(spark, n: int):
    """Arrow batches of at most ``n`` rows for the jobs run inside, so that rows of some 10 KB stay a few MB a batch."""
    return settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(n)})


def written_steps(spark):
    """For steps that are each written and read again: a query's shuffle files go when it ends, not when the driver
    happens to collect its garbage."""
    return settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixing function."""
    x = (x ^ (x >> U64(30))) * _M1
    x = (x ^ (x >> U64(27))) * _M2
    return x ^ (x >> U64(31))


with np.errstate(over="ignore"):
    BYTE_CODE = mix((np.arange(256, dtype=U64) + U64(1)) * _GOLD)

_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept for the next call."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        have = np.full(size, base, U64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if n <= 4 * SLICE_BYTES:
            _powers[int(base)] = have
    return have[:n]


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets from 0) of runs of rows of about ``limit`` bytes; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    n = len(texts)
    if not n:
        return
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, kind)[texts.offset:texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    start = 0
    while start < n:
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1)
        stop = min(stop, n)
        yield start, stop, data[offsets[start]:offsets[stop]], offsets[start:stop + 1] - offsets[start]
        start = stop


def word_spans(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words before each document) of the words of all documents; ``space`` marks the bytes between words."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    word = ~space[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    first[inner] = word[inner]
    last[inner - 1] = word[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets, "left")


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, from prefix sums of a polynomial."""
    if not len(starts):
        return np.zeros(0, U64)
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(BYTE_CODE[data] * powers(_BASE, len(data)), out=sums[1:])
    h = (sums[ends] - sums[starts]) * powers(_BASE_INV, len(data))[starts]
    return mix(h + (ends - starts).astype(U64) * _GOLD)


def words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word with A-Z lowered, words before each document)."""
    starts, ends, before = word_spans(data, offsets, space)
    return span_hashes(LOWER[data], starts, ends), before


def run_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """The hash of the k items from each position on (len - k + 1 of them)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = np.full(n, k, U64) * _GOLD
    for i in range(k):
        out = mix(out * _BASE + hashes[i:i + n])
    return out


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... (count of them) for every start, one after the other."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
    return np.arange(total, dtype=np.int64) + shift


def shingles(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(document index, hash) of every distinct k-word shingle, sorted by document and hash.

    A document of 1 to k - 1 words has its whole sequence as one shingle.
    """
    hashes, before = words(data, offsets)
    counts = np.diff(before)
    runs = run_hashes(hashes, k)
    full = np.maximum(counts - k + 1, 0)
    at = ragged(before[:-1], full)
    doc = np.repeat(np.arange(len(counts)), full)
    value = runs[at] if len(at) else np.zeros(0, U64)
    for i in np.flatnonzero((counts > 0) & (counts < k)):
        whole = hashes[before[i]:before[i + 1]]
        doc, value = np.append(doc, i), np.append(value, run_hashes(whole, len(whole)))
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return doc[new], value[new]
