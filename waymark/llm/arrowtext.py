"""Vectorised views of Arrow text columns, shared by the operators of this package.

A batch of texts is one flat byte buffer plus document offsets. Words are the maximal runs of bytes other than
0x20 and 0x09-0x0D; they are found, told apart and hashed for the whole batch at once, so no Python code runs per word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Text that is looked at at once: its words, hashes and spans are some 30 arrays of 8 bytes for each word or byte.
BATCH_BYTES = 1 << 20
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
U64 = np.uint64


def sliced(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds at most max_bytes of the text column, or a single row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(size, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            base = total[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(total, base + max_bytes, side="right")))
            yield batch.slice(at, end - at)
            at = end
    pa.default_memory_pool().release_unused()  # the worker lives on for other stages' tasks
    if _TRIM:
        _TRIM(0)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the n + 1 offsets of each in them; a null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
    buffer = texts.buffers()[2] if len(texts) else None
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the n + 1 word offsets of the documents."""
    if not len(data):
        none = np.empty(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    space = IS_SPACE[data]
    before = np.empty(len(data), bool)
    before[0], before[1:] = True, space[:-1]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    before[edge] = True
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = True, space[1:]
    after[edge - 1] = True
    starts, ends = np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def distinct_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """For each of the adjoining byte spans between bounds the number of its distinct form, and those forms."""
    if bounds[-1] >= 1 << 31:  # one text of 2 GB: offsets of 64 bits
        kind, column, size = pa.large_binary(), pa.LargeBinaryArray, np.int64
    else:
        kind, column, size = pa.binary(), pa.BinaryArray, np.int32
    spans = column.from_buffers(kind, len(bounds) - 1, [None, pa.py_buffer(bounds.astype(size)), pa.py_buffer(np.ascontiguousarray(data))])
    coded = spans.dictionary_encode()
    _, at, raw = coded.dictionary.buffers()
    at, raw = np.frombuffer(at, size, len(coded.dictionary) + 1).tolist(), raw.to_pybytes() if raw else b""
    return coded.indices.to_numpy(zero_copy_only=False), [raw[a:b] for a, b in zip(at, at[1:])]


def distinct_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """For each word the number of its distinct form in the batch, and those forms."""
    if not len(starts):
        return np.empty(0, np.int32), []
    at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=at[1:])
    return distinct_spans(data[~IS_SPACE[data]], at)


def hash128(values: list[bytes], seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """128-bit hashes as two columns."""
    raw = b"".join([xxhash.xxh3_128_digest(v, seed) for v in values])
    both = np.frombuffer(raw, ">u8").reshape(-1, 2).astype(U64)
    return both[:, 0], both[:, 1]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit hash of every word, as two columns."""
    index, forms = distinct_words(data, starts, ends)
    if not forms:
        return np.empty(0, U64), np.empty(0, U64)
    high, low = hash128(forms)
    return high[index], low[index]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (public splitmix64 constants)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class Spans:
    """Hashes of any span of a sequence of hashed words: a prefix polynomial modulo 2**64."""

    def __init__(self, hashes: np.ndarray, base: int):
        inverse = pow(base, -1, 1 << 64)
        n = len(hashes) + 1
        up, self.down = np.full(n, base, U64), np.full(n, inverse, U64)
        up[0] = self.down[0] = 1
        np.cumprod(up, out=up)
        np.cumprod(self.down, out=self.down)
        self.prefix = np.zeros(n, U64)
        np.cumsum(hashes * up[:-1], out=self.prefix[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.prefix[end] - self.prefix[start]) * self.down[start])


#: Odd multipliers of the two polynomials whose values make one 128-bit span hash.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def by_document(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of values over each document's slice; 0 for an empty one."""
    total = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated ranges [start, start + length)."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    first = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - first, lengths)
