"""Array kernels over the bytes of many texts at once (used inside Spark tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are taken in runs of about this many bytes, so that the arrays of a
# task (8 bytes per byte of text, several at a time) stay in the processor's caches;
# a longer text is a run of its own.
RUN_BYTES = 256 << 10

U64 = np.uint64


def splitmix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer, element by element."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def random_table(n: int, seed: int = 1) -> np.ndarray:
    """``n`` pseudo-random 64-bit values made by rule from ``seed``."""
    return splitmix((np.arange(1, n + 1, dtype=U64) + U64(seed << 20)) * U64(0x9E3779B97F4A7C15))


BYTE_VALUES = random_table(256)
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_powers: dict[str, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2**64 (of the inverse base if asked)."""
    key = "inverse" if inverse else "base"
    if key not in _powers or len(_powers[key]) < n:
        base = pow(_BASE, -1, 1 << 64) if inverse else _BASE
        out = np.empty(max(n, RUN_BYTES + 1), dtype=U64)
        out[0] = 1
        done = 1
        while done < len(out):
            take = min(done, len(out) - done)
            out[done : done + take] = out[:take] * U64(pow(base, done, 1 << 64))
            done += take
        _powers[key] = out
    return _powers[key]


def runs(batch: pa.RecordBatch, column: str = "text", limit: int = RUN_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of ``batch`` with about ``limit`` bytes of ``column`` each."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield batch.slice(at, to - at)
        at = to


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts (NULL: empty) end to end, and the ``n + 1`` places where texts begin."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def _blanks() -> np.ndarray:
    out = np.zeros(256, bool)
    out[[0x20, *range(0x09, 0x0E)]] = True
    return out


BLANK = _blanks()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_spans(buf: np.ndarray, off: np.ndarray, blank: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words (runs of non-blank bytes inside one text),
    and per text the place of its first word (``n + 1`` values)."""
    if not len(buf):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(off), np.int64)
    word = ~blank[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[off] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | edge[1:-1]
    last = word.copy()
    last[:-1] &= ~word[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, off)


def span_hashes(buf: np.ndarray, starts: np.ndarray, blank: np.ndarray = BLANK) -> np.ndarray:
    """A 64-bit hash of the non-blank bytes from each start to the next one."""
    if not len(starts):
        return np.empty(0, U64)
    value = BYTE_VALUES[buf] * powers(len(buf))[: len(buf)]
    value[blank[buf]] = 0
    return splitmix(np.add.reduceat(value, starts) * powers(len(buf), True)[starts])


_ORDER = random_table(64, 7) | U64(1)


def shingle_hashes(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``k`` consecutive words of each text, and ``n + 1`` places per text.

    A text of fewer words, but not none, has one shingle: all its words.
    """
    n = np.diff(first)
    total = np.zeros(max(0, len(words) - k + 1), U64)
    for j in range(k):
        total += words[j : j + len(total)] * _ORDER[j]
    full = np.maximum(n - k + 1, 0)
    count = np.where((n > 0) & (n < k), 1, full)
    place = np.concatenate([[0], np.cumsum(count)])
    index = np.arange(place[-1]) + np.repeat(first[:-1] - place[:-1], count)
    short = np.flatnonzero((n > 0) & (n < k))
    if len(total):
        out = splitmix(total[np.minimum(index, len(total) - 1)])
    else:
        out = np.empty(place[-1], U64)
    for t in short:
        own = words[first[t] : first[t + 1]]
        with np.errstate(over="ignore"):
            out[place[t]] = splitmix((own * _ORDER[: len(own)]).sum(dtype=U64, keepdims=True) + U64(len(own)))[0]
    return out, place
