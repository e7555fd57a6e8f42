"""A static, interleaved range asymmetric numeral system over token ids.

A block codes its ids in ``lanes`` independent states that take the ids in
turn, so that one array operation advances all lanes. All blocks share one
frequency table. Ids are coded backwards and decoded forwards; a block keeps
the states and the place in its words at every ``every`` steps (checkpoints),
so its parts can be decoded apart from each other.
"""

from __future__ import annotations

import struct

import numpy as np

U64 = np.uint64
LOW = 31  # states stay in [2**31, 2**63)
HEADER = struct.Struct("<4sIIHHII")
MAGIC = b"RAN1"


def quantize(counts: np.ndarray) -> tuple[np.ndarray, int]:
    """Frequencies adding up to a power of two, at least 1 for every symbol that occurs; and its exponent."""
    used = np.flatnonzero(counts)
    bits = min(24, max(12, int(np.ceil(np.log2(max(2, len(used))))) + 3))
    freq = np.zeros(len(counts), np.int64)
    if not len(used):
        return freq, bits
    total = 1 << bits
    share = counts[used].astype(float) * ((total - len(used)) / counts[used].sum())
    freq[used] = 1 + np.floor(share).astype(np.int64)
    # what rounding left over goes to the most frequent symbol
    freq[used[np.argmax(counts[used])]] += total - int(freq.sum())
    return freq, bits


class Table:
    """Shared coding table: frequencies, their running sums and the symbol of every slot."""

    def __init__(self, freq: np.ndarray, bits: int):
        self.bits = bits
        self.freq = freq.astype(U64)
        self.start = (np.cumsum(freq) - freq).astype(U64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)


def encode(ids: np.ndarray, table: Table, lanes: int, every: int) -> bytes:
    n = len(ids)
    steps = -(-n // lanes)
    state = np.full(lanes, 1 << LOW, U64)
    shift, bits, low = U64(LOW + 32 - table.bits), U64(table.bits), U64(0xFFFFFFFF)
    freq, start = table.freq[ids], table.start[ids]
    words: list[np.ndarray] = [np.empty(0, np.uint32)] * steps
    kept: dict[int, np.ndarray] = {}
    for r in range(steps - 1, -1, -1):
        f, c = freq[r * lanes : (r + 1) * lanes], start[r * lanes : (r + 1) * lanes]
        x = state[: len(f)]
        full = x >= (f << shift)
        if full.any():
            words[r] = (x[full] & low).astype(np.uint32)
            x = np.where(full, x >> U64(32), x)
        q = x // f
        state[: len(f)] = (q << bits) + (x - q * f) + c
        if r % every == 0:
            kept[r] = state.copy()
    marks = sorted(kept)
    sizes = np.cumsum([0, *map(len, words)])
    head = HEADER.pack(MAGIC, n, lanes, table.bits, 0, every, int(sizes[-1]))
    places = np.array([sizes[r] for r in marks], "<u4").tobytes()
    states = b"".join(kept[r].astype("<u8").tobytes() for r in marks)
    return head + places + states + np.concatenate([*words, np.empty(0, np.uint32)]).astype("<u4").tobytes()


def _parts(block: bytes):
    magic, n, lanes, bits, _, every, n_words = HEADER.unpack_from(block)
    if magic != MAGIC:
        raise ValueError("not a token block")
    marks = -(-(-(-n // lanes)) // every)
    at = HEADER.size
    places = np.frombuffer(block, "<u4", marks, at)
    at += 4 * marks
    states = np.frombuffer(block, "<u8", marks * lanes, at).reshape(marks, lanes)
    at += 8 * marks * lanes
    return n, lanes, bits, every, places, states, np.frombuffer(block, "<u4", n_words, at)


def checkpoints(block: bytes) -> int:
    """Number of parts of ``block`` that can be decoded apart."""
    return len(_parts(block)[4])


def decode(block: bytes, table: Table, part: int | None = None) -> np.ndarray:
    """The ids of ``block``, or of one of its checkpointed parts."""
    n, lanes, bits, every, places, states, words = _parts(block)
    if bits != table.bits:
        raise ValueError("block and table differ")
    if not n:
        return np.empty(0, np.uint32)
    first = (part or 0) * every
    last = -(-n // lanes) if part is None else min(first + every, -(-n // lanes))
    state, at = states[part or 0].astype(U64), int(places[part or 0])
    out = np.empty(min(n, last * lanes) - first * lanes, np.uint32)
    mask, shift, low = U64((1 << bits) - 1), U64(bits), U64(1 << LOW)
    for r in range(first, last):
        here = out[(r - first) * lanes : (r - first + 1) * lanes]
        x = state[: len(here)]
        slot = x & mask
        ids = table.symbol[slot]
        here[:] = ids
        x = table.freq[ids] * (x >> shift) + slot - table.start[ids]
        need = np.flatnonzero(x < low)
        if len(need):
            x[need] = (x[need] << U64(32)) | words[at : at + len(need)]
            at += len(need)
        state[: len(here)] = x
    return out
