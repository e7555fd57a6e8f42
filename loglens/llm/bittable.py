"""A bit table of fixed size, to tell which keys of a large table may be wanted.

A clear bit proves that a key is not wanted; a set bit may be another key's, so
whoever uses the table compares the keys themselves later on. Its size is
bounded by construction, whatever the number of keys.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET = 32768  # bits per row of Spark's bitmap functions


def bit_table(keys: DataFrame, column: str, bits: int) -> bytes:
    """The table of the 64-bit integers in ``column`` (built in parallel; ``bits / 8`` bytes are gathered)."""
    slot = F.pmod(F.col(column), F.lit(bits)).cast("long") + 1  # Spark's bitmap functions count from 1
    parts = keys.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
    rows = parts.agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).collect()
    out = bytearray(bits // 8)
    for r in rows:
        at = (r["bucket"] - 1) * BUCKET // 8
        out[at : at + len(r["bits"])] = r["bits"]
    return bytes(out)


def has_bit(table: bytes, keys: np.ndarray) -> np.ndarray:
    """Which of ``keys`` (64-bit integers) may be in the table."""
    slot = keys.view(np.int64) % (8 * len(table))
    return (np.frombuffer(table, np.uint8)[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
