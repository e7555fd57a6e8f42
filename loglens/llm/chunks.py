"""Substring deduplication by content-defined chunks.

A gear rolling hash over the bytes of a text places the chunk borders: a
border follows byte ``i`` where chosen bits of the hash of the bytes up to
``i`` are zero. The hash only depends on the last 32 bytes, so borders move with
their surroundings: an insertion changes the chunks next to it and no others.
A chunk shorter than ``MIN_BYTES`` is joined to the next one, a longer one
than ``MAX_BYTES`` is cut. Chunks are deduplicated by digest: of all equal
chunks the one in the smallest document, and there the first, stays.

Defined results: NULL and empty texts have no chunks; chunks of equal
``doc_id``s are ordered by the hash of the whole row's text, and fully equal
rows count as one document (their chunks stay or go alike); a NULL ``doc_id`` is
the smallest; other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow, save
from .textkernel import U64, random_table, runs, text_bytes

AVERAGE_BITS = 6
MIN_BYTES = 32
MAX_BYTES = 512
# One random value per byte value, made by rule.
GEAR = random_table(256, 11)
SPAN = 32  # bytes that the hash looks at
# the highest of the bits that all of the last 32 bytes reach
MASK = U64(((1 << AVERAGE_BITS) - 1) << (64 - AVERAGE_BITS))


def gear_hashes(buf: np.ndarray) -> np.ndarray:
    """For every byte the gear hash ``sum(GEAR[b[i - j]] << 2 j)`` of the last 32 bytes,
    summed by doubling the span (five array steps)."""
    h = GEAR[buf]
    step = 1
    while step < SPAN:
        h[step:] += h[:-step] << U64(2 * step)
        step *= 2
    return h


def borders(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of all chunks, and ``n + 1`` places per text in them.

    The hash never reaches into the text before (its first 31 bytes place no border).
    """
    at = np.flatnonzero((gear_hashes(buf) & MASK) == 0) + 1 if len(buf) else np.empty(0, np.int64)
    cut = np.searchsorted(at, off)
    ends: list[int] = []
    place = [0]
    for t in range(len(off) - 1):
        start, end = int(off[t]), int(off[t + 1])
        last = start
        for b in [x for x in at[cut[t] : cut[t + 1]].tolist() if x - start >= SPAN] + ([end] if end > start else []):
            if b - last < MIN_BYTES and b != end or b <= last:
                continue
            while b - last > MAX_BYTES:
                last += MAX_BYTES
                ends.append(last)
            ends.append(b)
            last = b
        place.append(len(ends))
    return np.array(ends, np.int64), np.array(place, np.int64)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for run in runs(batch):
            buf, off = text_bytes(run.column("text"))
            ends, place = borders(buf, off)
            row = np.repeat(np.arange(len(off) - 1), np.diff(place))
            starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            raw = buf.tobytes()
            digests = [hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            rows = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    run.column("doc_id").take(rows),
                    run.column("mark").take(rows),
                    pa.array((starts - off[row]).astype(np.int32)),
                    pa.array((ends - off[row]).astype(np.int32)),
                    pa.array(digests, pa.binary()),
                ],
                names=["doc_id", "mark", "start", "end", "digest"],
            )


def chunk_table(docs: DataFrame) -> DataFrame:
    """``doc_id, mark, start, end, digest`` of every chunk (bytes; ``mark`` tells texts of one id apart)."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    out = T.StructType(
        [
            rows.schema["doc_id"],
            T.StructField("mark", T.LongType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
            T.StructField("digest", T.BinaryType()),
        ]
    )
    return map_arrow(rows, _chunks, out)


def repeated_spans(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``doc_id, mark, spans``: per document the byte spans of chunks that stand earlier too.

    One aggregate finds the first place of every digest (combined before the
    shuffle, so a chunk that all documents share moves little); only digests
    that occur more than once go on to the join with the chunks.
    """
    chunks = save(spark, chunk_table(docs), "chunks")
    where = F.struct("doc_id", "mark", "start")  # in this order; NULL comes first
    firsts = chunks.groupBy("digest").agg(F.min(where).alias("first"), F.count("*").alias("n")).filter("n > 1")
    # stored, so that both sides of the join are plain scans whose hot digests Spark can split
    firsts = save(spark, firsts.drop("n"), "chunk-firsts")
    later = chunks.join(firsts, "digest").filter(~F.struct("doc_id", "mark", "start").eqNullSafe(F.col("first")))
    spans = later.groupBy("doc_id", "mark").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))
    return spans


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, removed, joined = [], [], []
        for text, spans in zip(batch.column("text"), batch.column("spans").to_pylist(), strict=True):
            raw = text.as_buffer().to_pybytes() if text.is_valid else None
            parts, runs_, at = [], [], 0
            for s in spans or ():
                if raw is None:
                    break
                parts.append(raw[at : s["start"]])
                at = s["end"]
                if runs_ and runs_[-1]["end"] == s["start"]:
                    runs_[-1]["end"] = at
                else:
                    runs_.append({"start": s["start"], "end": at})
            kept.append(None if raw is None else b"".join([*parts, raw[at:]]))
            removed.append(sum(r["end"] - r["start"] for r in runs_))
            joined.append(runs_)
        rest = [n for n in batch.schema.names if n not in ("text", "spans")]
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in rest), pa.array(kept, pa.binary()), pa.array(removed, pa.int64()), pa.array(joined, span)],
            names=[*rest, "kept", "n_removed", "removed"],
        )


def dedup_chunks(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, kept, n_removed, removed`` of all documents.

    ``kept`` holds the remaining bytes (whole chunks go, so it may split a code
    point only where two texts differ inside one), ``removed`` the joined spans.
    """
    spans = repeated_spans(spark, docs).withColumnRenamed("doc_id", "_id")
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("mark"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    rows = keyed.join(
        spans.withColumnRenamed("mark", "_mark"),
        F.col("mark").eqNullSafe(F.col("_mark")) & F.col("doc_id").eqNullSafe(F.col("_id")),
        "left",
    ).select("doc_id", "n_bytes", "text", "spans")
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    out = T.StructType(
        [
            rows.schema["doc_id"],
            T.StructField("n_bytes", T.LongType()),
            T.StructField("kept", T.BinaryType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("removed", T.ArrayType(span)),
        ]
    )
    return map_arrow(rows, _cut, out)
