"""Token-ID output in blocks coded by a static range asymmetric numeral system.

``write_tokens`` lays the documents out in ascending ``doc_id`` order (range
partitioning), encodes every whole text once, counts the ids of the whole
corpus, and codes the ids with one frequency table into blocks of consecutive
documents. A written folder holds

* ``table``: ``id, freq, bits``, the shared frequency table;
* ``blocks``: one row per block: ``part, block, first_token`` (ids of all
  documents before it), ``doc_ids``, ``n_tokens`` (per document), ``crc32`` and
  ``payload`` (see :mod:`.rans`: checkpoints, states and words).

The container is Parquet, so any store that Spark writes to will do and lost
executors are handled by Spark's output commit. Every block can be decoded by
itself (and every checkpointed part of it), so reading is parallel.

Defined results: NULL and empty texts have only the end id; equal ``doc_id``s
follow each other in the order of their texts' hashes; a NULL ``doc_id`` comes
first; an empty input writes no block.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import rans
from .common import map_arrow, save
from .encoder import ENCODE_BYTES, PieceEncoder, piece_encoder, with_end
from .textkernel import runs, text_bytes

BLOCK_TOKENS = 1 << 18
LANES = 512
# Steps between two checkpoints of a block.
EVERY = 256


def _encode(tokenizer: str, end_id: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    enc = piece_encoder(tokenizer)
    before: dict[int, int] = {}
    try:
        yield from _encode_runs(enc, end_id, before, batches)
    finally:
        enc.end_task()


def _encode_runs(enc: PieceEncoder, end_id: int, before: dict[int, int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for run in runs(batch, limit=ENCODE_BYTES):
            ids, per = with_end(*enc.encode(*text_bytes(run.column("text"))), end_id)
            at = np.concatenate([[0], np.cumsum(per)])
            raw = ids.astype("<u4").tobytes()
            part = run.column("part").to_numpy()
            places = np.empty(len(per), np.int64)
            for i, p in enumerate(part.tolist()):
                places[i] = before.get(p, 0)
                before[p] = int(places[i]) + int(per[i])
            offsets = pa.py_buffer((4 * at).astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    run.column("part"),
                    pa.array(places),
                    run.column("doc_id"),
                    pa.array(per),
                    pa.Array.from_buffers(pa.binary(), len(per), [None, offsets, pa.py_buffer(raw)]),
                ],
                names=["part", "place", "doc_id", "n_tokens", "ids"],
            )


def token_table(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """``part, place, doc_id, n_tokens, ids`` (little-endian uint32) of all documents, stored once.

    Parts follow each other in ``doc_id`` order; ``place`` counts the ids before
    a document in its part.
    """
    mark = F.xxhash64("text")
    ordered = (
        docs.select("doc_id", "text", mark.alias("_mark"))
        .repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("_mark"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("_mark"))
        .select(F.spark_partition_id().cast("long").alias("part"), "doc_id", "text")
    )
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType(
        [
            T.StructField("part", T.LongType()),
            T.StructField("place", T.LongType()),
            T.StructField("doc_id", id_type),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )
    return save(spark, map_arrow(ordered, functools.partial(_encode, tokenizer, end_id), schema), "tokens")


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << 16, np.int64)
    for batch in batches:
        ids = text_bytes(batch.column("ids"))[0].view("<u4")
        got = np.bincount(ids)
        if len(got) > len(total):
            total = np.concatenate([total, np.zeros(len(got) - len(total), np.int64)])
        total[: len(got)] += got
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])


def frequency_table(tokens: DataFrame) -> tuple[np.ndarray, int]:
    """The quantized frequencies of all ids (one entry per id of the vocabulary)."""
    counts = map_arrow(tokens.select("ids"), _counts, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    n = np.zeros(max((r["id"] for r in counts), default=0) + 1, np.int64)
    for r in counts:
        n[r["id"]] = r["n"]
    return rans.quantize(n)


_tables: dict[bytes, rans.Table] = {}


def _table(freq: bytes, bits: int) -> rans.Table:
    """The coding table of a task, built once per worker process."""
    if freq not in _tables:
        _tables.clear()
        _tables[freq] = rans.Table(np.frombuffer(freq, np.int64), bits)
    return _tables[freq]


def _blocks(freq: bytes, bits: int, doc_type: pa.DataType, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = _table(freq, bits)
    rows: list[tuple] = []  # consecutive documents of one part
    size = 0

    def block() -> pa.RecordBatch:
        payload = rans.encode(np.concatenate([r[4] for r in rows]), table, LANES, EVERY)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([rows[0][0]], pa.int64()),
                pa.array([rows[0][1]], pa.int64()),
                pa.array([[r[2] for r in rows]], pa.list_(doc_type)),
                pa.array([[r[3] for r in rows]], pa.list_(pa.int64())),
                pa.array([zlib.crc32(payload)], pa.int64()),
                pa.array([payload], pa.binary()),
            ],
            names=["part", "place", "doc_ids", "n_tokens", "crc32", "payload"],
        )

    for batch in batches:
        data, at = text_bytes(batch.column("ids"))
        ids, at = data.view("<u4"), at // 4
        for i, (part, place, doc, n) in enumerate(
            zip(*(batch.column(c).to_pylist() for c in ("part", "place", "doc_id", "n_tokens")), strict=True)
        ):
            # a block ends where it is full, and where its documents stop following each other
            if rows and (size >= BLOCK_TOKENS or part != rows[0][0] or place != rows[-1][1] + rows[-1][3]):
                yield block()
                rows, size = [], 0
            rows.append((part, place, doc, n, ids[at[i] : at[i + 1]].copy()))
            size += n
    if rows:
        yield block()


def write_tokens(spark: SparkSession, docs: DataFrame, path: str, tokenizer: str, end_id: int) -> str:
    """Write the ids of ``docs(doc_id, text)`` under ``path``; other columns are left out."""
    tokens = token_table(spark, docs, tokenizer, end_id)
    freq, bits = frequency_table(tokens)
    used = np.flatnonzero(freq)
    spark.createDataFrame(
        [(int(i), int(freq[i]), bits) for i in used], "id long, freq long, bits int"
    ).coalesce(1).write.parquet(f"{path}/table")
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType(
        [
            T.StructField("part", T.LongType()),
            T.StructField("place", T.LongType()),
            T.StructField("doc_ids", T.ArrayType(id_type)),
            T.StructField("n_tokens", T.ArrayType(T.LongType())),
            T.StructField("crc32", T.LongType()),
            T.StructField("payload", T.BinaryType()),
        ]
    )
    from pyspark.sql.pandas.types import to_arrow_type

    coder = functools.partial(_blocks, freq.tobytes(), bits, to_arrow_type(id_type))
    # one row per part: the ids of all parts before it
    parts = tokens.groupBy("part").agg(F.sum("n_tokens").alias("all"))
    before = F.coalesce(F.sum("all").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", before.alias("before"))
    blocks = map_arrow(tokens.select("part", "place", "doc_id", "n_tokens", "ids"), coder, schema)
    blocks.join(parts, "part").select(
        "part", (F.col("before") + F.col("place")).alias("first_token"), "doc_ids", "n_tokens", "crc32", "payload"
    ).write.option("compression", "none").parquet(f"{path}/blocks")
    return path


def _decode(freq: bytes, bits: int, doc_type: pa.DataType, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = _table(freq, bits)
    for batch in batches:
        for first, docs, sizes, crc, payload in zip(
            *(batch.column(c).to_pylist() for c in ("first_token", "doc_ids", "n_tokens", "crc32", "payload")), strict=True
        ):
            if zlib.crc32(payload) != crc:
                raise ValueError(f"checksum of the block at token {first} is wrong")
            ids = rans.decode(payload, table)
            at = np.concatenate([[0], np.cumsum(sizes)])
            offsets = pa.py_buffer((4 * at).astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(docs, doc_type),
                    pa.array(first + at[:-1]),
                    pa.array(sizes, pa.int64()),
                    pa.Array.from_buffers(pa.binary(), len(docs), [None, offsets, pa.py_buffer(ids.astype("<u4").tobytes())]),
                ],
                names=["doc_id", "start", "n_tokens", "ids"],
            )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` (little-endian uint32) of all documents written under ``path``."""
    from pyspark.sql.pandas.types import to_arrow_type

    rows = spark.read.parquet(f"{path}/table").collect()  # at most the vocabulary
    freq = np.zeros(max((r["id"] for r in rows), default=0) + 1, np.int64)
    for r in rows:
        freq[r["id"]] = r["freq"]
    bits = rows[0]["bits"] if rows else 12
    blocks = spark.read.parquet(f"{path}/blocks")
    id_type = blocks.schema["doc_ids"].dataType.elementType
    schema = T.StructType(
        [
            T.StructField("doc_id", id_type),
            T.StructField("start", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )
    decoder = functools.partial(_decode, freq.tobytes(), bits, to_arrow_type(id_type))
    return map_arrow(blocks.drop("part"), decoder, schema)
