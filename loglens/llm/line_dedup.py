"""Reversible line deduplication.

A line's key is the line without blanks at its ends, A-Z in lower case. Lines
whose key stands in at least ``min_docs`` documents go, except in the largest
``doc_id`` that holds it. Which keys are that frequent is kept as state, so that
documents can be added and taken out again without reading the others' texts:

* ``references``: a log of exact reference counts, one row per key and document with
  the number of its lines (negative when the document was deleted). What counts is the sum.
* ``frequent``: a log of the exact counts (documents, largest holder) of keys that are, or
  were, frequent; the latest row of a key counts.
* ``filters``: a cuckoo filter (:mod:`.cuckoo`) per shard of the key space with the
  frequent keys. They are small, and keys can be deleted from them.

An insert or delete writes its references, counts the keys it touches exactly, and puts
those that became frequent into their shard's filter, or takes out those that ceased to
be. :meth:`LineIndex.dedup` tests the references against the filters, shard by shard and without a
shuffle. Only what passes (the frequent lines, and some false hits that the
exact counts reject) is shuffled to the counts and on to the documents.

Filters go to the tasks in groups of shards of ``FILTER_BYTES`` together; the references are
sorted by key, so each group's scan skips the others' row groups. The shards grow in number with
the frequent keys. Every step is a written table, and a step counts once its
version is written, so lost executors or a killed job leave the last whole version.

Keys are told apart by 128 bits of BLAKE2b. Defined results: a NULL or empty text is one
empty line; rows of one ``doc_id`` (NULL too, the smallest) count as one document; a row
that is inserted twice counts once; ``delete`` takes out all rows of an id; documents that
are not in the state keep everything; other columns pass through, whatever their names.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import fresh_path
from .common import map_arrow, save, ship, whole_row
from .cuckoo import CuckooFilter, ShardedFilter
from .textkernel import runs

MIN_CHARS = 20
MIN_DOCS = 3
KEYS_PER_SHARD = 1 << 15
FILTER_BYTES = 32 << 20
PREFIX_BITS = 16
FILTERS = "shard int, filter binary"

BLANKS = b" \t\n\x0b\x0c\r"
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def line_digest(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """The digest of a line's key, None if the key has fewer than ``min_chars`` characters."""
    key = line.strip(BLANKS).translate(LOWER)
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode()) < min_chars:
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


def _raw(text: pa.Scalar) -> bytes:
    return text.as_buffer().to_pybytes() if text.is_valid else b""


def _lines(min_chars: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (run for whole in batches for run in runs(whole)):
        row, digests, counts = [], [], []
        for i, text in enumerate(batch.column("text")):
            found = Counter(line_digest(line, min_chars) for line in _raw(text).split(b"\n"))
            found.pop(None, None)
            row += [i] * len(found)
            digests += found.keys()
            counts += found.values()
        prefix = np.frombuffer(b"".join(d[:2] for d in digests), ">u2").astype(np.int32)
        at = pa.array(row, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(prefix), pa.array(digests, pa.binary()), batch.column("doc_id").take(at), batch.column("mark").take(at), pa.array(counts, pa.int64())],
            names=["prefix", "digest", "doc_id", "mark", "n"],
        )


def _hashes(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(d[8:] for d in digests), "<u8").astype(np.uint64)


def _passing(tables: dict[int, bytes], bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    filters = ShardedFilter({shard: CuckooFilter.load(raw).table for shard, raw in tables.items()})
    for batch in batches:
        shards = batch.column("prefix").to_numpy().astype(np.int64) >> (PREFIX_BITS - bits)
        found = filters.contains(shards, _hashes(batch.column("digest").to_pylist()))
        yield batch.filter(pa.array(found))


def _update(pdf: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
    """One shard's filter after its keys came and went; an empty one tells that its table has become too small."""
    if not len(pdf):
        return old[["shard", "filter"]]
    shard = int(pdf["shard"].iloc[0])
    come, gone = (_hashes(list(pdf["digest"][pdf["come"] == c])) for c in (True, False))
    made = CuckooFilter.load(bytes(old["filter"].iloc[0])) if len(old) else CuckooFilter.sized(len(come))
    made.delete(gone)
    fits = len(made) + len(come) <= len(made.table) * 3 and made.insert(come)
    return pd.DataFrame({"shard": [shard], "filter": [made.dump() if fits else b""]})


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "filter": [CuckooFilter.of(_hashes(list(pdf["digest"]))).dump()]})


def _drop_lines(min_chars: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (run for whole in batches for run in runs(whole)):
        n_lines, n_dropped, kept = [], [], []
        for text, digests in zip(batch.column("text"), batch.column("digests").to_pylist(), strict=True):
            lines = _raw(text).split(b"\n")
            n_lines.append(len(lines))
            if digests:
                gone = set(digests)
                stay = [line for line in lines if line_digest(line, min_chars) not in gone]
            else:
                stay = lines
            n_dropped.append(len(lines) - len(stay))
            kept.append(None if not text.is_valid else b"\n".join(stay))
        rest = [n for n in batch.schema.names if n not in ("text", "digests")]
        found = [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in rest), *found], names=[*rest, "n_lines", "n_dropped", "kept"])


class LineIndex:
    """The state at ``path`` as of one version; :meth:`insert` and :meth:`delete` give the next one."""

    def __init__(self, spark: SparkSession, path: str, version: dict):
        self.spark, self.path, self.version = spark, path, version

    @classmethod
    def create(cls, spark: SparkSession, path: str, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> LineIndex:
        """An empty state at ``path`` (a folder that all executors share)."""
        empty = {"number": 0, "min_chars": min_chars, "min_docs": min_docs, "references": [], "frequent": [], "filters": None, "bits": 0}
        return cls(spark, path, empty)._commit()

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> LineIndex:
        """The latest whole version at ``path``."""
        rows = spark.read.text(f"{path}/versions", recursiveFileLookup=True).collect()  # one row per version
        return cls(spark, path, max((json.loads(r["value"]) for r in rows), key=lambda v: v["number"]))

    def _commit(self) -> LineIndex:
        row = self.spark.createDataFrame([(json.dumps(self.version),)], "value string").coalesce(1)
        row.write.text(f"{self.path}/versions/{self.version['number']:08d}")
        return self

    def _write(self, df: DataFrame, name: str) -> str:
        folder = f"{self.path}/{name}-{self.version['number'] + 1:08d}-{fresh_path(self.spark, 'x')[-8:]}"
        df.write.option("compression", "zstd").parquet(folder)
        return folder

    def _read(self, folders: list[str], schema: T.StructType) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def _schemas(self, doc_id: T.DataType) -> tuple[T.StructType, T.StructType]:
        key = [T.StructField("prefix", T.IntegerType()), T.StructField("digest", T.BinaryType())]
        references = [T.StructField("doc_id", doc_id), T.StructField("mark", T.LongType()), T.StructField("n", T.LongType())]
        frequent = [T.StructField("n_docs", T.LongType()), T.StructField("keeper", doc_id), T.StructField("number", T.LongType())]
        return T.StructType([*key, *references]), T.StructType([*key, *frequent])

    def references(self, doc_id: T.DataType | None = None) -> DataFrame:
        """The log of reference counts."""
        return self._read(self.version["references"], self._schemas(doc_id or self._id_type())[0])

    def frequent(self, doc_id: T.DataType | None = None) -> DataFrame:
        """``prefix, digest, n_docs, keeper`` of the frequent keys, exact."""
        log = self._read(self.version["frequent"], self._schemas(doc_id or self._id_type())[1])
        value = F.struct("n_docs", "keeper")
        latest = log.groupBy("prefix", "digest").agg(F.max_by(value, "number").alias("v")).select("prefix", "digest", "v.*")
        return latest.filter(F.col("n_docs") >= self.version["min_docs"])

    def _id_type(self) -> T.DataType:
        folders = self.version["references"]
        return self.spark.read.parquet(folders[0]).schema["doc_id"].dataType if folders else T.LongType()

    def _next(self, added: DataFrame, doc_id: T.DataType) -> LineIndex:
        """The version after the references ``added``."""
        version = dict(self.version, number=self.version["number"] + 1)
        version["references"] = [*self.version["references"], self._write(added, "references")]
        schema = self._schemas(doc_id)[0]
        new = self.spark.read.schema(schema).parquet(version["references"][-1])
        touched = new.select("digest").distinct()
        held = new
        if self.version["references"]:
            older = self.references(doc_id).join(touched, "digest", "left_semi")
            held = older.unionByName(new)
        per = held.groupBy("prefix", "digest", "doc_id").agg(F.sum("n").alias("n")).filter("n > 0")
        counts = per.groupBy("prefix", "digest").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper"))
        counts = counts.filter(F.col("n_docs") >= self.version["min_docs"])
        before = self.frequent(doc_id).join(touched, "digest", "left_semi")
        before = before.select("prefix", "digest", F.lit(True).alias("was"))
        changed = counts.join(before, ["prefix", "digest"], "full").select(
            "prefix", "digest", F.coalesce("n_docs", F.lit(0)).cast("long").alias("n_docs"), "keeper",
            F.lit(version["number"]).cast("long").alias("number"), F.coalesce("was", F.lit(False)).alias("was"),
        )
        folder = self._write(changed, "frequent")
        version["frequent"] = [*self.version["frequent"], folder]
        made = LineIndex(self.spark, self.path, version)
        made._set_filters(self.spark.read.parquet(folder), doc_id)
        return made._commit()

    def _shard(self, bits: int) -> Column:
        return F.shiftright("prefix", PREFIX_BITS - bits).alias("shard")

    def _set_filters(self, changed: DataFrame, doc_id: T.DataType) -> None:
        """Filters of this version: the changed shards anew or updated, the others as they are."""
        ship(self.spark)
        now = F.col("n_docs") >= self.version["min_docs"]
        total = self.frequent(doc_id).count()
        bits = min(PREFIX_BITS, max(self.version["bits"], (total // KEYS_PER_SHARD).bit_length()))
        if self.version["filters"] and bits == self.version["bits"]:
            keys = changed.filter(now != F.col("was")).select(self._shard(bits), "digest", now.alias("come"))
            updated = keys.groupBy("shard").cogroup(self._filters().groupBy("shard")).applyInPandas(_update, FILTERS)
            self.version["filters"] = self._write(updated, "filters")
            if not self._filters().filter(F.octet_length("filter") == 0).limit(1).count():
                return
        keys = self.frequent(doc_id).select(self._shard(bits), "digest")
        self.version["filters"] = self._write(keys.groupBy("shard").applyInPandas(_build, FILTERS), "filters")
        self.version["bits"] = bits

    def insert(self, docs: DataFrame) -> LineIndex:
        """The state with ``docs(doc_id, text)`` added."""
        doc_id = docs.schema["doc_id"].dataType
        schema = self._schemas(doc_id)[0]
        rows = docs.select("doc_id", F.xxhash64("text").alias("mark"), "text")
        lines = save(self.spark, map_arrow(rows, functools.partial(_lines, self.version["min_chars"]), schema), "dedup-lines")
        keys = ["prefix", "digest", "doc_id", "mark"]
        # sorted by key for the scans to come; a row that occurs more than once counts once
        dealt = lines.repartitionByRange(*keys).groupBy(*keys).agg(F.max("n").alias("n"))
        if self.version["references"]:
            held = self.references(doc_id).groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(F.sum("n").alias("_n")).filter("_n > 0")
            same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
            dealt = dealt.join(held, same, "left_anti")
        return self._next(dealt.sortWithinPartitions("prefix", "digest"), doc_id)

    def delete(self, doc_ids: DataFrame) -> LineIndex:
        """The state without the documents in the column ``doc_id`` of ``doc_ids``; their texts aren't needed."""
        doc_id = self._id_type()
        ids = doc_ids.select(F.col("doc_id").cast(doc_id).alias("_doc_id")).distinct()
        held = self.references(doc_id).join(ids, F.col("doc_id").eqNullSafe(F.col("_doc_id")), "left_semi")
        keys = ["prefix", "digest", "doc_id", "mark"]
        gone = held.groupBy(*keys).agg((-F.sum("n")).alias("n")).filter("n < 0")
        return self._next(gone.sortWithinPartitions("prefix", "digest"), doc_id)

    def _filters(self) -> DataFrame:
        return self.spark.read.schema(FILTERS).parquet(self.version["filters"])

    def filter_groups(self) -> list[tuple[int, int]]:
        """Ranges of shards whose filters have about ``FILTER_BYTES`` together (sizes of shards, not keys, reach the driver)."""
        if not self.version["filters"]:
            return []
        sizes = self._filters().select("shard", F.octet_length("filter").alias("n")).collect()
        groups: list[list[int]] = []
        for shard, n in sorted(map(tuple, sizes)):
            if groups and groups[-1][2] + n <= FILTER_BYTES:
                groups[-1][1:] = [shard, groups[-1][2] + n]
            else:
                groups.append([shard, shard, n])
        return [(a, b) for a, b, _ in groups]

    def repeated(self, doc_id: T.DataType | None = None) -> DataFrame:
        """``doc_id, mark, digests``: per inserted row the keys of the lines that it loses."""
        doc_id = doc_id or self._id_type()
        schema, bits = self._schemas(doc_id)[0], self.version["bits"]
        shift = PREFIX_BITS - bits
        folders = []
        for low, high in self.filter_groups():
            filters = self._filters().filter(F.col("shard").between(low, high))
            tables = {r["shard"]: bytes(r["filter"]) for r in filters.collect()}  # at most FILTER_BYTES, or one shard
            part = self.references(doc_id).filter(F.col("prefix").between(low << shift, ((high + 1) << shift) - 1))
            found = map_arrow(part, functools.partial(_passing, tables, bits), schema)
            folder = fresh_path(self.spark, "dedup-passing")
            found.write.option("compression", "zstd").parquet(folder)
            folders.append(folder)
        keys = ["prefix", "digest", "doc_id", "mark"]
        maybe = self._read(folders, schema).groupBy(*keys).agg(F.sum("n").alias("n")).filter("n > 0").drop("n")
        # stored, so that both sides of the join are scans whose hot keys Spark can split
        maybe, exact = save(self.spark, maybe, "dedup-maybe"), save(self.spark, self.frequent(doc_id), "dedup-frequent")
        lost = maybe.join(exact, ["prefix", "digest"]).filter("doc_id < keeper OR doc_id IS NULL AND keeper IS NOT NULL")
        return lost.groupBy("doc_id", "mark").agg(F.collect_set("digest").alias("digests"))

    def dedup(self, docs: DataFrame) -> DataFrame:
        """``row`` (all columns of ``docs``), ``n_lines`` before, ``n_dropped`` and the ``kept`` text (NULL stays NULL)."""
        doc_id = docs.schema["doc_id"].dataType
        lost = save(self.spark, self.repeated(doc_id), "dedup-lost").select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "digests")
        rows = docs.select("doc_id", F.xxhash64("text").alias("mark"), "text", whole_row(docs))
        rows = rows.join(lost, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")), "left")
        rows = rows.select("row", "text", "digests")
        out = T.StructType([rows.schema["row"]]).add("n_lines", T.LongType()).add("n_dropped", T.LongType()).add("kept", T.StringType())
        return map_arrow(rows, functools.partial(_drop_lines, self.version["min_chars"]), out)


def dedup_lines(spark: SparkSession, docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """All of ``docs`` without their repeated lines, from a state that holds just them."""
    state = LineIndex.create(spark, fresh_path(spark, "line-index"), min_chars, min_docs).insert(docs)
    return state.dedup(docs)
