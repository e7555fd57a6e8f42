"""Exact substring deduplication with a run-length index.

Every byte covered by a string of ``LENGTH`` bytes that also starts in a
document with a smaller ``doc_id`` is removed. Texts are bytes of UTF-8 and a
string never crosses documents.

1. Texts that a smaller document has as a whole lose everything and are left out of the rest
   (equal texts are one text for the index).
2. Every window of ``LENGTH`` bytes is named by the smallest hash of the
   ``SEED``-byte strings in it. Equal windows have equal names, and neighbours
   mostly share theirs, so a text falls into stretches of windows of one name.
   Names that occur once in the corpus cannot repeat: only stretches of the
   other names go on.
3. The stretches are dealt by name. A task takes groups of names of a few
   megabytes and builds a run-length index (:mod:`.rindex`) over the different
   stretches in them (repetition costs one entry and one run), but for those that no
   other one can need. The others' bytes are streamed through it as matching statistics;
   a match of ``LENGTH`` bytes leads to the rows that begin with it, and so to the
   smallest document that holds it. Of a name's smallest document nothing needs to be looked up.
4. The marked spans are gathered per document and cut out.

Which names repeat is told to the scan by a bit table of fixed size (its bytes are broadcast);
beyond what it can tell apart (more than half full), the names are joined to the documents instead. A name of
more than ``HOT`` stretches, or of more than ``HOT_WINDOWS`` windows in them (long
runs of periodic text are long stretches), is not left to one task: it is dealt by its windows, so
that each group is one string, and grouped by Spark, combined before the shuffle.

Defined results: NULL and empty texts, and texts shorter than ``LENGTH``, keep
everything; documents of equal ``doc_id`` don't remove from each other; a NULL
``doc_id`` is smaller than any other; ``doc_id`` is an integer.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bittable import bit_table, has_bit
from .common import map_arrow, save
from .rindex import RunLengthIndex
from .textkernel import BYTE_VALUES, U64, random_table, runs, splitmix, text_bytes

LENGTH = 50
SEED = 24
BITS = 1 << 28
DOC_BITS = 1 << 26
HOT = 200_000
# A stretch of n bytes has n - LENGTH + 1 windows, with several 8-byte values each in an index.
HOT_WINDOWS = 1 << 22
# A task indexes groups of about this many bytes of stretches at a time.
GROUP_BYTES = 4 << 20
_STEP = random_table(8, 3) | U64(1)


def _window_names(buf: np.ndarray) -> np.ndarray:
    """For every place the smallest hash of a ``SEED``-byte string in the ``LENGTH`` bytes from there."""
    h = {1: BYTE_VALUES[buf]}
    for i, n in enumerate((1, 2, 4, 8)):
        a = h[n]
        h[2 * n] = a[: len(a) - n] * _STEP[i] + a[n:]
        if n != 8:
            del h[n]
    a, b = h[16], h[8]
    m = splitmix(a[: len(a) - 8] * _STEP[5] + b[16:])  # 16 + 8 bytes
    span, width = LENGTH - SEED + 1, 1
    while 2 * width <= span:
        m = np.minimum(m[: len(m) - width], m[width:])
        width *= 2
    return np.minimum(m[: len(m) - (span - width)], m[span - width :])


def stretches(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Name, text, first byte and end (exclusive) of all stretches of windows of one name."""
    sizes = np.diff(off)
    count = np.maximum(sizes - LENGTH + 1, 0)
    total = int(count.sum())
    if not total:
        return (np.empty(0, U64), *(np.empty(0, np.int64) for _ in range(3)))
    text = np.repeat(np.arange(len(sizes)), count)
    at = np.arange(total) + np.repeat(off[:-1] - (np.cumsum(count) - count), count)
    name = _window_names(buf)[at]
    new = np.ones(total, bool)
    new[1:] = (name[1:] != name[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], total) - 1
    return name[first], text[first], at[first], at[last] + LENGTH


def whole_copies(spark: SparkSession, keyed: DataFrame) -> DataFrame:
    """Stored ``doc_id, mark, size`` of the rows whose whole text a smaller document has (told by a digest)."""
    size = F.octet_length("text").alias("size")
    rows = save(spark, keyed.filter(F.octet_length("text") >= LENGTH).select("doc_id", "mark", size, F.md5(F.col("text").cast("binary")).alias("key")), "suffix-texts")
    ranked = F.struct(F.col("doc_id").isNotNull().alias("r"), "doc_id")
    least = rows.groupBy("key").agg(F.min(ranked).alias("least"), F.max(ranked).alias("most")).filter("least < most")
    least = save(spark, least.select("key", "least"), "suffix-first-texts")
    copies = save(spark, rows.join(least, "key").filter(ranked > F.col("least")).select("doc_id", "mark", "size"), "suffix-copies")
    return copies


class Skipped:
    """Tells the scans which rows are whole copies, by two bit tables: of the copies, and of the
    other rows that hit the first table by chance. A copy that hits the second too is only looked at in vain."""

    def __init__(self, spark: SparkSession, keyed: DataFrame, copies: DataFrame):
        self.copies = bit_table(copies.select("mark").distinct(), "mark", DOC_BITS)
        rows = map_arrow(keyed.select("doc_id", "mark"), functools.partial(_flagged, self.copies), "doc_id long, mark long")
        other = copies.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"))
        same = (F.col("mark") == F.col("_mark")) & F.col("doc_id").eqNullSafe(F.col("_id"))
        self.others = bit_table(rows.join(other, same, "left_anti").select("mark").distinct(), "mark", DOC_BITS)

    def rest(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        marks = batch.column("mark").to_numpy()
        return batch.filter(pa.array(~has_bit(self.copies, marks) | has_bit(self.others, marks)))


def _flagged(bits: bytes, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.filter(pa.array(has_bit(bits, batch.column("mark").to_numpy())))


def _names(skipped: Skipped, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for run in runs(skipped.rest(batch)):
            names, _, begin, end = stretches(*text_bytes(run.column("text")))
            name, at, n = np.unique(names, return_inverse=True, return_counts=True)
            windows = np.zeros(len(name), np.int64)
            np.add.at(windows, at, end - begin - (LENGTH - 1))
            yield pa.RecordBatch.from_arrays([pa.array(name.view(np.int64)), pa.array(n), pa.array(windows)], names=["name", "n", "windows"])


def _named(skipped: Skipped, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for run in runs(skipped.rest(batch)):
            name, text, _, _ = stretches(*text_bytes(run.column("text")))
            rows = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [run.column("doc_id").take(rows), run.column("mark").take(rows), pa.array(name.view(np.int64))], names=["doc_id", "mark", "name"]
            )


def _stretches(skipped: Skipped, bits: bytes | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stretches of names that may repeat: told by the bit table, or by the names in ``wanted``."""
    for batch in batches:
        for run in runs(skipped.rest(batch)):
            buf, off = text_bytes(run.column("text"))
            name, text, begin, end = stretches(buf, off)
            if bits is not None:
                use = has_bit(bits, name)
            else:
                use = np.zeros(len(name), bool)
                place = np.searchsorted(text, np.arange(run.num_rows + 1))
                for i, wanted in enumerate(run.column("wanted").to_pylist()):
                    own = slice(place[i], place[i + 1])
                    use[own] = np.isin(name[own].view(np.int64), np.array(wanted or [], np.int64))
            name, text, begin, end = (x[use] for x in (name, text, begin, end))
            size = end - begin
            upto = np.concatenate([[0], np.cumsum(size)])
            raw = buf[np.arange(upto[-1]) + np.repeat(begin - upto[:-1], size)]
            rows = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(name.view(np.int64)),
                    run.column("doc_id").take(rows),
                    run.column("mark").take(rows),
                    pa.array((begin - off[text]).astype(np.int32)),
                    pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(upto.astype(np.int32).tobytes()), pa.py_buffer(raw.tobytes())]),
                ],
                names=["name", "doc_id", "mark", "start", "bytes"],
            )


def mark_repeats(texts: list[bytes], docs: np.ndarray, starts: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans ``(row, first byte, end)`` of the rows' bytes that a smaller document's row also holds.

    Equal stretches are one string, which its smallest holder stands for. A name's *first*
    strings are those of its smallest document, its *last* ones those whose smallest holder is the largest.
    All of a first string stands in the smallest document. Every other string is streamed through the index
    of all strings but the last ones (which no other string needs as its source): a match of
    ``LENGTH`` bytes leads to the rows that begin with it, and so to its smallest holder.
    """
    none = (np.empty(0, np.int64),) * 3
    if not texts or docs.min() == docs.max():
        return none
    place: dict[bytes, int] = {}
    own = np.array([place.setdefault(t, len(place)) for t in texts], np.int64)
    different = list(place)
    size = np.array([len(t) for t in different], np.int64)
    least = np.full(len(different), np.iinfo(np.int64).max)
    np.minimum.at(least, own, docs)
    name = np.empty(len(different), names.dtype)
    name[own] = names
    _, group = np.unique(name, return_inverse=True)
    low = np.full(len(group), np.iinfo(np.int64).max)
    np.minimum.at(low, group, least)
    high = np.full(len(group), np.iinfo(np.int64).min)
    np.maximum.at(high, group, least)
    low, high = low[group], high[group]
    whole = np.flatnonzero((least == low)[own] & (docs > low[own]))
    spans = [(whole, starts[whole], starts[whole] + size[own[whole]])]
    streamed = np.flatnonzero(least > low)
    if len(streamed):
        upto = np.full(len(different), -1)
        windows = size[streamed] - LENGTH + 1
        upto[streamed] = np.cumsum(windows) - windows
        found = np.repeat(least[streamed], windows)
        indexed = np.flatnonzero(least < high)
        index = RunLengthIndex([different[i] for i in indexed], LENGTH)
        begin = np.flatnonzero(np.diff(index.class_of_row, prepend=-1))
        smallest = np.minimum.reduceat(least[indexed][index.row_text], begin)
        index.forget_rows()
        for which, at, row, match in index.matching_statistics([different[i] for i in streamed]):
            long = match >= LENGTH
            spot = upto[streamed[which[long]]] + at[long]
            found[spot] = np.minimum(found[spot], smallest[np.searchsorted(begin, row[long], "right") - 1])
        rows = np.flatnonzero(upto[own] >= 0)
        count = size[own[rows]] - LENGTH + 1
        row = np.repeat(rows, count)
        offset = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        hit = found[upto[own[row]] + offset] < docs[row]
        begins, ends = hit.copy(), hit.copy()
        begins[1:] &= ~hit[:-1] | (offset[1:] == 0)
        ends[:-1] &= ~hit[1:] | (offset[1:] == 0)
        a, b = np.flatnonzero(begins), np.flatnonzero(ends)
        spans.append((row[a], starts[row[a]] + offset[a], starts[row[b]] + offset[b] + LENGTH))
    return tuple(np.concatenate(x) for x in zip(*spans, strict=True))


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans to remove, from stretches sorted by name; groups are taken together up to ``GROUP_BYTES``."""
    held: list[pa.RecordBatch] = []
    size = 0

    def spans(rows: pa.Table) -> pa.RecordBatch:
        # a name that only one document has cannot repeat (the bit table lets some pass)
        name = rows.column("name").to_numpy()
        ids = rows.column("doc_id").combine_chunks().fill_null(np.iinfo(np.int64).min).to_numpy()
        first = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]]))
        alone = np.minimum.reduceat(ids, first) == np.maximum.reduceat(ids, first)
        rows = rows.filter(pa.array(np.repeat(~alone, np.diff(np.append(first, len(name))))))
        doc = rows.column("doc_id").combine_chunks()
        ids = doc.fill_null(np.iinfo(np.int64).min).to_numpy()
        row, a, b = mark_repeats(
            rows.column("bytes").to_pylist(), ids, rows.column("start").to_numpy().astype(np.int64), rows.column("name").to_numpy()
        )
        at = pa.array(row)
        return pa.RecordBatch.from_arrays(
            [doc.take(at), rows.column("mark").combine_chunks().take(at), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))],
            names=["doc_id", "mark", "start", "end"],
        )

    for whole in batches:
        for batch in runs(whole, "bytes", GROUP_BYTES):
            held.append(batch)
            size += batch.column("bytes").nbytes
            if size < GROUP_BYTES:
                continue
            rows = pa.Table.from_batches(held)
            name = rows.column("name").to_numpy()
            cut = int(np.searchsorted(name, name[-1]))  # the last group may go on
            if cut:
                yield spans(rows.slice(0, cut))
                held = rows.slice(cut).combine_chunks().to_batches()
                size = sum(b.column("bytes").nbytes for b in held)
    if held:
        rows = pa.Table.from_batches(held)
        if rows.num_rows:
            yield spans(rows)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("mark"), "text")


def repeated_spans(spark: SparkSession, docs: DataFrame, hot: int = HOT, bits: int = BITS, hot_windows: int = HOT_WINDOWS) -> DataFrame:
    """Stored ``doc_id, mark, start, end``: spans (bytes) of texts that a smaller document repeats.

    Spans of a document may overlap; ``mark`` tells texts of one ``doc_id`` apart.
    """
    keyed = _keyed(docs)
    copies = whole_copies(spark, keyed)
    skipped = Skipped(spark, keyed, copies)
    names = map_arrow(keyed.select("mark", "text"), functools.partial(_names, skipped), "name long, n long, windows long")
    names = names.groupBy("name").agg(F.sum("n").alias("n"), F.sum("windows").alias("windows"))
    shared = save(spark, names.filter("n > 1"), "suffix-names")
    table = bit_table(shared, "name", bits)
    out = "name long, doc_id long, mark long, start int, bytes binary"
    if int.from_bytes(table, "little").bit_count() <= bits // 2:
        parts = map_arrow(keyed, functools.partial(_stretches, skipped, table), out)
    else:
        of = map_arrow(keyed, functools.partial(_named, skipped), "doc_id long, mark long, name long").distinct().join(shared.select("name"), "name")
        of = of.groupBy(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).agg(F.collect_list("name").alias("wanted"))
        rows = keyed.join(of, (F.col("mark") == F.col("_mark")) & F.col("doc_id").eqNullSafe(F.col("_id")))
        parts = map_arrow(rows.select("doc_id", "mark", "text", "wanted"), functools.partial(_stretches, skipped, None), out)
    crowded = save(spark, shared.filter((F.col("n") > hot) | (F.col("windows") > hot_windows)).select("name"), "suffix-hot")
    few = parts if crowded.isEmpty() else parts.join(crowded, "name", "left_anti")
    dealt = few.repartition("name").sortWithinPartitions("name")
    spans = map_arrow(dealt, _mark, "doc_id long, mark long, start int, end int")
    if few is not parts:
        at = F.explode(F.sequence(F.lit(1), F.length("bytes") - (LENGTH - 1)))
        cut = parts.join(crowded, "name", "left_semi").select("doc_id", "mark", "start", "bytes", at.alias("at"))
        windows = cut.select(
            "doc_id", "mark", (F.col("start") + F.col("at") - 1).alias("start"), F.substring("bytes", F.col("at"), F.lit(LENGTH)).alias("window")
        )
        ranked = F.struct(F.col("doc_id").isNotNull().alias("r"), "doc_id")
        least = windows.groupBy("window").agg(F.min(ranked).alias("least"))
        later = windows.join(least, "window").filter(ranked > F.col("least"))
        spans = spans.union(later.select("doc_id", "mark", "start", (F.col("start") + LENGTH).cast("int").alias("end")))
    whole = copies.select("doc_id", "mark", F.lit(0).alias("start"), F.col("size").cast("int").alias("end"))
    return save(spark, spans.unionByName(whole), "suffix-spans")


def _join_spans(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching spans."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["start"], s["end"]) for s in spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _cut(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for a, b in spans:
        parts.append(raw[at:a])
        at = b
    return b"".join([*parts, raw[at:]])


def _touched(bits: bytes, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts go on only for documents that may have spans; of others the digest is enough."""
    for batch in batches:
        maybe = has_bit(bits, batch.column("mark").to_numpy())
        raw = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in batch.column("text")]
        digest = [None if m else hashlib.sha256(t).hexdigest() for t, m in zip(raw, maybe, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("mark"),
                pa.array([len(t) for t in raw], pa.int64()),
                pa.array(digest, pa.string()),
                pa.array([t if m else None for t, m in zip(raw, maybe, strict=True)], pa.binary()),
            ],
            names=["doc_id", "mark", "n_bytes", "digest", "raw"],
        )


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = [_join_spans(s or []) for s in batch.column("spans").to_pylist()]
        known, raw = batch.column("digest").to_pylist(), batch.column("raw").to_pylist()
        digest = [k or hashlib.sha256(_cut(t, s)).hexdigest() for k, t, s in zip(known, raw, spans, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("n_bytes"),
                pa.array([sum(b - a for a, b in s) for s in spans], pa.int64()),
                pa.array([len(s) for s in spans], pa.int64()),
                pa.array(digest, pa.string()),
            ],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def _per_document(spans: DataFrame) -> DataFrame:
    per = spans.groupBy(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"))
    return per.agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def removal_digest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of all documents."""
    spans = repeated_spans(spark, docs)
    touched = bit_table(spans.select("mark").distinct(), "mark", DOC_BITS)
    rows = map_arrow(
        _keyed(docs), functools.partial(_touched, touched), "doc_id long, mark long, n_bytes long, digest string, raw binary"
    )
    rows = rows.join(_per_document(spans), (F.col("mark") == F.col("_mark")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    rows = rows.select("doc_id", "n_bytes", "digest", "raw", "spans")
    return map_arrow(rows, _digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = []
        for text, spans in zip(batch.column("text"), batch.column("spans").to_pylist(), strict=True):
            kept.append(None if not text.is_valid else _cut(text.as_buffer().to_pybytes(), _join_spans(spans or [])))
        rest = [n for n in batch.schema.names if n not in ("text", "spans")]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in rest), pa.array(kept, pa.binary())], names=[*rest, "kept"])


def remove_repeats(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``doc_id, kept`` of all documents: the remaining bytes (a span may begin or end inside a code point)."""
    rows = _keyed(docs).join(
        _per_document(repeated_spans(spark, docs)), (F.col("mark") == F.col("_mark")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left"
    )
    out = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("kept", T.BinaryType())])
    return map_arrow(rows.select("doc_id", "text", "spans"), _remove, out)
