"""Importance resampling of documents towards a target distribution.

A text's features are all runs of 1 to ``n`` consecutive words, hashed into
``buckets`` buckets. How much more often a bucket occurs in the target texts
than in the documents gives it a gain; a document's weight is the sum of its
features' gains, and the documents with the highest weight plus Gumbel noise
are drawn (sampling without replacement in proportion to ``exp(weight)``).

Words are found bytewise: one 256-byte table lower-cases A-Z and blanks every
other ASCII byte that is neither letter nor digit, and ``bytes.split`` yields
the words (bytes of 0x80 and above only occur inside UTF-8 characters that belong to
words). A feature's bucket is its crc32 modulo ``buckets``; the crc32 of a run of k words
continues that of its first k - 1 words, so no run is put together as text.
``Counter``s reduce the codes inside a task, Spark adds up the tasks' tables
(``buckets`` rows each at most), and the driver only sees ``buckets`` sums.

Gains and noise are integers (thousandths, rounded down), so that sums do not
depend on their order. The noise of a document is a hash of the seed and its id.

Defined results: texts without words (NULL, empty) have no features and weight
0 and are never drawn, as ``min_words`` is at least 1; the id NULL is hashed as
empty text and orders before all others; rows alike in id and text have equal
scores, and any of them comes first; other columns, whatever their names, only
pass through :func:`resample`; empty tables give empty results.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow, save, whole_row

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
# Texts are split into words in pieces of about this many bytes.
PIECE_BYTES = 1 << 20
# Codes whose gains a task remembers at a time.
KNOWN_CODES = 1 << 18

FOLD = bytes(ord(chr(c).lower()) if c < 128 and chr(c).isalnum() else c if c >= 128 else 32 for c in range(256))


def word_pieces(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in lists of bounded size (a word is never split)."""
    at = 0
    while at < len(raw):
        to = at + PIECE_BYTES
        piece = raw[at:to].translate(FOLD)
        if to < len(raw):
            blank = piece.rfind(b" ", 1)
            while blank < 0 and to < len(raw):  # one word longer than a piece
                more = raw[to : to + PIECE_BYTES].translate(FOLD)
                blank = more.find(b" ")
                blank = len(piece) + blank if blank >= 0 else -1
                piece, to = piece + more, to + PIECE_BYTES
            if blank >= 0:
                piece, to = piece[:blank], at + blank
        yield piece.split()
        at = to


def run_codes(words: list[bytes], n: int, old: int = 0) -> list[int]:
    """crc32 of all runs of 1 to ``n`` words that end after the first ``old`` words."""
    codes = list(map(crc32, words))
    out = codes[old:]
    if n > 1:
        spaced = [b" " + w for w in words]
        for k in range(1, n):
            codes = list(map(crc32, spaced[k:], codes))
            out += codes[max(0, old - k) :]
    return out


def text_codes(raw: bytes | None, n: int) -> Iterator[tuple[int, list[int]]]:
    """Per piece of a text: how many words it has, and the codes of its features."""
    held: list[bytes] = []
    for words in word_pieces(raw or b""):
        yield len(words), run_codes(held + words, n, len(held))
        held = (held + words)[-(n - 1) :] if n > 1 else []


def _raw(text: pa.Scalar) -> bytes | None:
    return text.as_buffer().to_pybytes() if text.is_valid else None


def _count(n: int, buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = [0] * buckets
    for batch in batches:
        codes: Counter[int] = Counter()
        for text in batch.column("text"):
            for _, found in text_codes(_raw(text), n):
                codes.update(found)
                if len(codes) > KNOWN_CODES:
                    _fold(codes, total)
        _fold(codes, total)
    used = [b for b in range(buckets) if total[b]]
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([total[b] for b in used], pa.int64())], names=["bucket", "n"])


def _fold(codes: Counter, total: list[int]) -> None:
    for code, n in codes.items():
        total[code % len(total)] += n
    codes.clear()


def bucket_counts(docs: DataFrame, n: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n``: features of all texts per bucket."""
    parts = map_arrow(docs.select("text"), functools.partial(_count, n, buckets), "bucket int, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """Per bucket the log ratio of its smoothed shares in target and source, in thousandths rounded down."""
    s, t = float(sum(source.values()) + buckets), float(sum(target.values()) + buckets)
    share = ((target.get(b, 0) + 1.0) * s / ((source.get(b, 0) + 1.0) * t) for b in range(buckets))
    return [math.floor(1000 * math.log(x)) for x in share]


def learn_gains(docs: DataFrame, target: DataFrame, n: int = 1, buckets: int = BUCKETS) -> list[int]:
    """The gains of all buckets, from all texts of both tables (``buckets`` sums each reach the driver)."""
    counts = ({r["bucket"]: r["n"] for r in bucket_counts(x, n, buckets).collect()} for x in (docs, target))
    return bucket_gains(*counts, buckets)


class _Gains(dict):
    """Gains by code."""

    def __init__(self, gains: list[int]):
        self.gains = gains

    def __missing__(self, code: int) -> int:
        if len(self) >= KNOWN_CODES:
            self.clear()
        gain = self[code] = self.gains[code % len(self.gains)]
        return gain


def _weigh(n: int, gains: list[int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = _Gains(gains)
    for batch in batches:
        n_words, n_features, weight = [], [], []
        for text in batch.column("text"):
            w = f = g = 0
            for words, codes in text_codes(_raw(text), n):
                w, f, g = w + words, f + len(codes), g + sum(map(known.__getitem__, codes))
            n_words.append(w)
            n_features.append(f)
            weight.append(g)
        kept = [c for c in batch.schema.names if c != "text"]
        found = [pa.array(x, pa.int64()) for x in (n_words, n_features, weight)]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *found], names=[*kept, "n_words", "n_features", "weight"])


def noise(doc_id: str | Column = "doc_id", seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, rounded down, from a hash of ``seed`` and the id."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(c.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.left(digest, F.lit(8)), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0))))


def score(spark: SparkSession, docs: DataFrame, gains: list[int], n: int = 1, seed: int = SEED, rows: bool = False) -> DataFrame:
    """Stored ``doc_id, n_words, n_features, weight, score, place`` of all documents.

    ``place`` is a number of the row, for ties; with ``rows``, ``row`` holds all columns of ``docs``.
    """
    whole = [whole_row(docs)] if rows else []
    given = docs.select("doc_id", "text", *whole)
    out = T.StructType([f for f in given.schema if f.name != "text"])
    for name in ("n_words", "n_features", "weight"):
        out = out.add(name, T.LongType())
    weighed = map_arrow(given, functools.partial(_weigh, n, gains), out)
    scored = weighed.withColumns({"score": F.col("weight") + noise(seed=seed), "place": F.monotonically_increasing_id()})
    return save(spark, scored, "resampling-scores")


def rank(spark: SparkSession, scored: DataFrame, min_words: int = MIN_WORDS, percent: int = PERCENT) -> tuple[DataFrame, int]:
    """The documents of ``min_words`` words or more with ``rank`` (1, 2, ... from the
    highest score, ties to the smaller id), and how many of them are drawn (``percent`` of all).

    Rows are dealt by ranges of (score, id, place), so equal scores may be split,
    and numbered inside each range; only the ranges' sizes go to the driver.
    """
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("place")]
    narrow = scored.drop("row").filter(F.col("n_words") >= max(1, min_words))
    dealt = narrow.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = dealt.withColumns({"slice": F.spark_partition_id(), "at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    dealt = save(spark, dealt, "resampling-ranges")
    sizes = sorted((r["slice"], r["n"]) for r in dealt.groupBy("slice").agg(F.count("*").alias("n")).collect())
    before, total = [], 0
    for part, n in sizes:
        before.append((part, total))
        total += n
    offsets = F.broadcast(spark.createDataFrame(before, "slice int, before long"))  # one row per range
    ranked = dealt.join(offsets, "slice").withColumn("rank", F.col("before") + F.col("at") + 1)
    return ranked.drop("slice", "at", "before"), percent * total // 100


def draw(spark: SparkSession, scored: DataFrame, min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """All documents of ``scored`` with ``rank``, NULL for those not drawn."""
    ranked, drawn = rank(spark, scored, min_words, percent)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    short = scored.drop("row").filter(F.col("n_words") < max(1, min_words))
    return ranked.unionByName(short.withColumn("rank", F.lit(None).cast("long")))


def resample(
    spark: SparkSession,
    docs: DataFrame,
    target: DataFrame,
    n: int = 1,
    buckets: int = BUCKETS,
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """The drawn rows of ``docs``, with all their columns: those up to the last drawn one in rank order."""
    scored = score(spark, docs, learn_gains(docs, target, n, buckets), n, seed, rows=True)
    ranked, drawn = rank(spark, scored, min_words, percent)
    last = ranked.filter(F.col("rank") == drawn).select("score", "doc_id", "place").first()  # one row
    if last is None:
        return docs.limit(0)
    same, lower = F.col("doc_id").eqNullSafe(F.lit(last["doc_id"])), F.col("doc_id") < F.lit(last["doc_id"])
    lower = F.coalesce(lower | F.col("doc_id").isNull(), F.lit(False)) if last["doc_id"] is not None else F.lit(False)
    tie = (F.col("score") == last["score"]) & (lower | (same & (F.col("place") <= last["place"])))
    chosen = scored.filter((F.col("n_words") >= max(1, min_words)) & ((F.col("score") > last["score"]) | tie))
    return chosen.select("row.*")
