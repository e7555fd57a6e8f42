"""Benchmark decontamination with built-in functions only.

Texts are normalised (A-Z in lower case) and cut into words of ASCII letters,
digits and non-ASCII characters. Every ten consecutive words of a benchmark item
form a window; an item of fewer words (but not none) is one window. The set of
windows is broadcast as a hash table under one anchor word per window (its
longest, likely its rarest). The words of all documents are scanned against the
table in one pass, inside one code-generated stage; wherever an anchor occurs,
the window around it is compared word for word, so every hit is verified.

At most ``BROADCAST_BYTES`` of windows are broadcast at a time. A larger set is
dealt by hash into slices of that size, and the documents are scanned once for
each; no word of a document is shuffled, however large the benchmark is. Nothing
is emitted for a word that hits nothing.

Defined results: NULL and empty texts have no words; an item without words has no
window and a NULL ``item_id`` adds hits but is not listed; repeated documents
are reported one by one; an empty benchmark leaves every document clean.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, save, whole_row

WINDOW = 10
# Characters between words, after lowering A-Z; and in the text as it is.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BROADCAST_BYTES = 64 << 20


def _lower(text: str) -> Column:
    c = F.coalesce(F.col(text), F.lit(""))
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(ascii_lower(c))


def _split(text: str) -> Column:
    """The words from place 1 on; place 0 is always empty, and the last place may be."""
    return F.split(F.concat(F.lit(" "), _lower(text)), SEPARATORS)


def _with_words(df: DataFrame) -> DataFrame:
    """Adds ``_w`` (see :func:`_split`) and ``n_words``."""
    blank_end = F.when(F.element_at("_w", -1) == "", 1).otherwise(0)
    n = F.when(F.size("_w") > 1, F.size("_w") - 1 - blank_end).otherwise(0)
    return df.withColumn("_w", _split("text")).withColumn("n_words", n.cast("long"))


def windows(benchmark: DataFrame) -> DataFrame:
    """``item_id, window, k`` of every window of every item (words joined by blanks)."""
    items = _with_words(benchmark.select("item_id", "text")).filter("n_words > 0")
    k = F.least(F.col("n_words"), F.lit(WINDOW)).cast("int")
    starts = F.explode(F.sequence(F.lit(2), (F.col("n_words") - k + 2).cast("int")))
    cut = items.withColumn("k", k).withColumn("_at", starts)
    return cut.select("item_id", F.array_join(F.slice("_w", F.col("_at"), F.col("k")), " ").alias("window"), "k").distinct()


def find_hits(spark: SparkSession, docs: DataFrame, found: DataFrame) -> DataFrame:
    """Stored table ``doc_id, mark, n_words, start, k, window``: one row per occurrence of a window
    (``start`` counts words from 0), and per document one row with ``start = -1``.

    ``found`` are the windows (:func:`windows`); ``mark`` is a hash that tells
    documents of one ``doc_id`` apart.
    """
    table = found.select("window", "k").distinct()
    words = F.split("window", " ")
    # (length, hash, place) of the longest word; any fixed choice would do
    ranked = F.transform(words, lambda w, i: F.struct(F.length(w).alias("n"), F.xxhash64(w).alias("h"), i.alias("i")))
    place = F.array_max(ranked)["i"]
    anchors = table.select(F.element_at(words, place + 1).alias("_anchor"), place.alias("_offset"), "window", "k")
    # place 0 of every document is an empty word: it meets this row and stands for the document
    head = spark.range(1).select(
        F.lit("").alias("_anchor"), F.lit(0).alias("_offset"), F.lit(None).cast("string").alias("window"), F.lit(0).alias("k")
    )
    size = table.agg(F.sum(F.octet_length("window") + 64)).first()[0] or 0
    slices = max(1, -(-size // BROADCAST_BYTES))
    keyed = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("mark"), "text")
    scan = _with_words(keyed).select("doc_id", "mark", "n_words", "_w", F.posexplode("_w").alias("_at", "_word"))
    start = F.col("_at") - F.col("_offset")
    same = (start >= 1) & (F.array_join(F.slice("_w", F.greatest(start, F.lit(1)) + 1, F.col("k")), " ") == F.col("window"))
    match = (F.col("_word") == F.col("_anchor")) & F.when(F.col("k") == 0, F.col("_at") == 0).otherwise(same)
    parts = []
    for i in range(slices):
        # one slice at a time, so that a task never holds more than one
        some = anchors if slices == 1 else anchors.filter(F.pmod(F.xxhash64("window"), F.lit(slices)) == i)
        some = F.broadcast(some if i else some.union(head))
        hits = scan.join(some, match).select(
            "doc_id", "mark", "n_words", F.when(F.col("k") == 0, -1).otherwise(start - 1).alias("start"), "k", "window"
        )
        parts.append(save(spark, hits, "decontam-hits"))
    return functools.reduce(DataFrame.union, parts)


def _covered(spans: Column) -> Column:
    """Number of words inside the sorted spans ``(start, k)``."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))

    def step(acc: Column, s: Column) -> Column:
        end = s["start"] + s["k"]
        more = F.greatest(F.lit(0), end - F.greatest(acc["end"], s["start"]))
        return F.struct((acc["n"] + more).alias("n"), F.greatest(acc["end"], end).alias("end"))

    return F.aggregate(spans, zero, step, lambda acc: acc["n"])


def hit_documents(hits: DataFrame) -> DataFrame:
    """``doc_id, mark, n_words, copies, spans, n_hit`` of all documents, from :func:`find_hits`."""
    span = F.when(F.col("start") >= 0, F.struct("start", "k"))
    per = hits.groupBy("doc_id", "mark", "n_words").agg(
        F.count_if(F.col("start") < 0).alias("copies"), F.array_sort(F.collect_set(span)).alias("spans")
    )
    return per.withColumn("n_hit", _covered(F.col("spans")))


def contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, mark, n_words, spans, n_hit, items, contaminated`` per document (a row each)."""
    found = save(spark, windows(benchmark), "decontam-windows")
    hits = find_hits(spark, docs, found)
    listed = (
        hits.filter("start >= 0")
        .select(F.xxhash64("doc_id").alias("_id"), "mark", "window")
        .distinct()
        .join(found.filter("item_id IS NOT NULL").select("window", "item_id"), "window")
        .groupBy("_id", "mark")
        .agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    )
    per = hit_documents(hits).withColumn("_id", F.xxhash64("doc_id")).join(listed, ["_id", "mark"], "left")
    none = F.array().cast("array<string>")
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return per.select(
        "doc_id",
        "mark",
        "n_words",
        "spans",
        "n_hit",
        F.coalesce("items", none).alias("items"),
        (F.col("n_hit") > 0).alias("contaminated"),
        each.alias("_n"),
    ).drop("_n")


def _dirty(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    hits = find_hits(spark, docs, save(spark, windows(benchmark), "decontam-windows"))
    dirty = hit_documents(hits).filter("n_hit > 0")
    return dirty.select(F.xxhash64("doc_id").alias("_id"), F.col("mark").alias("_mark"), "spans")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(whole_row(docs), F.xxhash64("doc_id").alias("_id"), F.xxhash64("doc_id", "text").alias("_mark"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window; other columns may have any names."""
    return _keyed(docs).join(_dirty(spark, docs, benchmark), ["_id", "_mark"], "left_anti").select("row.*")


def remove_spans(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with the hit words (and the separators before them) cut from the texts; other columns may have any names."""
    joined = _keyed(docs).join(_dirty(spark, docs, benchmark), ["_id", "_mark"], "left")
    text = F.col("row.text")
    between = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
    parts = F.regexp_extract_all(text, F.lit(f"[{between}]*[^{between}]+"), F.lit(0))
    tail = F.regexp_extract(text, f"[{between}]*$", 0)
    hit = lambda i: F.exists("spans", lambda s: (s["start"] <= i) & (i < s["start"] + s["k"]))
    cut = F.concat(F.array_join(F.filter(parts, lambda p, i: ~hit(i)), ""), tail)
    changed = F.when(F.col("spans").isNotNull(), cut).otherwise(text)
    return joined.select(F.col("row").withField("text", changed).alias("row")).select("row.*")
