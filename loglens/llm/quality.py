"""Quality rules per document and per host.

Every document gets counts from its whole text and fails the base rules if it
is too short or too repetitive. The failures are then counted per host
(domain). A host's failure rate is shrunk towards the corpus with a beta prior
whose two parameters are estimated from all hosts by the method of moments, so
that a host with few documents is not judged by them alone; a host whose
shrunk rate reaches ``HOST_LIMIT`` is rejected with all its documents. The
verdicts are joined back to the documents.

Defined results: NULL and empty texts have no words and fail; a NULL host is a
host of its own; an empty input gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import group_key, map_arrow
from .textkernel import BLANK, runs, text_bytes

MIN_WORDS = 10
# Base rule: more than this percentage of the words stands in repeated windows.
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"
# A host is rejected when its shrunk failure rate reaches this share.
HOST_LIMIT = 0.5


def repeated_words(words: list[bytes], k: int = WINDOW) -> int:
    """Words that stand in a window of ``k`` words found twice or more in ``words``."""
    n = len(words) - k + 1
    if n < 2:
        return 0
    seen: set = set()
    twice: set = set()
    grams = list(zip(*(words[j:] for j in range(k)), strict=False))
    seen.update(grams)
    if len(seen) == n:
        return 0
    seen.clear()
    for g in grams:
        (twice if g in seen else seen).add(g)
    covered = end = 0
    for i, g in enumerate(grams):
        if g in twice:
            covered += i + k - max(i, end)
            end = i + k
    return covered


def _flags(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


_SYMBOL = _flags(SYMBOLS)


def _per_text(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """How many ``flags`` are set in each text."""
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[off])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for run in runs(batch):
            buf, off = text_bytes(run.column("text"))
            lead = (buf & 0xC0) != 0x80  # the first byte of a code point
            chars = _per_text(lead & ~BLANK[buf], off)
            symbols = _per_text(_SYMBOL[buf], off)
            raw = buf.tobytes()
            n, again, repeat = ([0] * run.num_rows for _ in range(3))
            for i in range(run.num_rows):
                text = raw[off[i] : off[i + 1]]
                words = text.split()  # bytes are split at ASCII blanks only
                lines = [x for x in text.split(b"\n") if x and not x.isspace()]
                n[i], again[i], repeat[i] = len(words), len(lines) - len(set(lines)), repeated_words(words)
            yield pa.RecordBatch.from_arrays(
                [run.column("doc_id"), run.column("_host"), pa.array(n), *map(pa.array, (chars, symbols)), pa.array(again), pa.array(repeat)],
                names=["doc_id", "_host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"],
            )


def features(docs: DataFrame, host: Column) -> DataFrame:
    """``doc_id, _host`` with the counts of each whole text and ``base_failed``.

    ``n_words``, ``word_chars`` (code points in words), ``n_symbols``,
    ``n_dup_lines`` (lines with a word, equal to an earlier line) and
    ``n_repeat_words`` (words in repeated windows of five words).
    """
    rows = docs.select("doc_id", host.cast("string").alias("_host"), "text")
    out = T.StructType(rows.schema.fields[:2])
    for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"):
        out = out.add(name, T.LongType())
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return map_arrow(rows, _features, out).withColumn("base_failed", failed)


def host_verdicts(documents: DataFrame) -> DataFrame:
    """Per host of ``documents(_host, base_failed)``: ``_key, docs, failures, rate, host_rejected``.

    ``rate`` is the posterior mean ``(failures + a) / (docs + a + b)``. With
    ``m`` and ``v`` the mean and variance of the hosts' raw rates,
    ``a + b = m (1 - m) / v - 1``, at least 1; if all hosts have the same rate
    (or there is one host only), the rates are taken as they are.
    """
    hosts = documents.groupBy(group_key("_host").alias("_key")).agg(
        F.count("*").alias("docs"), F.count_if("base_failed").alias("failures")
    )
    raw = F.col("failures") / F.col("docs")
    # one row: the moments of all hosts
    prior = hosts.agg(F.avg(raw).alias("m"), F.var_pop(raw).alias("v"))
    strength = F.when(F.col("v") > 0, F.greatest(F.lit(1.0), F.col("m") * (1 - F.col("m")) / F.col("v") - 1))
    prior = prior.select(F.struct(F.col("m"), F.coalesce(strength, F.lit(0.0)).alias("s")).alias("prior"))
    rated = hosts.withColumn("_prior", prior.scalar())
    m, s = F.col("_prior.m"), F.col("_prior.s")
    rate = (F.col("failures") + m * s) / (F.col("docs") + s)
    return rated.withColumn("rate", rate).select(
        "_key", "docs", "failures", "rate", (F.col("rate") >= HOST_LIMIT).alias("host_rejected")
    )


def judge(documents: DataFrame) -> DataFrame:
    """``documents`` (from :func:`features`, stored) with the host's figures and ``kept``."""
    hosts = host_verdicts(documents)
    joined = documents.withColumn("_key", group_key("_host")).join(hosts, "_key").drop("_key")
    return joined.withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))
