"""Toxicity by multiple-instance learning.

Only documents are labelled, but what is toxic is a sentence. A sentence has
the probability ``p = sigmoid(bias + sum of its words' weights)`` and a document is
toxic if one of its sentences is: ``1 - product(1 - p)`` (noisy-or). Weights and
bias are fitted to the document labels by proximal gradient steps with an L1
penalty: once a sentence explains a toxic document, the document's other words
get no weight. The same sentence probabilities then locate the offending ones.

The classifier is fitted on a bounded sample of labelled documents: the
``MAX_TOXIC`` and ``MAX_OTHER`` texts of either label whose ids hash lowest (all texts
of a smaller table), weighted back to the table's proportion, up to ``MAX_BYTES`` of
text. Equal texts of one id count once, so the fitting task's size does not depend on
repeated ids. The vocabulary has at most ``MAX_WORDS`` words. Scoring takes
every sentence of every text. Inputs of a score are the words of the text only.

Defined results: texts without words (NULL, empty) score 0; rows with a NULL
label or id are not learnt from; without labels of both kinds every score is 0;
repeated rows score alike.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow, save, whole_row
from .textkernel import LOWER, runs, span_hashes, text_bytes, word_spans

# The bounds of the sample that the classifier is fitted on: rows of either label, and bytes of text.
MAX_TOXIC = 6144
MAX_OTHER = 6144
MAX_BYTES = 128 << 20
# Words that the classifier may use: the most telling ones of the sample, in MIN_DOCS of its documents at least.
MAX_WORDS = 4096
MIN_DOCS = 4
STEPS = 400
L1 = 1e-5
THRESHOLD = 0.3

# Words are runs of ASCII letters, digits and non-ASCII bytes.
GAP = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
STOP = np.isin(np.arange(256), list(b".!?\n"))


class Words:
    """The words of many texts: hash, text and sentence of each; sentences are numbered through."""

    def __init__(self, column: pa.Array):
        raw, self.off = text_bytes(column)
        low = LOWER[raw]
        self.raw = raw
        self.starts, self.ends, first = word_spans(low, self.off, GAP)
        self.hash = span_hashes(low, self.starts, GAP)
        self.text = np.repeat(np.arange(len(self.off) - 1), np.diff(first))
        # a sentence is a run of words of one text with no stop between
        stops = np.concatenate([[0], np.cumsum(STOP[low])])
        new = np.ones(len(self.starts), bool)
        if len(new):
            new[1:] = (np.diff(stops[self.starts]) > 0) | (np.diff(self.text) > 0)
        self.sentence = np.cumsum(new) - 1
        self.heads = np.flatnonzero(new)
        self.sentence_text = self.text[self.heads]


def _log_rest(z: np.ndarray) -> np.ndarray:
    """``log(1 - sigmoid(z))``."""
    return -np.logaddexp(0, z)


def gradient(
    w: np.ndarray, bias: float, col: np.ndarray, row: np.ndarray, owner: np.ndarray, plain: np.ndarray, label: np.ndarray, weight: np.ndarray
) -> np.ndarray:
    """Derivative of the weighted negative log-likelihood by every word's weight and, last, the bias.

    Word ``col[i]`` stands in sentence ``row[i]``, which belongs to document ``owner[row[i]]``;
    ``plain`` counts each document's sentences without any such word.
    """
    n = len(label)
    z = bias + np.bincount(row, weights=w[col], minlength=len(owner))
    rest = np.bincount(owner, weights=_log_rest(z), minlength=n) + plain * _log_rest(np.array(bias))
    q = np.exp(rest)
    pull = weight * np.where(label, -q / np.maximum(1 - q, 1e-9), 1.0)
    p = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
    dz = pull[owner] * p
    return np.append(np.bincount(col, weights=dz[row], minlength=len(w)), dz.sum() + (pull * plain).sum() / (1 + np.exp(-bias)))


def fit(words: list[tuple[np.ndarray, np.ndarray]], sentences: np.ndarray, label: np.ndarray, weight: np.ndarray):
    """Word hashes with weights, and the bias.

    ``words``: per document the hashes and sentence numbers (from 0) of its words;
    ``sentences``: how many sentences each has.
    """
    if not len(label) or label.all() or not label.any():
        return np.empty(0, np.uint64), np.empty(0), -np.inf
    base = np.concatenate([[0], np.cumsum(sentences)])
    # G-test of every word's document frequency against the label
    own = [np.unique(h) for h, _ in words]
    vocab, index = np.unique(np.concatenate(own), return_inverse=True)
    toxic = np.repeat(label, [len(h) for h in own])
    pos = np.bincount(index, weights=toxic, minlength=len(vocab))
    both = np.bincount(index, minlength=len(vocab)).astype(float)
    del own, index, toxic
    share = label.mean()

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / expected), 0.0)

    telling = part(pos, both * share) + part(both - pos, both * (1 - share))
    telling[both < MIN_DOCS] = 0
    best = np.sort(np.argsort(-telling, kind="stable")[:MAX_WORDS])
    best = best[telling[best] > 0]
    known = vocab[best]
    cols, rows = [], []
    for i, (h, s) in enumerate(words):
        place = np.minimum(np.searchsorted(known, h), max(0, len(known) - 1))
        use = np.flatnonzero(known[place] == h) if len(known) else np.empty(0, np.int64)
        cols.append(place[use].astype(np.int32))
        rows.append(s[use] + base[i])
    col, row = np.concatenate(cols), np.concatenate(rows)
    # sentences without a used word are all alike: keep how many each document has
    active, row = np.unique(row, return_inverse=True)
    owner = np.searchsorted(base, active, "right") - 1
    plain = sentences - np.bincount(owner, minlength=len(words))
    w, bias = np.zeros(len(best)), float(np.log(max(share, 1e-6) / max(1.0, sentences.mean())))
    first, second = np.zeros(len(best) + 1), np.zeros(len(best) + 1)
    weight = weight / weight.sum()
    for step in range(1, STEPS + 1):
        grad = gradient(w, bias, col, row, owner, plain, label, weight)
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad**2
        rate = 0.15 / (np.sqrt(second / (1 - 0.99**step)) + 1e-5)
        move = rate * first / (1 - 0.9**step)
        w = w - move[:-1]
        bias -= float(move[-1])
        w = np.sign(w) * np.maximum(np.abs(w) - rate[:-1] * L1, 0)
    return known[w != 0], w[w != 0], bias


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words: list[tuple] = []
    sentences, label, weight, mark = [], [], [], []
    for batch in batches:
        for run in runs(batch):
            found = Words(run.column("text"))
            first = np.searchsorted(found.text, np.arange(run.num_rows + 1))
            for i in range(run.num_rows):
                own = slice(first[i], first[i + 1])
                s = found.sentence[own]
                # copies: a slice would keep the arrays of the whole run
                words.append((found.hash[own].copy(), (s - s[0] if len(s) else s).astype(np.int32)))
                sentences.append(int(s[-1] - s[0]) + 1 if len(s) else 0)
            label += run.column("toxic").to_pylist()
            weight += run.column("weight").to_pylist()
            mark += run.column("mark").to_pylist()
    # the order of arrival must not matter, and equal texts count once
    order = sorted({(m, y): i for i, (m, y) in enumerate(zip(mark, label, strict=True))}.values(), key=lambda i: (mark[i], label[i]))
    h, w, bias = fit(
        [words[i] for i in order],
        np.array([sentences[i] for i in order], np.int64),
        np.array([label[i] for i in order], bool),
        np.array([weight[i] for i in order], float),
    )
    yield pa.RecordBatch.from_arrays(
        [pa.array([None, *h.view(np.int64).tolist()], pa.int64()), pa.array([float(bias), *w.tolist()])], names=["word", "weight"]
    )


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
    """The classifier (word hashes, weights, bias) from ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    known = known.dropDuplicates(["doc_id", "toxic"])
    mark = F.xxhash64("text").alias("mark")
    # one row per text of an id, however often it stands there; no text is moved yet
    given = docs.select("doc_id", mark, F.coalesce(F.octet_length("text"), F.lit(0)).alias("bytes")).dropDuplicates(["doc_id", "mark"])
    given = save(spark, given.join(known, "doc_id"), "toxic-known")
    totals = {r["toxic"]: r["n"] for r in given.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    parts = [
        given.filter(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id", "mark").limit(most)
        .withColumn("weight", F.lit(max(1.0, totals.get(y, 0) / most)))
        for y, most in ((1, MAX_TOXIC), (0, MAX_OTHER))
    ]
    # at most MAX_TOXIC + MAX_OTHER rows, so one task may add up their bytes
    upto = W.orderBy(F.xxhash64("doc_id", "mark"), "doc_id", "mark").rowsBetween(W.unboundedPreceding, W.currentRow)
    sample = parts[0].union(parts[1]).withColumn("upto", F.sum("bytes").over(upto)).filter(F.col("upto") <= MAX_BYTES)
    sample = save(spark, sample.select("doc_id", "mark", "toxic", "weight"), "toxic-sample")
    texts = docs.select("doc_id", mark, "text").join(F.broadcast(sample), ["doc_id", "mark"])
    texts = texts.dropDuplicates(["doc_id", "mark", "toxic"]).select("text", "toxic", "weight", "mark").repartition(1)
    rows = map_arrow(texts, _fit, "word long, weight double").collect()  # at most MAX_WORDS + 1
    bias = next((r["weight"] for r in rows if r["word"] is None), -np.inf)
    pairs = sorted((np.uint64(r["word"] % (1 << 64)), r["weight"]) for r in rows if r["word"] is not None)
    return np.array([h for h, _ in pairs], np.uint64), np.array([w for _, w in pairs], float), float(bias)


def _score(model: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    vocab, weights, bias = model
    for batch in batches:
        for run in runs(batch):
            n = run.num_rows
            found = Words(run.column("text"))
            z = np.full(len(found.heads), bias)
            if len(vocab):
                place = np.minimum(np.searchsorted(vocab, found.hash), len(vocab) - 1)
                known = np.flatnonzero(vocab[place] == found.hash)
                z += np.bincount(found.sentence[known], weights=weights[place[known]], minlength=len(z))
            rest = np.bincount(found.sentence_text, weights=_log_rest(z), minlength=n) if len(z) else np.zeros(n)
            # sentences that are toxic by themselves, as code point spans
            bad = np.flatnonzero(1 / (1 + np.exp(-np.clip(z, -50, 50))) >= THRESHOLD)
            spans: list[list] = [[] for _ in range(n)]
            if len(bad):
                chars = np.concatenate([[0], np.cumsum((found.raw & 0xC0) != 0x80)])
                tails = np.append(found.heads[1:], len(found.starts)) - 1
                for s in bad.tolist():
                    t = int(found.sentence_text[s])
                    zero = chars[found.off[t]]
                    spans[t].append(
                        {
                            "start": int(chars[found.starts[found.heads[s]]] - zero),
                            "end": int(chars[found.ends[tails[s]]] - zero),
                            "p": float(1 / (1 + np.exp(-z[s]))),
                        }
                    )
            kept = [run.column(i) for i, name in enumerate(run.schema.names) if name != "text"]
            names = [name for name in run.schema.names if name != "text"]
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(np.clip(-np.expm1(rest), 0.0, 1.0)), pa.array(spans, span)], names=[*names, "score", "offending"]
            )


def score(docs: DataFrame, model: tuple) -> DataFrame:
    """``docs`` without its text, with ``score`` and ``offending`` (sentences that are toxic by
    themselves: ``start``, ``end`` in code points, and ``p``)."""
    spans = T.ArrayType(
        T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("p", T.DoubleType())])
    )
    out = T.StructType([f for f in docs.schema.fields if f.name != "text"])
    return map_arrow(docs, functools.partial(_score, model), out.add("score", T.DoubleType()).add("offending", spans))


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Documents kept out of the training: crc32 of the id as text leaves 2 modulo 4."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def drop_toxic(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents that score ``THRESHOLD`` or more; columns may have any names."""
    model = train(spark, docs, labels.filter(~held_out()))
    rows = docs.select(whole_row(docs), F.col("text"))
    return score(rows, model).filter(F.col("score") < THRESHOLD).select("row.*")
