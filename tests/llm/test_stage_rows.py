"""Stage functions on clashing column names and on rows alike in id and text; the classifier by hand."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from loglens.llm import decontam, jaccard, mixing, toxicity
from loglens.llm.textkernel import span_hashes
from tests.llm.conftest import prose

CLASHING = ["_id", "_mark", "_n", "_row", "_all", "_copies", "_text", "score", "offending", "spans", "row", "_hash", "mark", "n_words", "a`b.c"]


@pytest.fixture(scope="module")
def some_docs(spark, odd_rows):
    bad = [(200 + k, f"{prose(k, 30)}. You vile{k % 3} wretch filth. {prose(90 + k, 10)}", "en", "a", 0) for k in range(12)]
    return spark.createDataFrame([*odd_rows, *bad], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, int(i >= 200)) for i in [*range(15), *range(200, 212)]]
    return spark.createDataFrame(rows, "doc_id long, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([("b1", prose(6, 90)), ("b2", "Two words"), ("b3", None)], "item_id string, text string")


def stages(spark, labels, benchmark):
    return {
        "keep_one": lambda d: jaccard.keep_one(spark, d),
        "drop_toxic": lambda d: toxicity.drop_toxic(spark, d, labels),
        "drop_contaminated": lambda d: decontam.drop_contaminated(spark, d, benchmark),
        "remove_spans": lambda d: decontam.remove_spans(spark, d, benchmark),
        "mix_documents": lambda d: mixing.mix_documents(spark, d, (3, 1, 2), 1.5, 2),
    }


def listed(df):
    return sorted((repr(tuple(r)) for r in df.collect()))


@pytest.mark.parametrize("name", ["keep_one", "drop_toxic", "drop_contaminated", "remove_spans", "mix_documents"])
def test_any_column_names_pass_a_stage(spark, some_docs, labels, benchmark, name):
    stage = stages(spark, labels, benchmark)[name]
    extra = some_docs.withColumns({c: F.lit(f"own {c}") for c in CLASHING}).withColumn("m", F.create_map(F.lit("k"), F.lit(1)))
    got = stage(extra)
    assert got.columns == extra.columns
    plain = stage(some_docs)
    assert plain.columns == some_docs.columns
    assert listed(got.select(*some_docs.columns)) == listed(plain) != []
    own = ["`" + c.replace("`", "``") + "`" for c in CLASHING]
    assert [tuple(r) for r in got.select(*own).distinct().collect()] == [tuple(f"own {c}" for c in CLASHING)]


@pytest.mark.parametrize("name", ["keep_one", "mix_documents"])
def test_the_same_rows_stay_however_they_are_dealt(spark, labels, benchmark, name):
    text = prose(3, 40)
    rows = [(1, text, "en", "src", k % 37) for k in range(60)] + [(2, text + " more", "de", "src", 5)] * 4 + [(3, prose(8, 50), "fr", "other", k) for k in range(5)]
    seen = set()
    for parts in (1, 3, 11):
        random.Random(parts).shuffle(rows)
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(parts)
        seen.add(tuple(listed(stages(spark, labels, benchmark)[name](docs))))
    assert len(seen) == 1
    kept = next(iter(seen))
    assert len(kept) == 2 if name == "keep_one" else len(set(kept)) > 10


def test_mix_takes_every_row_as_often_as_the_rates_say(spark):
    rows = [(k // 3, prose(k // 9, 20), "en", "ab"[k % 2], k // 5) for k in range(120)] + [(7, "three words here", "x", "a", 1)] * 9
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    items = mixing.size_table(spark, docs)
    mixed = mixing.entropy_mix(spark, items, mixing.source_targets(items, (3, 1), 1.3, 2), 2)
    want = {(r["doc_id"], r["source"]): r["n"] for r in mixed.groupBy("doc_id", "source").agg(F.sum("copies").alias("n")).collect()}
    out = mixing.mix_documents(spark, docs, (3, 1), 1.3, 2)
    got = {(r["doc_id"], r["source"]): r["n"] for r in out.groupBy("doc_id", "source").agg(F.count("*").alias("n")).collect()}
    assert got == {k: n for k, n in want.items() if n}


def test_a_dual_that_does_not_converge_raises(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_NEWTON_STEPS", 1)
    docs = spark.createDataFrame([(k, prose(k, 5 + 13 * k), "en", "ab"[k % 2], 0) for k in range(20)], "doc_id long, text string, lang string, source string, n_chars long")
    with pytest.raises(RuntimeError, match="did not converge"):
        mixing.mix_documents(spark, docs, (3, 1), 1.3, 2)


def test_fit_sample_is_bounded_by_texts_not_rows(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "MAX_TOXIC", 5)
    monkeypatch.setattr(toxicity, "MAX_OTHER", 5)
    counts = []
    real = toxicity.map_arrow

    def counting(df, function, schema):
        if function is toxicity._fit:
            counts.append(df.count())
        return real(df, function, schema)

    monkeypatch.setattr(toxicity, "map_arrow", counting)
    rows = [(1, "the same toxic text")] * 3000 + [(k, f"text {k} of others") for k in range(2, 30)]
    labels = spark.createDataFrame([(k, int(k < 3)) for k in range(1, 30)], "doc_id long, toxic int")
    toxicity.train(spark, spark.createDataFrame(rows, "doc_id long, text string"), labels)
    assert counts == [2 + 5]
    monkeypatch.setattr(toxicity, "MAX_BYTES", 40)
    toxicity.train(spark, spark.createDataFrame(rows, "doc_id long, text string"), labels)
    assert 1 <= counts[1] <= 3


WORD, STOP = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), re.compile(r"[.!?\n]")


def sentences_of(text: str):
    """Spans and lower-case words of all sentences with a word."""
    out = []
    for m in re.finditer(r"[^.!?\n]+", text):
        words = [(m.start() + w.start(), m.start() + w.end(), w.group()) for w in WORD.finditer(m.group())]
        if words:
            out.append((words[0][0], words[-1][1], ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for _, _, w in words]))
    return out


def word_hash(word: str) -> int:
    buf = np.frombuffer(word.encode(), np.uint8)
    return int(span_hashes(buf, np.array([0]), toxicity.GAP)[0])


def test_scores_and_sentences_by_hand(spark, odd_rows):
    texts = [t for _, t, *_ in odd_rows if t and len(t) < 3000] + [
        "Vile ONE! fine words here. vile vile WRETCH? no\nwretch é ü vile-wretch ... ", "...", "vile", "ÀÉ Vile. ok",
    ]
    weights = {"vile": 2.5, "wretch": 1.25, "fine": -3.0, "é": 0.5}
    bias = -2.0
    order = sorted((word_hash(w), x) for w, x in weights.items())
    model = (np.array([h for h, _ in order], np.uint64), np.array([x for _, x in order]), bias)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in toxicity.score(docs, model).collect():
        rest, bad = 1.0, []
        for start, end, words in sentences_of(texts[r["doc_id"]]):
            p = 1 / (1 + math.exp(-(bias + sum(weights.get(w, 0.0) for w in words))))
            rest *= 1 - p
            if p >= toxicity.THRESHOLD:
                bad.append((start, end, p))
        assert r["score"] == pytest.approx(1 - rest, abs=1e-12)
        assert [(s["start"], s["end"]) for s in r["offending"]] == [(a, b) for a, b, _ in bad]
        assert [s["p"] for s in r["offending"]] == pytest.approx([p for _, _, p in bad])


def test_gradient_against_differences():
    r = random.Random(2)
    docs = [[[r.randrange(6) for _ in range(r.randint(0, 4))] for _ in range(r.randint(1, 4))] for _ in range(15)]
    label = np.array([r.random() < 0.5 for _ in docs])
    weight = np.array([r.random() + 0.1 for _ in docs])
    weight /= weight.sum()
    used = [(d, s) for d, doc in enumerate(docs) for s, words in enumerate(doc) if words]
    row = np.array([k for k, (d, s) in enumerate(used) for _ in docs[d][s]])
    col = np.array([w for d, s in used for w in docs[d][s]])
    owner = np.array([d for d, _ in used])
    plain = np.array([sum(1 for words in doc if not words) for doc in docs])

    def loss(theta):
        total = 0.0
        for doc, y, c in zip(docs, label, weight, strict=True):
            rest = 1.0
            for words in doc:
                rest *= 1 - 1 / (1 + math.exp(-(theta[6] + sum(theta[w] for w in words))))
            total -= c * math.log(1 - rest if y else rest)
        return total

    theta = np.array([r.uniform(-1, 1) for _ in range(6)] + [-0.7])
    got = toxicity.gradient(theta[:6], theta[6], col, row, owner, plain, label, weight)
    step = 1e-6
    want = [(loss(theta + step * e) - loss(theta - step * e)) / (2 * step) for e in np.eye(7)]
    assert got == pytest.approx(want, abs=1e-7)
