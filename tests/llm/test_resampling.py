"""Importance resampling against counting words by regular expression."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from loglens.llm import resampling
from tests.llm.conftest import prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def features_of(text, n):
    words = words_of(text)
    return [" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def brute(rows, target, n, buckets, min_words, percent, seed):
    code = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(code(f) for r in rows for f in features_of(r[1], n))
    t = Counter(code(f) for r in target for f in features_of(r[1], n))
    ns, nt = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * ns / ((s[b] + 1) * nt))) for b in range(buckets)}
    out = []
    for r in rows:
        found = features_of(r[1], n)
        weight = sum(gain[code(f)] for f in found)
        h = int(hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([r[0], len(found), weight, weight + noise, len(words_of(r[1])), None])
    long = sorted((x for x in out if x[4] >= min_words), key=lambda x: (-x[3], x[0] is not None, x[0] or 0))
    for k, x in enumerate(long[: percent * len(long) // 100]):
        x[5] = k + 1
    return out


@pytest.fixture
def given_rows(odd_rows):
    rows = [r[:2] for r in odd_rows]
    return rows + [(100 + k, prose(k, 15 + k) + " Mixed CASE\x1cA_b-c\x7fÀÉ 日本 9x") for k in range(40)]


@pytest.mark.parametrize(("n", "buckets", "min_words", "percent"), [(1, 10_000, 20, 10), (2, 97, 1, 50), (3, 1000, 20, 100)])
def test_scores_and_ranks_against_brute_force(spark, given_rows, n, buckets, min_words, percent):
    docs = spark.createDataFrame(given_rows, "doc_id long, text string").repartition(5)
    target = [(k, prose(20 + k, 40)) for k in range(6)] + [(None, None), (9, "")]
    gains = resampling.learn_gains(docs, spark.createDataFrame(target, "item_id long, text string"), n, buckets)
    got = resampling.draw(spark, resampling.score(spark, docs, gains, n, 7), min_words, percent)
    want = brute(given_rows, target, n, buckets, min_words, percent, 7)
    have = [[r["doc_id"], r["n_features"], r["weight"], r["score"], r["n_words"], r["rank"]] for r in got.collect()]
    assert sorted(map(repr, have)) == sorted(map(repr, want))


def test_ranks_run_through_ranges(spark):
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(k // 2, "the same words " * 10) for k in range(2000)]
        target = spark.createDataFrame([("same",)], "text string")
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
        got = resampling.draw(spark, resampling.score(spark, docs, resampling.learn_gains(docs, target)), percent=75).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    ranked = sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])
    assert len(got) == 2000 and [r["rank"] for r in ranked] == list(range(1, 1501))
    keys = [(-r["score"], r["doc_id"]) for r in ranked]
    assert keys == sorted(keys)


def test_resample_returns_whole_rows(spark, given_rows):
    names = "doc_id long, text string, row string, place long, score string, weight int, before long, slice string"
    rows = [(*r, "r", 1, "s", 2, 3, "t") for r in given_rows]
    docs = spark.createDataFrame(rows, names).repartition(3)
    target = spark.createDataFrame([(1, prose(30, 50))], "item_id long, text string")
    drawn = resampling.resample(spark, docs, target, percent=30, min_words=20)
    want = [tuple(r[:1]) for r in brute(given_rows, [(1, prose(30, 50))], 1, 10_000, 20, 30, 2024) if r[5]]
    assert drawn.columns == docs.columns
    got = drawn.collect()
    assert sorted(repr((r[0],)) for r in got) == sorted(map(repr, want))
    assert all(tuple(r) in rows for r in got)
    # none to draw, nothing to learn from
    assert resampling.resample(spark, docs, target, min_words=10**6).collect() == []
    assert resampling.resample(spark, docs.limit(0), target).collect() == []
    assert resampling.resample(spark, docs, target.limit(0), percent=100, min_words=1).count() == sum(1 for r in given_rows if words_of(r[1]))


@pytest.mark.parametrize("piece", [1, 7, 64])
def test_words_in_pieces(monkeypatch, piece):
    monkeypatch.setattr(resampling, "PIECE_BYTES", piece)
    for text in ["", " ", "one", " one two  three-four ÀÉÎ" * 9, "x" * 300 + " y " + "z" * 500, prose(8, 200), " " + "q" * 80]:
        raw = text.encode()
        assert [w.decode() for ws in resampling.word_pieces(raw) for w in ws] == words_of(text)
        for n in (1, 2, 4):
            codes = [c for _, found in resampling.text_codes(raw, n) for c in found]
            assert sorted(codes) == sorted(zlib.crc32(f.encode()) for f in features_of(text, n))
