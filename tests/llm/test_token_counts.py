"""Section attribution against a byte-by-byte version."""

from __future__ import annotations

import public_tokenizers as P
import pytest

from loglens.llm import token_counts as tc

VOCAB = P.path("byte_bpe_50k.tiktoken")


def brute(text, sections, rule):
    """``section -> tokens`` by looking at every byte of every token."""
    enc, size = tc._encoder(VOCAB, P.PATTERN)
    raw = (text or "").encode()
    owner = [-1] * len(raw)
    byte = [len((text or "")[:i].encode()) for i in range(len(text or "") + 1)]
    for k, (a, b) in enumerate(sections):
        for i in range(byte[a], byte[b]):
            owner[i] = k
    out, at = {k: 0 for k in range(len(sections))}, 0
    for t in enc.encode_ordinary(text or ""):
        own = owner[at : at + int(size[t])]
        at += int(size[t])
        if rule == "first":
            k = own[0]
        elif rule == "last":
            k = own[-1]
        else:
            inside = [(-own.count(k), k) for k in set(own) if k >= 0]
            n, k = min(inside, default=(0, -1))
            k = k if -n >= own.count(-1) and n else -1
        out[k] = out.get(k, 0) + 1
    return out


@pytest.mark.parametrize("rule", tc.RULES)
def test_given_sections(spark, rule):
    texts = {
        1: ("Hello wörld, this is   it.\n\nNext línes 日本語 tail", [(0, 3), (3, 8), (8, 20), (30, 41)]),
        2: ("unbelievable internationalization", [(0, 2), (2, 13), (13, 13), (14, 33)]),
        3: ("", []),
        4: (None, []),
        5: ("no sections here", []),
        6: ("    spaces    and\ttabs", [(5, 16)]),
    }
    rows = [(i, t, [{"start": a, "end": b} for a, b in s], "x") for i, (t, s) in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sections array<struct<start:int,end:int>>, n_tokens string")
    got: dict = {}
    for r in tc.section_tokens(docs, VOCAB, P.PATTERN, rule).collect():
        got.setdefault(r.doc_id, {})[r.section] = r.n_tokens
    for i, (text, sections) in texts.items():
        want = {k: v for k, v in brute(text, sections, rule).items() if v or k >= 0}
        assert got.get(i, {}) == want, i


def test_sentences_add_up(spark):
    docs = spark.createDataFrame(
        [(1, "One two. Three!\n\n Four?  five"), (1, "One two. Three!\n\n Four?  five"), (None, " \n "), (3, None)],
        "doc_id long, text string",
    )
    enc, _ = tc._encoder(VOCAB, P.PATTERN)
    rows = tc.section_tokens(docs, VOCAB, P.PATTERN).collect()
    one = [r for r in rows if r.doc_id == 1]
    assert sum(r.n_tokens for r in one) == 2 * len(enc.encode_ordinary("One two. Three!\n\n Four?  five"))
    assert {(r.start, r.end) for r in one if r.section >= 0} == {(0, 8), (9, 15), (18, 23), (25, 29)}
    assert sum(r.n_tokens for r in rows if r.doc_id is None) == len(enc.encode_ordinary(" \n "))
    assert all(r.n_crossing <= r.n_tokens for r in rows)


def test_empty_table_and_bad_rule(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert tc.section_tokens(docs, VOCAB, P.PATTERN).count() == 0
    with pytest.raises(ValueError):
        tc.section_tokens(docs, VOCAB, P.PATTERN, "all")


def test_null_sections_and_overlaps(spark):
    schema = "doc_id long, text string, sections array<struct<start: long, end: long>>"
    rows = [(1, "one two three", [(0, 3), None, (4, None), (None, 7), (8, 13)]), (2, "one two", [None]), (3, None, [(0, 2)])]
    docs = spark.createDataFrame(rows, schema)
    got = tc.section_tokens(docs, VOCAB, P.PATTERN).collect()
    counts = {(r["doc_id"], r["section"]): r["n_tokens"] for r in got}
    assert counts[(1, 1)] == counts[(1, 2)] == counts[(1, 3)] == 0 and counts[(1, 0)] > 0 and counts[(1, 4)] > 0
    whole = tc.section_tokens(docs.drop("sections"), VOCAB, P.PATTERN)
    total = {r["doc_id"]: r["n"] for r in whole.groupBy("doc_id").agg({"n_tokens": "sum"}).withColumnRenamed("sum(n_tokens)", "n").collect()}
    assert sum(n for (d, _), n in counts.items() if d == 1) == total[1]
    bad = spark.createDataFrame([(1, "one two three", [(0, 5), (3, 8)])], schema)
    with pytest.raises(Exception, match="overlap"):
        tc.section_tokens(bad, VOCAB, P.PATTERN).collect()
