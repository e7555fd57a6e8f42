"""Line dedup against brute force, its state under inserts and deletes, and cuckoo filters."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loglens.llm import cuckoo, line_dedup
from loglens.llm.line_dedup import LineIndex
from loglens.session import fresh_path

SCHEMA = "doc_id long, text string"
BLANK = " \t\n\x0b\x0c\r"


def key_of(line: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANK))


def brute_lines(rows, min_chars=20, min_docs=3):
    order = lambda i: (i is not None, i or 0)
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= min_chars:
                holders[key_of(line)].add(order(i))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if not (len(holders[key_of(x)]) >= min_docs and order(i) < max(holders[key_of(x)]))]
        out.append((i, len(lines), len(lines) - len(stay), None if text is None else "\n".join(stay)))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r["row"]["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in df.collect()), key=repr)


def texts(seed: int, n: int, first: int = 0):
    r = random.Random(seed)
    lines = [f"  Shared LINE number {k} of many É " for k in range(12)] + ["short", "", " " * 30, "x" * 19, "é" * 19, "é" * 20, "日" * 7 + "abc" * 4 + "x"]
    rows = []
    for i in range(first, first + n):
        own = [f"line {k} of document {i} alone" for k in range(r.randint(0, 3))]
        rows.append((i, "\n".join(r.sample(own + r.choices(lines, k=r.randint(0, 6)), k=len(own)) + r.choices(lines, k=4))))
    return rows


def test_documents_against_brute_force(spark, odd_rows, no_docs):
    rows = texts(1, 40) + [r[:2] for r in odd_rows] + [(None, "a line that NULL documents hold too"), (None, None)]
    rows += [(7000 + k, " A line that null documents hold TOO\t") for k in range(3)] + texts(2, 3)  # ids with two texts
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert found(line_dedup.dedup_lines(spark, docs)) == brute_lines(rows)
    assert found(line_dedup.dedup_lines(spark, docs, min_chars=1, min_docs=2)) == brute_lines(rows, 1, 2)
    assert line_dedup.dedup_lines(spark, no_docs).collect() == []


def test_other_columns_pass_whatever_their_names(spark):
    rows = [(k, "one line that stands in all documents", k, "m", "d", "r", "l") for k in range(4)]
    names = "doc_id long, text string, mark long, digests string, row string, _id string, n_lines string"
    out = line_dedup.dedup_lines(spark, spark.createDataFrame(rows, names))
    assert sorted(tuple(r["row"]) for r in out.collect()) == rows
    assert sorted(r["n_dropped"] for r in out.collect()) == [0, 1, 1, 1]


def fingerprints(state: LineIndex):
    """All fingerprints of all shards by unordered bucket pair, wherever they stand."""
    out = []
    for r in state._filters().collect():
        table = cuckoo.CuckooFilter.load(bytes(r["filter"])).table
        for at, bucket in enumerate(table.tolist()):
            for mark in filter(None, bucket):
                other = at ^ int(cuckoo.splitmix(np.array([mark], np.uint64))[0]) & (len(table) - 1)
                out.append((r["shard"], mark, len(table) and min(at, other)))
    return sorted(out)


def test_inserts_and_deletes_are_reversible(spark):
    a, b = texts(3, 30), texts(4, 30, 100)
    df = lambda rows: spark.createDataFrame(rows, SCHEMA)
    path = fresh_path(spark, "lines")
    first = LineIndex.create(spark, path).insert(df(a))
    both = first.insert(df(b))
    assert found(both.dedup(df(a + b))) == brute_lines(a + b)
    again = both.insert(df(a[:9] + b[:9]))  # replayed rows count once
    assert found(again.dedup(df(a + b))) == brute_lines(a + b)
    less = again.delete(df(b[10:]).select("doc_id"))
    assert found(less.dedup(df(a + b[:10]))) == brute_lines(a + b[:10])
    back = less.delete(df(b).select("doc_id"))
    assert found(back.dedup(df(a))) == brute_lines(a) == found(first.dedup(df(a)))
    key = [(s, m) for s, m, _ in fingerprints(first)]
    assert [(s, m) for s, m, _ in fingerprints(back)] == key and key
    counts = lambda s: sorted((bytes(r["digest"]), r["n_docs"], r["keeper"]) for r in s.frequent().collect())
    assert counts(back) == counts(first)
    # the last whole version is the one that is opened; earlier ones still read
    assert LineIndex.open(spark, path).version == back.version
    assert found(both.dedup(df(a + b))) == brute_lines(a + b)
    nothing = back.delete(df(a).select("doc_id"))
    assert fingerprints(nothing) == [] and found(nothing.dedup(df(a))) == sorted(((i, t.count("\n") + 1, 0, t) for i, t in a), key=repr)


def test_many_shards_and_groups(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "KEYS_PER_SHARD", 2)
    monkeypatch.setattr(line_dedup, "FILTER_BYTES", 64)
    a, b = texts(5, 25), texts(6, 40, 50)
    df = lambda rows: spark.createDataFrame(rows, SCHEMA).repartition(3)
    state = LineIndex.create(spark, fresh_path(spark, "lines")).insert(df(a[:2])).insert(df(a)).insert(df(b))
    assert state.version["bits"] > 1 and len(state.filter_groups()) > 1
    assert found(state.dedup(df(a + b))) == brute_lines(a + b)


def test_lines_go_only_where_the_filter_says_so(spark, monkeypatch):
    rows = texts(7, 20)
    docs = spark.createDataFrame(rows, SCHEMA)
    state = LineIndex.create(spark, fresh_path(spark, "lines")).insert(docs)
    assert any(n for _, _, n, _ in found(state.dedup(docs)))
    empty = [(r["shard"], bytes(len(r["filter"]))) for r in state._filters().collect()]
    monkeypatch.setattr(LineIndex, "_filters", lambda self: spark.createDataFrame(empty, line_dedup.FILTERS))
    assert not any(n for _, _, n, _ in found(state.dedup(docs)))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=300, unique=True), st.randoms())
def test_cuckoo_filter_holds_what_was_inserted(keys, r):
    hashes = np.array(keys, np.uint64)
    made = cuckoo.CuckooFilter.of(hashes)
    assert made.contains(hashes).all() and len(made) == len(keys)
    gone = np.array([k for k in keys if r.random() < 0.5], np.uint64)
    made.delete(gone)
    made = cuckoo.CuckooFilter.load(made.dump())
    rest = np.array([k for k in keys if k not in set(gone.tolist())], np.uint64)
    assert made.contains(rest).all() and len(made) == len(rest)


def test_cuckoo_filter_size_and_false_hits():
    r = np.random.default_rng(1)
    keys = r.integers(0, 2**63, 30_000).astype(np.uint64) * np.uint64(2)
    made = cuckoo.CuckooFilter.sized(20_000)
    assert made.insert(keys) and made.contains(keys).all()  # beyond the size it was made for
    assert made.contains(keys + np.uint64(1)).mean() < 0.001
    full = cuckoo.CuckooFilter.sized(10)
    assert not full.insert(keys[:200])
    with pytest.raises(KeyError):
        cuckoo.CuckooFilter.of(keys[:10]).delete(keys[10:20])
