"""Entropy balancing: targets, rates and copies."""

from __future__ import annotations

import math

from loglens.llm import mixing
from tests.oracle_compare import duck_connection
from tests.conftest import SF_SMALL


def water_level(sizes: dict, weights: dict, total: float, cap: float) -> dict:
    """Targets by resharing the excess until no source is above its cap."""
    target, open_, left = {}, set(sizes), total
    while open_:
        w = sum(weights[s] for s in open_)
        over = {s for s in open_ if left * weights[s] / w >= cap * sizes[s]}
        if not over:
            return target | {s: left * weights[s] / w for s in open_}
        for s in over:
            target[s] = cap * sizes[s]
        left -= sum(cap * sizes[s] for s in over)
        open_ -= over
    return target


def by_source(rows):
    out: dict = {}
    for r in rows:
        out.setdefault(r.source, []).append(r)
    return out


def run(spark, docs, weights=(3, 1, 2)):
    items = mixing.size_table(spark, docs)
    targets = mixing.source_targets(items, weights, 1.5, 2)
    return mixing.entropy_mix(spark, items, targets, 2).collect()


def test_targets_rates_and_copies(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = run(spark, docs)
    assert len(rows) == docs.count()
    groups = by_source(rows)
    order = sorted(groups)
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    sizes = {s: sum(r.size for r in rs) for s, rs in groups.items()}
    want = water_level(sizes, weights, 1.5 * sum(sizes.values()), 2)
    for s, rs in groups.items():
        assert all(math.isclose(r.target, want[s], rel_tol=1e-9) and r.source_size == sizes[s] for r in rs)
        assert all(0 <= r.copies <= 2 and abs(r.copies - r.rate) <= 1 for r in rs)
        # the rates meet the target, and follow one exponential tilt of the size
        assert math.isclose(sum(r.rate * r.size for r in rs), want[s], rel_tol=1e-6, abs_tol=1)
        tilt = [(math.log(r.rate / (2 - r.rate)) / r.size) for r in rs if 1e-6 < r.rate < 1.999 and r.rate != 1]
        assert not tilt or max(tilt) - min(tilt) < 1e-4 * max(map(abs, tilt)) + 1e-9
        taken = sum(r.copies * r.size for r in rs)
        assert abs(taken - want[s]) <= max(r.size for r in rs)
    words = duck_connection(SF_SMALL).sql(
        r"SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) FROM documents"
    ).fetchall()
    assert {r.doc_id: r.size for r in rows} == dict(words)
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, run(spark, docs)), key=repr)


def test_odd_documents(spark, odd_docs, odd_rows, no_docs):
    rows = run(spark, odd_docs)
    assert len(rows) == len(odd_rows)
    assert {r.source for r in rows} == {r[3] for r in odd_rows}
    assert all(r.copies == 0 for r in rows if r.size == 0)
    assert all(r.copies * r.size <= 2 * r.size for r in rows)
    assert run(spark, no_docs) == []


def test_copies_become_rows(spark, odd_docs, odd_rows):
    mixed = run(spark, odd_docs)
    out = mixing.mix_documents(spark, odd_docs, (3, 1, 2), 1.5, 2).collect()
    assert len(out) == sum(r.copies for r in mixed)
    assert set(map(tuple, out)) <= set(odd_rows)


def test_equal_sizes_share_their_copies(spark):
    docs = spark.createDataFrame([(i, f"w{i} x y", "a" if i % 3 else "b") for i in range(3000)], "doc_id long, text string, source string")
    rows = run(spark, docs, (1, 1))
    for rs in by_source(rows).values():
        assert abs(sum(r.copies * r.size for r in rs) - rs[0].target) <= 3
