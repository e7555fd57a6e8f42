"""The pipeline's stages, each against a plain version on what the one before it kept."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np

import corpus_pipeline
from loglens.llm import queries
from loglens.llm.common import save, table
from loglens.llm.encoder import PieceEncoder
from tests.conftest import SF_SMALL
from tests.llm.test_index_operators import brute_components
from tests.llm.test_mixing import water_level
from tests.llm.test_text_operators import brute_hits


def test_every_stage_against_a_plain_version(spark):
    docs = table(spark, SF_SMALL, "documents")
    columns = docs.columns
    rows = [tuple(r) for r in docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = save(spark, stage(spark, docs, SF_SMALL), "test-stage")
        if name != "token-ID output":
            assert docs.columns == columns
        before, rows = rows, [tuple(r) for r in docs.collect()]
        if name == "toxicity":
            # the score itself is held against held-out labels elsewhere
            bad = {r.doc_id for r in queries.op4_mil_toxicity(spark, SF_SMALL).filter("predicted = 1").collect()}
            assert bad and sorted(rows) == sorted(r for r in before if r[0] not in bad)
        elif name == "n-gram Jaccard join":
            least = {(c if n != "0" else None) for _, n, c in ((a, str(b), c) for a, b, c in brute_components(before))}
            assert sorted(rows) == sorted(r for r in before if str(r[0]) in least)
            assert len(rows) < len(before)
        elif name == "benchmark decontamination":
            items = [tuple(r) for r in table(spark, SF_SMALL, "benchmark").select("item_id", "text").collect()]
            assert sorted(rows) == sorted(r for r in before if not brute_hits(r[1], items)[1])
        elif name == "mixing":
            size = {r[0]: len((r[1] or "").encode().split()) for r in before}
            source = {r[0]: r[3] for r in before}
            total: dict = {}
            for i, n in size.items():
                total[source[i]] = total.get(source[i], 0) + n
            order = sorted(total)
            want = water_level(total, {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}, 1.5 * sum(size.values()), 2)
            copies = Counter(r[0] for r in rows)
            assert set(rows) <= set(before) and max(copies.values()) <= 2
            for s in order:
                taken = sum(n * size[i] for i, n in copies.items() if source[i] == s)
                assert abs(taken - want[s]) <= max(n for i, n in size.items() if source[i] == s)
        else:
            enc = PieceEncoder(queries.tokenizer_path())
            text = {r[0]: r[1] for r in before}
            at = 0
            for i, start, n, crc in sorted(rows, key=lambda r: r[1]):
                ids = np.array([*enc.ids(text[i] or ""), queries.END_ID], "<u4")
                assert (start, n, crc) == (at, len(ids), zlib.crc32(ids.tobytes()))
                at += n
            ids_in_order = [r[0] for r in sorted(rows, key=lambda r: r[1])]
            assert ids_in_order == sorted(r[0] for r in before)


def test_empty_documents_run_through(spark, tmp_path):
    for name in ("documents", "benchmark", "labels"):
        table(spark, SF_SMALL, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
