"""What the Python workers hold between two tasks, beside the JVM's heap."""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa

from loglens.llm import encoder, queries, tokens_binary
from loglens.llm.common import map_arrow
from tests.llm.conftest import prose


def held_mb(pid: int | str = "self") -> float:
    with open(f"/proc/{pid}/smaps_rollup") as f:
        return sum(map(int, re.findall(r"\nPss_(?:Anon|Shmem):\s+(\d+)", f.read()))) / 1024


def report(mb: float, n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([os.getpid()]), pa.array([mb]), pa.array([n])], names=["pid", "mb", "n"])


def churn(batches):
    for _ in batches:
        pass
    del _
    first = np.ones(31 << 17)  # glibc now takes blocks of up to 31 MB from its heap
    del first
    blocks = [np.ones(1 << 17) for _ in range(100)]  # 1 MB each
    last = np.ones(1 << 13)  # above them, so that the heap can't shrink from its end
    del blocks
    yield report(held_mb(), len(last))


def encoders(batches):
    for _ in batches:
        pass
    yield report(0, len(encoder._encoders))


def test_freed_memory_leaves_the_worker_with_the_task(spark):
    row = map_arrow(spark.range(0, 8, 1, 1), churn, "pid long, mb double, n long").first()
    assert held_mb(row["pid"]) < row["mb"] - 60


def test_other_tasks_drop_the_tokenizers(spark):
    docs = spark.createDataFrame([(i, prose(i, 20)) for i in range(64)], "doc_id long, text string").repartition(8)
    tokens = tokens_binary.token_table(spark, docs, queries.tokenizer_path(), 2)
    assert tokens.count() == 64
    rows = map_arrow(spark.range(0, 64, 1, 16), encoders, "pid long, mb double, n long").collect()
    assert len(rows) == 16 and all(r["n"] == 0 for r in rows)


def test_one_module_keeps_its_tokenizers(spark):
    """Tasks of the module that loaded a tokenizer find it again."""
    before = dict(encoder._encoders)
    try:
        path = queries.tokenizer_path()
        batch = pa.RecordBatch.from_pydict({"part": [0], "doc_id": [1], "text": ["a word"]})
        from loglens.llm.common import _tidy_task

        found = []
        for _ in range(2):
            list(_tidy_task(lambda b: tokens_binary._encode(path, 2, b), iter([batch])))
            found.append(encoder._encoders.get(path))
        assert found[0] is not None and found[0] is found[1]
    finally:
        encoder._encoders.clear()
        encoder._encoders.update(before)
