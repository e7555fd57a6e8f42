"""Quality rules, decontamination and toxicity on odd documents and against brute force."""

from __future__ import annotations

import random
import zlib

import pytest

from loglens.llm import decontam, quality, queries, toxicity
from tests.conftest import SF_SMALL
from tests.llm.conftest import prose
from tests.oracle_compare import compare
from pyspark.sql import functions as F


@pytest.mark.parametrize("key", sorted(queries.ORACLE_SQL))
def test_query_matches_oracle(spark, duck, key):
    ok, msg = compare(queries.QUERIES[key](spark, SF_SMALL), duck, queries.ORACLE_SQL[key], exact=True)
    assert ok, msg


def test_repeated_words_against_brute_force():
    r = random.Random(3)
    for _ in range(200):
        words = [r.choice([b"a", b"b", b"c"]) for _ in range(r.randint(0, 40))]
        k = 5
        grams = [tuple(words[i : i + k]) for i in range(len(words) - k + 1)]
        hit = {i + j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(k)}
        assert quality.repeated_words(words) == len(hit)


def test_quality_of_odd_documents(spark, odd_docs, odd_rows, no_docs):
    judged = quality.judge(quality.features(odd_docs, F.col("source"))).collect()
    assert len(judged) == len(odd_rows)
    by = {r.doc_id: r for r in judged}
    assert by[4].n_words == by[5].n_words == by[6].n_words == 0 and by[4].base_failed
    assert by[11].n_dup_lines == 2
    assert (by[12].n_words, by[12].word_chars) == (1, 300)
    assert by[14].n_repeat_words == 500 and by[14].base_failed
    assert by[9].kept is False or by[9].base_failed is False
    assert quality.judge(quality.features(no_docs, F.col("source"))).collect() == []


def test_hosts_shrink_towards_all_hosts(spark):
    rows = [(f"h{h}", i < h) for h in range(10) for i in range(20)] + [("one", True), ("bad", True)] + [("bad", True)] * 200
    docs = spark.createDataFrame(rows, "_host string, base_failed boolean")
    out = {r["_key"]: r for r in quality.host_verdicts(docs).collect()}
    assert out["sbad"].host_rejected and out["sbad"].rate > 0.9
    assert not out["sh1"].host_rejected
    assert out["sone"].rate < out["sbad"].rate
    assert out["sh0"].rate > 0


def bench(spark):
    passage = prose(11, 30)
    rows = [(1, passage), (2, "Short Item, here"), (3, None), (4, "..."), (None, prose(12, 15)), (5, passage)]
    return rows, spark.createDataFrame(rows, "item_id long, text string")


def brute_hits(text, items):
    import re

    words = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").translate({i: i + 32 for i in range(65, 91)}))
    w, hit, found = words(text), set(), set()
    for item, t in items:
        iw = words(t)
        k = min(10, len(iw))
        grams = {tuple(iw[i : i + k]) for i in range(len(iw) - k + 1)} if k else set()
        for i in range(len(w) - k + 1) if k else ():
            if tuple(w[i : i + k]) in grams:
                hit |= set(range(i, i + k))
                found |= {item} - {None}
    return len(w), len(hit), sorted(map(str, found))


def test_decontamination_against_brute_force(spark, odd_rows):
    items, table = bench(spark)
    own = [
        (100, prose(20, 40) + " " + items[0][1] + " " + prose(21, 5), "x", "s", 0),
        (101, "a short ITEM here!", "x", "s", 0),
        (102, " ".join(items[0][1].split()[5:14]), "x", "s", 0),
        (103, " ".join(items[0][1].upper().split()[5:15]) + "?", "x", "s", 0),
        (104, items[4][1], "x", "s", 0),
        (104, items[4][1], "x", "s", 0),
    ]
    rows = odd_rows + own
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = decontam.contamination(spark, docs, table).collect()
    want = sorted((str(r[0]), *brute_hits(r[1], items)) for r in rows)
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r["items"]) for r in got) == want
    kept = decontam.drop_contaminated(spark, docs, table)
    assert kept.columns == docs.columns
    assert sorted(map(repr, kept.collect())) == sorted(
        repr(r) for r in docs.collect() if not brute_hits(r.text, items)[1]
    )
    cut = {r.doc_id: r.text for r in decontam.remove_spans(spark, docs, table).collect()}
    assert cut[101].strip() == "a!" and brute_hits(cut[100], items)[1] == 0
    assert cut[0] == odd_rows[0][1] and cut[4] is None
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in decontam.contamination(spark, docs, none).collect()} == {0}


def toxic_corpus(n=600):
    r = random.Random(5)
    rows, labels = [], []
    for i in range(n):
        sentences = [prose(1000 * i + j, r.randint(4, 10)) for j in range(r.randint(1, 12))]
        bad = i % 4 == 0
        if bad:
            j = r.randrange(len(sentences))
            sentences[j] += " " + r.choice(["vile", "rotten", "nasty"])
        rows.append((i, ". ".join(sentences) + "."))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity_held_out_and_located(spark):
    rows, labels = toxic_corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(spark, docs, marks.filter(~toxicity.held_out()))
    truth, right, total, found, located = dict(labels), 0, 0, 0, 0
    for r in toxicity.score(docs, model).collect():
        assert 0 <= r.score <= 1
        if zlib.crc32(str(r.doc_id).encode()) % 4 == 2:
            total += 1
            right += (r.score >= toxicity.THRESHOLD) == bool(truth[r.doc_id])
            for s in r.offending if truth[r.doc_id] else ():
                located += 1
                found += any(w in rows[r.doc_id][1][s.start : s.end] for w in ("vile", "rotten", "nasty"))
    assert total > 100 and right / total > 0.97
    assert located > 25 and found / located > 0.9


def test_toxicity_of_odd_documents(spark, odd_docs, odd_rows, no_docs):
    rows, labels = toxic_corpus(200)
    marks = spark.createDataFrame(labels + [(None, 1), (5, None)], "doc_id long, toxic int")
    train = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(spark, train, marks)
    scored = toxicity.score(odd_docs.select("doc_id", "text"), model).collect()
    assert len(scored) == len(odd_rows)
    by = {r.doc_id: r.score for r in scored}
    assert by[4] == by[5] == by[6] == 0.0
    assert toxicity.score(no_docs, model).collect() == []
    unlabelled = toxicity.train(spark, train, marks.filter("toxic = 1"))
    assert {r.score for r in toxicity.score(odd_docs, unlabelled).collect()} == {0.0}


def test_a_large_benchmark_is_broadcast_in_slices(spark, monkeypatch):
    words = [f"w{k}" for k in range(400)]
    items = [(i, " ".join(words[20 * i : 20 * i + 14])) for i in range(20)] + [(90, "w3 only"), (91, "w5")]
    docs = [(i, " ".join(words[15 * i : 15 * i + 40])) for i in range(26)] + [(50, None), (51, "w3 only"), (51, "w3 only")]
    table = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    want = sorted(map(repr, decontam.contamination(spark, docs, table).collect()))
    plans, kept = [], decontam.save

    def spy(spark, df, name):
        if name == "decontam-hits":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return kept(spark, df, name)

    monkeypatch.setattr(decontam, "save", spy)
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", 3000)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(repr, decontam.contamination(spark, docs, table).collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert len(plans) > 1 and all("BroadcastHashJoin" in p and "SortMergeJoin" not in p for p in plans)
