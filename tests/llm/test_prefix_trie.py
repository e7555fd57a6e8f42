"""The prefix trie against rebuilding every conversation, and running products over ranges."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loglens.llm import prefix_trie, queries, scan

SCHEMA = "conv_id long, turn int, role string, text string"


@pytest.fixture
def many_ranges(spark):
    """Small ranges that stay apart, so that conversations run through several."""
    names = ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")
    old = [spark.conf.get(n) for n in names]
    for name, value in zip(names, ("false", "7"), strict=True):
        spark.conf.set(name, value)
    yield
    for name, value in zip(names, old, strict=True):
        spark.conf.set(name, value)


def brute_nodes(rows, base, head):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append(((turn is not None, turn or 0, digest), (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    paths = {c: [*own.get(base(c), [])[: head(c)], *own[c][head(c) :]] for c in own}
    nodes = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            nodes[tuple(path[:d])].append(c)
    children = defaultdict(set)
    for prefix in nodes:
        if prefix:
            children[prefix[:-1]].add(prefix)
    leaves, saved = defaultdict(int), defaultdict(int)
    for prefix, members in nodes.items():
        charge = (len(members) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", prefix[-1][1])) if prefix else 0
        for d in range(len(prefix) + 1):
            saved[prefix[:d]] += charge
            leaves[prefix[:d]] += not children[prefix]
    out = []
    for prefix, members in nodes.items():
        ends = sorted(c for c in members if len(paths[c]) == len(prefix))
        up = min(nodes[prefix[:-1]]) if prefix else None
        sha = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        out.append((min(members), len(prefix), up, len(members), len(children[prefix]), leaves[prefix], saved[prefix], sha))
    return sorted(out, key=repr)


def some_conversations(seed: int):
    """Shared beginnings, ties, NULLs, repeated rows, a long conversation and copies of one."""
    r = random.Random(seed)
    texts = [f"turn {k} with words " * (k % 4) for k in range(6)] + ["", " \n ", "é ü 日本"]
    rows = []
    for c in [*range(0, 70), -5, -20, 400, 405]:
        for turn in range(r.randint(0, 6)):
            rows.append((c, r.choice([turn, turn, 1, None]), r.choice(["user", "assistant", None]), r.choice([*texts[:3], *texts, None])))
    rows += [(401, k, "user", texts[k % 5]) for k in range(700)]
    rows += [(402, k, "user", texts[k % 5]) for k in range(690)]
    rows += [(None, 1, "user", "nobody's"), (3, 2, "user", "twice"), (3, 2, "user", "twice")]
    r.shuffle(rows)
    return rows


def contract_base(c: int) -> int:
    return c - (abs(c) % 20) * (1 if c >= 0 else -1)


@pytest.mark.parametrize("seed", [1, 2])
def test_nodes_against_rebuilt_conversations(spark, many_ranges, seed):
    rows = some_conversations(seed)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", depth string, hi int").repartition(4)
    conv = F.col("conv_id")
    head = F.crc32(conv.cast("string").cast("binary")) % 4
    got = prefix_trie.prefix_trie(spark, df, conv - conv % 20, head).drop("source", "place")
    want = brute_nodes(rows, contract_base, lambda c: zlib.crc32(str(c).encode()) % 4)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_plain_trie_and_stored_turns(spark, many_ranges):
    rows = [(c, t, "user", f"text {t if t < 2 else (c % 3, t)}") for c in range(12) for t in range(1 + c % 5)]
    got = prefix_trie.prefix_trie(spark, spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((tuple(r)[:8] for r in got), key=repr) == brute_nodes(rows, lambda c: c, lambda c: 0)
    assert all((r["source"], r["place"]) == ((r["conv_id"], r["depth"]) if r["depth"] else (None, None)) for r in got)


def test_long_lists_of_ends(spark, many_ranges):
    rows = [(c, 0, "user", "the same") for c in range(5000)]
    got = {r["depth"]: r for r in prefix_trie.prefix_trie(spark, spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    assert got[1]["ends_sha256"] == hashlib.sha256(",".join(map(str, range(5000))).encode()).hexdigest()
    assert got[0]["saved_tokens"] == got[1]["saved_tokens"] == 4999 * 2 and got[0]["n_leaves"] == 1


def test_no_conversations(spark):
    assert prefix_trie.prefix_trie(spark, spark.createDataFrame([], SCHEMA)).collect() == []
    assert prefix_trie.prefix_trie(spark, spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)).collect() == []


def test_different_turns_under_one_hash_stop_the_job(spark):
    rebuilt = spark.createDataFrame([(1, 1), (2, 1)], "conv_id long, length long")
    members = [(c, 1, 7, 7, 0, 0, ref, 5, 2, c, 1, True) for c, ref in ((1, 11), (2, 12))]
    with pytest.raises(RuntimeError, match="one hash"):
        prefix_trie.node_table(spark, spark.createDataFrame(members, prefix_trie._MEMBER), rebuilt)


def test_turn_hashes_form_a_monoid():
    m = prefix_trie.TurnHashes()
    r = random.Random(3)
    turns = [(1, r.getrandbits(127) % prefix_trie.MODULUS) for _ in range(30)]

    def product(part):
        out = (0, 0)
        for t in part:
            out = m.mul(out, t)
        return out

    for a in range(0, 31, 5):
        assert m.mul(product(turns[:a]), product(turns[a:])) == product(turns)
    assert m.load(m.store([*turns, None])) == [*turns, None]
    assert product(turns[::-1]) != product(turns)


def test_running_sums_through_ranges(spark, many_ranges):
    r = random.Random(5)
    rows = [(0, k, r.randint(-9, 9)) for k in range(400)] + [(s, k, r.randint(-9, 9)) for s in range(1, 40) for k in range(r.randint(0, 5))]
    df = spark.createDataFrame(rows, "s long, k long, v long").repartition(6)
    got = scan.segmented_scan(spark, df, "s", [F.col("s"), F.col("k")], scan.Sums("v"), "sums")
    sums: dict = defaultdict(int)
    want = []
    for s, k, v in sorted(rows):
        want.append((s, k, v, sums[s] + v, sums[s] if k else None))
        sums[s] += v
    assert sorted(tuple(x) for x in got.collect()) == want
    assert scan.segmented_scan(spark, df.limit(0), "s", [F.col("s")], scan.Sums("v"), "sums").count() == 0


def test_members_are_checked_by_the_other_half_of_the_digest(spark):
    row = spark.createDataFrame([(None, "a:b")], "role string, text string").select(prefix_trie.turn_digest().alias("d")).first()
    assert row["d"] == hashlib.sha256(b"0:a:b").hexdigest()
    lifted = prefix_trie.TurnHashes().lift(pa.RecordBatch.from_arrays([pa.array([row["d"]])], names=["digest"]))
    assert lifted == [(1, int(row["d"][:32], 16) % prefix_trie.MODULUS)]


def test_query_on_given_tables(spark):
    df = queries.op11_prefix_trie(spark, "/root/testdata/sf0.001")
    root = df.filter("depth = 0").first()
    assert root["n_children"] == df.filter("depth = 1").count() and root["n_leaves"] == df.filter("n_children = 0").count()
