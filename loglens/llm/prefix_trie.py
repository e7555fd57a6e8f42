"""The prefix trie of conversations that share their beginnings.

A rebuilt conversation is the head of a base conversation (its first turns)
followed by its own turns after as many. None is put together: a turn counts as
a number (from its SHA-256), a sequence of turns as its polynomial hash modulo
2**127 - 1, and these hashes form a monoid, ``(m, H) * (n, G) = (m + n, H * B**n + G)``.
Running products over every conversation's own turns are all that is stored.
The hash of a rebuilt prefix follows from them by algebra: with ``D`` the hash of
the base's head less that of the own head which it replaces, the prefix that ends
with own turn j has ``D * B**(j - h) + (own product up to j)``.

Equal prefixes are the nodes. Their equality is checked, not only hashed: every
member of a node refers to the stored turn that it ends with, all members'
turns must agree in the other half of the SHA-256 (which the hash above does not use), and so
must their parents, down to the root. A mismatch stops the job.

Sums over subtrees need no walk by levels. Each node is charged to its smallest
member. A conversation belongs to all nodes on its path, so a subtree's sum is that of
its members' charges, less what the smallest member is charged for above the
node: one grouping of member rows and one running sum.

Rows are grouped with partial sums, dealt by ranges, or joined from stored
tables whose hot keys Spark splits; a conversation of any length and a turn that
everybody shares are spread over tasks. The ids that end in one node are hashed in
order as SHA-256 needs, from strings of up to ``CHUNK`` characters put together before.

Defined results: rows without a ``conv_id`` belong to no conversation; NULL roles
and texts are empty; turns are ordered by number (NULL first), equal numbers by
the SHA-256 of role and text, and repeated rows are turns of their own; other columns
are left out; without conversations there is no node.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import count_words, map_arrow, save
from .scan import Monoid, Sums, segmented_scan

MODULUS = (1 << 127) - 1
BASE = int.from_bytes(hashlib.sha256(b"prefix trie").digest()[:16], "big") % MODULUS
MAX_HEAD = 3
CHUNK = 4096

_NODE = ["depth", "hi", "lo"]


def _split(h: int) -> tuple[int, int]:
    """A hash as two signed 64-bit halves."""
    low = h & ((1 << 64) - 1)
    return h >> 64, low - (1 << 64) if low >> 63 else low


def _join(hi: int, lo: int) -> int:
    return (hi << 64) | (lo & ((1 << 64) - 1))


@functools.lru_cache(maxsize=4096)
def _power(n: int) -> int:
    return pow(BASE, n, MODULUS)


class TurnHashes(Monoid):
    """Sequences of turns as (number of turns, polynomial hash)."""

    ddl = "struct<n: long, hi: long, lo: long>"

    def lift(self, batch: pa.RecordBatch) -> list:
        return [(1, int(d[:32], 16) % MODULUS) for d in batch.column("digest").to_pylist()]

    def mul(self, a: tuple, b: tuple) -> tuple:
        return a[0] + b[0], (a[1] * _power(b[0]) + b[1]) % MODULUS

    def store(self, elements: list) -> pa.Array:
        rows = [None if e is None else dict(zip(("n", "hi", "lo"), (e[0], *_split(e[1])), strict=True)) for e in elements]
        return pa.array(rows, pa.struct([("n", pa.int64()), ("hi", pa.int64()), ("lo", pa.int64())]))

    def load_value(self, value) -> tuple:
        return value["n"], _join(value["hi"], value["lo"])


def turn_digest(role: str | Column = "role", text: str | Column = "text") -> Column:
    """SHA-256 (hex) of a turn; the role's length keeps role and text apart."""
    role, text = (F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in (role, text))
    return F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)


def turn_table(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """Stored ``conv_id, ref_hi, ref_lo, words, upto, before`` of all turns: the reference half of the
    digest, and the hash of the conversation's own turns with and without this one (``upto.n`` is its place)."""
    digest = turn_digest()
    half = lambda at: F.conv(F.substring("digest", at, 16), 16, -10).cast("long")
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), count_words("text").alias("words")
    )
    rows = save(spark, rows.withColumns({"ref_hi": half(33), "ref_lo": half(49)}), "trie-turns")
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest")]
    return segmented_scan(spark, rows, "conv_id", order, TurnHashes(), "trie-scan").drop("turn", "digest")


_FIRST = ("hi", "lo", "ref_hi", "ref_lo", "words")


def rebuilt_table(spark: SparkSession, turns: DataFrame, base: Column, head: Column, max_head: int) -> DataFrame:
    """Stored row per conversation: its own length ``n``, ``h`` turns to replace, ``hh`` turns of the base's
    head in their place (fewer if the base has fewer), and the values of the base's first turns."""
    value = {"hi": F.col("upto.hi"), "lo": F.col("upto.lo"), "ref_hi": F.col("ref_hi"), "ref_lo": F.col("ref_lo"), "words": F.col("words")}
    firsts = [F.max(F.when(F.col("upto.n") == i, value[v])).alias(f"{v}_{i}") for i in range(1, max_head + 1) for v in _FIRST]
    convs = turns.groupBy("conv_id").agg(F.max("upto.n").alias("n"), *firsts)
    convs = save(spark, convs.withColumns({"base": base.cast("long"), "h": head.cast("long")}), "trie-conversations")
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"), *(F.col(f"{v}_{i}").alias(f"base_{v}_{i}") for i in range(1, max_head + 1) for v in _FIRST))
    both = convs.join(bases, "base", "left")
    both = both.withColumns({"hh": F.least(F.col("h"), F.coalesce("base_n", F.lit(0))), "oh": F.least("h", "n")})

    def at(prefix: str, half: str, n: str) -> Column:  # hash of the first n turns
        found = [F.when(F.col(n) == i, F.col(f"{prefix}{half}_{i}")) for i in range(1, max_head + 1)]
        return F.coalesce(*found, F.lit(0)).cast("long")

    hashes = {"head_hi": at("base_", "hi", "hh"), "head_lo": at("base_", "lo", "hh"), "own_hi": at("", "hi", "oh"), "own_lo": at("", "lo", "oh")}
    kept = [F.col(f"base_{v}_{i}") for i in range(1, max_head + 1) for v in _FIRST]
    both = both.select("conv_id", "base", "n", "h", "hh", *(c.alias(k) for k, c in hashes.items()), *kept)
    length = F.col("hh") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    return save(spark, both.withColumn("length", length), "trie-rebuilt")


_MEMBER = "conv_id long, depth long, hi long, lo long, parent_hi long, parent_lo long, ref_hi long, ref_lo long, words long, source long, place long, last boolean"


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the rebuilt prefixes that end with own turns, and of those one turn shorter."""
    for batch in batches:
        c = {name: batch.column(name).to_pylist() for name in batch.schema.names}
        found: list[list[int]] = [[], [], [], []]
        rows = zip(c["head_hi"], c["head_lo"], c["own_hi"], c["own_lo"], c["place"], c["h"], c["hi"], c["lo"], c["before_hi"], c["before_lo"], strict=True)
        for head_hi, head_lo, own_hi, own_lo, place, h, hi, lo, before_hi, before_lo in rows:
            replaced = _join(head_hi, head_lo) - _join(own_hi, own_lo)
            here, up = _join(hi, lo), _join(before_hi, before_lo)
            if replaced:
                shift = _power(place - h - 1)
                up = (replaced * shift + up) % MODULUS
                here = (replaced * shift * BASE + here) % MODULUS
            for column, value in zip(found, (*_split(here), *_split(up)), strict=True):
                column.append(value)
        depth = pa.array([hh + p - h for hh, p, h in zip(c["hh"], c["place"], c["h"], strict=True)], pa.int64())
        rest = [batch.column(n) for n in ("ref_hi", "ref_lo", "words", "conv_id", "place", "last")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), depth, *(pa.array(f, pa.int64()) for f in found), *rest],
            names=[part.split()[0] for part in _MEMBER.split(", ")],
        )


def member_table(spark: SparkSession, turns: DataFrame, rebuilt: DataFrame, max_head: int) -> DataFrame:
    """Stored row per rebuilt conversation and depth from 1: the node's hash and its parent's, the digest half and
    words of the last turn, and the stored turn (``source`` conversation, ``place``) that it is."""
    heads = []
    for i in range(1, max_head + 1):
        parent = [F.col(f"base_{v}_{i - 1}") if i > 1 else F.lit(0).cast("long") for v in ("hi", "lo")]
        values = [F.col(f"base_{v}_{i}") for v in _FIRST]
        heads.append(F.struct(
            F.lit(i).cast("long").alias("depth"), values[0].alias("hi"), values[1].alias("lo"), parent[0].alias("parent_hi"), parent[1].alias("parent_lo"),
            values[2].alias("ref_hi"), values[3].alias("ref_lo"), values[4].alias("words"), F.col("base").alias("source"), F.lit(i).cast("long").alias("place"),
            (F.col("length") == i).alias("last"),
        ))
    given = rebuilt.select("conv_id", F.explode(F.slice(F.array(*heads), 1, F.col("hh").cast("int"))).alias("m")).select("conv_id", "m.*")
    info = rebuilt.select("conv_id", "n", "h", "hh", "head_hi", "head_lo", "own_hi", "own_lo")
    rows = turns.join(info, "conv_id").filter(F.col("upto.n") > F.col("h"))
    zero = F.lit(0).cast("long")
    rows = rows.select(
        "conv_id", "h", "hh", "head_hi", "head_lo", "own_hi", "own_lo", F.col("upto.n").alias("place"), F.col("upto.hi").alias("hi"), F.col("upto.lo").alias("lo"),
        F.coalesce("before.hi", zero).alias("before_hi"), F.coalesce("before.lo", zero).alias("before_lo"), "ref_hi", "ref_lo", "words",
        (F.col("upto.n") == F.col("n")).alias("last"),
    )
    return save(spark, given.unionByName(map_arrow(rows, _compose, _MEMBER)), "trie-members")


def node_table(spark: SparkSession, members: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """Stored row per node, the root included: smallest member, members, children, its parent's hash and
    the stored turn that it ends with. Raises if members of a node differ."""
    checked = ("parent_hi", "parent_lo", "ref_hi", "ref_lo")
    nodes = members.groupBy(*_NODE).agg(
        F.min("conv_id").alias("owner"), F.count("*").alias("n_convs"), F.max("words").alias("words"),
        F.min_by("source", "conv_id").alias("source"), F.min_by("place", "conv_id").alias("place"),
        *(F.min(c).alias(c) for c in checked), *(F.max(c).alias(f"max_{c}") for c in checked),
    )
    nodes = save(spark, nodes, "trie-groups")
    differ = functools.reduce(lambda a, b: a | b, (F.col(c) != F.col(f"max_{c}") for c in checked))
    if nodes.filter(differ).limit(1).count():
        raise RuntimeError("two different prefixes have one hash: change BASE")
    nodes = nodes.drop("ref_hi", "ref_lo", *(f"max_{c}" for c in checked))
    zero = F.lit(0).cast("long")
    root = rebuilt.agg(F.min("conv_id").alias("owner"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    root = root.withColumns({c: zero for c in ("depth", "hi", "lo", "words")})
    children = nodes.select((F.col("depth") - 1).alias("depth"), F.col("parent_hi").alias("hi"), F.col("parent_lo").alias("lo"), F.lit(1).alias("n_children"))
    rows = nodes.unionByName(root, allowMissingColumns=True).unionByName(children, allowMissingColumns=True)
    values = ("owner", "n_convs", "words", "source", "place", "parent_hi", "parent_lo")
    whole = rows.groupBy(*_NODE).agg(*(F.max(c).alias(c) for c in values), F.coalesce(F.sum("n_children"), F.lit(0)).cast("long").alias("n_children"))
    return save(spark, whole.withColumn("charge", (F.col("n_convs") - 1) * F.col("words")), "trie-nodes")


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of one node that follow each other, comma-joined up to ``CHUNK`` characters."""
    key, first, ids, size = None, None, [], 0
    done: list[tuple] = []

    def flush() -> pa.RecordBatch:
        columns = [pa.array([d[i] for d in done], pa.int64()) for i in range(4)]
        strings = pa.array([d[4] for d in done], pa.string())
        done.clear()
        return pa.RecordBatch.from_arrays([*columns, strings], names=[*_NODE, "first", "ids"])

    for batch in batches:
        for depth, hi, lo, conv in zip(*(batch.column(n).to_pylist() for n in (*_NODE, "conv_id")), strict=True):
            if (depth, hi, lo) != key or size > CHUNK:
                if ids:
                    done.append((*key, first, ",".join(ids)))
                key, first, ids, size = (depth, hi, lo), conv, [], 0
            ids.append(str(conv))
            size += len(ids[-1]) + 1
        yield flush()
    if ids:
        done.append((*key, first, ",".join(ids)))
        yield flush()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the joined strings of each node, which come in order."""
    key, running = None, None
    for batch in batches:
        keys, found = [], []
        for depth, hi, lo, ids in zip(*(batch.column(n).to_pylist() for n in (*_NODE, "ids")), strict=True):
            if (depth, hi, lo) != key:
                if running:
                    keys.append(key)
                    found.append(running.hexdigest())
                key, running = (depth, hi, lo), hashlib.sha256(ids.encode())
            else:
                running.update(b"," + ids.encode())
        yield _digest_rows(keys, found)
    if running:
        yield _digest_rows([key], [running.hexdigest()])


def _digest_rows(keys: list, found: list) -> pa.RecordBatch:
    columns = [pa.array([k[i] for k in keys], pa.int64()) for i in range(3)]
    return pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.string())], names=[*_NODE, "ends_sha256"])


def end_digests(spark: SparkSession, members: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """``depth, hi, lo, ends_sha256`` of all nodes in which conversations end."""
    zero = F.lit(0).cast("long")
    turnless = rebuilt.filter("length = 0").select(zero.alias("depth"), zero.alias("hi"), zero.alias("lo"), "conv_id")
    ends = save(spark, members.filter("last").select(*_NODE, "conv_id").unionByName(turnless), "trie-ends")
    order = [*_NODE, "conv_id"]
    node = "depth long, hi long, lo long"
    strings = map_arrow(ends.repartitionByRange(*order).sortWithinPartitions(*order), _strings, f"{node}, first long, ids string")
    strings = save(spark, strings, "trie-end-strings")
    return map_arrow(strings.repartition(*_NODE).sortWithinPartitions(*_NODE, "first"), _digests, f"{node}, ends_sha256 string")


def prefix_trie(spark: SparkSession, conversations: DataFrame, base: Column | None = None, head: Column | None = None, max_head: int = MAX_HEAD) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations.

    ``base`` and ``head`` are columns over ``conv_id``: which conversation's first turns replace
    how many (0 to ``max_head``) of the own ones. By default nothing is replaced.

    Returns ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves`` (childless nodes in the subtree), ``saved_tokens`` (words of the subtree's turns that its
    members share, times all members but one), ``ends_sha256`` (of the ids of the members that end here,
    ascending, comma-joined) and the stored turn the node ends with: ``source``, ``place`` (from 1; NULL for the root).
    """
    base = F.col("conv_id") if base is None else base
    head = F.lit(0) if head is None else head
    turns = turn_table(spark, conversations)
    rebuilt = rebuilt_table(spark, turns, base, head, max_head)
    members = member_table(spark, turns, rebuilt, max_head)
    nodes = node_table(spark, members, rebuilt)
    charged = segmented_scan(spark, nodes, "owner", [F.col("owner"), F.col("depth")], Sums("charge"), "trie-charges")

    # what a conversation adds to every node on its path: its charges, and 1 if it is the smallest in a leaf
    shares = charged.groupBy(F.col("owner").alias("conv_id")).agg(F.sum("charge").alias("saved"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    shares = save(spark, shares.filter("saved > 0 OR leaf > 0"), "trie-shares")
    zero = F.lit(0).cast("long")
    paths = members.select(*_NODE, "conv_id").join(shares, "conv_id").select(*_NODE, "saved", "leaf")
    roots = shares.select(zero.alias("depth"), zero.alias("hi"), zero.alias("lo"), "saved", "leaf")
    own = charged.withColumns({"saved": -F.coalesce("before", zero), "first": F.col("before").isNull()}).drop("upto", "before", "charge", "words")
    rows = own.unionByName(paths.unionByName(roots), allowMissingColumns=True)
    rows = rows.unionByName(end_digests(spark, members, rebuilt), allowMissingColumns=True)
    values = ("owner", "n_convs", "n_children", "parent_hi", "parent_lo", "first", "source", "place", "ends_sha256")
    whole = rows.groupBy(*_NODE).agg(*(F.max(c).alias(c) for c in values), F.sum("saved").alias("saved_tokens"), F.coalesce(F.sum("leaf"), zero).alias("n_leaves"))
    whole = save(spark, whole, "trie-whole")

    # the parent has the same smallest member but for the first node that each conversation is charged for
    root = whole.filter("depth = 0").select("owner").first()  # one row
    firsts = whole.filter("first AND depth > 1")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("hi").alias("parent_hi"), F.col("lo").alias("parent_lo"), F.col("owner").alias("parent"))
    found = firsts.join(parents, ["depth", "parent_hi", "parent_lo"])
    rest = whole.filter("depth < 2 OR NOT first")
    plain = F.when(F.col("depth") == 1, F.lit(root["owner"] if root else None).cast("long")).when(F.col("depth") > 1, F.col("owner"))
    out = rest.withColumn("parent", plain).unionByName(found)
    empty = hashlib.sha256(b"").hexdigest()
    return out.select(
        F.col("owner").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"), "source", "place",
    )
