"""Similarity join of documents on word shingles (Jaccard), with components.

Equal shingle sets are one set from the start, however many documents share
them. Two different sets can only be similar if the first ``n - ceil(t n) + 1``
shingles of both, in one global order, have a shingle in common (prefix
filter). The order is rare-first: a fixed table of counters over all documents
(:data:`SLOTS`) bounds every shingle's frequency from above; ties go by hash, so
any counting error costs work and never a link. Prefix shingles are shuffled
once; length and positional filters are applied where they meet, and a suffix
filter (a bound on the sets' difference from counts per hash range): a coarse one
inside the join, a finer one before any set is fetched. What is left is verified
once per pair on the whole sets.

Pairs inside a large group of similar sets are not enumerated. First every set
is verified against one set it shares most prefix shingles with (a hub of one
of its shingles). Then only sets in different components of the links
found so far are paired: a link inside a component changes nothing, so no link
between components is lost.

Sets are named by a 64-bit hash of their shingles, shingles by a 64-bit hash of
their words. Defined results: documents without words have an empty set and
are linked with nothing; fewer words than a shingle are one shingle; a NULL
``doc_id`` belongs to its component but never names it unless it has no other
name; repeated rows share a set; other columns are left out.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow, row_hash, save, whole_row
from .components import components
from .textkernel import LOWER, U64, runs, shingle_hashes, span_hashes, splitmix, text_bytes, word_spans

SHINGLE = 5
PERCENT = 80  # similar: 100 * intersection >= PERCENT * union
# Counters of the frequency table (a power of two) and how many go into one row of it.
SLOTS = 1 << 22
BLOCK = 1 << 12
# Bits of the table of wanted sets.
WANTED_BITS = 1 << 26
# Hash ranges of the coarse suffix filter, which is part of the join.
RANGES = 64
COARSE = [f"c{i}" for i in range(RANGES // 8)]
# Sets remembered by a task to write equal ones once.
SEEN = 1 << 20


def doc_sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Number and sorted distinct shingles of each text."""
    raw, off = text_bytes(column)
    low = LOWER[raw]
    starts, _, first = word_spans(low, off)
    hashes, place = shingle_hashes(span_hashes(low, starts), first, SHINGLE)
    for i in range(len(off) - 1):
        yield i, np.unique(hashes[place[i] : place[i + 1]])


def set_name(s: np.ndarray) -> int:
    """A signed 64-bit name of a set."""
    mixed = splitmix(s ^ U64(0x5851F42D4C957F2D))
    total = mixed.sum(dtype=U64, keepdims=True) ^ splitmix(np.bitwise_xor.reduce(mixed, keepdims=True) + U64(len(s)))
    return int(splitmix(total).view(np.int64)[0])


def spread(s: np.ndarray) -> bytes:
    """Counts of a sorted set per hash range: a power of two of ranges with about 2 shingles each."""
    ranges = 1 << max(6, int(max(1, len(s) // 2) - 1).bit_length())
    counts = np.bincount((s >> U64(64 - ranges.bit_length() + 1)).astype(np.int64), minlength=ranges)
    return np.minimum(counts, 65535).astype("<u2").tobytes()


def coarse(s: np.ndarray) -> np.ndarray:
    """Counts of a sorted set in :data:`RANGES` hash ranges, one byte each (255: that or more), as longs."""
    counts = np.bincount((s >> U64(64 - RANGES.bit_length() + 1)).astype(np.int64), minlength=RANGES)
    return np.minimum(counts, 255).astype(np.uint8).view("<i8")


def _coarse_difference(a: str, b: str) -> Column:
    """A lower bound of the symmetric difference of two sets from the longs of :func:`coarse`."""
    terms = []
    for i in range(RANGES // 8):
        for j in range(0, 64, 8):
            byte = lambda s: F.shiftrightunsigned(f"{s}{i}", j).bitwiseAND(F.lit(255))  # noqa: E731, B023
            terms.append(F.abs(byte(a) - byte(b)))
    return functools.reduce(lambda x, y: x + y, terms)


def least_difference(a: bytes, b: bytes) -> int:
    """A lower bound of the symmetric difference of two sets from their :func:`spread`."""
    x, y = np.frombuffer(a, "<u2").astype(np.int64), np.frombuffer(b, "<u2").astype(np.int64)
    if len(x) < len(y):
        x, y = y, x
    return int(np.abs(x.reshape(len(y), -1).sum(axis=1) - y).sum())


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for run in runs(batch):
            sets = [s for _, s in doc_sets(run.column("text"))]
            found = [(set_name(s), len(s), spread(s)) if len(s) else (None, 0, None) for s in sets]
            name, n, counts = zip(*found, strict=True)
            bytes_ = np.array([coarse(s) for s in sets], np.int64).reshape(-1, len(COARSE))
            yield pa.RecordBatch.from_arrays(
                [run.column("doc_id"), run.column("mark"), pa.array(name, pa.int64()), pa.array(n, pa.int64()), pa.array(counts, pa.binary()), *(pa.array(c) for c in bytes_.T.copy())],
                names=["doc_id", "mark", "set_id", "n", "spread", *COARSE],
            )


def set_table(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Stored table ``doc_id, mark, set_id, n`` and the counts per hash range of all documents
    (``set_id`` NULL: empty set)."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    out = T.StructType([rows.schema["doc_id"], T.StructField("mark", T.LongType()), T.StructField("set_id", T.LongType())])
    out = out.add("n", T.LongType()).add("spread", T.BinaryType())
    for name in COARSE:
        out = out.add(name, T.LongType())
    return save(spark, map_arrow(rows, _sets, out), "jaccard-sets")


def _slots(slots: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(slots, np.int64)
    for batch in batches:
        for run in runs(batch):
            found = [s for _, s in doc_sets(run.column("text"))]
            np.add.at(total, (np.concatenate(found) & U64(slots - 1)).astype(np.int64), 1)
    # a counter that overflows is as frequent as any other such
    rows = np.minimum(total, 65535).astype("<u2").reshape(-1, BLOCK)
    full = np.flatnonzero(rows.any(axis=1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(full), pa.array([rows[i].tobytes() for i in full], pa.binary())], names=["block", "counts"]
    )


def _add_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            if block not in total:
                total[block] = np.zeros(BLOCK, np.int64)
            total[block] += np.frombuffer(counts, "<u2")
    # eight steps per doubling are order enough
    level = [np.minimum(8 * np.log2(total[b] + 1.0), 255).astype(np.uint8).tobytes() for b in total]
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(level, pa.binary())], names=["block", "level"])


def frequency_levels(docs: DataFrame, slots: int = SLOTS) -> bytes:
    """One level (0 to 255, growing with the number of documents) per slot: ``slots`` bytes."""
    if slots < BLOCK or slots & (slots - 1):
        raise ValueError(f"slots must be a power of two, {BLOCK} or more")
    parts = map_arrow(docs.select("text"), functools.partial(_slots, slots), "block long, counts binary").repartition("block")
    rows = map_arrow(parts, _add_slots, "block long, level binary").collect()  # slots bytes at most
    out = np.zeros(slots, np.uint8)
    for r in rows:
        out[r["block"] * BLOCK : (r["block"] + 1) * BLOCK] = np.frombuffer(r["level"], np.uint8)
    return out.tobytes()


def _postings(levels: bytes, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    level = np.frombuffer(levels, np.uint8)
    seen: set[int] = set()
    for batch in batches:
        for run in runs(batch):
            tokens, names, sizes, places = [np.empty(0, U64)], [], [], []
            for _, s in doc_sets(run.column("text")):
                if not len(s) or (name := set_name(s)) in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(name)
                n = len(s)
                prefix = n - (PERCENT * n + 99) // 100 + 1
                order = np.lexsort((s, level[(s & U64(len(level) - 1)).astype(np.int64)]))[:prefix]
                tokens.append(s[order])
                names.append(np.full(prefix, name))
                sizes.append(np.full(prefix, n))
                places.append(np.arange(prefix))
            cols = [np.concatenate(c) if c else np.empty(0, np.int64) for c in (names, sizes, places)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(tokens).view(np.int64)),
                    pa.array(cols[0].astype(np.int64)),
                    *(pa.array(c.astype(np.int32)) for c in cols[1:]),
                ],
                names=["token", "set_id", "n", "pos"],
            )


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by token, size and set: those of tokens of two or more sets, each once. Rows
    stream through; only the first row of the last token is remembered."""
    last: tuple | None = None  # token, set, n, pos; put out once a second set shows up
    waiting = False
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(c).to_numpy() for c in ("token", "set_id", "n", "pos")]
        if last is not None:  # carry it over as a first row
            cols = [np.concatenate([[v], c]).astype(c.dtype) for v, c in zip(last, cols, strict=True)]
        carried = last is not None
        token, name = cols[0], cols[1]
        new = np.ones(len(token), bool)
        new[1:] = token[1:] != token[:-1]
        first = np.flatnonzero(new)
        head = np.repeat(first, np.diff(np.append(first, len(token))))
        # equal rows of one set (from different tasks) count once
        again = np.zeros(len(token), bool)
        again[1:] = ~new[1:] & (name[1:] == name[:-1])
        other = ~new & ~again & (name != name[head])
        many = np.zeros(len(token), bool)
        many[head[other]] = True
        put = other | many
        if carried and not waiting:
            put[0] = False
        at = np.flatnonzero(put)
        yield pa.RecordBatch.from_arrays([pa.array(c[at]) for c in cols], names=["token", "set_id", "n", "pos"])
        begin = first[-1]
        waiting = not many[begin] and (waiting if carried and begin == 0 else True)
        last = tuple(c[begin] for c in cols)


def shared_postings(spark: SparkSession, docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Stored ``token, set_id, n, pos`` for prefix shingles that two sets share."""
    rows = map_arrow(
        docs.select("text"), functools.partial(_postings, frequency_levels(docs, slots)), "token long, set_id long, n int, pos int"
    )
    dealt = rows.repartition("token").sortWithinPartitions("token", "n", "set_id", "pos")
    return save(spark, map_arrow(dealt, _shared, "token long, set_id long, n int, pos int"), "jaccard-shared")


def _hubs(shared: DataFrame) -> DataFrame:
    """``token, hub, hub_n, hub_pos``: of the sets that share a token, the one most of whose prefix is shared.

    What others were copied from has no rare shingles of its own, so it comes
    out as the hub of its copies.
    """
    of = shared.groupBy("set_id").agg((F.count("*") / F.first("n")).alias("part")).withColumnRenamed("set_id", "_set")
    best = F.max(F.struct("part", "set_id", "n", "pos")).alias("h")
    hubs = shared.join(of, F.col("set_id") == F.col("_set")).groupBy("token").agg(best)
    return hubs.select("token", F.col("h.set_id").alias("hub"), F.col("h.n").alias("hub_n"), F.col("h.pos").alias("hub_pos"))


def _can_link(n: Column, pos: Column, m: Column, at: Column) -> Column:
    """Length filter, and positional filter for a first common prefix shingle."""
    length = (F.least(n, m) * 100) >= (F.greatest(n, m) * PERCENT)
    need = F.ceil((n + m) * PERCENT / F.lit(100.0 + PERCENT) - 1e-9)
    return length & (1 + F.least(n - pos - 1, m - at - 1) >= need)


def _suffix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drops pairs whose counts per hash range differ by more than similar sets can."""
    for batch in batches:
        n, m = batch.column("a_n").to_pylist(), batch.column("b_n").to_pylist()
        x, y = batch.column("a_spread").to_pylist(), batch.column("b_spread").to_pylist()
        keep = [
            # similar sets have 180 * overlap >= 80 * (n + m), and differ in n + m - 2 * overlap
            (100 + PERCENT) * (n[i] + m[i] - least_difference(x[i], y[i])) >= 2 * PERCENT * (n[i] + m[i])
            for i in range(batch.num_rows)
        ]
        yield batch.select(["a", "b", "weight"]).filter(pa.array(keep, pa.bool_()))


def suffix_filter(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs(a, b, weight)`` that the counts per hash range don't rule out."""
    one = sets.select("set_id", "n", "spread")
    a, b = (one.select(*[F.col(c).alias(f"{s}_{c}") for c in one.columns]) for s in "ab")
    both = pairs.join(a, F.col("a") == F.col("a_set_id")).join(b, F.col("b") == F.col("b_set_id"))
    both = both.select("a", "b", "weight", "a_n", "b_n", "a_spread", "b_spread")
    return map_arrow(both, _suffix, "a long, b long, weight long")


def _wanted(bits: bytes, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = np.frombuffer(bits, np.uint8)
    seen: set[int] = set()
    for batch in batches:
        for run in runs(batch):
            names, sets = [], []
            for _, s in doc_sets(run.column("text")):
                if not len(s):
                    continue
                name = set_name(s)
                slot = name % WANTED_BITS
                if not table[slot >> 3] >> (slot & 7) & 1 or name in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(name)
                names.append(name)
                sets.append(s.astype("<u8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(sets, pa.binary())], names=["set_id", "shingles"])


def fetch_sets(spark: SparkSession, docs: DataFrame, names: DataFrame) -> DataFrame:
    """Stored ``set_id, shingles`` of the sets in ``names(set_id)``, and few others.

    The documents are read again; which sets are wanted is told by a bit table of
    fixed size, so neither texts nor names are shuffled or gathered for it.
    """
    slot = F.pmod("set_id", F.lit(WANTED_BITS)).cast("long")
    # Spark's bitmap functions count from 1 within buckets of 32768 bits
    parts = names.select((slot + 1).alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
    rows = parts.agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).collect()  # WANTED_BITS at most
    bits = bytearray(WANTED_BITS // 8)
    for r in rows:
        bits[(r["bucket"] - 1) * 4096 : (r["bucket"] - 1) * 4096 + len(r["bits"])] = r["bits"]
    rows = map_arrow(docs.select("text"), functools.partial(_wanted, bytes(bits)), "set_id long, shingles binary")
    return save(spark, rows.join(names.select("set_id").distinct(), "set_id", "left_semi").dropDuplicates(["set_id"]), "jaccard-whole")


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("a_shingles").to_pylist(), batch.column("b_shingles").to_pylist(), strict=True):
            x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
            common = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * common >= PERCENT * (len(x) + len(y) - common))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def verify(spark: SparkSession, docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs of the stored ``pairs(a, b)`` whose whole sets are similar."""
    names = pairs.select(F.explode(F.array("a", "b")).alias("set_id"))
    whole = fetch_sets(spark, docs, names)
    a, b = (whole.select(F.col("set_id").alias(s), F.col("shingles").alias(f"{s}_shingles")) for s in "ab")
    return save(spark, map_arrow(pairs.select("a", "b").join(a, "a").join(b, "b"), _verify, "a long, b long"), "jaccard-links")


def _ordered_pairs(rows: DataFrame) -> DataFrame:
    """One row per unordered pair of ``rows(a, b)`` with how often it occurs."""
    return rows.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.count("*").alias("weight"))


def set_components(spark: SparkSession, docs: DataFrame, sets: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``a, b``: every linked set but the smallest of its component, with that smallest."""
    one = save(spark, sets.filter("n > 0").groupBy("set_id").agg(*[F.first(c).alias(c) for c in ("n", "spread", *COARSE)]), "jaccard-one")
    shared = shared_postings(spark, docs, slots)
    # 1: every set against the hub it shares most prefix shingles with
    met = shared.join(save(spark, _hubs(shared), "jaccard-hubs"), "token").filter("set_id <> hub").filter(_can_link(F.col("n"), F.col("pos"), F.col("hub_n"), F.col("hub_pos")))
    met = met.groupBy("set_id", "hub").agg(F.count("*").alias("weight"))
    pairs = suffix_filter(met.select(F.col("set_id").alias("a"), F.col("hub").alias("b"), "weight"), one)
    best = pairs.groupBy("a").agg(F.max_by("b", F.struct("weight", "b")).alias("b"))
    links = verify(spark, docs, save(spark, _ordered_pairs(best).select("a", "b"), "jaccard-pairs"))
    found = components(spark, links)
    # 2: all pairs of sets in different components
    tagged = shared.select("token", "set_id", "n", "pos").join(found.withColumnRenamed("a", "set_id"), "set_id", "left")
    tagged = tagged.select("token", "set_id", "n", "pos", F.coalesce("b", "set_id").alias("comp"))
    mixed = tagged.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi")
    tagged = tagged.join(mixed.select("token"), "token", "left_semi").join(one.select("set_id", *COARSE), "set_id")
    tagged = save(spark, tagged, "jaccard-mixed")
    # per component: its sizes, and the most that any of its sets has left from the token on
    left_over = F.max(F.col("n") - F.col("pos")).alias("rest")
    groups = tagged.groupBy("token", "comp").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), left_over)
    other = groups.select("token", *[F.col(c).alias(f"{c}2") for c in ("comp", "lo", "hi", "rest")])
    near = (F.col("hi") * 100 >= F.col("lo2") * PERCENT) & (F.col("hi2") * 100 >= F.col("lo") * PERCENT)
    near &= F.least("rest", "rest2") * (100 + PERCENT) >= (F.col("lo") + F.col("lo2")) * PERCENT
    met = groups.join(other, "token").filter((F.col("comp") < F.col("comp2")) & near).select("token", "comp", "comp2", "lo2", "hi2", "rest2")
    left = tagged.select("token", "comp", F.col("set_id").alias("a"), "n", "pos", *[F.col(c).alias(f"a{i}") for i, c in enumerate(COARSE)])
    right = tagged.select("token", F.col("comp").alias("comp2"), F.col("set_id").alias("b"), F.col("n").alias("m"), F.col("pos").alias("at"), *[F.col(c).alias(f"b{i}") for i, c in enumerate(COARSE)])
    # a set that the best of the other component's sets could not match is left out before they are paired
    may = (F.col("n") * 100 >= F.col("lo2") * PERCENT) & (F.col("hi2") * 100 >= F.col("n") * PERCENT)
    may &= F.least(F.col("n") - F.col("pos"), "rest2") * (100 + PERCENT) >= (F.col("n") + F.col("lo2")) * PERCENT
    met = met.join(left, ["token", "comp"]).filter(may).join(right, ["token", "comp2"])
    both = F.col("n") + F.col("m")
    # similar sets have 180 * overlap >= 80 * (n + m), and differ in n + m - 2 * overlap
    close = (both - _coarse_difference("a", "b")) * (100 + PERCENT) >= both * (2 * PERCENT)
    met = met.filter(_can_link(F.col("n"), F.col("pos"), F.col("m"), F.col("at"))).filter(close)
    pairs = save(spark, suffix_filter(_ordered_pairs(met.select("a", "b")), one), "jaccard-pairs")
    more = verify(spark, docs, pairs)
    return components(spark, links.union(more))


def _placed(spark: SparkSession, docs: DataFrame, slots: int) -> tuple[DataFrame, DataFrame]:
    """Stored ``doc_id, mark, set_id, n, root`` of the documents with shingles, and the sets of all documents."""
    sets = set_table(spark, docs)
    roots = set_components(spark, docs, sets, slots)
    placed = sets.filter("n > 0").join(roots.withColumnRenamed("a", "set_id"), "set_id", "left")
    # stored, so that a join of it by root is one of plain scans and a component of very many documents can be split
    return save(spark, placed.select("doc_id", "mark", "set_id", "n", F.coalesce("b", "set_id").alias("root")), "jaccard-placed"), sets


def similar_documents(spark: SparkSession, docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``doc_id, mark, set_id, n_shingles, root, component_id`` per document of ``docs(doc_id, text)``.

    ``component_id`` is the smallest ``doc_id`` reachable over links (itself
    included); ``mark`` tells texts of one ``doc_id`` apart. ``root`` (the smallest
    ``set_id``; NULL for an empty set) names the component itself: several
    components have the same ``component_id`` where ids are NULL or repeated.
    ``slots`` (a power of two) counters order the shingles, a byte each is broadcast: the result does not
    depend on them, the pairs to look at do. Give about as many as there are thousands of different shingles.
    """
    placed, sets = _placed(spark, docs, slots)
    named = save(spark, placed.groupBy("root").agg(F.min("doc_id").alias("component_id")), "jaccard-named")
    full = placed.join(named, "root").select("doc_id", "mark", "set_id", F.col("n").alias("n_shingles"), "root", "component_id")
    none = F.lit(None).cast("long").alias("root")
    empty = sets.filter("n = 0").select("doc_id", "mark", "set_id", F.col("n").alias("n_shingles"), none, F.col("doc_id").alias("component_id"))
    return full.union(empty)


def keep_one(spark: SparkSession, docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``docs`` with one document (the smallest) of each component; documents with an empty set all stay.

    Of rows alike in id and text the one with the smallest hash of all its columns
    stays (:func:`.common.row_hash`), and of wholly equal rows one; other columns may have any names.
    """
    placed, sets = _placed(spark, docs, slots)
    least = placed.groupBy("root").agg(F.min(F.struct(F.isnull("doc_id").alias("x"), "doc_id", "mark")).alias("s"))
    stay = least.select(F.xxhash64("s.doc_id").alias("_id"), F.col("s.mark").alias("_mark")).distinct()
    keys = [F.xxhash64("doc_id").alias("_id"), F.xxhash64("text").alias("_mark"), row_hash(docs).alias("_hash")]
    # per id and text: the hash of the row that stays, and how many rows have it (no text is moved for it)
    alike = docs.select(*keys).groupBy("_id", "_mark", "_hash").agg(F.count("*").alias("_n"))
    chosen = alike.groupBy("_id", "_mark").agg(F.min(F.struct("_hash", "_n")).alias("s"))
    chosen = chosen.select("_id", "_mark", F.col("s._hash").alias("_chosen"), "s._n").join(stay, ["_id", "_mark"])
    empty = sets.filter("n = 0").select(F.xxhash64("doc_id").alias("_id"), F.col("mark").alias("_mark")).distinct()
    # the two kinds have no (id, text) in common, as the text decides whether a set is empty; an empty one has no hash
    decided = save(spark, chosen.unionByName(empty, allowMissingColumns=True), "jaccard-stay")
    kept = docs.select(whole_row(docs), *keys).join(decided, ["_id", "_mark"]).filter("_chosen IS NULL OR _hash = _chosen")
    alone = F.col("_n").isNull() | (F.col("_n") == 1)
    more = kept.filter(~alone).groupBy("_id", "_mark").agg(F.first("row").alias("row"))  # wholly equal rows
    return kept.filter(alone).select("row").union(more.select("row")).select("row.*")
