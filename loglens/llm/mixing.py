"""Mixing sources to target weights by entropy balancing.

Every document gets a rate (expected number of copies) in ``[0, cap]``. Among
all rates whose words add up to the target of each source, the chosen ones are
the closest to the base rate 1 in (box-constrained) relative entropy. The
convex dual has one multiplier per source and its solution is an exponential
tilt of the document size, ``rate = cap * sigmoid(a + lambda * size / scale)``
with ``sigmoid(a) = 1 / cap``. The dual is solved by safeguarded Newton steps;
each step is one distributed aggregation.

A rate depends on (source, size) only, so the documents are first reduced to
counts per (source, size): exact, and bounded by the number of different sizes
however large a source is. Rates become whole copies by systematic rounding
along the sizes of a source: the copies of every prefix differ from the summed
rates by less than one, so the words taken from a source miss its target by
less than about its longest document, and the best of a fixed set of rounding
offsets usually brings them far nearer.

Defined results: a NULL source is a source of its own; a document without
words (or with NULL text) has size 0, takes 0 words and gets no copy; identical rows are
separate documents; equal sizes are told apart by a hash of the row key, so
reruns agree; an empty input gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import count_words, group_key, row_hash, save, whole_row

MAX_NEWTON_STEPS = 80
# Documents of one (source, size) are ranked in slices of about this many.
RANK_SLICE = 1024
# Rounding offsets tried per source.
OFFSETS = 64


def source_targets(
    sizes: DataFrame, weights: Sequence[float], share: float = 1.0, cap: float = 2.0
) -> DataFrame:
    """``_g, source_size, target`` per source of ``sizes(source, size)``.

    Sources in code point order (NULL last) get ``weights`` in turn and share
    ``share`` times all words. A target stops at ``cap`` times its source's
    words and the excess is shared again by weight among the others. Solved
    in closed form: in order of cap / weight, a source is capped when its fair
    part of what is left reaches its cap.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (place + 1).cast("int"))
    per = per.withColumn("_w", w).withColumn("_cap", F.col("source_size") * F.lit(float(cap)))
    order = W.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("_cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("source_size").over(W.partitionBy()) * F.lit(float(share)) - before
    level = left / F.sum("_w").over(order.rowsBetween(W.currentRow, W.unboundedFollowing))
    per = per.withColumn("_level", level).withColumn("_capped", F.col("_level") * F.col("_w") >= F.col("_cap"))
    # the level of the first source that is not capped holds for all that are not
    # (it falls from there on, so it is their largest)
    final = F.max(F.when(~F.col("_capped"), F.col("_level"))).over(W.partitionBy())
    target = F.when(F.col("_capped"), F.col("_cap")).otherwise(F.least(final * F.col("_w"), F.col("_cap")))
    return per.select(group_key("source").alias("_g"), "source_size", target.alias("target"))


def _rate(cap: float) -> Column:
    a = -math.log(cap - 1.0)
    free = F.lit(cap) / (1 + F.exp(-(F.lit(a) + F.col("lam") * F.col("size") / F.col("scale"))))
    return F.when(F.col("full"), F.lit(cap)).when(F.col("none"), F.lit(0.0)).otherwise(free)


def solve_dual(spark: SparkSession, cells: DataFrame, targets: DataFrame, cap: float) -> DataFrame:
    """Multipliers per source: ``_g, lam, scale, full, none`` from ``cells(_g, size, n)``.

    Newton on the dual gradient (words taken minus target), kept inside a
    shrinking bracket, so it converges from anywhere. The state of a step is a
    small table in the shared folder, one row per source.
    """
    words = cells.filter("size > 0")
    mass = words.groupBy("_g").agg(
        F.sum(F.col("n") * F.col("size")).alias("mass"),
        F.sum(F.col("n") * F.col("size") * F.col("size").cast("double")).alias("square"),
    )
    inf = F.lit(float("inf"))
    state = targets.join(mass, "_g").select(
        "_g",
        "target",
        (F.col("square") / F.col("mass")).alias("scale"),
        (F.col("target") >= F.col("mass") * F.lit(cap * (1 - 1e-12))).alias("full"),
        (F.col("target") <= 0).alias("none"),
        F.lit(0.0).alias("lam"),
        (-inf).alias("lo"),
        inf.alias("hi"),
        F.lit(False).alias("done"),
    )
    state = save(spark, state.withColumn("done", F.col("full") | F.col("none")), "mix-dual")
    for _ in range(MAX_NEWTON_STEPS):
        if state.filter(~F.col("done")).isEmpty():
            break
        rate = _rate(cap)
        x = F.col("size") / F.col("scale")
        keys = state.columns
        taken = F.sum(F.col("n") * F.col("size") * rate)
        slope = F.sum(F.col("n") * F.col("size") * rate * (1 - rate / F.lit(cap)) * x)
        step = words.join(state, "_g").groupBy(*keys).agg(taken.alias("taken"), slope.alias("slope"))
        gap = F.col("target") - F.col("taken")
        lo = F.when(gap > 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(gap < 0, F.col("lam")).otherwise(F.col("hi"))
        newton = F.col("lam") + F.try_divide(gap, F.col("slope"))
        inside = newton.isNotNull() & ~F.isnan(newton) & (newton > lo) & (newton < hi)
        middle = (
            F.when(lo == -inf, hi * 2 - F.abs(hi) - 1).when(hi == inf, lo + F.abs(lo) + 1).otherwise((lo + hi) / 2)
        )
        # without a bracket a step may overshoot by far: at most double the multiplier (plus 4)
        bounded = F.greatest(
            F.least(newton, F.col("lam") + F.abs("lam") + 4), F.col("lam") - F.abs("lam") - 4
        )
        done = F.col("done") | (F.abs(gap) <= F.greatest(F.lit(0.25), F.col("target") * 1e-9)) | (hi - lo < 1e-13)
        state = step.select(
            "_g", "target", "scale", "full", "none",
            F.when(done, F.col("lam")).when(inside, bounded).otherwise(middle).alias("lam"),
            lo.alias("lo"), hi.alias("hi"), done.alias("done"),
        )
        state = save(spark, state, "mix-dual")
    open_ = state.filter(~F.col("done")).count()
    if open_:
        raise RuntimeError(f"{open_} sources' multipliers did not converge in {MAX_NEWTON_STEPS} steps")
    return state.select("_g", "lam", "scale", "full", "none")


def entropy_mix(spark: SparkSession, items: DataFrame, targets: DataFrame, cap: float = 2.0) -> DataFrame:
    """``items(doc_id, _row, source, size)`` with ``rate``, ``copies``, ``target`` and ``source_size``.

    ``items`` must be a stored table (it is read several times); ``_row`` is a
    hash that tells rows apart in the rounding. ``targets`` as from
    :func:`source_targets`. ``cap`` (> 1) bounds every document's copies.
    """
    if cap <= 1:
        raise ValueError("cap must be over 1")
    items = items.withColumn("_g", group_key("source"))
    cells = save(spark, items.groupBy("_g", "size").agg(F.count("*").alias("n")), "mix-cells")
    dual = solve_dual(spark, cells, targets, cap)
    rated = cells.join(dual, "_g", "left").withColumn(
        "rate", F.when(F.col("size") > 0, F.coalesce(_rate(cap), F.lit(0.0))).otherwise(F.lit(0.0))
    )
    along = W.partitionBy("_g").orderBy("size")
    done = F.coalesce(F.sum(F.col("n") * F.col("rate")).over(along.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    rated = save(
        spark,
        rated.withColumn("before", done)
        .withColumn("slices", F.ceil(F.col("n") / RANK_SLICE).cast("long"))
        .select("_g", "size", "n", "rate", "before", "slices"),
        "mix-rates",
    )
    # the rounding offset of a source: of a fixed set, the one whose whole copies come nearest to its target
    tried = F.explode(F.array(*[F.lit((i + 0.5) / OFFSETS) for i in range(OFFSETS)]))
    reach = F.col("before") + F.col("n") * F.col("rate")
    taken = F.sum(F.col("size") * (F.floor(reach + F.col("offset")) - F.floor(F.col("before") + F.col("offset"))))
    offsets = (
        rated.withColumn("offset", tried)
        .groupBy("_g", "offset")
        .agg(taken.alias("taken"))
        .join(targets, "_g")
        .groupBy("_g")
        .agg(F.min_by("offset", F.struct(F.abs(F.col("taken") - F.col("target")), "offset")).alias("offset"))
    )
    rated = save(spark, rated.join(offsets, "_g"), "mix-offsets")
    # rank the documents of a (source, size) in slices, so that no task ranks a large group
    big = rated.filter("slices > 1").select("_g", "size", "slices")
    mark = F.xxhash64("doc_id", "_row")
    sliced = items.join(big, ["_g", "size"], "left").withColumn(
        "slice", F.pmod(mark, F.coalesce(F.col("slices"), F.lit(1).cast("long")))
    ).drop("slices")
    parts = sliced.groupBy("_g", "size", "slice").agg(F.count("*").alias("m"))
    upto = W.partitionBy("_g", "size").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.withColumn("skip", F.coalesce(F.sum("m").over(upto), F.lit(0)))
    start = F.col("before") + F.col("skip") * F.col("rate")
    end = F.col("before") + (F.col("skip") + F.col("m")) * F.col("rate")
    whole = F.floor(end + F.col("offset")) - F.floor(start + F.col("offset"))
    parts = parts.join(rated, ["_g", "size"]).select(
        "_g", "size", "slice", "m", "rate", F.least(whole, F.floor(F.col("m") * F.lit(cap))).alias("whole")
    )
    rank = F.row_number().over(W.partitionBy("_g", "size", "slice").orderBy(F.xxhash64("_row", "doc_id"), "doc_id"))
    extra = F.when(F.col("_rank") <= F.col("whole") % F.col("m"), 1).otherwise(0)
    copies = F.floor(F.col("whole") / F.col("m")) + extra
    return (
        sliced.withColumn("_rank", rank)
        .join(parts, ["_g", "size", "slice"])
        .withColumn("copies", copies.cast("long"))
        .join(targets, "_g", "left")
        .select("doc_id", "_row", "source", "size", "source_size", "target", "rate", "copies")
    )


def size_table(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``doc_id, _row, source, size`` of all documents, stored once (texts are read here only)."""
    sizes = docs.select("doc_id", F.xxhash64("doc_id", "text", "source").alias("_row"), "source", count_words("text").alias("size"))
    return save(spark, sizes, "mix-sizes")


def mix_documents(
    spark: SparkSession, docs: DataFrame, weights: Sequence[float], share: float = 1.0, cap: float = 2.0
) -> DataFrame:
    """The mixed corpus: every document of ``docs`` as often as the mix takes it, with its columns.

    Documents of size 0 (NULL or blank text) have rate 0, so they all leave the
    mixed corpus. Copies are joined back on the row key, so the texts are shuffled once.
    Rows alike in id, text and source share the copies in the order of a hash of all
    their columns (:func:`.common.row_hash`); other columns may have any names.
    """
    items = size_table(spark, docs)
    mixed = entropy_mix(spark, items, source_targets(items, weights, share, cap), cap)
    # rows alike in id, text and source: so many of them are taken so often
    found = mixed.select(F.xxhash64("doc_id").alias("_id"), "_row", "copies").groupBy("_id", "_row", "copies").agg(F.count("*").alias("_m"))
    upto = F.sum("_m").over(W.partitionBy("_id", "_row").orderBy("copies"))  # at most cap + 1 different numbers of copies
    found = found.select("_id", "_row", F.col("copies").alias("_copies"), (upto - F.col("_m")).alias("_from"), upto.alias("_to"))
    keys = [F.xxhash64("doc_id").alias("_id"), F.xxhash64("doc_id", "text", "source").alias("_row")]
    # which of them: in the order of a hash of all columns; of wholly equal rows it does not matter
    alike = docs.select(*keys, row_hash(docs).alias("_hash")).groupBy("_id", "_row", "_hash").agg(F.count("*").alias("_n"))
    rank = F.sum("_n").over(W.partitionBy("_id", "_row").orderBy("_hash")) - F.col("_n")
    alike = alike.withColumn("_first", rank)
    shares = alike.join(found, ["_id", "_row"]).withColumn(
        "_part", F.least(F.col("_first") + F.col("_n"), "_to") - F.greatest("_first", "_from")
    )  # how many of these rows are taken _copies times
    shares = shares.filter("_part > 0 AND _copies > 0").groupBy("_id", "_row", "_hash").agg(F.sum(F.col("_part") * F.col("_copies")).alias("_all"), F.max("_n").alias("_n"))
    shares = save(spark, shares, "mix-shares")
    keyed = docs.select(whole_row(docs), *keys, row_hash(docs).alias("_hash")).join(shares, ["_id", "_row", "_hash"])
    # wholly equal rows: one of them stands for all
    one = keyed.filter("_n = 1").select("row", "_all")
    more = keyed.filter("_n > 1").groupBy("_id", "_row", "_hash").agg(F.first("row").alias("row"), F.first("_all").alias("_all"))
    out = one.union(more.select("row", "_all"))
    return out.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_all")))).select("row.*")
