"""Chat formatting by quotation linking, with built-in functions only.

Messages quote others by lines that begin with ``>`` (one per level). Every
message is parsed into passages, runs of lines of one level. The quoted
passages are cut into units (the whole passage, its paragraphs, its lines),
normalised and hashed, and joined to the units that other messages wrote
themselves. A message replies to the earlier message of its conversation that
most of its shallowest linked quotation comes from. Conversations then come out
in reply order and without quotations: by thread (the message at the root of
the replies, in turn order), then by turn, so a reply follows what it answers.

Of all messages of a conversation that wrote a unit themselves, the first one
is its original: one row per (conversation, unit) is left before the join, so
a sentence that everybody uses meets every quotation once. A quotation whose
original is not in the conversation is linked to the first message anywhere
that wrote it (``source_conv``, ``source_turn``), which does not change the order.
Inside a conversation units of any length are linked; only links to other
conversations need :data:`MIN_UNIT` characters.

Defined results: a quotation is linked by whole units, so a part of a sentence
that is no line of its own is not; a passage of nothing but ASCII punctuation is
one unit, as written without blanks; NULL and empty texts have no passages and stay, empty;
messages of a NULL ``conv_id`` form a conversation; a NULL ``turn`` comes first and
is never an original; messages that share ``conv_id`` and ``turn`` are ordered by
a hash of role and text; a message without a linked quotation begins a thread;
other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import save

QUOTE = r"^[ \t]*>[> \t]*"
# Shorter units (in characters) are linked inside their conversation only.
MIN_UNIT = 12
# Between two sentences: blanks after a full stop and closing signs; nothing after a full-width one.
SENTENCE = r"""(?<=[.!?…]["'”’»)\]]{0,3})\s+|(?<=[。！？｡][」』”’）]{0,3})(?![。！？｡」』”’）])"""


def parse(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, role, mark, own, passages``: ``passages`` holds ``level`` and ``text`` of each
    run of lines of one level, ``own`` the lines that are not quoted."""
    lines = F.split(F.coalesce("text", F.lit("")), "\r?\n")

    def line(x: Column) -> Column:
        level = F.length(F.regexp_replace(F.regexp_extract(x, QUOTE, 0), "[^>]", ""))
        return F.struct(level.alias("level"), F.when(level > 0, F.regexp_replace(x, QUOTE, "")).otherwise(x).alias("body"))

    rows = messages.select("conv_id", "turn", "role", F.xxhash64("role", "text").alias("mark"), F.transform(lines, line).alias("lines"))
    at = lambda i: F.element_at("lines", i)
    begins = F.filter(
        F.sequence(F.lit(1), F.size("lines")),
        lambda i: (i == 1) | (at(i)["level"] != at(F.greatest(i - 1, F.lit(1)))["level"]),
    )
    rows = rows.withColumn("begins", begins)

    def passage(b: Column, k: Column) -> Column:
        last = F.coalesce(F.try_element_at("begins", k + 2), F.size("lines") + 1)
        body = F.array_join(F.transform(F.slice("lines", b, last - b), lambda x: x["body"]), "\n")
        return F.struct(at(b)["level"].alias("level"), body.alias("text"))

    own = F.array_join(F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["body"]), "\n")
    return rows.select(
        "conv_id",
        "turn",
        "role",
        "mark",
        F.regexp_replace(F.regexp_replace(own, r"^\s+|\s+$", ""), r"\n{3,}", "\n\n").alias("own"),
        F.transform("begins", passage).alias("passages"),
    )


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[\s\p{Punct}]+", " "))


def _units(text: Column) -> Column:
    """The distinct normalised units of a passage: the whole, its paragraphs, its lines and the sentences of both."""
    cuts = [r"\n[ \t]*\n", r"\n", rf"\n[ \t]*\n|{SENTENCE}", rf"\n|{SENTENCE}"]
    parts = F.concat(F.array(text), *[F.split(text, c) for c in cuts])
    units = F.filter(F.array_distinct(F.transform(parts, _normal)), lambda u: u != "")
    signs = F.filter(F.array(F.regexp_replace(text, r"\s+", "")), lambda u: u != "")
    return F.when(F.size(units) > 0, units).otherwise(signs)


def _unit_hash(u: str) -> Column:
    """A short unit is hashed with its conversation, so it meets no other one."""
    return F.when(F.length(u) >= MIN_UNIT, F.xxhash64(u)).otherwise(F.xxhash64(u, "conv_id"))


def quoted_units(parsed: DataFrame) -> DataFrame:
    """``conv_id, turn, mark, level, unit, n``: hash and length of every quoted unit."""
    quoted = parsed.select("conv_id", "turn", "mark", F.explode(F.filter("passages", lambda p: p["level"] > 0)).alias("p"))
    rows = quoted.select("conv_id", "turn", "mark", F.col("p.level").alias("level"), F.explode(_units(F.col("p.text"))).alias("u"))
    return rows.select("conv_id", "turn", "mark", "level", _unit_hash("u").alias("unit"), F.length("u").alias("n")).distinct()


def link_quotes(spark: SparkSession, parsed: DataFrame, quoted: DataFrame) -> DataFrame:
    """Per message with a linked quotation: ``conv_id, turn, mark, parent_turn, source_conv, source_turn``."""
    asked = quoted.select("unit").distinct()
    wrote = parsed.filter("turn IS NOT NULL").select(
        "conv_id", "turn", F.explode(F.filter("passages", lambda p: p["level"] == 0)).alias("p")
    )
    wrote = wrote.select("conv_id", "turn", F.explode(_units(F.col("p.text"))).alias("u"))
    wrote = wrote.select("conv_id", "turn", _unit_hash("u").alias("unit")).join(asked, "unit", "left_semi")
    here = wrote.groupBy("conv_id", "unit").agg(F.min("turn").alias("first"))
    here = save(spark, here, "quote-originals")
    anywhere = here.groupBy("unit").agg(F.min(F.struct("conv_id", "first")).alias("source"))
    local = here.select(F.col("conv_id").alias("_conv"), F.col("unit").alias("_unit"), "first")
    met = quoted.join(local, (F.col("unit") == F.col("_unit")) & F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    met = met.join(anywhere, "unit")
    found = F.when(F.col("first") < F.col("turn"), F.col("first"))
    outside = F.when(found.isNull() & ~F.col("source.conv_id").eqNullSafe(F.col("conv_id")), F.col("source"))
    met = met.select("conv_id", "turn", "mark", "level", "n", found.alias("found"), outside.alias("outside"))
    keys = ["conv_id", "turn", "mark"]
    # how much of each level comes from each original
    parts = met.groupBy(*keys, "level", "found", "outside").agg(F.sum("n").alias("n"))
    best = F.struct((-F.col("level")).alias("l"), "n", "found")
    links = parts.groupBy(*keys).agg(
        F.max_by("found", F.when(F.col("found").isNotNull(), best)).alias("parent_turn"),
        F.max_by("outside", F.when(F.col("outside").isNotNull(), F.struct("n", "outside"))).alias("o"),
    )
    return links.select(*keys, "parent_turn", F.col("o.conv_id").alias("source_conv"), F.col("o.first").alias("source_turn"))


def threads(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``conv_id, turn, thread, depth`` of every replying turn, by pointer jumping.

    A reply points to an earlier turn, so the pointers reach the roots in as
    many rounds as the logarithm of the longest chain of replies.
    """
    up = links.filter("parent_turn IS NOT NULL").groupBy("conv_id", "turn").agg(F.min("parent_turn").alias("thread"))
    state = save(spark, up.withColumn("depth", F.lit(1).cast("long")), "threads")
    while True:
        above = state.select(F.col("conv_id").alias("_c"), F.col("turn").alias("_t"), F.col("thread").alias("_up"), F.col("depth").alias("_d"))
        met = state.join(above, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("thread") == F.col("_t")), "left")
        if met.filter("_up IS NOT NULL").isEmpty():
            return state
        depth = F.col("depth") + F.coalesce("_d", F.lit(0))
        state = save(spark, met.select("conv_id", "turn", F.coalesce("_up", "thread").alias("thread"), depth.alias("depth")), "threads")


def reply_ordered(spark: SparkSession, messages: DataFrame) -> DataFrame:
    """``conv_id, position, turn, role, text, thread, depth, parent_turn, source_conv, source_turn, n_quoted``
    of all ``messages(conv_id, turn, role, text)``.

    ``text`` has no quotations, ``position`` counts a conversation's messages from
    0 in reply order, ``n_quoted`` counts the quoted passages. Positions come from
    one range-partitioned sort of all messages, so a conversation of any length
    is spread over many tasks.
    """
    parsed = save(spark, parse(messages), "quote-parsed")
    quoted = save(spark, quoted_units(parsed), "quote-units")
    links = save(spark, link_quotes(spark, parsed, quoted), "quote-links")
    tree = threads(spark, links)
    n = F.size(F.filter("passages", lambda p: p["level"] > 0)).cast("long")
    rows = parsed.select("conv_id", "turn", "role", "mark", F.col("own").alias("text"), n.alias("n_quoted"))
    l = links.select(*[F.col(c).alias(f"_{c}") for c in ("conv_id", "turn", "mark")], "parent_turn", "source_conv", "source_turn")  # noqa: E741
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    rows = rows.join(l, same("conv_id", "_conv_id") & same("turn", "_turn") & (F.col("mark") == F.col("_mark")), "left")
    t = tree.select(F.col("conv_id").alias("_c"), F.col("turn").alias("_t"), F.col("thread").alias("_thread"), "depth")
    rows = rows.join(t, same("conv_id", "_c") & same("turn", "_t"), "left")
    rows = rows.select(
        "conv_id", "turn", "role", "mark", "text", "n_quoted", "parent_turn", "source_conv", "source_turn",
        F.coalesce("_thread", "turn").alias("thread"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
    )
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "thread", "turn", "mark")]
    local = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    laid = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    laid = save(spark, laid.withColumns({"_part": F.spark_partition_id(), "_at": local}), "quote-order")
    parts = laid.groupBy("_part").agg(F.count("*").alias("all"))  # one row per task
    before = F.coalesce(F.sum("all").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    laid = laid.join(parts.select("_part", before.alias("_before")), "_part").withColumn("_at", F.col("_before") + F.col("_at"))
    begin = laid.groupBy(F.col("conv_id").alias("_c")).agg(F.min("_at").alias("_begin"))
    return laid.join(begin, same("conv_id", "_c")).select(
        "conv_id", (F.col("_at") - F.col("_begin")).alias("position"), "turn", "role", "text", "thread", "depth",
        "parent_turn", "source_conv", "source_turn", "n_quoted",
    )
