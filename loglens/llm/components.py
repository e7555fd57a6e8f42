"""Connected components of a link table, by alternating large-star and small-star steps.

Every step is one aggregate (combined before the shuffle) and one join; a
vertex with very many links is split by the skew join. The links of a step are
written to the shared folder, so the lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import save

MAX_ROUNDS = 60


def _fingerprint(links: DataFrame) -> tuple:
    row = links.agg(F.count("*").alias("n"), F.sum(F.hash("a", "b").cast("long")).alias("h")).first()
    return row["n"], row["h"]


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a vertex is linked to the smallest of its neighbourhood."""
    both = links.select("a", "b").union(links.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A vertex and its smaller neighbours are linked to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    others = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``a, b``: every vertex of ``links(a, b)`` but the smallest of its component, with that smallest.

    Links of a vertex to itself and repeated links are ignored.
    """
    now = save(spark, links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = _fingerprint(now)
    for _ in range(MAX_ROUNDS):
        now = save(spark, _small_star(_large_star(now)), "links")
        after = _fingerprint(now)
        if after == before:
            return now
        before = after
    raise RuntimeError("the components did not settle")
