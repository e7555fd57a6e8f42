"""Dense numbers for the rows of a large table without one task that sees them all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path


def number_rows(spark: SparkSession, df: DataFrame, order: Sequence[Column], name: str = "number", start: int = 1) -> DataFrame:
    """``df`` with ``name``: ``start``, ``start`` + 1, ... in the order of ``order``; the result is a stored table.

    The rows are dealt by ranges of ``order`` and numbered inside each range; the ranges' sizes (one
    row each) go to the driver and come back as offsets.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    path = fresh_path(spark, "numbered")
    numbered = dealt.withColumns({"_range": F.spark_partition_id(), "_place": place})
    numbered.write.parquet(path)
    numbered = spark.read.schema(numbered.schema).parquet(path)
    sizes = sorted((r["_range"], r["n"]) for r in numbered.groupBy("_range").agg(F.count("*").alias("n")).collect())
    before, total = [], start
    for part, n in sizes:
        before.append((part, total))
        total += n
    offsets = F.broadcast(spark.createDataFrame(before, "_range int, _before long"))
    return numbered.join(offsets, "_range").withColumn(name, F.col("_before") + F.col("_place")).drop("_range", "_place", "_before")
