"""Data-quality checks: NULL counts, an input profile, sample rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import top_k

NULL_CHECK_COLUMNS: dict[str, str] = {
    "endpoint": "null_endpoints",
    "method": "null_methods",
    "server": "null_servers",
}


def null_counts(logs: DataFrame, columns: dict[str, str] | None = None) -> DataFrame:
    """One row with a NULL count per column, in one pass (0 on empty input)."""
    columns = columns or NULL_CHECK_COLUMNS
    return logs.agg(*[F.count_if(F.col(c).isNull()).alias(alias) for c, alias in columns.items()])


def profile_input(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: ``position, column_name, data_type, records, nulls``.

    The row count and every NULL count come from a single global aggregate
    (partial per task, one row per task to the final step); the per-column
    rows are then unfolded from that one row.
    """
    names = list(columns or df.columns)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    counts = df.agg(
        F.count("*").alias("_records"),
        *[F.count_if(F.col(c).isNull()).alias(f"_nulls_{i}") for i, c in enumerate(names)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("position"),
                F.lit(c).alias("column_name"),
                F.lit(types[c]).alias("data_type"),
                F.col("_records").alias("records"),
                F.col(f"_nulls_{i}").alias("nulls"),
            )
            for i, c in enumerate(names)
        ]
    )
    return counts.select(F.inline(rows))


def partition_profile(df: DataFrame) -> DataFrame:
    """``partition_id, records``: how the input is spread over its partitions."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(F.count("*").alias("records"))


def sample_rows(df: DataFrame, n: int = 3, key: Sequence[str] = ("timestamp",)) -> DataFrame:
    """The first ``n`` rows by ``key`` (a deterministic sample when ``key`` is unique)."""
    return top_k(df, n, asc=list(key))
