"""Running products of a monoid over ordered rows, however long a segment is.

The rows are dealt by ranges of their order and scanned range by range; a
segment (the rows of one key) may run through many ranges. Only the product at
the end of each range goes to the driver, which folds them into what each range
has to add in front: one element per range, whatever the number of rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow, save


class Monoid:
    """Elements are Python values; ``lift`` reads one per row, ``store``/``load`` convert them to Arrow."""

    ddl: str

    def lift(self, batch: pa.RecordBatch) -> list:
        raise NotImplementedError

    def mul(self, a, b):
        raise NotImplementedError

    def store(self, elements: list) -> pa.Array:
        raise NotImplementedError

    def load(self, column: pa.Array) -> list:
        return [None if v is None else self.load_value(v) for v in column.to_pylist()]

    def load_value(self, value):
        """The element of a stored value (a number, or a struct as dict or Row)."""
        return value


class Sums(Monoid):
    """Whole numbers of one column under addition."""

    ddl = "long"

    def __init__(self, column: str):
        self.column = column

    def lift(self, batch: pa.RecordBatch) -> list:
        return batch.column(self.column).to_pylist()

    def mul(self, a: int, b: int) -> int:
        return a + b

    def store(self, elements: list) -> pa.Array:
        return pa.array(elements, pa.int64())


def _local(monoid: Monoid, segment: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    last, product, head, at = None, None, True, 0
    for batch in batches:
        upto, before, heads = [], [], []
        for key, element in zip(batch.column(segment).to_pylist(), monoid.lift(batch), strict=True):
            if key != last:
                head = at == 0 and not upto
                last, product = key, None
            before.append(product)
            product = element if product is None else monoid.mul(product, element)
            upto.append(product)
            heads.append(head)
        n = len(upto)
        found = [monoid.store(upto), monoid.store(before), pa.array([part] * n, pa.int32()), pa.array(range(at, at + n), pa.int64()), pa.array(heads, pa.bool_())]
        at += n
        yield pa.RecordBatch.from_arrays([*batch.columns, *found], names=[*batch.schema.names, *_ADDED])


_ADDED = ["upto", "before", "slice", "at", "head"]


def _carry(monoid: Monoid, carries: dict, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.schema.names
        add = [carries.get(s) if h else None for s, h in zip(batch.column("slice").to_pylist(), batch.column("head").to_pylist(), strict=True)]
        columns = [c for c, name in zip(batch.columns, names, strict=True) if name not in _ADDED]
        for name in ("upto", "before"):
            found = monoid.load(batch.column(name))
            columns.append(monoid.store([x if c is None else c if x is None else monoid.mul(c, x) for c, x in zip(add, found, strict=True)]))
        yield pa.RecordBatch.from_arrays(columns, names=[n for n in names if n not in _ADDED] + ["upto", "before"])


def segmented_scan(spark: SparkSession, df: DataFrame, segment: str, order: list[Column], monoid: Monoid, name: str) -> DataFrame:
    """``df`` with ``upto`` and ``before``: the product of its segment's rows up to this one, and without it (NULL: none).

    ``order`` sorts all rows and must begin with ``segment`` (a whole number, not NULL).
    ``df`` should be a stored table, as dealing by ranges reads it twice.
    """
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    fields = df.schema.fields
    extra = f"upto {monoid.ddl}, before {monoid.ddl}"
    local_schema = T.StructType(fields + T.StructType.fromDDL(f"{extra}, slice int, at long, head boolean").fields)
    local = save(spark, map_arrow(sorted_rows, functools.partial(_local, monoid, segment), local_schema), f"{name}-local")
    ends = local.groupBy("slice").agg(
        F.min_by(segment, "at").alias("first"), F.max_by(segment, "at").alias("last"), F.max_by("upto", "at").alias("total")
    )
    carries, open_key, open_product = {}, None, None
    for row in sorted(ends.collect(), key=lambda r: r["slice"]):  # one row per range
        total = monoid.load_value(row["total"])
        if open_product is not None and row["first"] == open_key:
            carries[row["slice"]] = open_product
            if row["first"] == row["last"]:
                total = monoid.mul(open_product, total)
        open_key, open_product = row["last"], total
    out = T.StructType(fields + T.StructType.fromDDL(extra).fields)
    return save(spark, map_arrow(local, functools.partial(_carry, monoid, carries), out), name)
