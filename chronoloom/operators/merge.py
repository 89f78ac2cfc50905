"""Union of batches with different columns, and counts per measurement."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def check_kinds(name: str, old: T.DataType, new: T.DataType) -> None:
    """Refuse a column whose type changes; numbers may differ in width."""
    times = (T.TimestampType, T.TimestampNTZType)
    if old == new or all(isinstance(kind, T.NumericType) for kind in (old, new)):
        return
    if all(isinstance(kind, times) for kind in (old, new)):
        return
    if T.NullType() in (old, new):
        return
    raise ValueError(f"column {name!r} is {old.simpleString()} in one place and {new.simpleString()} in another")


def sparse_merge(batches: Sequence[DataFrame]) -> DataFrame:
    """Rows of all batches; a cell whose batch lacks the column is null. No shuffle."""
    if not batches:
        raise ValueError("nothing to merge")
    kinds: dict[str, T.DataType] = {}
    for batch in batches:
        for field in batch.schema.fields:
            check_kinds(field.name, kinds.setdefault(field.name, field.dataType), field.dataType)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)


def rows_per_measurement(df: DataFrame, total: bool = False) -> DataFrame:
    """``measurement, rows``; with ``total`` also one row with a null measurement for all."""
    counts = df.groupBy("measurement").agg(F.count(F.lit(1)).alias("rows"))
    # The rollup sees the counts only: over the rows it would double them before they are counted.
    return counts.rollup("measurement").agg(F.sum("rows").alias("rows")) if total else counts
