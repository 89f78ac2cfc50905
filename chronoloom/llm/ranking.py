"""Places and running sums over sorted rows, without one task that holds a whole group, and joins behind a size check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoloom.llm.common import written

#: Rows of a side that may be sent to every executor; both sides are shuffled beyond that.
MAX_SENT_ROWS = 100_000


def looked_up(rows: DataFrame, table: DataFrame, keys: Sequence[str], limit: int = MAX_SENT_ROWS) -> DataFrame:
    """Inner join with a table that has each key once."""
    small = table.limit(limit + 1).count() <= limit
    return rows.join(F.broadcast(table) if small else table, list(keys))


def placed(
    rows: DataFrame, group: Sequence[str], order: Sequence[str | Column], value: str | None = None, name: str = "rank"
) -> DataFrame:
    """Rows with ``rank``, the number of rows before each in its group (or the sum of ``value`` over them), and ``group_size``.

    Columns of ``group`` hold no nulls. Rows are range-partitioned by group and order, so a hot group lies on many tasks,
    and are written in that order; a row's number in its task comes with it. Only one row a group and task is then summed
    up across tasks. Rows equal in all of ``order`` take places in any order.
    """
    taken = rows.repartitionByRange(*group, *order) if group or order else rows
    taken = taken.sortWithinPartitions(*group, *order).withColumn("_at", F.monotonically_increasing_id())
    table = written(taken, "placed").withColumn("_part", F.shiftright("_at", 33))
    amount = F.lit(1) if value is None else F.col(value)
    runs = table.groupBy("_part", *group).agg(F.min("_at").alias("_first"), F.sum(amount).alias("_sum"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = runs.select(
        "_part",
        *group,
        "_first",
        (F.sum("_sum").over(before) - F.col("_sum")).alias("_before"),
        F.sum("_sum").over(whole).alias("group_size"),
    )
    joined = looked_up(table, written(runs, "runs"), ["_part", *group])
    if value is None:
        place = F.col("_before") + F.col("_at") - F.col("_first")
    else:
        inside = Window.partitionBy("_part", *group).orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        place = F.col("_before") + F.sum(value).over(inside) - F.col(value)
    return joined.select(*rows.columns, place.cast("bigint").alias(name), F.col("group_size").cast("bigint").alias("group_size"))
