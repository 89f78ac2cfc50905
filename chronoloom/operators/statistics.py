"""Statistics of measurements by day, kept in a table and merged, from which queries are estimated without a look at their data.

``ANALYZE`` reads a whole table again for each new row. Here a day's statistics are one small row, worked out once and again only
when files of the day have come or changed; all of them merge: counts add up, bounds widen, and distinct values are counted by the
union of HyperLogLog sketches.
"""

from __future__ import annotations

import math
from datetime import date
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoloom.functions.timeunits import now_micros
from chronoloom.operators.measurements import DAY, days_of, exists, quoted, read
from chronoloom.operators.pruning import _items, _name, _parts, scans

DAY_STATISTICS = "_day_statistics"
SCHEMA = (
    "measurement string, day date, rows bigint, bytes bigint, "
    "columns map<string, struct<low: string, high: string, nulls: bigint, sketch: binary, mean: double, longest: int>>, taken bigint"
)
_ORDERED = (T.NumericType, T.TimestampType, T.DateType)
#: How moments are noted, in UTC.
_MOMENT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _columns(table: DataFrame) -> list[T.StructField]:
    """Columns that statistics are taken of: not the rows' day, and no nested ones."""
    kinds = (*_ORDERED, T.StringType, T.BooleanType)
    return [f for f in table.schema.fields if isinstance(f.dataType, kinds) and f.name != DAY]


def _kept(spark: SparkSession, database: str, measurement: str) -> DataFrame:
    """The newest statistics of each day that the measurement has."""
    rows = spark.table(quoted(database, DAY_STATISTICS)).filter(F.col("measurement") == measurement)
    days = spark.createDataFrame([(day,) for day in days_of(spark, database, measurement)], f"{DAY} date")
    rows = rows.join(days, DAY, "left_semi")
    newest = rows.groupBy(DAY).agg(F.max("taken").alias("taken"))
    return rows.join(newest, [DAY, "taken"])


def refresh_statistics(spark: SparkSession, database: str, measurement: str) -> list[date]:
    """Take the statistics of days with files that came since the last time, or of all; gives these days.

    File times tell which, so the other days are not opened. Files that went and left none behind in their day are not noticed until the
    day changes again. Times of files and of the driver are compared, so their clocks have to agree.
    """
    now = now_micros()
    table = read(spark, database, measurement)
    name = quoted(database, DAY_STATISTICS)
    rows = table
    if exists(spark, database, DAY_STATISTICS):
        noted = spark.table(name).filter(F.col("measurement") == measurement)
        since = noted.agg(F.max("taken").alias("taken")).first().taken
        if since is not None:
            # File times may be whole seconds, so the second of the last time is looked at again.
            second = F.timestamp_seconds(F.lit(since // 1_000_000))
            changed = table.filter(F.col("_metadata.file_modification_time") >= second)
            days = [row[DAY] for row in changed.select(DAY).distinct().collect()]
            if not days:
                return []
            rows = table.filter(F.col(DAY).isin(days))
    else:
        spark.sql(f"CREATE TABLE {name} ({SCHEMA}) USING parquet")
    fields = _columns(table)
    # One row a task and day is shuffled: counts, bounds and sketches are combined before.
    taken = rows.groupBy(DAY).agg(
        F.count(F.lit(1)).alias("rows"), *[_of_column(f).alias(f"c{i}") for i, f in enumerate(fields)]
    )
    pairs = [part for i, f in enumerate(fields) for part in (F.lit(f.name), F.col(f"c{i}"))]
    width = sum((F.coalesce(F.col(f"c{i}.mean"), F.lit(0.0)) for i in range(len(fields))), F.lit(0.0))
    taken = taken.select(
        F.lit(measurement).alias("measurement"),
        DAY,
        "rows",
        F.ceil(F.col("rows") * width).cast("bigint").alias("bytes"),
        F.create_map(*pairs).alias("columns"),
        F.lit(now).cast("bigint").alias("taken"),
    )
    taken.coalesce(1).write.insertInto(name)
    spark.catalog.refreshTable(name)
    newest = spark.table(name).filter((F.col("measurement") == measurement) & (F.col("taken") == now))
    return sorted(row[DAY] for row in newest.select(DAY).collect())


def _of_column(field: T.StructField) -> Column:
    value = F.col(quoted(field.name))
    text = value.cast("string")
    ordered = isinstance(field.dataType, _ORDERED)
    low, high = (_written(f(value), field) if ordered else F.lit(None).cast("string") for f in (F.min, F.max))
    return F.struct(
        low.alias("low"),
        high.alias("high"),
        F.count_if(value.isNull()).alias("nulls"),
        F.hll_sketch_agg(text).alias("sketch"),
        F.avg(F.octet_length(text)).alias("mean"),
        F.max(F.octet_length(text)).alias("longest"),
    )


def _written(value: Column, field: T.StructField) -> Column:
    return F.date_format(value, _MOMENT) if isinstance(field.dataType, T.TimestampType) else value.cast("string")


def merged_statistics(spark: SparkSession, database: str, measurement: str) -> DataFrame | None:
    """``column, kind, rows, bytes, low, high, nulls, distinct, mean, longest`` of a measurement's noted days; None if none are.

    One row for each column, worked out from the noted rows alone; the measurement is not read.
    """
    if not exists(spark, database, DAY_STATISTICS):
        return None
    days = _kept(spark, database, measurement)
    totals = days.agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes")).first()
    if totals.rows is None:
        return None
    kinds = {f.name: f.dataType for f in _columns(read(spark, database, measurement))}
    columns = days.select("rows", F.explode("columns").alias("column", "of")).select("rows", "column", "of.*")
    parts = []
    for kind in sorted({k.simpleString() for k in kinds.values()}):
        names = [name for name, k in kinds.items() if k.simpleString() == kind]
        low, high = F.min(F.col("low").cast(kind)), F.max(F.col("high").cast(kind))
        if kind == "timestamp":
            low, high = F.date_format(low, _MOMENT), F.date_format(high, _MOMENT)
        part = columns.filter(F.col("column").isin(names)).groupBy("column").agg(
            low.cast("string").alias("low"),
            high.cast("string").alias("high"),
            # Days from before a column was there hold nothing but nulls of it.
            F.sum(F.col("rows") - F.col("nulls")).alias("filled"),
            F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct"),
            F.avg("mean").alias("mean"),
            F.max("longest").alias("longest"),
        )
        parts.append(part.withColumn("kind", F.lit(kind)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    rows, size = (F.lit(total).cast("bigint") for total in totals)
    nulls = (rows - F.col("filled")).alias("nulls")
    return out.select(
        "column", "kind", rows.alias("rows"), size.alias("bytes"), "low", "high", nulls, "distinct", "mean", "longest"
    )


def estimated_rows(spark: SparkSession, df: DataFrame) -> int | None:
    """Rows of a query over one measurement, from the noted statistics of its days alone; None where they cannot tell.

    Each day counts with the share of its times that the query's bounds leave. An equality keeps one of the day's distinct values, a limit
    and the distinct values of grouping columns are upper bounds, and other conditions are taken to keep all. Joins, grouping by
    expressions, conditions over groups or limits, and measurements with days that have not been noted are left to others.
    """
    found = scans(df)
    shape = _shape(df._jdf.queryExecution().optimizedPlan()) if len(found) == 1 else None
    if shape is None or not exists(spark, found[0].database, DAY_STATISTICS):
        return None
    scan, (equal, groups, limit) = found[0], shape
    days = _kept(spark, scan.database, scan.measurement)
    if days.count() < len(days_of(spark, scan.database, scan.measurement)):
        return None
    low, high = (F.unix_micros(F.col(f"columns.time.{edge}").cast("timestamp")) for edge in ("low", "high"))
    first = low if scan.low is None else F.greatest(low, F.lit(scan.low).cast("bigint"))
    last = high if scan.high is None else F.least(high, F.lit(scan.high).cast("bigint"))
    rows = F.col("rows") * F.greatest(F.lit(0.0), (last - first + 1) / (high - low + 1))
    for name in equal:
        of = F.col("columns")[F.lit(name)]
        filled = (F.col("rows") - of["nulls"]) / F.col("rows")
        rows = rows * F.coalesce(filled / F.greatest(F.lit(1), F.hll_sketch_estimate(of["sketch"])), F.lit(0.0))
    estimate = round(days.agg(F.sum(rows).alias("rows")).first().rows or 0)
    if groups is not None:
        known = merged_statistics(spark, scan.database, scan.measurement) if groups else None
        distinct = {r["column"]: r["distinct"] + (r["nulls"] > 0) for r in known.collect()} if known is not None else {}
        if not set(groups) <= set(distinct):
            return None
        estimate = min(estimate, math.prod(distinct[name] for name in groups)) if groups else 1
    return estimate if limit is None else min(estimate, limit)


def _shape(node: Any) -> tuple[list[str], list[str] | None, int | None] | None:
    """Columns compared with a value, grouping columns if any, and the limit, of a plan that ends in one scan."""
    equal: list[str] = []
    groups, limit, filtered = None, None, False
    while (kind := _name(node)) != "LogicalRelation":
        if kind == "Filter":
            filtered = True
            for condition in _parts(node.condition()):
                if _name(condition) == "EqualTo":
                    kinds = {_name(side): side for side in (condition.left(), condition.right())}
                    if set(kinds) == {"AttributeReference", "Literal"}:
                        equal.append(kinds["AttributeReference"].name())
        elif kind in ("GlobalLimit", "LocalLimit") and not filtered and groups is None:
            if _name(node.limitExpr()) != "Literal":
                return None
            limit = int(node.limitExpr().value())
        elif kind == "Aggregate" and not filtered and groups is None:
            keys = _items(node.groupingExpressions())
            if any(_name(key) != "AttributeReference" for key in keys):
                return None
            groups = [key.name() for key in keys]
        elif kind not in ("Project", "Sort"):
            return None
        node = node.children().apply(0)
    # Bounds on times are the scan's, and days follow from them.
    return [name for name in equal if name not in ("time", DAY)], groups, limit
