"""Mixed batches: columnar and row items of several measurements in one payload."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoloom.functions.timeunits import moment_of
from chronoloom.sources.columnar import columnar_rows
from chronoloom.sources.records import cells, has_fields, merged


# Whole and fractional types, from narrow to wide.
_WHOLE, _FRACTIONS = ["tinyint", "smallint", "int", "bigint"], ["float", "double"]


def wider(name: str, one: T.DataType, other: T.DataType) -> T.DataType:
    """The type that holds values of both: the wider of two whole or two fractional ones, double for one of each."""
    kinds = [one.simpleString(), other.simpleString()]
    if one == other or "void" in kinds:
        return other if kinds[0] == "void" else one
    for family in (_WHOLE, _FRACTIONS):
        if all(k in family for k in kinds):
            return one if family.index(kinds[0]) > family.index(kinds[1]) else other
    if all(k in _WHOLE + _FRACTIONS for k in kinds):
        return T.DoubleType()
    raise ValueError(f"column {name!r} holds {kinds[0]} in one item and {kinds[1]} in another")


def exactly(value: Column, items: DataFrame, kind: T.DataType, own: T.DataType | None = None) -> Column:
    """The value in a wider type; a whole number that a double cannot hold is an error."""
    own = items.select(value).schema[0].dataType if own is None else own
    if own == kind or own.simpleString() != "bigint" or kind.simpleString() != "double":
        return value.cast(kind)
    lost = F.abs(value) > F.lit(1 << 53)
    return F.when(lost, F.raise_error(F.concat(F.lit("a double cannot hold "), value.cast("string")))).otherwise(value.cast(kind))


def batch_rows(
    df: DataFrame,
    field_names: Sequence[str] | None = None,
    tag_names: Sequence[str] | None = None,
    now_us: int | None = None,
) -> DataFrame:
    """Rows of mixed batches: ``measurement, time`` and every column of any item, null where an item has none.

    ``batch`` is an array of ``{m, columns}`` and ``{m, t, fields, tags}`` items, held in one struct with the parts
    an item lacks left null; times are microseconds. A row item is taken as a columnar batch of one row, so both kinds
    go through one scan and one explode. An empty batch is an error.
    """
    kind = df.schema["batch"].dataType.elementType
    parts = {f.name: f.dataType for f in kind.fields}
    filled = F.when(
        F.col("batch").isNull() | (F.size("batch") == 0), F.raise_error(F.lit("batch cannot be empty"))
    ).otherwise(F.col("batch"))
    items = df.select(F.explode(filled).alias("item"))

    columnar = {f.name: f.dataType.elementType for f in parts["columns"].fields} if "columns" in parts else {}
    by_row = {}
    if "fields" in parts:
        fields = cells(items, "fields", field_names, "item.")
        tags = cells(items, "tags", tag_names, "item.") if "tags" in parts else {}
        if "time" in fields or "time" in tags:
            raise ValueError("a tag or field may not be called 'time'")
        by_row = merged(fields, tags)
    is_columnar = F.col("item.columns").isNotNull() if "columns" in parts else F.lit(False)

    columns = []
    for name in dict.fromkeys(["time", *columnar, *by_row]):
        if name == "time":
            given = F.col("item.t") if "t" in parts else F.lit(None)
            cell = F.coalesce(given.cast("bigint"), moment_of(df, now_us))
            element = columnar.get("time", T.LongType())
        else:
            cell = by_row.get(name)
            element = columnar.get(name)
            if cell is not None and element is not None:
                element = wider(name, element, items.select(cell).schema[0].dataType)
        single = None if cell is None else F.array(cell if element is None else exactly(cell, items, element))
        if name in columnar:
            array = F.col("item.columns")[name]
            if columnar[name] != element:
                array = F.transform(array, lambda x: exactly(x, items, element, columnar[name]))
            array = F.when(is_columnar, array)
            array = array if single is None else array.otherwise(single)
        else:
            array = F.when(~is_columnar, single)
        columns.append(array.alias(name))

    name = F.col("item.m")
    if "fields" in parts:
        bare = ~is_columnar & ~has_fields(parts["fields"], F.col("item.fields"))
        name = F.when(bare, F.raise_error(F.lit("record must have 'fields'"))).otherwise(name)
    return columnar_rows(items.select(name.alias("m"), F.struct(*columns).alias("columns")), "us", now_us)
