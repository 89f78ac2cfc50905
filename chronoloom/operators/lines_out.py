"""Rows to line protocol."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoloom.functions.linetext import KEY_SPECIAL, MEASUREMENT_SPECIAL, escape, field_text, plain_text
from chronoloom.functions.timeunits import to_nanos


def _time_text(df: DataFrame, column: str, unit: str) -> Column:
    value = F.col(f"`{column}`")
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return to_nanos(F.unix_micros(value.cast("timestamp")), "us").cast("string")
    return to_nanos(value, unit).cast("string")


def _pair(key: str, text: Column) -> Column:
    # Null text makes a null pair, which concat_ws leaves out.
    return F.concat(F.lit(f"{escape(key, KEY_SPECIAL)}="), text)


def _tag_text(value: Column, kind: T.DataType) -> Column:
    text = plain_text(value, kind)
    return F.when(text != "", escape(text, KEY_SPECIAL))


def _map_pairs(pairs: Column, text) -> Column:
    """Pairs of a map, in key order; null text is left out by ``array_join``."""
    parts = F.transform(
        F.sort_array(F.map_entries(pairs)),
        lambda e: F.concat(escape(e["key"], KEY_SPECIAL), F.lit("="), text(e["value"])),
    )
    return F.when(F.size(F.array_compact(parts)) > 0, F.array_join(parts, ","))


def table_lines(
    df: DataFrame,
    measurement: str,
    tags: Sequence[str] = (),
    time_column: str = "time",
    unit: str = "us",
) -> DataFrame:
    """One line per row, in column ``value``; rows whose fields are all null make none.

    ``tags`` names the tag columns; every other column but the time is a field. One narrow projection.
    """
    if not measurement:
        raise ValueError("measurement name cannot be empty")
    if not df.columns:
        raise ValueError("columns cannot be empty")
    missing = [name for name in tags if name not in df.columns]
    if missing:
        raise ValueError(f"tag columns not found: {', '.join(missing)}")
    kinds = {f.name: f.dataType for f in df.schema.fields}
    fields = [name for name in df.columns if name not in tags and name != time_column]
    if not fields:
        raise ValueError("fields cannot be empty")

    def quoted(name: str) -> Column:
        return F.col(f"`{name}`")

    head = F.concat_ws(
        ",",
        F.lit(escape(measurement, MEASUREMENT_SPECIAL)),
        *[_pair(name, _tag_text(quoted(name), kinds[name])) for name in sorted(set(tags) - {time_column})],
    )
    body = F.concat_ws(",", *[_pair(name, field_text(quoted(name), kinds[name])) for name in fields])
    parts = [head, body]
    if time_column in df.columns:
        parts.append(_time_text(df, time_column, unit))
    some_field = reduce(or_, [quoted(name).isNotNull() for name in fields])
    return df.filter(some_field).select(F.concat_ws(" ", *parts).alias("value"))


def record_lines(df: DataFrame, unit: str = "us") -> DataFrame:
    """One line per record ``{measurement, timestamp?, fields, tags?}``, in column ``value``.

    ``fields`` and ``tags`` are structs or maps. A record without a name or without any field is an error.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    if "measurement" not in kinds or "fields" not in kinds:
        raise ValueError("records need the columns 'measurement' and 'fields'")

    if isinstance(kinds["fields"], T.MapType):
        kind = kinds["fields"].valueType
        body = _map_pairs(F.col("fields"), lambda v: field_text(v, kind))
    else:
        pairs = [
            _pair(f.name, field_text(F.col("fields")[f.name], f.dataType)) for f in kinds["fields"].fields
        ]
        body = F.nullif(F.concat_ws(",", *pairs), F.lit(""))

    if "tags" not in kinds:
        tags = F.lit(None).cast("string")
    elif isinstance(kinds["tags"], T.MapType):
        kind = kinds["tags"].valueType
        tags = _map_pairs(F.col("tags"), lambda v: _tag_text(v, kind))
    else:
        ordered = sorted(kinds["tags"].fields, key=lambda f: f.name)
        pairs = [_pair(f.name, _tag_text(F.col("tags")[f.name], f.dataType)) for f in ordered]
        tags = F.nullif(F.concat_ws(",", *pairs), F.lit(""))

    name = F.col("measurement")
    head = F.concat_ws(",", escape(name, MEASUREMENT_SPECIAL), tags)
    parts = [head, body]
    if "timestamp" in kinds:
        parts.append(_time_text(df, "timestamp", unit))
    line = (
        F.when(F.coalesce(name, F.lit("")) == "", F.raise_error(F.lit("measurement name cannot be empty")))
        .when(body.isNull(), F.raise_error(F.lit("fields cannot be empty")))
        .otherwise(F.concat_ws(" ", *parts))
    )
    return df.select(line.alias("value"))


def write_lines(lines: DataFrame, path: str, compression: str | None = "gzip", max_lines: int = 1_000_000) -> None:
    """Write lines as text, gzip by default.

    A gzip file cannot be split on reading, so ``max_lines`` bounds each file and with it the largest read task.
    """
    writer = lines.write.option("maxRecordsPerFile", max_lines).mode("append")
    writer.option("compression", compression or "none").text(path)
