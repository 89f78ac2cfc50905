"""Row records, ``{measurement, timestamp?, fields, tags?}``, to wide rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoloom.functions.timeunits import generated_time, moment_of



def record_rows(
    df: DataFrame,
    field_names: Sequence[str] | None = None,
    tag_names: Sequence[str] | None = None,
    now_us: int | None = None,
) -> DataFrame:
    """Rows of records: ``measurement, time``, then tags and fields as columns.

    ``fields`` and ``tags`` are structs or maps. Keys of a map are taken from ``field_names`` or ``tag_names``, else
    found by one distinct pass. A tag hides a field of the same name. A missing timestamp becomes ``now_us``. A record
    without a measurement or without any field is an error.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    if "measurement" not in kinds:
        raise ValueError("record must have 'measurement'")
    if "fields" not in kinds:
        raise ValueError("record must have 'fields'")
    fields = cells(df, "fields", field_names)
    tags = cells(df, "tags", tag_names) if "tags" in kinds else {}
    if not fields:
        raise ValueError("record must have 'fields'")
    if "time" in fields or "time" in tags:
        raise ValueError("a tag or field may not be called 'time'")

    stamp = generated_time(moment_of(df, now_us))
    given = F.timestamp_micros(F.col("timestamp").cast("bigint")) if "timestamp" in kinds else F.lit(None)
    time = F.when(~has_fields(kinds["fields"], F.col("fields")), F.raise_error(F.lit("record must have 'fields'")))
    name = F.col("measurement")
    named = F.when(F.coalesce(name, F.lit("")) == "", F.raise_error(F.lit("record must have 'measurement'")))
    return df.select(
        named.otherwise(name).alias("measurement"),
        time.otherwise(F.coalesce(given, stamp)).alias("time"),
        *[value.alias(key) for key, value in merged(fields, tags).items()],
    )


def merged(fields: dict[str, tuple[Column, T.DataType]], tags: dict[str, tuple[Column, T.DataType]]) -> dict[str, Column]:
    """Columns of both parts; on equal names the tag, where it is set, goes before the field."""
    out = {key: value for key, (value, _) in tags.items()}
    for key, (value, kind) in fields.items():
        if key not in tags:
            out[key] = value
        else:
            tag, tag_kind = tags[key]
            out[key] = F.coalesce(tag, value if kind == tag_kind else value.cast(tag_kind))
    return out


def has_fields(kind: T.DataType, fields: Column) -> Column:
    """Whether a record holds any field."""
    if isinstance(kind, T.MapType):
        return F.coalesce(F.size(fields) > 0, F.lit(False))
    found = F.lit(False)
    for field in kind.fields:
        found = found | fields[field.name].isNotNull()
    return found


def cells(
    df: DataFrame, column: str, names: Sequence[str] | None = None, prefix: str = ""
) -> dict[str, tuple[Column, T.DataType]]:
    """Value and type by key of a struct or map column."""
    path = f"{prefix}{column}"
    kind = df.select(path).schema[0].dataType
    if isinstance(kind, T.StructType):
        return {f.name: (F.col(path)[f.name], f.dataType) for f in kind.fields}
    if not isinstance(kind, T.MapType):
        raise ValueError(f"{column!r} must be a struct or a map")
    keys = map_keys(df, path) if names is None else names
    return {key: (F.try_element_at(F.col(path), F.lit(key)), kind.valueType) for key in keys}


def map_keys(df: DataFrame, column: str) -> list[str]:
    """Distinct keys of a map column, reduced on the map side to one row per key and task."""
    keys = df.select(F.explode(F.map_keys(column)).alias("key")).distinct()
    return sorted(row.key for row in keys.toLocalIterator())


def tags_in(df: DataFrame, tag_names: Sequence[str] | None = None, column: str = "tags") -> list[str]:
    """Names of the tags of records, or of the items of mixed batches with ``column`` as ``item.tags``."""
    head, _, last = column.rpartition(".")
    there = df.select(f"{head}.*") if head else df
    return list(cells(df, last, tag_names, f"{head}." if head else "")) if last in there.columns else []
