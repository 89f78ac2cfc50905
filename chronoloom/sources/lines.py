"""Line-protocol text to typed rows, with built-in string functions only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoloom.functions.linetext import (
    FIELD_PAIR,
    FIELDS,
    HEAD,
    KEY_SPECIAL,
    MEASUREMENT_SPECIAL,
    NAME,
    TAG_PAIR,
    escape,
    field_kind,
    field_value,
    unescape,
)
from chronoloom.functions.timeunits import generated_time, moment_of, nanos_to_time



def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files; ``.gz`` files are read as they are."""
    return spark.read.text(path)


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Cut each line into its parts; blank lines and comments are left out.

    Gives ``measurement, tag_keys, tag_values, field_keys, field_values, time_ns, line``. A line off the grammar has a
    null measurement.

    Each regex runs once over its own part of the line. The parts pass through a generator of one row on the way: a
    filter on the measurement stops there, where otherwise Catalyst would push it to the scan with all the regexes
    behind it, and run them again for every column.
    """
    text = F.trim(F.col(column))
    cut = lines.filter((text != "") & ~text.startswith("#"))
    cut = cut.select(F.rtrim(F.col(column), F.lit(" \r\n")).alias("line"))
    cut = cut.select("line", F.regexp_extract("line", HEAD, 0).alias("head"))
    cut = cut.select("line", "head", F.substring("line", F.length("head") + F.lit(2), F.length("line")).alias("rest"))
    cut = cut.select("line", "head", "rest", F.regexp_extract("rest", FIELDS, 0).alias("fields"))
    cut = cut.select(
        "line", "head", "fields", F.substring("rest", F.length("fields") + F.lit(1), F.length("rest")).alias("tail")
    )
    cut = cut.select("line", "head", "fields", "tail", F.expr("try_cast(substring(tail, 2) AS bigint)").alias("time"))
    timed = F.col("tail").startswith(" ") & F.col("time").isNotNull()
    valid = (F.col("head") != "") & (F.col("fields") != "") & ((F.col("tail") == "") | timed)
    name = F.when(
        F.col("head").contains("\\"), unescape(F.regexp_extract("head", f"(?s)^{NAME}", 0), MEASUREMENT_SPECIAL)
    ).otherwise(F.substring_index("head", ",", 1))
    whole = F.struct(
        F.when(valid, name).alias("measurement"),
        F.when(valid, F.col("head")).alias("head"),
        F.when(valid, F.col("fields")).alias("fields"),
        F.when(valid, F.col("time")).alias("time_ns"),
        F.col("line").alias("line"),
    )
    return cut.select(F.inline(F.array(whole))).select(
        "measurement",
        F.regexp_extract_all("head", F.lit(TAG_PAIR), F.lit(1)).alias("tag_keys"),
        F.regexp_extract_all("head", F.lit(TAG_PAIR), F.lit(2)).alias("tag_values"),
        F.regexp_extract_all("fields", F.lit(FIELD_PAIR), F.lit(1)).alias("field_keys"),
        F.regexp_extract_all("fields", F.lit(FIELD_PAIR), F.lit(2)).alias("field_values"),
        "time_ns",
        "line",
    )


def rejects(parsed: DataFrame) -> DataFrame:
    """Lines off the grammar."""
    return parsed.filter(F.col("measurement").isNull()).select("line")


def line_schema(parsed: DataFrame) -> DataFrame:
    """Keys in use: ``measurement, part (tag or field), key, type``.

    One distinct pass; map-side it shrinks to one row per key, whatever the number of lines.
    """
    tag = F.transform(
        "tag_keys", lambda k: F.struct(F.lit("tag").alias("part"), k.alias("key"), F.lit("string").alias("type"))
    )
    field = F.transform(
        F.arrays_zip("field_keys", "field_values"),
        lambda e: F.struct(
            F.lit("field").alias("part"), e["field_keys"].alias("key"), field_kind(e["field_values"]).alias("type")
        ),
    )
    keys = parsed.filter(F.col("measurement").isNotNull()).select(
        "measurement", F.explode_outer(F.concat(tag, field)).alias("k")
    )
    distinct = keys.filter(F.col("k").isNotNull()).select("measurement", "k.part", "k.key", "k.type").distinct()
    return distinct.withColumn("key", unescape(F.col("key"), KEY_SPECIAL))


def known_schemas(parsed: DataFrame) -> dict[str, tuple[list[str], dict[str, str]]]:
    """Tags and typed fields of each measurement, looked up by ``line_schema`` in one pass."""
    kinds: dict[str, dict[tuple[str, str], set[str]]] = {}
    # One row for each column that a table will have; they come a partition at a time.
    for row in line_schema(parsed).toLocalIterator():
        kinds.setdefault(row.measurement, {}).setdefault((row.part, row.key), set()).add(row.type)
    return {name: _typed_keys(name, keys) for name, keys in sorted(kinds.items())}


def _typed_keys(measurement: str, keys: dict[tuple[str, str], set[str]]) -> tuple[list[str], dict[str, str]]:
    fields = {}
    for (part, key), types in sorted(keys.items()):
        if part == "tag":
            continue
        if types == {"bigint", "double"}:
            types = {"double"}
        if len(types) > 1:
            raise ValueError(f"field {key!r} of {measurement!r} has several types: {', '.join(sorted(types))}")
        (fields[key],) = types
    return sorted(key for part, key in keys if part == "tag"), fields


def _lookup(keys: str, values: str, key: str) -> Column:
    position = F.array_position(keys, escape(key, KEY_SPECIAL)).cast("int")
    return F.when(position > 0, F.get(F.col(values), position - F.lit(1)))


def typed_rows(
    parsed: DataFrame,
    measurement: str,
    tags: Sequence[str],
    fields: Mapping[str, str],
    now_us: int | None = None,
) -> DataFrame:
    """Rows of one measurement: ``time``, tags as strings, fields in the given types.

    With tags and fields named, parsing and typing are one narrow stage, in batch and on a stream. On equal names the
    tag wins. Lines without a time take ``now_us``.
    """
    if not fields:
        raise ValueError("fields cannot be empty")
    if "time" in tags or "time" in fields:
        raise ValueError("a tag or field may not be called 'time'")
    stamp = generated_time(moment_of(parsed, now_us))
    columns = [F.coalesce(nanos_to_time(F.col("time_ns")), stamp).alias("time")]
    for key in tags:
        columns.append(unescape(_lookup("tag_keys", "tag_values", key), KEY_SPECIAL).alias(key))
    for key, kind in fields.items():
        if key not in tags:
            columns.append(field_value(_lookup("field_keys", "field_values", key), _type(kind)).alias(key))
    return parsed.filter(F.col("measurement") == measurement).select(*columns)


def _type(kind: str) -> T.DataType:
    known = {"string": T.StringType(), "bigint": T.LongType(), "boolean": T.BooleanType(), "double": T.DoubleType()}
    if kind not in known:
        raise ValueError(f"a field type is one of {', '.join(known)}, not {kind!r}")
    return known[kind]
